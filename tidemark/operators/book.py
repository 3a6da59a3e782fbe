"""Order-book validity: a feed is cut down to the events that can change a book's state, then replayed by jumps between them.

Nearly all changes of a book continue the one before and change nothing but levels. They are left
out in the JVM, slice by slice, so a connection with a third of all rows is spread over its slices;
what is left per book are snapshots, gaps, breaks and their neighbours, as narrow rows of ids and
times. The replay jumps over these arrays from one change of state to the next. Which book counts
for a symbol follows from the changes of state by windows. Price levels stay in the JVM and are
applied by :func:`tidemark.operators.changes.last_writer`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import is_zero
from tidemark.operators.changes import last_writer
from tidemark.operators.quality import effective_ns
from tidemark.session import cut, small

#: Length of a slice of receive time in which gaps are placed.
SLICE_NS = 600 * 10**9
#: Places of the source, and ids, in a slice of a book that is looked at in one piece.
SLICE, ID_SLICE = 1 << 16, 1 << 24
#: A place behind all others; twice a place is still a bigint.
END = 1 << 61
UNANCHORED, VALID, GAPPED = "UNANCHORED", "VALID", "GAPPED"
DIFF, SNAPSHOT, GAP, RESTORE = range(4)
_KEY = ["exchange_symbol", "connection_id"]


def essential(events: DataFrame, slice_rows: int = SLICE, slice_ids: int = ID_SLICE) -> DataFrame:
    """The events that a replay needs, with ``run``: changes of one run continue each other without a break.

    Left out are changes in the middle of a run whose neighbours are changes as well, unless they
    are the first whose ids reach a snapshot's. First and last of a slice always stay, so slices
    need not know each other; a slice stays whole where its changes are not in the order of their
    numbers and ids, or reach into another slice's. A change in a whole slice is a run of its own.
    """
    is_diff = F.col("kind") == DIFF
    # the first change that reaches a snapshot: the one behind it in the order of ids
    spot = Window.partitionBy(*_KEY, F.expr(f"last div {slice_ids}")).orderBy("last", F.when(is_diff, 1).otherwise(0), "pos")
    e = events.withColumn("hit", F.coalesce(F.lag("kind").over(spot) == SNAPSHOT, F.lit(True)))
    e = e.withColumn("slice", F.expr(f"pos div {slice_rows}"))
    w = Window.partitionBy(*_KEY, "slice").orderBy("pos", "sub", "gap_no")
    before = F.last(F.when(is_diff, F.struct("last", "seq")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    e = e.withColumn("before", before)
    e = e.withColumn("start", is_diff & ~F.coalesce(F.col("previous") == F.col("before.last"), F.lit(False)))
    e = e.withColumn("odd", is_diff & F.coalesce((F.col("seq") < F.col("before.seq")) | (F.col("first") <= F.col("before.last")) | (F.col("last") < F.col("first")), F.lit(False)))
    plain = lambda c: F.coalesce(c, F.lit(False))
    inner = plain((F.lag("kind").over(w) == DIFF) & (F.lead("kind").over(w) == DIFF) & ~F.lead("start").over(w) & ~F.lag("hit").over(w))
    e = e.withColumn("run", F.sum(F.col("start").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("idle", is_diff & ~F.col("start") & ~F.col("hit") & inner)
    of = lambda c: F.when(is_diff, F.col(c))
    s = e.groupBy(*_KEY, "slice").agg(F.bool_or("odd").alias("odd"), *[f(of(c)).alias(f"{n}_{c}") for c in ("seq", "last") for n, f in (("lo", F.min), ("hi", F.max))])
    back = Window.partitionBy(*_KEY).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*_KEY).orderBy("slice").rowsBetween(1, Window.unboundedFollowing)
    whole = F.col("odd")
    for c in ("seq", "last"):
        whole = whole | plain(F.max(f"hi_{c}").over(back) >= F.col(f"lo_{c}")) | plain(F.min(f"lo_{c}").over(ahead) <= F.col(f"hi_{c}"))
    s = s.select(*_KEY, "slice", whole.alias("whole"))
    e = e.drop("odd").join(s, [*_KEY, "slice"])
    run = F.when(is_diff & ~F.col("whole"), F.col("slice") * (2 * slice_rows) + F.col("run"))
    return e.where(F.col("whole") | ~F.col("idle")).select(*events.columns, run.alias("run"))


class Replay(NamedTuple):
    """Changes of state (event, time, state, id, reason), stretches on one base, and how a book stands after its last event.

    A stretch: the event it begins with, the event it ends before, the snapshot or restored book it
    rests on, and the places of the changes that were applied to that by its first event, as pairs
    of first and last. ``waiting``: the snapshot that waits for a change.
    """

    changes: list[tuple[int, int, str, int, str | None]]
    stretches: list[tuple[int, int, int, list[tuple[int, int]]]]
    state: str
    expected: int | None
    waiting: int | None


class Events(NamedTuple):
    """The events of one book in order, as arrays. ``last``: the id after the event; ``run`` below 0: a run of its own."""

    kind: np.ndarray
    pos: np.ndarray
    ns: np.ndarray
    seq: np.ndarray
    first: np.ndarray
    last: np.ndarray
    previous: np.ndarray
    run: np.ndarray


def _ahead(test: Callable[[slice], np.ndarray], at: int, end: int) -> int:
    """The first place from ``at`` on where ``test`` holds, ``end`` if there is none; looks at ever longer stretches."""
    size = 256
    while at < end:
        found = np.flatnonzero(test(slice(at, min(end, at + size))))
        if len(found):
            return at + int(found[0])
        at, size = at + size, size * 4
    return end


def continues(previous: np.ndarray, last: np.ndarray, run: np.ndarray) -> np.ndarray:
    """For neighbouring changes in an order, whether the later continues the earlier."""
    return (previous[1:] == last[:-1]) | ((run[1:] == run[:-1]) & (run[1:] >= 0))


def reached(anchor: int, last: np.ndarray) -> int:
    """The place of the first change that reaches a snapshot's id; their number if none does."""
    return int(np.argmax(last >= anchor)) if (last >= anchor).any() else len(last)


def replay(e: Events) -> Replay:
    """Validity of one book.

    A book becomes valid where a snapshot meets the change that spans its id and all buffered
    changes behind that one continue each other. It stays valid up to the next change that does
    not continue what was before it, or the next gap. Buffered changes are taken by number.
    """
    n = len(e.kind)
    is_diff = e.kind == DIFF
    run = e.run.copy()
    follows = np.ones(n, bool)
    follows[1:] = continues(e.previous, e.last, run)
    follows[1:][is_diff[1:] & ~is_diff[:-1]] = (e.previous[1:] == e.last[:-1])[is_diff[1:] & ~is_diff[:-1]]
    ends = np.flatnonzero((e.kind == GAP) | (is_diff & ~follows))
    marks = np.flatnonzero(~is_diff)
    changes: list[tuple[int, int, str, int, str | None]] = []
    state, at, none = UNANCHORED, 0, np.zeros(0, np.int64)
    stretches: list[tuple[int, int, int, list[tuple[int, int]]]] = []
    anchor: int | None = None
    expected: int | None = None
    kept, since = none, 0  # buffered: these, and all changes from `since` on
    chain, base, turn = none, 0, 0

    def pieces() -> list[tuple[int, int]]:
        ends = np.flatnonzero(~((run[chain][1:] == run[chain][:-1]) & (run[chain][1:] >= 0))) + 1
        return [(int(e.pos[p[0]]), int(e.pos[p[-1]])) for p in np.split(chain, ends) if len(p)]
    while at < n:
        if state == VALID:
            stands = not is_diff[at] or e.previous[at] == expected or (run[at] >= 0 and len(chain) and run[at] == run[chain[-1]])
            k = int(np.searchsorted(ends, at + 1 if stands and e.kind[at] != GAP else at))
            stop = at if not stands or e.kind[at] == GAP else int(ends[k]) if k < len(ends) else n
            if stop > at:
                expected = int(e.last[stop - 1])
            # each snapshot on the way is a new base
            bases = [(turn, base, pieces()), *((int(m), int(m), []) for m in marks[(marks > turn) & (marks < stop)])]
            for (begin, on, parts), until in zip(bases, [*(x[0] for x in bases[1:]), stop], strict=True):
                stretches.append((begin, until, on, parts))
            if stop == n:
                break
            state, chain, kept = GAPPED, none, none
            if e.kind[stop] == GAP:
                changes.append((stop, int(e.ns[stop]), GAPPED, expected, None))
                since = stop + 1
            else:
                changes.append((stop, int(e.ns[stop]), GAPPED, int(e.last[stop]), "pu_discontinuity"))
                since = stop
            at = stop + 1
            continue
        k = int(np.searchsorted(marks, at))
        turn = int(marks[k]) if k < len(marks) else n
        if anchor is not None:
            want = e.last[anchor]
            turn = _ahead(lambda s: (e.first[s] <= want) & (want <= e.last[s]) & is_diff[s], at, turn) if turn > at else turn  # noqa: B023
        if turn == n:
            break
        at = turn + 1
        if e.kind[turn] == GAP:
            state, anchor, kept, since = GAPPED, None, none, at
            continue
        if e.kind[turn] == RESTORE:
            state, expected, base, chain, anchor = VALID, int(e.last[turn]), turn, none, None
            continue
        if e.kind[turn] == SNAPSHOT:
            anchor = turn
        held = np.concatenate([kept, since + np.flatnonzero(is_diff[since:at])])
        held = held[np.argsort(e.seq[held], kind="stable")]
        held = held[reached(int(e.last[anchor]), e.last[held]) :]
        kept, since = held, at
        if not len(held):
            continue
        if e.first[held[0]] > e.last[anchor]:
            anchor = None
            continue
        torn = np.flatnonzero(~continues(e.previous[held], e.last[held], run[held]))
        if len(torn):
            x = int(held[torn[0] + 1])
            changes.append((turn, int(e.ns[x]), GAPPED, int(e.last[x]), "buffered_pu_discontinuity"))
            # what came behind it is lost, so its run does not go on
            state, anchor, kept, run[x] = GAPPED, None, held[torn[0] + 1 : torn[0] + 2], -1
        else:
            expected = int(e.last[held[-1]])
            changes.append((turn, int(max(e.ns[anchor], e.ns[held[0]])), VALID, expected, "snapshot_bridge"))
            state, base, chain, anchor, kept = VALID, anchor, held, None, none
    if state == VALID and (not stretches or stretches[-1][1] < n):  # it became valid with its last event
        stretches.append((turn, n, base, pieces()))
    return Replay(changes, stretches, state, expected, anchor)


_IN = "exchange_symbol string, connection_id string, pos bigint, kind int, ns bigint, seq bigint, first bigint, last bigint, previous bigint, reason string, run bigint"
_TAGGED = "exchange_symbol string, connection_id string, kind string, pos bigint, at_ns bigint, to_pos bigint, state string, update_id bigint, reason string"
_NAMES = [x.split()[0] for x in _TAGGED.split(", ")]
_TYPES = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]


def _told(key: tuple[str, str], t: pa.Table) -> list[tuple]:
    """What one book's replay has to say, as rows."""
    col = {n: t.column(n) for n in t.column_names}
    whole = lambda n: col[n].fill_null(-1).to_numpy()
    e = Events(*[whole(n).astype(np.int64) for n in ("kind", "pos", "ns", "seq", "first", "last", "previous", "run")])
    r = replay(e)
    out = [(*key, "change", int(e.pos[i]), at, None, state, uid, why if why is not None else col["reason"][i].as_py()) for i, at, state, uid, why in r.changes]
    for begin, until, base, parts in r.stretches:
        start = int(e.pos[begin])
        # rows and gaps of one place: a gap comes first
        end = END if until == len(e.pos) else 2 * int(e.pos[until]) + int(e.kind[until] != GAP)
        out.append((*key, "stretch", start, int(e.pos[base]), end, None, None, None))
        out += [(*key, "part", lo, start, hi, None, None, None) for lo, hi in parts]
    if r.state == VALID:
        start, _, base, parts = r.stretches[-1]
        out.append((*key, "held", int(e.pos[base]), None, None, r.state, r.expected, None))
        out += [(*key, "applied", lo, None, hi, None, None, None) for lo, hi in [*parts, (int(e.pos[start]) + 1, END)]]
    elif r.waiting is not None:
        out.append((*key, "waiting", int(e.pos[r.waiting]), int(e.ns[r.waiting]), None, r.state, None, None))
    return out


def _replays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replays book after book of rows that are sorted by book; holds the rows of one."""
    key, parts, out = None, [], []
    for b in batches:
        if not b.num_rows:
            continue
        ids = pa.StructArray.from_arrays([b.column(0).dictionary_encode().indices, b.column(1).dictionary_encode().indices], names=["a", "b"])
        a, c = (ids.field(i).to_numpy() for i in (0, 1))
        edges = [0, *(np.flatnonzero((a[1:] != a[:-1]) | (c[1:] != c[:-1])) + 1).tolist(), b.num_rows]
        for lo, hi in zip(edges, edges[1:], strict=False):
            mine = (b.column(0)[lo].as_py(), b.column(1)[lo].as_py())
            if mine != key and parts:
                out += _told(key, pa.Table.from_batches(parts))
                parts = []
            key = mine
            parts.append(b.slice(lo, hi - lo))
        if len(out) > 20_000:
            yield _batch(out)
            out = []
    if parts:
        out += _told(key, pa.Table.from_batches(parts))
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES)


def authority(steps: DataFrame, end_ns: int) -> tuple[DataFrame, DataFrame]:
    """From when to when which connection's book counts for a symbol, and which one does at the end.

    ``steps`` (exchange_symbol, pos, sub, gap_no, what, connection_id, at_ns, reason, gap_id), in
    this order: ``VALID`` and ``BROKEN`` of a connection, ``OPEN`` and ``CLOSED`` of a gap. A book
    counts from the step that makes it valid if no gap is open, or from the closing of the last
    open gap if it was the last to become valid since the last opening and still is. It counts up
    to the next opening, the next book that becomes valid, or its own break.
    """
    order = ["pos", "sub", "gap_no"]
    w = Window.partitionBy("exchange_symbol").orderBy(*order)
    s = steps.withColumn("step", F.row_number().over(w))
    # open gaps: an opening counts once until its gap is closed
    was = F.lag("what").over(Window.partitionBy("exchange_symbol", "gap_id").orderBy("step"))
    delta = F.when((F.col("what") == "OPEN") & ~was.eqNullSafe("OPEN"), 1).when((F.col("what") == "CLOSED") & was.eqNullSafe("OPEN"), -1).otherwise(0)
    s = s.withColumn("delta", F.when(F.col("gap_id").isNotNull(), delta).otherwise(0))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("open", F.sum("delta").over(upto)).withColumn("era", F.count_if(F.col("what") == "OPEN").over(upto))
    mine = Window.partitionBy("exchange_symbol", "connection_id").orderBy("step").rowsBetween(1, Window.unboundedFollowing)
    s = s.withColumn("breaks", F.when(F.col("connection_id").isNotNull(), F.min(F.when(F.col("what") == "BROKEN", F.struct("step", "at_ns", "reason", (F.col("pos") * 2 + F.col("sub")).alias("place")))).over(mine)))
    after = w.rowsBetween(1, Window.unboundedFollowing)
    nxt = F.min(F.when(F.col("what").isin("OPEN", "VALID"), F.struct("step", "at_ns", F.when(F.col("what") == "OPEN", "transport_gap").otherwise("connection_switch").alias("reason"), (F.col("pos") * 2 + F.col("sub")).alias("place")))).over(after)
    s = s.withColumn("next", nxt)
    era = Window.partitionBy("exchange_symbol", "era").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("newest", F.last(F.when(F.col("what") == "VALID", F.struct("connection_id", "breaks")), ignorenulls=True).over(era))
    resumes = (F.col("what") == "CLOSED") & F.col("newest").isNotNull() & (F.col("newest.breaks").isNull() | (F.col("newest.breaks.step") > F.col("step")))
    starts = s.where((F.col("open") == 0) & ((F.col("what") == "VALID") | resumes))
    own = F.when(F.col("what") == "VALID", F.col("breaks")).otherwise(F.col("newest.breaks"))
    stop = F.least(F.coalesce("next", own), F.coalesce(own, "next"))  # by step
    got = starts.select("exchange_symbol", "step", (F.col("pos") * 2 + F.col("sub")).alias("from_place"), F.coalesce(stop["place"], F.lit((1 << 62))).alias("to_place"), F.coalesce(stop["step"], F.lit(-1)).alias("stop"), F.col("at_ns").alias("valid_from_ns"), F.coalesce(stop["at_ns"], F.lit(end_ns)).alias("valid_to_ns"), F.col("newest.connection_id").alias("connection_id"), F.coalesce(stop["reason"], F.lit("utc_day_end")).alias("end_reason"), stop.isNull().alias("__last"))
    holder = got.where("__last").select(*_KEY).distinct()
    # a closing while its book counts already does not begin anew but tells a later time: of starts with one end the last holds
    last = Window.partitionBy("exchange_symbol", "stop").orderBy(F.desc("step"))
    got = got.withColumn("k", F.row_number().over(last)).where("k = 1 and valid_to_ns > valid_from_ns")
    return got.drop("k", "step", "stop", "__last"), holder


def rebuild(rows: DataFrame, gaps: DataFrame | None, start_ns: int, end_ns: int, order: str = "ord", carry: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Validity of each symbol's book over a day: state changes, valid intervals, final state.

    ``rows``: depth and depth_snapshot rows with a symbol and ``order``, their unique place in the
    source per symbol (at least 0). ``gaps``: facts by symbol (see
    :func:`tidemark.operators.quality.scoped`). ``carry``: the third result of the day before.

    * changes: exchange_symbol, connection_id, at_ns, state, update_id, reason
    * intervals: exchange_symbol, valid_from_ns, valid_to_ns, connection_id, end_reason
    * checkpoint: the rows from which the next day starts: per symbol the book that counted at the
      end with its levels (``restore``), and of each connection that waits for its bridge the
      snapshot and the changes since (``snapshot``, ``depth``).

    A gap takes effect before the first row of its symbol that was received at or after it; an
    opening invalidates all books, a closing lets the last valid book count again. Changes
    repeated on one connection count once. Rows with a null symbol, connection, id or time are
    ignored. Symbols with gaps but no rows have no interval.
    """
    src, events, tagged, intervals, holder = _states(rows, gaps, start_ns, end_ns, order, carry)
    changes = tagged.where("kind = 'change'").select(*_KEY, "at_ns", "state", "update_id", "reason")
    return changes, intervals.drop("from_place", "to_place"), _checkpoint(src, events, tagged, holder, end_ns)


def validity(rows: DataFrame, gaps: DataFrame | None, start_ns: int, end_ns: int, order: str = "ord", carry: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """State changes and valid intervals as of :func:`rebuild`, without the books at the end."""
    _, _, tagged, intervals, _ = _states(rows, gaps, start_ns, end_ns, order, carry)
    return tagged.where("kind = 'change'").select(*_KEY, "at_ns", "state", "update_id", "reason"), intervals.drop("from_place", "to_place")


def _states(rows: DataFrame, gaps: DataFrame | None, start_ns: int, end_ns: int, order: str, carry: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows with their places, distinct events, what the replays say, valid intervals with places, and who counts at the end."""
    src = rows.where(F.col("stream_type").isin("depth", "depth_snapshot")).withColumn("kind", F.when(F.col("stream_type") == "depth", "depth").otherwise("snapshot")).withColumn("pos", F.col(order).cast("bigint"))
    if carry is not None:
        low = carry.withColumn("pos", F.col("ord") - (1 << 40))
        src = src.unionByName(low.drop("ord"), allowMissingColumns=True)
    last = F.when(F.col("kind") == "depth", F.col("final_update_id")).otherwise(F.col("last_update_id"))
    src = src.withColumn("__last", last)
    src = src.where(F.col("exchange_symbol").isNotNull() & F.col("connection_id").isNotNull() & F.col("__last").isNotNull() & F.col("app_receive_realtime_ns").isNotNull() & F.col("pos").isNotNull())
    src = src.where((F.col("kind") != "depth") | (F.col("first_update_id").isNotNull() & F.col("previous_final_update_id").isNotNull()))
    code = F.when(F.col("kind") == "depth", DIFF).when(F.col("kind") == "snapshot", SNAPSHOT).otherwise(RESTORE)
    narrow = src.select(*_KEY, "pos", code.alias("kind"), F.col("app_receive_realtime_ns").alias("ns"), F.coalesce("receive_seq", F.lit(0)).alias("seq"), F.col("first_update_id").alias("first"), F.col("__last").alias("last"), F.col("previous_final_update_id").alias("previous"), "payload_hash")
    once = narrow.where(F.col("kind") == DIFF).groupBy(*_KEY, "first", "last", "previous", "payload_hash").agg(F.min("pos").alias("pos"), F.min_by("ns", "pos").alias("ns"), F.min_by("seq", "pos").alias("seq"))
    once = once.select(*_KEY, "pos", F.lit(DIFF).alias("kind"), "ns", "seq", "first", "last", "previous")
    events = once.unionByName(narrow.where(F.col("kind") != DIFF).drop("payload_hash"))
    events = cut(events.withColumn("sub", F.lit(1)).withColumn("gap_no", F.lit(0)).withColumn("reason", F.lit(None).cast("string")))

    placed = None
    if gaps is not None:
        g = gaps.select("exchange_symbol", "gap_id", "state", "reason", effective_ns().alias("ns")).where(F.col("ns").isNotNull())
        w = Window.partitionBy("exchange_symbol")
        g = g.withColumn("gap_no", F.row_number().over(w.orderBy("ns", "gap_id", "state")))
        # the first row received at or after the gap: within its slice of time, else of a later slice
        slice_of = F.expr(f"ns div {SLICE_NS}")
        when = narrow.where((F.col("kind") != RESTORE) & (F.col("pos") >= 0)).groupBy("exchange_symbol", "ns").agg(F.min("pos").alias("pos"))
        both = when.select("exchange_symbol", "ns", "pos", F.lit(None).cast("int").alias("gap_no")).unionByName(g.select("exchange_symbol", "ns", F.lit(None).cast("bigint").alias("pos"), "gap_no")).withColumn("s", slice_of)
        inside = F.min("pos").over(Window.partitionBy("exchange_symbol", "s").orderBy("ns").rangeBetween(Window.currentRow, Window.unboundedFollowing))
        later = both.groupBy("exchange_symbol", "s").agg(F.min("pos").alias("m")).withColumn("later", F.min("m").over(w.orderBy("s").rowsBetween(1, Window.unboundedFollowing))).drop("m")
        spot = both.withColumn("inside", inside).where("gap_no is not null").join(later, ["exchange_symbol", "s"]).select("exchange_symbol", "gap_no", F.least("inside", "later").alias("pos"))
        placed = cut(g.join(spot, ["exchange_symbol", "gap_no"]).withColumn("pos", F.coalesce("pos", F.lit(END))))
        opens = placed.where("state = 'OPEN'").join(events.select(*_KEY).distinct(), "exchange_symbol")
        null = lambda t: F.lit(None).cast(t)
        events = events.unionByName(opens.select(*_KEY, "pos", F.lit(GAP).alias("kind"), "ns", null("bigint").alias("seq"), null("bigint").alias("first"), null("bigint").alias("last"), null("bigint").alias("previous"), F.lit(0).alias("sub"), "gap_no", "reason"))

    kept = essential(events).repartition(*_KEY).sortWithinPartitions(*_KEY, "pos", "sub", "gap_no")
    tagged = cut(kept.select(*[c.split()[0] for c in _IN.split(", ")]).mapInArrow(_replays, _TAGGED))
    changes = tagged.where("kind = 'change'")

    what = F.when(F.col("state") == VALID, "VALID").when(F.col("reason").isin("pu_discontinuity", "buffered_pu_discontinuity"), "BROKEN")
    null = F.lit(None).cast("string")
    steps = changes.select("exchange_symbol", "pos", F.lit(1).alias("sub"), F.lit(0).alias("gap_no"), what.alias("what"), "connection_id", "at_ns", "reason", null.alias("gap_id")).where("what is not null")
    steps = steps.unionByName(events.where(F.col("kind") == RESTORE).select("exchange_symbol", "pos", F.lit(1).alias("sub"), F.lit(0).alias("gap_no"), F.lit("VALID").alias("what"), "connection_id", F.lit(start_ns).cast("bigint").alias("at_ns"), null.alias("reason"), null.alias("gap_id")))
    if placed is not None:
        steps = steps.unionByName(placed.select("exchange_symbol", "pos", F.lit(0).alias("sub"), "gap_no", F.col("state").alias("what"), null.alias("connection_id"), F.col("ns").alias("at_ns"), "reason", "gap_id"))
    intervals, holder = authority(steps, end_ns)
    return src, events, tagged, intervals, holder


def _checkpoint(src: DataFrame, events: DataFrame, tagged: DataFrame, holder: DataFrame, end_ns: int) -> DataFrame:
    key = _KEY
    held = tagged.where("kind = 'held'").join(holder, key).select(*key, "pos", F.col("update_id").alias("last_id"))
    # the base comes first, then the changes applied to it in the order of their ids
    parts = small(tagged.where("kind = 'applied'").select(*key, F.col("pos").alias("__lo"), F.col("to_pos").alias("__hi")).join(holder, key))
    applied = events.where(F.col("kind") == DIFF).select(*key, "pos").join(parts, key).where("pos between __lo and __hi").select(*key, "pos")
    parts = src.join(applied.unionByName(held.select(*key, "pos")), [*key, "pos"])
    books = held.select(*key, "last_id").join(_levels(parts, key), key)
    restore = books.where((F.size("bids") > 0) & (F.size("asks") > 0)).select(
        *key, F.lit("restore").alias("kind"), F.lit(0).cast("bigint").alias("ord"), F.lit(end_ns).cast("bigint").alias("app_receive_realtime_ns"), F.lit(0).cast("bigint").alias("receive_seq"),
        F.lit(None).cast("bigint").alias("first_update_id"), F.lit(None).cast("bigint").alias("final_update_id"), F.lit(None).cast("bigint").alias("previous_final_update_id"), F.col("last_id").alias("last_update_id"),
        F.lit(None).cast("binary").alias("payload_hash"), "bids", "asks",
    )
    waits = tagged.where("kind = 'waiting'").select(*key, "pos").join(holder, key, "left_anti")
    since = small(waits.withColumnRenamed("pos", "__lo"))
    buffered = events.where(F.col("kind") == DIFF).select(*key, "pos").join(since, key).where("pos > __lo").select(*key, "pos")
    cols = ["app_receive_realtime_ns", "receive_seq", "first_update_id", "final_update_id", "previous_final_update_id", "last_update_id", "payload_hash", "bids", "asks"]
    again = src.join(waits.unionByName(buffered), [*key, "pos"]).select(*key, "kind", (F.row_number().over(Window.partitionBy(*key).orderBy(F.col("kind") == "depth", "pos"))).cast("bigint").alias("ord"), *cols)
    return restore.unionByName(again)


def _levels(parts: DataFrame, key: list[str]) -> DataFrame:
    """The levels of each ``key`` after its rows, as sorted ``bids`` and ``asks``.

    The base comes first, then the changes in the order of their ids; of one price twice in a
    message the later counts.
    """
    whole = lambda c, n: c.cast(f"decimal({n},0)")
    at = F.when(F.col("kind") != "depth", F.lit(0)).otherwise(F.col("final_update_id") + 1)
    side = lambda name, c: F.transform(F.coalesce(F.col(c), F.array().cast("array<struct<price:string,quantity:string>>")), lambda x, i: F.struct(F.lit(name).alias("side"), i.alias("i"), x["price"].alias("p"), x["quantity"].alias("q")))
    levels = parts.select(*key, at.alias("at"), F.explode(F.concat(side("bid", "bids"), side("ask", "asks"))).alias("l"))
    levels = levels.withColumn("seq", whole(whole(F.col("at"), 20) * whole(F.lit(1 << 31), 10) + whole(F.col("l.i"), 10), 32))
    feed = levels.select(*key, "l.side", F.col("l.p").try_cast("decimal(30,12)").alias("p"), "seq", F.struct(F.col("l.p").alias("price"), F.col("l.q").alias("quantity")).alias("level"), F.when(is_zero(F.col("l.q")), "delete").otherwise("update").alias("op"))
    book = last_writer(feed.where("p is not null"), [*key, "side", "p"], "seq", "op", ["level"])
    pick = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == s, F.struct("p", "level")))), lambda x: x["level"])
    return book.groupBy(*key).agg(pick("bid").alias("bids"), pick("ask").alias("asks"))


def replay_stream(rows: DataFrame, gaps: DataFrame | None, start_ns: int, end_ns: int, order: str = "ord", carry: DataFrame | None = None) -> DataFrame:
    """What a replay of the books needs, and nothing else: per stretch of validity CLEAR, the whole book, then its changes.

    A stretch (``valid_from_ns``, ``segment``: its place) is a valid interval on one base; it begins
    with CLEAR and SNAPSHOT (the book of the connection that counts, at that place) and goes on with
    the DIFF rows of that connection, each message once, in the order of ``place``. Nothing of
    another connection, and nothing from outside valid intervals, is in it. Columns: symbol,
    connection, ``valid_from_ns``, ``segment``, ``place``, ``kind``, ids, times, levels.
    """
    src, events, tagged, intervals, _ = _states(rows, gaps, start_ns, end_ns, order, carry)
    own = tagged.where("kind = 'stretch'").select(*_KEY, F.col("pos").alias("begin"), F.col("at_ns").alias("base"), F.when(F.col("to_pos") == END, F.lit(1 << 62)).otherwise(F.col("to_pos")).alias("until"))
    both = intervals.select(*_KEY, "valid_from_ns", "from_place", "to_place").join(own, _KEY).withColumn("segment", F.greatest("from_place", F.col("begin") * 2 + 1)).withColumn("ends", F.least("to_place", "until"))
    both = cut(both.where("segment < ends"))
    near = small(both)
    changes = events.where(F.col("kind") == DIFF).select(*_KEY, "pos")
    after = changes.join(near, _KEY).where("pos * 2 + 1 > segment and pos * 2 + 1 < ends").select(*_KEY, "valid_from_ns", "segment", "pos")
    # what the book at a segment's place is made of
    parts = small(tagged.where("kind = 'part'").select(*_KEY, F.col("at_ns").alias("begin"), F.col("pos").alias("lo"), F.col("to_pos").alias("hi")).join(both, [*_KEY, "begin"]))
    first = changes.join(parts, _KEY).where("pos between lo and hi").select(*_KEY, "segment", "pos")
    more = changes.join(near, _KEY).where("pos > begin and pos * 2 + 1 <= segment").select(*_KEY, "segment", "pos")
    made = both.select(*_KEY, "segment", F.col("base").alias("pos")).unionByName(first).unionByName(more).distinct()
    books = _levels(src.join(made, [*_KEY, "pos"]), [*_KEY, "segment"])
    ids = ["receive_seq", "first_update_id", "final_update_id", "previous_final_update_id"]
    out = [*_KEY, "valid_from_ns", "segment", "place", "kind", *ids, "app_receive_realtime_ns", "bids", "asks"]
    diffs = src.drop("kind").join(after, [*_KEY, "pos"]).withColumn("place", F.col("pos")).withColumn("kind", F.lit("DIFF")).select(*out)
    heads = both.select(*_KEY, "valid_from_ns", "segment")
    none = [F.lit(None).cast("bigint").alias(c) for c in ids]
    no_levels = [F.lit(None).cast(dict(src.dtypes)[c]).alias(c) for c in ("bids", "asks")]
    clear = heads.select(*_KEY, "valid_from_ns", "segment", F.lit(-END - 2).alias("place"), F.lit("CLEAR").alias("kind"), *none, F.col("valid_from_ns").alias("app_receive_realtime_ns"), *no_levels)
    whole = heads.join(books, [*_KEY, "segment"], "left").select(*_KEY, "valid_from_ns", "segment", F.lit(-END - 1).alias("place"), F.lit("SNAPSHOT").alias("kind"), *none, F.col("valid_from_ns").alias("app_receive_realtime_ns"), "bids", "asks")
    return clear.unionByName(whole).unionByName(diffs)
