"""Replay of order books: bridges, gaps, switches of connection, and the state carried over midnight."""

import random

import numpy as np
import pytest

from tidemark.operators.book import _IN, _TAGGED, DIFF, GAP, RESTORE, SNAPSHOT, Events, _replays, essential, rebuild, replay, replay_stream

S, E = 0, 10_000
SCHEMA = "exchange_symbol string, connection_id string, stream_type string, ord bigint, receive_seq bigint, app_receive_realtime_ns bigint, first_update_id bigint, final_update_id bigint, previous_final_update_id bigint, last_update_id bigint, payload_hash binary, bids array<struct<price:string,quantity:string>>, asks array<struct<price:string,quantity:string>>"
GAP_FACTS = "exchange_symbol string, gap_id string, state string, reason string, observed_at_realtime_ns bigint, affected_from_realtime_ns bigint"
BID, ASK = [("100", "1")], [("101", "1")]


def diff(c, ns, u0, u, pu, bids=BID, asks=ASK):
    return ("A", c, "depth", ns, u0, u, pu, None, bids, asks)


def snap(c, ns, last, bids=(("99", "1"),), asks=(("102", "1"),)):
    return ("A", c, "depth_snapshot", ns, None, None, None, last, list(bids), list(asks))


def run(spark, rows, gaps=(), start=S, end=E, carry=None):
    data = [(y, c, s, i, i + 1, ns, a, b, p, last, repr((a, b, p)).encode(), bi, ak) for i, (y, c, s, ns, a, b, p, last, bi, ak) in enumerate(rows)]
    g = spark.createDataFrame([("A", f"gap-{k}", st, "CONNECTION_LOST", o, a) for k, st, o, a in gaps], GAP_FACTS)
    changes, intervals, checkpoint = rebuild(spark.createDataFrame(data, SCHEMA), g, start, end, carry=carry)
    got = sorted((r.valid_from_ns, r.valid_to_ns, r.connection_id, r.end_reason) for r in intervals.collect())
    return got, changes, checkpoint


def events(rows):
    """(kind, ns, seq, first, last, previous) as arrays, nothing left out."""
    c = np.array([(k, i, ns, seq, f, u, p, -1) for i, (k, ns, seq, f, u, p) in enumerate(rows)], np.int64).reshape(-1, 8).T
    return Events(*c)


def test_a_snapshot_and_the_buffer():
    d = [(DIFF, 10, 1, 90, 99, 89), (DIFF, 20, 2, 100, 110, 99)]
    waits = replay(events([d[0], (SNAPSHOT, 30, 3, -1, 105, -1)]))
    assert (waits.changes, waits.waiting) == ([], 1)
    assert replay(events([*d, (SNAPSHOT, 30, 3, -1, 105, -1)])).changes == [(2, 30, "VALID", 110, "snapshot_bridge")]
    stale = replay(events([*d, (SNAPSHOT, 30, 3, -1, 80, -1)]))
    assert (stale.changes, stale.waiting, stale.state) == ([], None, "UNANCHORED")


def test_a_break_in_the_buffer():
    rows = [(DIFF, 10, 1, 100, 105, 99), (DIFF, 20, 2, 106, 110, 104), (SNAPSHOT, 30, 3, -1, 102, -1)]
    assert replay(events(rows)).changes == [(2, 20, "GAPPED", 110, "buffered_pu_discontinuity")]


def test_buffered_changes_are_taken_by_number():
    rows = [(DIFF, 10, 2, 106, 110, 105), (DIFF, 20, 1, 100, 105, 99), (SNAPSHOT, 30, 3, -1, 102, -1)]
    assert replay(events(rows)).changes == [(2, 30, "VALID", 110, "snapshot_bridge")]


def plain(rows):
    """One event after the other, as plainly as can be: changes (event, ns, state, id, reason)."""
    out, state, expected, anchor, buffer = [], "UNANCHORED", None, None, []
    for i, (kind, ns, seq, first, last, previous) in enumerate(rows):
        tries = False
        if kind == GAP:
            if state == "VALID":
                out.append((i, ns, "GAPPED", expected, None))
            state, expected, anchor, buffer = "GAPPED", None, None, []
        elif kind == RESTORE:
            state, expected, anchor, buffer = "VALID", last, None, []
        elif kind == SNAPSHOT:
            if state == "VALID":
                expected = last
            else:
                anchor, tries = (last, ns), True
        elif state == "VALID":
            if previous == expected:
                expected = last
            else:
                out.append((i, ns, "GAPPED", last, "pu_discontinuity"))
                state, expected, anchor, buffer = "GAPPED", None, None, [(seq, ns, first, last, previous)]
        else:
            buffer.append((seq, ns, first, last, previous))
            tries = anchor is not None and first <= anchor[0] <= last
        if not tries:
            continue
        buffer.sort(key=lambda x: x[0])
        while buffer and buffer[0][3] < anchor[0]:
            buffer.pop(0)
        if not buffer:
            continue
        if buffer[0][2] > anchor[0]:
            anchor = None
            continue
        broken = next((b for a, b in zip(buffer, buffer[1:]) if b[4] != a[3]), None)  # noqa: B905
        if broken is not None:
            out.append((i, broken[1], "GAPPED", broken[3], "buffered_pu_discontinuity"))
            state, expected, anchor, buffer = "GAPPED", None, None, [broken]
        else:
            expected = buffer[-1][3]
            out.append((i, max(anchor[1], buffer[0][1]), "VALID", expected, "snapshot_bridge"))
            state, anchor, buffer = "VALID", None, []
    return out, state, expected


def feed(rng, n, dirty):
    """A feed of one book: losses, late and repeated ids, snapshots of old and new ids, gaps."""
    rows, at, before = [], 100, 99
    for i in range(n):
        x = rng.random()
        if x < 0.12:
            rows.append((SNAPSHOT, 10 * i, i, -1, max(1, at - rng.choice([0, 0, 1, 2, 5, 30, -3])), -1))
        elif x < 0.14:
            rows.append((GAP, 10 * i, -1, -1, -1, -1))
        elif x < 0.15:
            rows.append((RESTORE, 10 * i, i, -1, at - 1, -1))
        else:
            width = rng.randint(1, 4)
            first, last, previous = at, at + width - 1, before
            if rng.random() < 0.08 * dirty:
                previous -= rng.randint(1, 3)
            if rng.random() < 0.05 * dirty:
                first, last = first - rng.randint(0, 6), last - rng.randint(0, 6)
            seq = i - (rng.randint(0, 5) if rng.random() < 0.06 * dirty else 0)
            if rng.random() > 0.03:
                rows.append((DIFF, 10 * i, seq, first, last, previous))
            at, before = at + width, at + width - 1
    return rows


def test_replay_against_one_event_after_the_other():
    rng = random.Random(3)
    for case in range(400):
        rows = feed(rng, rng.randint(0, 120), case % 3)
        got = replay(events(rows))
        assert (got.changes, got.state, got.expected if got.state == "VALID" else None) == plain(rows), rows


def test_essential_events_give_the_same_replay(spark):
    """Books cut down in slices of a few places against the plain replay of all their events, also where much is out of order."""
    rng = random.Random(11)
    books = {f"B{k}": feed(rng, rng.randint(1, 400), [0, 0, 0, 0.1, 0.3, 1][k % 6]) for k in range(48)}
    none = lambda v: None if v == -1 else v
    data = [(y, "c", 3 * i, 1, 0, kind, ns, none(seq), none(f), none(u), none(p), "why" if kind == GAP else None) for y, rows in books.items() for i, (kind, ns, seq, f, u, p) in enumerate(rows)]
    df = spark.createDataFrame(data, "exchange_symbol string, connection_id string, pos bigint, sub int, gap_no int, kind int, ns bigint, seq bigint, first bigint, last bigint, previous bigint, reason string")
    for places, ids in ((30, 40), (1 << 16, 1 << 24), (7, 3)):
        kept = essential(df, places, ids)
        tagged = kept.repartition(4, "exchange_symbol", "connection_id").sortWithinPartitions("exchange_symbol", "connection_id", "pos", "sub", "gap_no").select(*[c.split()[0] for c in _IN.split(", ")]).mapInArrow(_replays, _TAGGED).where("kind = 'change'").collect()
        for y, rows in books.items():
            got = [(r.pos // 3, r.at_ns, r.state, r.update_id, r.reason) for r in tagged if r.exchange_symbol == y]
            assert sorted(got) == sorted((i, ns, st, u, why or "why") for i, ns, st, u, why in plain(rows)[0]), (y, places)
    assert kept.count() <= df.count() and essential(df).count() < 0.8 * df.count()


@pytest.mark.parametrize(
    ("rows", "gaps", "expected"),
    [
        # authority moves to the connection that becomes valid last
        ([diff("a", 100, 100, 101, 99), snap("a", 200, 100), diff("b", 300, 200, 201, 199), snap("b", 400, 200)], [], [(200, 400, "a", "connection_switch"), (400, E, "b", "utc_day_end")]),
        ([snap("a", 100, 100), diff("a", 200, 100, 101, 99), diff("a", 300, 100, 101, 99)], [], [(200, E, "a", "utc_day_end")]),
        # same connection, bridged again inside the gap
        ([snap("a", 100, 100), diff("a", 200, 100, 101, 99), diff("a", 400, 102, 103, 101), snap("a", 500, 103), diff("a", 600, 103, 104, 102)], [(1, "OPEN", 300, None), (1, "CLOSED", 550, None)], [(200, 300, "a", "transport_gap"), (550, 600, "a", "pu_discontinuity")]),
        ([snap("a", 100, 100), diff("a", 200, 100, 101, 99), diff("a", 400, 102, 103, 101), snap("a", 500, 103), diff("a", 520, 104, 104, 103), diff("a", 700, 105, 105, 104)], [(1, "OPEN", 300, None), (1, "CLOSED", 550, None)], [(200, 300, "a", "transport_gap"), (550, E, "a", "utc_day_end")]),
        # an opening that affects an earlier time
        ([snap("a", 100, 100), diff("a", 200, 100, 101, 99), snap("a", 550, 102), diff("a", 700, 102, 102, 101)], [(1, "OPEN", 500, 300), (1, "CLOSED", 600, None)], [(200, 300, "a", "transport_gap"), (700, E, "a", "utc_day_end")]),
        ([snap("a", 100, 100), diff("a", 200, 100, 101, 99), diff("a", 300, 200, 201, 999), snap("a", 400, 200), diff("a", 500, 202, 202, 201)], [], [(200, 300, "a", "pu_discontinuity"), (400, E, "a", "utc_day_end")]),
        ([diff("a", 100, 100, 101, 99)], [(1, "OPEN", 50, None)], []),
        ([], [(1, "OPEN", 50, None)], []),
    ],
)
def test_intervals(spark, rows, gaps, expected):
    assert run(spark, rows, gaps)[0] == expected


def test_checkpoint_carries_the_book_and_unbridged_anchors(spark):
    rows = [
        snap("a", 100, 100, bids=[("99.0", "1"), ("98", "3")]), diff("a", 200, 100, 101, 99, bids=[("99.00", "2"), ("98", "0E-8")]),
        snap("n", 300, 200),
    ]
    _, _, saved = run(spark, rows)
    kept = {(r.connection_id, r.kind): r for r in saved.collect()}
    assert set(kept) == {("a", "restore"), ("n", "snapshot")}
    assert [(x.price, x.quantity) for x in kept["a", "restore"].bids] == [("99.00", "2")] and kept["a", "restore"].last_update_id == 101
    got, _, _ = run(spark, [diff("n", E + 100, 199, 201, 198), diff("a", E + 200, 102, 102, 101)], start=E, end=2 * E, carry=saved)
    assert got == [(E, E + 100, "a", "connection_switch"), (E + 100, 2 * E, "n", "utc_day_end")]


def test_nulls_are_ignored(spark):
    rows = [("A", None, "depth", 5, 1, 2, 0, None, None, None), (None, "a", "depth", 5, 1, 2, 0, None, None, None), ("A", "a", "depth", 5, None, 2, 0, None, None, None), snap("a", 100, 100, [], []), diff("a", 200, 100, 101, 99, None, None)]
    got, _, saved = run(spark, rows)
    assert got == [(200, E, "a", "utc_day_end")]
    assert saved.count() == 0


def test_replay_stream_has_each_valid_stretch_and_nothing_else(spark):
    """Applied from its CLEAR on, every stretch gives the book that a plain replay has at each of its places."""
    rng = random.Random(21)
    rows, at, before_it = [], 100, 99
    book, valid_book = {}, {}
    for i in range(260):
        c = "a" if i < 130 or rng.random() < 0.5 else "b"
        if i % 40 == 5:
            for k in "ab":
                rows.append(snap(k, 10 * i, at - 1, bids=[(str(90 + j), "5") for j in range(4)], asks=[(str(110 + j), "5") for j in range(4)]))
        elif rng.random() < 0.03:
            at, before_it = at + 7, before_it + 5  # something was lost
        else:
            width = rng.randint(1, 3)
            bids = [(str(rng.randint(88, 96)), rng.choice(["0", "1", "2.5"])) for _ in range(2)]
            for k in "ab" if c == "b" else "a":
                rows.append(diff(k, 10 * i, at, at + width - 1, before_it, bids=bids, asks=[(str(rng.randint(108, 116)), rng.choice(["0", "7"]))]))
            at, before_it = at + width, at + width - 1
    data = [(y, c, s, i, i + 1, ns, a, b, p, last, repr((i, a, b, p)).encode(), [dict(price=x, quantity=q) for x, q in bi], [dict(price=x, quantity=q) for x, q in ak]) for i, (y, c, s, ns, a, b, p, last, bi, ak) in enumerate(rows)]
    g = spark.createDataFrame([("A", "gap-1", "OPEN", "CONNECTION_LOST", 900, None), ("A", "gap-1", "CLOSED", "CONNECTION_LOST", 1_300, None)], GAP_FACTS)
    df = spark.createDataFrame(data, SCHEMA)
    got = replay_stream(df, g, S, E).orderBy("segment", "place").collect()
    spans = sorted((r.valid_from_ns, r.valid_to_ns, r.connection_id) for r in rebuild(df, g, S, E)[1].collect())
    segments = {}
    for r in got:
        segments.setdefault((r.segment, r.connection_id, r.valid_from_ns), []).append(r)
    assert len(segments) >= 5 and {(k[2], k[1]) for k in segments} == {(lo, c) for lo, _, c in spans}
    names = SCHEMA.replace("array<struct<price:string,quantity:string>>", "levels").split(", ")
    table = [dict(zip([n.split()[0] for n in names], r, strict=True)) for r in data]
    # a snapshot that comes while its book is valid takes the book's place as it is
    renewed = set()
    for c in "ab":
        mine = [t for t in table if t["connection_id"] == c]
        k = next(i for i, t in enumerate(mine) if t["app_receive_realtime_ns"] >= 900)
        none = lambda v: -1 if v is None else v
        seen = [(SNAPSHOT if t["stream_type"] == "depth_snapshot" else DIFF, t["app_receive_realtime_ns"], t["receive_seq"], none(t["first_update_id"]), t["last_update_id"] or t["final_update_id"], none(t["previous_final_update_id"])) for t in mine]
        said = plain([*seen[:k], (GAP, 900, -1, -1, -1, -1), *seen[k:]])[0]
        for i, t in enumerate(mine):
            before_ = [x for x in said if x[0] < i + (i >= k)]
            if t["stream_type"] == "depth_snapshot" and before_ and before_[-1][2] == "VALID":
                renewed.add((c, t["ord"]))
    assert renewed
    for (place, c, _), events_ in segments.items():
        assert [r.kind for r in events_[:2]] == ["CLEAR", "SNAPSHOT"] and {r.kind for r in events_[2:]} <= {"DIFF"}
        book = {s: {float(x.price): x.quantity for x in events_[1][s]} for s in ("bids", "asks")}
        ids = [r.previous_final_update_id for r in events_[2:]]
        assert ids[1:] == [r.final_update_id for r in events_[2:-1]]  # an unbroken chain
        for r in [None, *events_[2:]]:
            upto = r.place if r else (place - 1) // 2  # a gap comes before the row of its place
            if r:
                for s in ("bids", "asks"):
                    for x in r[s]:
                        book[s].pop(float(x.price), None) if float(x.quantity) == 0 else book[s].__setitem__(float(x.price), x.quantity)
            mine = [t for t in table if t["connection_id"] == c and t["ord"] <= upto]
            base = max(t["ord"] for t in mine if t["stream_type"] == "depth_snapshot" and t["ord"] <= (place - 1) // 2)
            first = next(t for t in mine if t["ord"] == base)
            want = {s: {float(x["price"]): x["quantity"] for x in first[s]} for s in ("bids", "asks")}
            chain = [t for t in mine if t["stream_type"] == "depth" and t["final_update_id"] >= first["last_update_id"] and t["ord"] <= upto]
            for t in sorted(chain, key=lambda t: t["ord"]):
                if t["ord"] > base or (c, base) not in renewed and t["first_update_id"] <= first["last_update_id"] <= t["final_update_id"]:
                    for s in ("bids", "asks"):
                        for x in t[s]:
                            want[s].pop(float(x["price"]), None) if float(x["quantity"]) == 0 else want[s].__setitem__(float(x["price"]), x["quantity"])
            assert book == want, (place, c, upto)
