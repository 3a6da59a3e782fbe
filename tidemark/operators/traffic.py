"""Message rates per minute, peaks of blocks of minutes, and balanced assignment."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from itertools import combinations
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import floor_div

#: Minutes in a block, blocks kept, imbalance that triggers a swap. Fixed values.
BLOCK, KEPT, TRIGGER = 60, 24, 1.25
MINUTE_NS = 60 * 10**9


def per_slot(events: DataFrame, key: str, time: str, width: int = MINUTE_NS) -> DataFrame:
    """Events per key and slot of ``width`` time units. Null keys and times are left out."""
    src = events.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    return src.groupBy(F.col(key), floor_div(time, width).alias("slot")).agg(F.count(F.lit(1)).alias("n"))


def blocks(rates: DataFrame, key: str, seen: DataFrame, size: int = BLOCK) -> DataFrame:
    """The peak rate of each key in each complete block of ``size`` consecutive observed slots.

    ``seen`` lists the slots that were observed (``slot``), silent ones too. A slot that is missing
    from it ends a run; a run is cut into blocks from its start and an incomplete rest gives none.
    The first slot, in which the observation started, is never whole and does not count.
    ``seen`` has one row per slot of time whatever the traffic.
    """
    w = Window.orderBy("slot")
    runs = seen.select("slot").distinct().withColumn("__n", F.row_number().over(w)).where("__n > 1").withColumn("__run", F.col("slot") - F.col("__n"))
    place = F.row_number().over(Window.partitionBy("__run").orderBy("slot")) - 1
    runs = runs.withColumn("block_start", F.col("slot") - F.pmod(place, F.lit(size)))
    whole = runs.groupBy("block_start").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") == size).drop("c")
    inside = runs.join(whole, "block_start").select("slot", "block_start")
    return rates.join(inside, "slot").groupBy(key, "block_start").agg(F.max("n").alias("peak"))


def effective(peaks: DataFrame, key: str, kept: int = KEPT, baseline: DataFrame | None = None) -> DataFrame:
    """The rate to plan with: a key's highest peak over the last ``kept`` blocks.

    While there are fewer blocks, the rates of ``baseline`` (key and ``rate``), else none.
    """
    ids = peaks.select("block_start").distinct().orderBy(F.desc("block_start")).limit(kept)
    enough = ids.agg((F.count(F.lit(1)) == kept).alias("__enough"))  # one row
    last = peaks.join(F.broadcast(ids), "block_start").groupBy(key).agg(F.max("peak").alias("rate"))
    last = last.join(F.broadcast(enough.where("__enough")), how="left_semi")
    return last if baseline is None else last.unionByName(baseline.select(key, F.col("rate").cast(dict(last.dtypes)["rate"])).join(F.broadcast(enough.where("not __enough")), how="left_semi"))


def upper_median(rates: DataFrame, value: str) -> DataFrame:
    """The upper of the two middle values (one row; none for an empty table).

    Equal values are counted first, combined on the map side; what is ordered in one task is one
    row per distinct value.
    """
    counts = rates.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    up = counts.withColumn("upto", F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))).withColumn("all", F.sum("n").over(Window.partitionBy()))
    return up.where("upto > all div 2 and upto - n <= all div 2").select(F.col("v").alias("upper_median"))


def lanes(sizes: Sequence[tuple[str, int]], count: int) -> list[list[str]]:
    """Items over ``count`` lanes, largest first to the least loaded lane (then the lower number).

    A plan for a few hundred items, made on the driver.
    """
    out: list[list[str]] = [[] for _ in range(count)]
    load = [0] * count
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        at = min(range(count), key=lambda i: (load[i], i))
        out[at].append(name)
        load[at] += size
    return out


def _known(symbols: Sequence[str], rates: Mapping[str, int]) -> dict[str, int]:
    """A rate for each symbol; one without gets the upper median of all rates, or 1 if there are none."""
    ordered = sorted(rates.values())
    other = ordered[len(ordered) // 2] if ordered else 1
    return {s: rates.get(s, other) for s in symbols}


def shards(symbols: Sequence[str], rates: Mapping[str, int], count: int, current: Mapping[str, int] | None = None) -> list[list[str]]:
    """Symbols over at most ``count`` shards, none with more than ceil(n / shards) + 1 of them.

    Symbols that have a shard in ``current`` stay there; the others go, heaviest first, to the
    lightest shard with room. Only where there was no assignment at all, swaps follow for as long
    as one makes the spread (heaviest less lightest) smaller. Fewer symbols than shards: as many
    shards as symbols. A plan for some hundred symbols, made on the driver.
    """
    count = min(count, len(symbols))
    if not count:
        return []
    rate, room = _known(symbols, rates), -(-len(set(symbols)) // count) + 1
    kept = {s: at for s, at in (current or {}).items() if s in rate and at < count}
    out: list[list[str]] = [sorted(s for s, at in kept.items() if at == i) for i in range(count)]
    load = [sum(rate[s] for s in shard) for shard in out]
    for s in sorted(rate.keys() - kept.keys(), key=lambda s: (-rate[s], s)):
        at = min((i for i in range(count) if len(out[i]) < room), key=lambda i: (load[i], i))
        out[at].append(s)
        load[at] += rate[s]
    while not current and _swapped(out, rate):
        pass
    return [sorted(shard) for shard in out]


def _swapped(at: list[list[str]], rate: Mapping[str, int]) -> bool:
    """Swap the two symbols that bring the loads closest together, the first such pair of several; False if none does.

    All pairs of two shards are judged at once: the loads of the other shards bound the spread, and
    the two that change move by the difference of rates.
    """
    load = np.array([sum(rate[s] for s in shard) for shard in at], np.int64)
    least, found = int(load.max() - load.min()), None
    for a, b in combinations(range(len(at)), 2):
        if not at[a] or not at[b]:
            continue
        other = np.delete(load, [a, b])
        d = np.array([rate[s] for s in at[a]])[:, None] - np.array([rate[s] for s in at[b]])[None, :]
        pair = np.stack([load[a] - d, load[b] + d])
        high, low = pair.max(0), pair.min(0)
        spread = np.maximum(high, other.max(initial=high.min())) - np.minimum(low, other.min(initial=low.max()))
        k = int(spread.argmin())
        if spread.flat[k] < least:
            least, found = int(spread.flat[k]), (a, b, *divmod(k, len(at[b])))
    if found is None:
        return False
    a, b, i, j = found
    left, right = at[a].pop(i), at[b].pop(j)
    at[a].append(right)
    at[b].append(left)
    return True


def rebalance(symbols: Sequence[str], rates: Mapping[str, int], at: Sequence[Sequence[str]], count: int, trigger: float = TRIGGER) -> list[list[str]]:
    """At most one swap, and only if the heaviest shard has more than ``trigger`` times the mean load.

    ``at`` must hold every symbol once, in as many shards as there are to be.
    """
    if len(at) != min(count, len(symbols)) or sorted(s for shard in at for s in shard) != sorted(set(symbols)):
        raise ValueError("the assignment does not hold every symbol once in the right number of shards")
    out, rate = [list(shard) for shard in at], _known(symbols, rates)
    load = [sum(rate[s] for s in shard) for shard in out]
    if len(out) > 1 and max(load) * len(out) > trigger * sum(load):
        _swapped(out, rate)
    return [sorted(shard) for shard in out]


def offsets(count: int, window: float) -> list[float]:
    """When so many pollers start, spread evenly over a window."""
    return [window * i / count for i in range(count)]


def next_deadline(previous: float, interval: float, now: float) -> float:
    """The first point of the fixed raster of ``interval`` from ``previous`` on that is after ``now``; missed ones are left out."""
    missed = max(0, math.floor((now - previous) / interval))
    return previous + interval * (missed + 1) if now >= previous else previous + interval


def load_blocks(text: str | None, size: int = BLOCK, kept: int = KEPT) -> list[dict[str, Any]]:
    """The last blocks of a saved state (``start_minute``, ``end_minute``, ``rates``); none at all if any of it is broken."""
    try:
        state = json.loads(text or "")
        blocks = state["blocks"] if state["version"] == 1 else None
        until = -1
        for b in blocks:
            whole = [b["start_minute"], b["end_minute"], *b["rates"].values()]
            if any(type(n) is not int for n in whole) or min(b["rates"].values(), default=1) < 1 or b["end_minute"] - b["start_minute"] != size - 1 or b["start_minute"] <= until or not all(1 <= len(s) <= 30 and s.isalnum() and s == s.upper() for s in b["rates"]):
                return []
            until = b["end_minute"]
    except (ValueError, KeyError, TypeError, AttributeError):
        return []
    return blocks[-kept:]
