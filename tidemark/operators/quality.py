"""Coverage of a collection window, clock quality and audits of a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import nine_decimals, product
from tidemark.operators import intervals
from tidemark.operators.sliding import before
from tidemark.schemas import GAP_REASONS

#: Permille of a window that must be valid. Fixed value.
VALID_PER_MILLE = 999
#: The remark on a closing that stands one unit before the end of its day. Fixed value.
ROLLOVER = "gap continues into the next UTC day"


def effective_ns(zero_is_none: bool = False) -> Column:
    """When a gap fact takes effect: an opening from when it affected, else when it was observed.

    With ``zero_is_none`` a start of 0 counts as missing.
    """
    since = F.col("affected_from_realtime_ns")
    use = (F.col("state") == "OPEN") & since.isNotNull()
    return F.when(use & (since != 0) if zero_is_none else use, since).otherwise(F.col("observed_at_realtime_ns"))


def scoped(gaps: DataFrame, symbols: DataFrame, stream: str = "depth") -> DataFrame:
    """Gap facts by the symbols they concern: an empty or null list of symbols or streams means all.

    ``symbols`` is the list of expected symbols (``exchange_symbol``), one row each. Gaps for some
    are exploded and joined; gaps for all are few facts against that list.
    """
    of = gaps.where((F.coalesce(F.size("stream_types"), F.lit(0)) <= 0) | F.array_contains("stream_types", stream))
    everyone = F.coalesce(F.size("exchange_symbols"), F.lit(0)) <= 0
    names = symbols.select("exchange_symbol").distinct()
    one = of.where(~everyone).withColumn("exchange_symbol", F.explode(F.array_distinct("exchange_symbols"))).join(names, "exchange_symbol")
    # the expected symbols are a list of configuration: one array, exploded where the facts are
    listed = names.where("exchange_symbol is not null").agg(F.collect_set("exchange_symbol").alias("__names"))
    every = of.where(everyone).join(F.broadcast(listed)).withColumn("exchange_symbol", F.explode("__names")).drop("__names")
    return one.unionByName(every.select(one.columns))


def invalid(gaps: DataFrame, lo: int, hi: int) -> DataFrame:
    """Intervals per symbol in which the feed is known to be broken, within [lo, hi)."""
    facts = gaps.withColumn("at", effective_ns(zero_is_none=True))
    back = F.when(F.col("detail") == ROLLOVER, 1).otherwise(0)
    paired = intervals.pair(facts, ["exchange_symbol", "gap_id"], "at", "state", hi, plus=back)
    return intervals.clip(paired.select("exchange_symbol", "lo", "hi"), lo, hi)


def coverage(expected: DataFrame, valid: DataFrame, broken: DataFrame, lo: int, hi: int, per_mille: int = VALID_PER_MILLE) -> DataFrame:
    """How each expected symbol's window [lo, hi) is accounted for, to the nanosecond.

    ``valid`` and ``broken`` have ``exchange_symbol``, ``lo``, ``hi``. Broken intervals last until
    validity resumes. Columns: expected, valid, explicit_invalid, accounted, conflicting and
    unclassified lengths, the ratios as text of nine decimals, and ``accepted``: enough is valid
    and nothing is unclassified or in conflict. Symbols without any interval have zeros.
    """
    by = ["exchange_symbol"]
    good = intervals.clip(valid.select(*by, "lo", "hi"), lo, hi)
    bad = intervals.extend(broken.select(*by, "lo", "hi"), good, by, hi)
    return _accounted(expected.select(*by).distinct(), good, bad, by, hi - lo, per_mille)


def coverage_by_day(expected: DataFrame, valid: DataFrame, broken: DataFrame, first: int, last: int, day: int = intervals.DAY_NS, per_mille: int = VALID_PER_MILLE) -> DataFrame:
    """:func:`coverage` of every day from number ``first`` to ``last``, both included, with ``day``.

    Each day is a window of its own: intervals are cut at its bounds, and a broken one lasts until
    validity resumes on that day or to its end. Symbols are expected on all days.
    """
    by = ["day", "exchange_symbol"]
    within = F.col("day").between(first, last)
    good, broken = (intervals.by_day(intervals.clip(x.select("exchange_symbol", "lo", "hi"), first * day, (last + 1) * day), day).where(within).select(*by, "lo", "hi") for x in (valid, broken))
    bad = intervals.extend(broken, good, by, (F.col("day") + 1) * day)
    days = F.explode(F.sequence(F.lit(first).cast("bigint"), F.lit(last).cast("bigint"))).alias("day")
    return _accounted(expected.select("exchange_symbol").distinct().select("exchange_symbol", days), good, bad, by, day, per_mille)


def _accounted(out: DataFrame, good: DataFrame, bad: DataFrame, by: list[str], expected: int, per_mille: int) -> DataFrame:
    names = {"a": "valid_ns", "b": "explicit_invalid_ns", "either": "accounted_ns", "both": "conflicting_ns"}
    out = out.join(intervals.lengths(good, bad, by).withColumnsRenamed(names), by, "left").fillna(0, list(names.values())).withColumn("expected_ns", F.lit(expected).cast("bigint"))
    out = out.withColumn("unclassified_ns", F.col("expected_ns") - F.col("accounted_ns"))
    ratio = lambda c: nine_decimals(F.col(c) / F.col("expected_ns"))
    ok = (F.col("valid_ns") * 1000 >= F.col("expected_ns") * per_mille) & (F.col("unclassified_ns") == 0) & (F.col("conflicting_ns") == 0)
    return out.withColumn("valid_ratio", ratio("valid_ns")).withColumn("accounted_ratio", ratio("accounted_ns")).withColumn("accepted", ok)


def verdict(covered: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row (or one of each ``by``): whether the day is accepted, how many symbols and which ones are not."""
    return covered.groupBy(*by).agg(F.coalesce(F.bool_and("accepted"), F.lit(False)).alias("accepted"), F.count(F.lit(1)).alias("symbols"), F.array_sort(F.collect_list(F.when(~F.col("accepted"), F.col("exchange_symbol")))).alias("rejected"))


def clock(samples: DataFrame) -> DataFrame:
    """Offset, uncertainty and round trip of clock samples in nanoseconds, and their status.

    Needs request, receive and exchange time; rows without one are left out. VALID up to 100 ms of
    offset and uncertainty together, INVALID beyond 1 s, else DEGRADED.
    """
    sent, got, said = F.col("request_realtime_ns"), F.col("app_receive_realtime_ns"), F.col("exchange_event_time_ms")
    src = samples.where((F.col("stream_type") == "clock_sample") & sent.isNotNull() & got.isNotNull() & said.isNotNull())
    src = src.withColumn("clock_sample_rtt_ns", got - sent)
    src = src.withColumn("clock_offset_uncertainty_ns", F.expr("greatest(0L, clock_sample_rtt_ns) div 2"))
    src = src.withColumn("clock_offset_estimate_ns", F.expr("exchange_event_time_ms * 1000000 - (request_realtime_ns + app_receive_realtime_ns) div 2"))
    worst = F.abs("clock_offset_estimate_ns") + F.col("clock_offset_uncertainty_ns")
    status = F.when(worst <= 10**8, "VALID").when(worst > 10**9, "INVALID").otherwise("DEGRADED")
    return src.select(F.col("app_receive_realtime_ns").alias("observed_at_ns"), "clock_offset_estimate_ns", "clock_offset_uncertainty_ns", "clock_sample_rtt_ns", status.alias("status"))


def audit(events: DataFrame) -> DataFrame:
    """Per stream: rows, exact sums of quantity, notional and non-RPI quantity, and level updates.

    Rows flagged as duplicates do not count. Sums are over trades, level updates over depth; they
    are null or 0 elsewhere. Numbers up to 10^20 are read; for products see
    :func:`tidemark.functions.numbers.product`.
    """
    d = lambda c: F.col(c).try_cast("decimal(28,8)")
    levels = F.coalesce(F.size("bids"), F.lit(0)) + F.coalesce(F.size("asks"), F.lit(0))
    src = events.where(~F.coalesce("is_duplicate", F.lit(False)) & F.col("stream_type").isin("trade", "agg_trade", "depth", "rpi_depth"))
    return src.groupBy("stream_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum(d("quantity")).alias("quantity"), F.sum(product(d("price"), d("quantity"))).alias("notional"),
        F.sum(d("non_rpi_quantity")).alias("non_rpi_quantity"), F.sum(F.greatest(levels, F.lit(0))).cast("bigint").alias("level_updates"),
    )


def open_gaps(facts: DataFrame) -> DataFrame:
    """Gaps whose latest fact is an opening: still open."""
    last = facts.groupBy("gap_id").agg(F.max_by(F.struct("state", "reason", "observed_at_realtime_ns"), F.struct(effective_ns().alias("t"), F.col("state"))).alias("f"))
    return last.select("gap_id", "f.*").where("state = 'OPEN'")


def gap_violations(facts: DataFrame) -> DataFrame:
    """Gap facts that break a rule, with ``rule``: one row per rule broken."""
    since, seen = F.col("affected_from_realtime_ns"), F.col("observed_at_realtime_ns")
    fails = lambda c: ~F.coalesce(c, F.lit(False))
    rules = {
        "gap_id": fails(F.length("gap_id").between(8, 160)), "state": fails(F.col("state").isin("OPEN", "CLOSED")), "reason": fails(F.col("reason").isin(*GAP_REASONS)), "observed_at": fails(seen >= 0),
        "affected_after_observed": F.coalesce(since > seen, F.lit(False)), "closing_with_start": (F.col("state") == "CLOSED") & since.isNotNull(),
    }
    return facts.withColumn("rule", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))))


def minute_tiers(minutes: DataFrame, symbols: int, least: int) -> DataFrame:
    """Per day: share of minutes in which at least ``least`` of ``symbols`` are valid, longest run of others, and the tier.

    ``minutes`` has ``minute`` (number since the epoch), ``exchange_symbol`` and ``ok``, every minute
    of the day. Tiers by share: 99.9, 99.8, 99.5, 99.0 or none; a run over three minutes gives none.
    """
    m = minutes.groupBy("minute").agg(F.count_if("ok").alias("n")).withColumn("utc_day", F.expr("minute div 1440")).withColumn("good", F.col("n") >= min(least, symbols))
    m = m.withColumn("run", F.col("minute") - F.row_number().over(Window.partitionBy("utc_day", "good").orderBy("minute")))
    runs = m.groupBy("utc_day", "good", "run").agg(F.count(F.lit(1)).alias("len"))
    d = runs.groupBy("utc_day").agg((F.sum(F.when(F.col("good"), F.col("len")).otherwise(0)) / F.sum("len")).alias("share"), F.coalesce(F.max(F.when(~F.col("good"), F.col("len"))), F.lit(0)).alias("longest_bad"))
    tier = F.lit("none")
    for t in ("99.0", "99.5", "99.8", "99.9"):
        tier = F.when(F.col("share") >= float(t) / 100, t).otherwise(tier)
    return d.withColumn("tier", F.when(F.col("longest_bad") > 3, "none").otherwise(tier))


def route_gap_starts(events: DataFrame, route: str, key: Sequence[str], time: str) -> DataFrame:
    """Since when a route's loss affects what it carries: the least of the last times of its keys (``affected_from_ns``)."""
    last = events.where(F.col(time).isNotNull()).groupBy(route, *key).agg(F.max(time).alias("__last"))
    return last.groupBy(route).agg(F.min("__last").alias("affected_from_ns"), F.count(F.lit(1)).alias("keys"))


def liveness(events: DataFrame, key: str, time: str, limit: int, until: int | None) -> DataFrame:
    """Silences longer than ``limit``: from the last event before (``affected_from_ns``) to the first after it (``closed_ns``).

    One that lasts at ``until`` has a null ``closed_ns``. Slices of time are looked at apart, so a
    key with many events is spread.
    """
    t = events.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(key, F.col(time).alias("closed_ns"))
    gaps = before(t, [key], ["closed_ns"], "closed_ns", "affected_from_ns", F.expr(f"closed_ns div {240 * limit}"))
    over = gaps.where(F.col("closed_ns") - F.col("affected_from_ns") > limit).select(key, "affected_from_ns", "closed_ns")
    if until is None:
        return over
    still = t.groupBy(key).agg(F.max("closed_ns").alias("affected_from_ns")).where(F.lit(until) - F.col("affected_from_ns") > limit)
    return over.unionByName(still.withColumn("closed_ns", F.lit(None).cast("bigint")))
