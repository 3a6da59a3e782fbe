"""Cross-sections: competition ranks, weakest-metric order, exact percentiles, activity regimes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import exact_percentile

#: Days of the baseline and horizons, least ratio and breadth, least symbols of a panel. Fixed values.
BASELINE_DAYS, HORIZONS, RATIO, BREADTH, LEAST_SYMBOLS = 28, (7, 3, 1), 1.25, 0.7, 60


def by_weakest(df: DataFrame, key: str, metrics: Sequence[tuple[str, bool]], group: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``rank_{metric}`` (1, 1, 3, ...) and ``position``.

    ``metrics`` pairs a column with whether more is better. Rows are ordered by their worst rank,
    then the sum of ranks, then the ranks in the order of the metrics, then the key; nulls rank
    last. A cross-section has one row per instrument; with ``group`` each group is one.
    """
    part = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    names = []
    for m, more in metrics:
        names.append(f"rank_{m}")
        df = df.withColumn(names[-1], F.rank().over(part.orderBy(F.desc_nulls_last(m) if more else F.asc_nulls_last(m))))
    worst = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return df.withColumn("position", F.row_number().over(part.orderBy(worst, total, *names, key)))


def percentile(df: DataFrame, by: Sequence[str], value: str, numerator: int, denominator: int, to: str, kind: str = "decimal(38,10)", of: str = "decimal(26,8)") -> DataFrame:
    """The exact percentile of a column of type ``of`` per group, without a list of a group's values.

    Values are counted first (combined on the map side), ordered by value within the group, and
    the two neighbours of the wanted place are picked from running counts.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("__x")).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*by).orderBy("__x")
    upto = F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("__n").over(Window.partitionBy(*by))
    rows = counts.withColumn("__hi", upto).withColumn("__pos", (total - 1) * numerator)
    lo = F.expr(f"__pos div {denominator}")
    holds = lambda at: (F.col("__hi") > at) & (F.col("__hi") - F.col("__n") <= at)
    got = rows.groupBy(*by).agg(
        F.max(F.when(holds(lo), F.col("__x"))).alias("__a"), F.max(F.when(holds(lo + 1), F.col("__x"))).alias("__b"), F.max(F.col("__pos") % denominator).alias("__r")
    )
    x, few = (lambda c: c.cast(of)), (lambda c: c.cast("decimal(4,0)"))
    mixed = (x(F.col("__a")) * few(F.lit(denominator) - F.col("__r")) + x(F.coalesce("__b", "__a")) * few(F.col("__r"))) / few(F.lit(denominator))
    return got.select(*by, mixed.cast(kind).alias(to))


def median(values: Column) -> Column:
    return exact_percentile(values, 1, 2)


def quotient(a: Column, b: Column) -> Column:
    """a / b of decimals(27,9), not negative and b above zero, exactly to 18 digits behind the point (then cut) as decimal(36,18).

    Long division in two steps of nine digits: one division of such decimals keeps ten digits only.
    """
    div = lambda x, y: F.call_function("div", x, y)
    nine = F.lit(10**9).cast("decimal(10,0)")
    wide = lambda c, t: c.cast(f"decimal({t})")
    whole, rest = div(a, b), wide(a % b, "27,9") * nine
    first, second = div(rest, b), div(wide(rest % b, "27,9") * nine, b)
    part = lambda q, unit: wide(q, "10,0") * F.lit(unit).cast("decimal(18,18)")
    return wide(wide(wide(whole, "18,0"), "36,18") + part(first, "0.000000001") + part(second, "0.000000000000000001"), "36,18")


def market_factors(days: DataFrame, end_day: int) -> DataFrame:
    """Per symbol and horizon the ratio of recent to baseline medians of ``volume`` and ``trades``, as decimals.

    ``days`` has one row per symbol and ``day``; figures are whole or have up to eight digits behind
    the point. Only symbols with every one of the 35 days before ``end_day`` and positive baselines
    take part; a null figure is a missing day. Median over at most 28 days each: groups are bounded
    by the calendar.
    """
    span = BASELINE_DAYS + max(HORIZONS)
    first = end_day - span
    src = days.where((F.col("day") >= first) & (F.col("day") < end_day) & F.col("volume").isNotNull() & F.col("trades").isNotNull()).withColumn("i", F.col("day") - first)
    full = src.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct("i", F.col("volume").cast("decimal(26,8)").alias("v"), F.col("trades").cast("decimal(26,8)").alias("t")))).alias("d")).where(F.size("d") == span)
    med = lambda f, lo, n: _median_of(F.transform(F.slice("d", lo + 1, n), lambda x: x[f]))
    base = full.withColumn("bv", med("v", 0, BASELINE_DAYS)).withColumn("bt", med("t", 0, BASELINE_DAYS)).where((F.col("bv") > 0) & (F.col("bt") > 0))
    recent = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), med("v", span - h, h).alias("v"), med("t", span - h, h).alias("t")) for h in HORIZONS]))
    return base.select("symbol", "bv", "bt", recent.alias("h")).select("symbol", "h.horizon", quotient(F.col("h.v"), F.col("bv")).alias("volume_factor"), quotient(F.col("h.t"), F.col("bt")).alias("trade_factor"))


def _median_of(a: Column) -> Column:
    s = F.array_sort(a)
    n = F.size(s)
    two = F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))
    return (two * F.lit("0.5").cast("decimal(1,1)")).cast("decimal(27,9)")


def market_context(factors: DataFrame, least: int = LEAST_SYMBOLS) -> DataFrame:
    """One row: the state of the whole market and the horizon that shows it.

    Per horizon the medians of the factors and the shares of symbols beyond the ratio in the
    direction of volume. A broad move has both medians and both shares beyond the limits. Seven
    days of it are ACTIVITY_SHIFT_CONFIRMED, three or one ACTIVITY_SHOCK_PENDING, else NORMAL by
    the last day. Panels that are too small, empty ones too, are NORMAL with horizon 0, factors of
    1 and shares of 0. All comparisons are of decimals.
    """
    number = lambda x: F.lit(str(x)).cast("decimal(4,2)")
    up, down = number(RATIO), number(1 / RATIO)
    kind = "decimal(36,18)"
    mid = factors.groupBy("horizon").agg(F.count(F.lit(1)).alias("panel"))
    for c, to in (("volume_factor", "vf"), ("trade_factor", "tf")):
        mid = mid.join(percentile(factors, ["horizon"], c, 1, 2, to, "decimal(38,19)", kind), "horizon")
    # three rows of horizons
    beyond = lambda c: F.count_if(F.when(F.col("vf") >= up, F.col(c) >= up).otherwise(F.col(c) <= down))
    wide = factors.join(F.broadcast(mid), "horizon").groupBy("horizon", "panel", "vf", "tf").agg(beyond("volume_factor").alias("vn"), beyond("trade_factor").alias("tn"))
    broad = lambda n: F.col(n) * 10 >= F.col("panel") * round(BREADTH * 10)
    moved = ((F.col("vf") >= up) & (F.col("tf") >= up) | (F.col("vf") <= down) & (F.col("tf") <= down)) & broad("vn") & broad("tn")
    state = F.when(moved & (F.col("horizon") == 7), "ACTIVITY_SHIFT_CONFIRMED").when(moved, "ACTIVITY_SHOCK_PENDING").otherwise("NORMAL")
    # the first that moved by falling horizon; without one, the last day
    order = F.when(moved, F.lit(100) - F.col("horizon")).otherwise(F.when(F.col("horizon") == 1, 1000).otherwise(2000))
    share = lambda n: (F.col(n) / F.col("panel")).cast("decimal(20,18)")
    best = wide.agg(F.min_by(F.struct(state.alias("state"), "horizon", "panel", "vf", "tf", share("vn").alias("vb"), share("tn").alias("tb")), order).alias("b"))
    enough = F.coalesce(F.col("b.panel") >= least, F.lit(False))
    pick = lambda c, other: F.when(enough, F.col(f"b.{c}")).otherwise(other)
    return best.select(
        pick("state", "NORMAL").alias("state"), pick("horizon", F.lit(0)).alias("horizon_days"), F.coalesce(F.col("b.panel"), F.lit(0)).alias("panel_count"),
        pick("vf", F.lit(1)).alias("volume_factor"), pick("tf", F.lit(1)).alias("trade_factor"), pick("vb", F.lit(0)).alias("volume_breadth"), pick("tb", F.lit(0)).alias("trade_breadth"),
    )


def band_depth(levels: DataFrame, by: Sequence[str], bps: int) -> DataFrame:
    """The thinner side's exact notional within ``bps`` of the mid price, per group.

    ``levels`` has ``side`` (bid, ask), ``price`` and ``quantity`` as decimals. Groups without both
    sides give none.
    """
    best = levels.groupBy(*by).agg(F.max(F.when(F.col("side") == "bid", F.col("price"))).alias("__b"), F.min(F.when(F.col("side") == "ask", F.col("price"))).alias("__a"))
    best = best.where(F.col("__b").isNotNull() & F.col("__a").isNotNull())
    # price against mid (1 -+ bps/10000), in whole multiples: 20000 p against (b + a)(10000 -+ bps)
    mid, p = F.col("__b") + F.col("__a"), F.col("price") * 20_000
    near = F.when(F.col("side") == "bid", p >= mid * (10_000 - bps)).otherwise(p <= mid * (10_000 + bps))
    value = F.when(near, F.col("price") * F.col("quantity"))
    sums = levels.join(best, list(by)).groupBy(*by).agg(*[F.coalesce(F.sum(F.when(F.col("side") == s, value)), F.lit(0)).alias(s) for s in ("bid", "ask")])
    return sums.select(*by, F.least("bid", "ask").alias(f"depth_{bps}bps"))


def thin_depth(levels: DataFrame, by: Sequence[str], sample: Sequence[str], bands: Sequence[int] = (10, 50)) -> DataFrame:
    """Per ``by`` the number of samples with both sides and the least :func:`band_depth` over them, for each band."""
    key = [*by, *sample]
    out = None
    for b in bands:
        one = band_depth(levels, key, b).groupBy(*by).agg(F.count(F.lit(1)).alias("samples"), F.min(f"depth_{b}bps").alias(f"thin_depth_{b}bps"))
        out = one if out is None else out.join(one.drop("samples"), list(by))
    return out


def block_statistics(days: DataFrame, block: int) -> DataFrame:
    """Per block of ``block`` days what the market was like, for ``volume`` and ``trades``.

    ``days``: one row per symbol and ``day``, decimals. Columns: ``block`` (number), symbols; of each
    metric the median day of the whole market (``market_``), the quartiles of the symbols' own
    median days (``p25_``, ``p50_``, ``p75_``), and ``up_``: the share of symbols whose median is
    above that of the block before, of those that are in both (null in the first block).
    """
    d = days.withColumn("block", F.expr(f"day div {block}"))
    wide = "decimal(36,8)"
    out = d.groupBy("block").agg(F.count_distinct("symbol").alias("symbols"))
    for m in ("volume", "trades"):
        total = d.groupBy("block", "day").agg(F.sum(F.col(m).cast("decimal(26,8)")).cast("decimal(28,8)").alias("x"))
        own = percentile(d.withColumn("x", F.col(m).cast("decimal(26,8)")), ["block", "symbol"], "x", 1, 2, "x", "decimal(26,8)")
        out = out.join(percentile(total, ["block"], "x", 1, 2, f"market_{m}", wide, "decimal(28,8)"), "block", "left")
        for q in (1, 2, 3):
            out = out.join(percentile(own, ["block"], "x", q, 4, f"p{25 * q}_{m}", wide), "block", "left")
        was = own.select((F.col("block") + 1).alias("block"), "symbol", F.col("x").alias("was"))
        up = own.join(was, ["block", "symbol"]).groupBy("block").agg((F.count_if(F.col("x") > F.col("was")) / F.count(F.lit(1))).alias(f"up_{m}"))
        out = out.join(up, "block", "left")
    return out
