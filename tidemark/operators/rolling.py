"""Rolling totals over trailing periods, days without activity included (problem 3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_MS = 86_400_000
#: Longest windows in a chunk of days.
CHUNKS = 8


def latest_daily(rows: DataFrame, entity: str, time_ms: str, version: str, metrics: Mapping[str, Column]) -> DataFrame:
    """One row per entity and UTC day (``day``, days since the epoch): the row with the largest version.

    Equal versions: the larger metrics, compared in their order, nulls lowest. A null version is
    the lowest. Null entity or time: ignored.
    """
    pick = F.max(F.struct(F.col(version).alias("__version"), *[c.alias(m) for m, c in metrics.items()]))
    day = F.expr(f"cast(floor(`{time_ms}` / {DAY_MS}) as bigint)")
    src = rows.where(F.col(entity).isNotNull() & F.col(time_ms).isNotNull())
    return src.groupBy(F.col(entity), day.alias("day")).agg(pick.alias("r")).select(entity, "day", *[F.col("r")[m].alias(m) for m in metrics])


def trailing(daily: DataFrame, entity: str, metrics: Sequence[str], windows: Sequence[int] = (7, 30)) -> DataFrame:
    """Trailing totals and averages of each entity and day from its first day to its last.

    ``daily`` has at most one row per entity and ``day``. Days without a row and null figures are
    zero. Output: entity, ``day``, ``age`` (days since the entity's first) and for each metric and
    window w ``{metric}_sum_{w}`` and ``{metric}_avg_{w}`` (the total over w, also before w days
    have passed: days before the first count as zero). Sums keep the metric's exact type. Rows
    with a null entity or day: ignored.

    Block decomposition: days are cut into blocks of w. A window ending at day d is the prefix sum
    of d's block up to d plus the suffix sum of the block before from d-w+1 on. For that, one
    shuffle sends rows to (entity, chunk of days), and the days that the next chunk's windows
    reach back to also there; blocks, prefixes and suffixes are then made inside a chunk, whose
    length is fixed, so no task has a whole entity.
    """
    halo = max(windows) - 1
    span = CHUNKS * max(windows)
    types = dict(daily.dtypes)
    zero = {m: F.lit(0).cast(types[m]) for m in metrics}
    daily = daily.where(F.col(entity).isNotNull() & F.col("day").isNotNull())
    ends = daily.groupBy(entity).agg(F.min("day").alias("__lo"), F.max("day").alias("__hi"))
    # zero days before the first one, so that each window has all its days
    spine = ends.select(entity, F.explode(F.expr(f"sequence(__lo - {halo}, __hi)")).alias("day"), (F.col("day") - F.col("__lo")).cast("int").alias("age"), *[zero[m].alias(m) for m in metrics])
    seen = daily.select(entity, "day", F.lit(None).cast("int").alias("age"), *[F.coalesce(F.col(m), zero[m]).alias(m) for m in metrics])
    chunk = F.floor(F.col("day") / span).cast("bigint")
    to = F.array_compact(F.array(chunk, F.when(F.col("day") >= (chunk + 1) * span - halo, chunk + 1)))
    sent = spine.unionByName(seen).withColumn("__c", F.explode(to)).repartition(entity, "__c")
    own = Window.partitionBy(entity, "__c")
    dense = sent.groupBy(entity, "__c", "day").agg(F.max("age").alias("age"), *[F.sum(m).cast(types[m]).alias(m) for m in metrics])
    names = [(m, w) for w in windows for m in metrics]
    # suffixes over the same ascending order as prefixes: one sort per window length serves all metrics
    for w in windows:
        block = Window.partitionBy(entity, "__c", F.expr(f"floor(day / {w})")).orderBy("day")
        up, down = block.rowsBetween(Window.unboundedPreceding, 0), block.rowsBetween(0, Window.unboundedFollowing)
        dense = dense.withColumns({f"__{side}_{m}_{w}": F.sum(m).over(frame) for m in metrics for side, frame in (("p", up), ("s", down))})
    # days of a chunk have no holes, so the row w - 1 before is the day w - 1 before
    behind = own.orderBy("day")
    dense = dense.withColumns({f"__b_{m}_{w}": F.lag(f"__s_{m}_{w}", w - 1).over(behind) for m, w in names if w > 1})
    kind = dict(dense.dtypes)

    def total(m: str, w: int) -> Column:
        prefix = F.col(f"__p_{m}_{w}")
        # on a block's last day the prefix has the whole window
        return prefix if w == 1 else F.when(F.expr(f"pmod(day, {w})") == w - 1, prefix).otherwise((prefix + F.col(f"__b_{m}_{w}")).cast(kind[f"__p_{m}_{w}"]))

    mine = dense.where((F.col("age") >= 0) & (F.col("__c") == chunk))
    out = [total(m, w).alias(f"{m}_sum_{w}") for m, w in names] + [(total(m, w).cast("double") / w).alias(f"{m}_avg_{w}") for m, w in names]
    return mine.select(entity, "day", F.col("age").cast("bigint").alias("age"), *out)


def activity_days(klines: DataFrame) -> DataFrame:
    """Trailing 7 and 30 day totals of quote volume and trades of each symbol and day of the bars."""
    metrics = {"quote_volume": F.col("quote_volume").try_cast("decimal(26,8)"), "trades": F.col("trades").cast("bigint")}
    daily = latest_daily(klines, "exchange_symbol", "open_ms", "request_realtime_ns", metrics)
    return trailing(daily, "exchange_symbol", list(metrics)).withColumn("open_ms", F.col("day") * DAY_MS)


def surges(klines: DataFrame) -> DataFrame:
    """Days on which a metric's 7-day average is at least 1.25 times its 30-day average.

    Exact: s7/7 >= 1.25 s30/30 is 24 s7 >= 7 s30 in whole multiples of the totals.
    """
    days = activity_days(klines).where(F.col("age") >= 29)
    hit = lambda m, t: (F.col(f"{m}_sum_30") > 0) & (F.col(f"{m}_sum_7").cast(t) * 24 >= F.col(f"{m}_sum_30").cast(t) * 7)
    tests = [F.when(hit("quote_volume", "decimal(34,8)"), F.lit("quote_volume")), F.when(hit("trades", "decimal(20,0)"), F.lit("trades"))]
    return days.select("exchange_symbol", "open_ms", F.explode(F.array_compact(F.array(*tests))).alias("metric"))
