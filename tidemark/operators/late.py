"""Per-period aggregates by event time that late records correct, up to a cut-off (problem 6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import product
from tidemark.operators.exactly_once import deduplicated
from tidemark.session import cut

MINUTE_MS = 60_000
#: After a period's end: first publication, and the cut-off beyond which it is closed.
GRACE_MS, CUTOFF_MS = 2_000, 300_000
MS = 1_000_000

#: How the figures of two partial aggregates of one period are merged.
MERGE = {"trades": F.sum, "unread": F.sum, "quantity": F.sum, "notional": F.sum, "low": F.min, "high": F.max, "last_ns": F.max}


def stage(receive_ns: Column, period_ms: Column) -> Column:
    """0: before first publication; 1: late but before the cut-off; 2: the period is closed."""
    late = receive_ns - (period_ms + MINUTE_MS) * MS
    return F.when(late < GRACE_MS * MS, 0).when(late < CUTOFF_MS * MS, 1).otherwise(2)


def partials(events: DataFrame, batch_ms: int = MINUTE_MS) -> DataFrame:
    """Mergeable partial aggregates per symbol, minute and arrival batch.

    ``batch`` numbers the arrival interval of ``batch_ms``; ``stage`` is what that arrival means for
    the minute (see :func:`stage`). An event belongs to the minute of its transaction time, or if
    null of its event time; without either, a symbol or a receive time it is left out. Prices or
    quantities that are null or no numbers count as trades only, and in ``unread``.
    """
    at = F.coalesce("exchange_transaction_time_ms", "exchange_event_time_ms")
    price, quantity = F.col("price").try_cast("decimal(28,8)"), F.col("quantity").try_cast("decimal(28,8)")
    minute = (F.floor(at / MINUTE_MS) * MINUTE_MS).cast("bigint")
    src = events.where(F.col("exchange_symbol").isNotNull() & at.isNotNull() & F.col("app_receive_realtime_ns").isNotNull()).select(
        "exchange_symbol", minute.alias("minute_ms"), F.col("app_receive_realtime_ns").alias("ns"), price.alias("p"), quantity.alias("q")
    )
    batch = F.expr(f"ns div {batch_ms * MS}").alias("batch")
    return src.groupBy("exchange_symbol", "minute_ms", batch, stage(F.col("ns"), F.col("minute_ms")).alias("stage")).agg(
        F.count(F.lit(1)).alias("trades"),
        F.sum("q").cast("decimal(38,8)").alias("quantity"),
        F.sum(product("p", "q")).alias("notional"),
        F.count_if(F.col("p").isNull() | F.col("q").isNull()).alias("unread"),
        F.min("p").alias("low"),
        F.max("p").alias("high"),
        F.max("ns").alias("last_ns"),
    )


def merge(*stores: DataFrame) -> DataFrame:
    """Partial aggregates of several arrivals or stores combined per period and stage; associative and commutative.

    What comes out can be merged again, or replace what went in.
    """
    out = stores[0]
    for s in stores[1:]:
        out = out.unionByName(s)
    types = dict(out.dtypes)
    return out.groupBy("exchange_symbol", "minute_ms", "stage").agg(F.max("batch").alias("batch"), *[f(c).cast(types[c]).alias(c) for c, f in MERGE.items()])


def revisions(store: DataFrame) -> DataFrame:
    """One row per symbol and minute: figures as first known, as corrected later, and what came after the cut-off.

    Read from partial aggregates alone. ``first_*``: stage 0. ``final_*``: stages 0 and 1.
    ``refused_trades``: stage 2, in neither. Figures of a stage without trades are null, counts 0.
    """
    n = lambda *s: F.coalesce(F.sum(F.when(F.col("stage").isin(*s), F.col("trades"))), F.lit(0)).cast("bigint")
    t = dict(store.dtypes)
    of = lambda c, *s: MERGE[c](F.when(F.col("stage").isin(*s), F.col(c))).cast(t[c])
    return store.groupBy("exchange_symbol", "minute_ms").agg(
        n(0).alias("first_trades"), of("quantity", 0).alias("first_quantity"), of("notional", 0).alias("first_notional"),
        n(0, 1).alias("final_trades"), of("quantity", 0, 1).alias("final_quantity"), of("notional", 0, 1).alias("final_notional"),
        of("low", 0, 1).alias("final_low"), of("high", 0, 1).alias("final_high"),
        n(1).alias("corrections"), n(2).alias("refused_trades"),
    )


def outcomes(store: DataFrame) -> DataFrame:
    """``corrected`` for each symbol and minute with a late trade before the cut-off, ``incomplete`` with one after it."""
    r = revisions(store).where((F.col("corrections") > 0) | (F.col("refused_trades") > 0))
    tests = [F.when(F.col("corrections") > 0, F.lit("corrected")), F.when(F.col("refused_trades") > 0, F.lit("incomplete"))]
    return r.select("exchange_symbol", "minute_ms", F.explode(F.array_compact(F.array(*tests))).alias("outcome"))


def trade_minutes(spark: SparkSession, path: str) -> DataFrame:
    """A store of the aggregate trades of a typed table, each message once: partial aggregates per period and arrival batch, merged on read.

    The partials are written to the shared folder, as the stream writes its own
    (:func:`tidemark.streaming.feeds.late_store`); figures only ever come from the store.
    """
    columns = ["exchange_symbol", "exchange_transaction_time_ms", "exchange_event_time_ms", "app_receive_realtime_ns", "price", "quantity"]
    return merge(cut(partials(deduplicated(spark, path, columns, ["agg_trade"]))))
