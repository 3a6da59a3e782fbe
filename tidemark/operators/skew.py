"""Per-key results where a few keys hold most rows (problem 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut, small


def number_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], to: str = "number", partitions: int | None = None) -> DataFrame:
    """Number the rows of each key from 1 in the given order, whatever a key's share of the rows.

    Range partitioning on (keys, order) samples quantiles of the composite key and so splits a
    heavy key over as many partitions as its rows need. Each partition numbers its own rows; the
    count with which a key enters a partition is stitched from the partial counts of the ones
    before. Only (partition, key) counts are joined back: at most partitions + keys rows.

    The order should be total; rows that tie in all of it are numbered in an arbitrary order.
    Nulls sort first; a null key is a key of its own. All columns are kept; ``to`` must be free.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    k = list(keys)
    ranged = df.repartitionByRange(n, *k, *order).sortWithinPartitions(*k, *order)
    ranged = cut(ranged.withColumn("__pos", F.monotonically_increasing_id()))  # partition << 33, then the row's place
    ranged = ranged.withColumn("__part", F.shiftright("__pos", 33).cast("int"))
    parts = ranged.groupBy("__part", *k).agg(F.min("__pos").alias("__start"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*k).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("__part").alias("__p"), *[F.col(c).alias(f"__k_{c}") for c in k], "__start", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__carry"))
    parts = small(cut(parts))
    on = F.col("__part") == F.col("__p")
    for c in k:
        on = on & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    return ranged.join(parts, on).select(*df.columns, (F.col("__pos") - F.col("__start") + F.col("__carry") + 1).alias(to))


def messages(raw: DataFrame) -> DataFrame:
    """One row per received message: ``connection_id``, ``receive_seq``, ``segment_id``, ``ns``, ``symbol``.

    Rows with equal (connection, number) are one message; copies that disagree give the earliest
    time, the lowest segment and the highest symbol that one of them has. The symbol is the
    envelope's, else ``data.s``, else ``data.o.s`` of the payload, in upper case. Messages without
    a symbol, connection or number are left out. The payload is only parsed where the envelope has
    no symbol, and never shuffled.
    """
    text = F.col("payload_bytes").cast("string")
    symbol = F.upper(F.coalesce(F.col("exchange_symbol"), F.get_json_object(text, "$.data.s"), F.get_json_object(text, "$.data.o.s")))
    rows = raw.select("connection_id", "receive_seq", "segment_id", F.col("app_receive_realtime_ns").alias("ns"), symbol.alias("symbol"))
    rows = rows.where(F.col("symbol").isNotNull() & F.col("connection_id").isNotNull() & F.col("receive_seq").isNotNull())
    return rows.groupBy("connection_id", "receive_seq").agg(F.min("segment_id").alias("segment_id"), F.min("ns").alias("ns"), F.max("symbol").alias("symbol"))


def message_blocks(raw: DataFrame, rates: DataFrame) -> DataFrame:
    """Each message of a symbol with a rate, with its ``number`` in (segment, symbol) by order of
    receipt and the ``block`` of ``message_rate`` messages it falls in, both from 1.

    Rates that are null or below 1 do not count; of several rates of a symbol the highest counts.
    """
    r = rates.where(F.col("message_rate") >= 1).groupBy(F.upper("exchange_symbol").alias("symbol")).agg(F.max("message_rate").alias("message_rate"))
    # written once: the range partitioning behind it reads its rows twice, for the quantiles and for the rows
    rated = cut(messages(raw).join(small(r), "symbol"))
    numbered = number_in_order(rated, ["segment_id", "symbol"], ["ns", "connection_id", "receive_seq"])
    return numbered.withColumn("block", F.expr("(number - 1) div message_rate + 1"))
