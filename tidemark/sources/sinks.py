"""Writing typed days, projections, ledgers and markers."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import canonical_json, dumps
from tidemark.schemas import PROJECTION
from tidemark.session import cut


def typed_day(df: DataFrame, path: str) -> None:
    """Typed rows as Parquet, replaced as a whole."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def projection(df: DataFrame, path: str, order: list[str], rows_per_file: int = 5_000_000) -> None:
    """Book rows partitioned by symbol, each file in source order.

    Rows are range-partitioned by (symbol, order), so a symbol with many rows is written by several
    tasks into several files whose order is that of their names.
    """
    keep = ["exchange_symbol", *PROJECTION.names]
    src = df.where(F.col("stream_type").isin("depth", "depth_snapshot") & F.col("exchange_symbol").isNotNull())
    ranged = src.repartitionByRange("exchange_symbol", *order).sortWithinPartitions("exchange_symbol", *order)
    ranged.select(*keep).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").partitionBy("exchange_symbol").parquet(path)


def json_lines(df: DataFrame, path: str) -> None:
    """Rows as canonical JSON, one a line: keys sorted, nulls kept."""
    df.select(canonical_json(*[F.col(c) for c in df.columns]).alias("value")).write.mode("overwrite").text(path)


def ledger(df: DataFrame, path: str, time_ns: str, identity: str = "event_id") -> DataFrame:
    """Append events to a ledger by UTC date; gives those that were new.

    Events whose identity is in the ledger already are left out, and repeated ones appended once.
    An identity has one time, so only the dates at hand are read of the ledger.
    """
    spark = df.sparkSession
    dated = df.dropDuplicates([identity]).withColumn("utc_date", F.date_format(F.timestamp_micros(F.expr(f"{time_ns} div 1000")), "yyyy-MM-dd"))
    try:
        dates = [r[0] for r in dated.select("utc_date").distinct().collect()]
        known = spark.read.parquet(path).where(F.col("utc_date").cast("string").isin(dates)).select(identity)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        known = None
    fresh = dated if known is None else dated.join(known, identity, "left_anti")
    fresh = cut(fresh)
    fresh.write.mode("append").partitionBy("utc_date").parquet(path)
    return fresh


def marker(spark: SparkSession, value: dict[str, Any], path: str) -> None:
    """A small JSON document as one file, through the session's file system: written aside, then renamed."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(dumps(value)))
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(aside, target):
        raise OSError(f"could not publish {path}")


def read_marker(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """What :func:`marker` wrote; None if there is no such file. (Sources of Spark pass over names that begin with an underscore.)"""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return None
    src = fs.open(at)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(src, "UTF-8"))
    finally:
        src.close()
