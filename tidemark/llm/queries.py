"""Queries of the language-model problems, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import encode, mix, nearest, reading
from tidemark.session import spread


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """The documents, on all cores even if the table is one small file: the work per row is long."""
    return spread(_t(spark, d, "documents"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return nearest.marks_with_tickers(_t(spark, d, "typed_events")).select("exchange_symbol", "mark_event_time_ms", "update_id")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode(_documents(spark, d), ["doc_id"])


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mix.mixture(_documents(spark, d), _t(spark, d, "mix_targets"))[0]


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """Shares reached, recounted from the mixture itself rather than from the plan."""
    mixed, report = mix.mixture(_documents(spark, d), _t(spark, d, "mix_targets"))
    got = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("n"), F.max("copies").alias("most_copies"), F.count(F.lit(1)).alias("documents_used"))
    total = F.sum("n").over(Window.partitionBy())
    shares = got.withColumn("share", F.round(F.col("n") / total, 9))
    return report.drop("mix_tokens", "actual_share").join(shares, "source", "left").select(
        "source", "target_share", "max_repeats", "documents", "source_tokens", "budget_tokens",
        F.coalesce("n", F.lit(0)).alias("mix_tokens"), F.coalesce("share", F.lit(0.0)).alias("actual_share"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"), F.coalesce("documents_used", F.lit(0)).alias("documents_used"),
    )


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return reading.demanding(_documents(spark, d), _t(spark, d, "reading_labels"))


def p9_levels(spark: SparkSession, d: str) -> DataFrame:
    """Documents and words by rounded level (null: no prose of an author)."""
    rows = reading.levels(_documents(spark, d), _t(spark, d, "reading_labels"))
    return rows.groupBy(F.round("level").cast("int").alias("reading_level")).agg(F.count(F.lit(1)).alias("documents"), F.sum("words").alias("words"))


P5 = """with m as (select distinct exchange_symbol s, exchange_event_time_ms t from typed_events where stream_type = 'mark_price' and exchange_symbol is not null and exchange_event_time_ms is not null and mark_price is not null),
k as (select exchange_symbol s, exchange_event_time_ms r, max(update_id) u from typed_events where stream_type = 'book_ticker' and exchange_symbol is not null and exchange_event_time_ms is not null and bid_price is not null group by all),
j as (select m.s, m.t, k.u, row_number() over (partition by m.s, m.t order by abs(k.r - m.t), k.r) n from m join k on m.s = k.s and k.r between m.t - 2000 and m.t + 2000)
select s exchange_symbol, t mark_event_time_ms, u update_id from j where n = 1"""

QUERIES = {f.__name__: f for f in (p5_found, p7_ids, p8_mixture, p8_report, p9_found, p9_levels)}
ORACLES = {"p5_found": P5}
