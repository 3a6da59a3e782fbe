"""Evidence files of the market: instrument lists, daily bars, book samples (plain or gzipped JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ranking

DAY_MS = 86_400_000
_INFO = "symbols array<struct<symbol:string,contractType:string,status:string,quoteAsset:string,marginAsset:string,onboardDate:bigint>>"
_BARS = "window_start_ms bigint, window_end_exclusive_ms bigint, symbols map<string,struct<payload:array<array<string>>>>"
_BOOKS = "book_tickers array<struct<sample:bigint,payload:array<struct<symbol:string,bidPrice:string,askPrice:string>>>>, symbols map<string,array<struct<payload:struct<bids:array<array<string>>,asks:array<array<string>>>>>>"


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def instruments(spark: SparkSession, path: str) -> DataFrame:
    """One row per listed instrument; an error if one is listed twice."""
    rows = _json(spark, path, _INFO).select(F.explode("symbols").alias("s")).select("s.*").where("symbol is not null")
    if (twice := rows.groupBy("symbol").count().where("count > 1").limit(1).collect()):
        raise ValueError(f"instrument {twice[0][0]} is listed twice")
    return rows


def daily_bars(spark: SparkSession, path: str) -> DataFrame:
    """Bars as rows: symbol, open_ms, close_ms, quote_volume, trades, complete (closed before the cut-off). The cut-off must be a UTC midnight."""
    src = _json(spark, path, _BARS)
    if src.where(F.col("window_end_exclusive_ms") % DAY_MS != 0).limit(1).count():
        raise ValueError("the cut-off is not a UTC midnight")
    bars = src.select("window_end_exclusive_ms", F.explode("symbols").alias("symbol", "v")).select("symbol", "window_end_exclusive_ms", F.explode("v.payload").alias("b"))
    at = lambda i, t: F.get("b", F.lit(i)).try_cast(t)
    out = bars.select("symbol", at(0, "bigint").alias("open_ms"), at(6, "bigint").alias("close_ms"), at(7, "decimal(26,8)").alias("quote_volume"), at(8, "bigint").alias("trades"), "window_end_exclusive_ms")
    return out.withColumn("complete", F.col("close_ms") < F.col("window_end_exclusive_ms")).drop("window_end_exclusive_ms")


def ticker_spreads(spark: SparkSession, path: str) -> DataFrame:
    """Spread in basis points of each book ticker sample."""
    t = _json(spark, path, _BOOKS).select(F.explode("book_tickers").alias("s")).select("s.sample", F.explode("s.payload").alias("t")).select("sample", "t.*")
    bid, ask = F.col("bidPrice").try_cast("decimal(18,8)"), F.col("askPrice").try_cast("decimal(18,8)")
    return t.select("symbol", "sample", ((ask - bid).cast("double") / ((ask + bid).cast("double") / 2) * 10_000).cast("decimal(20,8)").alias("spread_bps"))


def book_levels(spark: SparkSession, path: str) -> DataFrame:
    """Levels of the sampled books: symbol, sample, side, price, quantity."""
    s = _json(spark, path, _BOOKS).select(F.explode("symbols").alias("symbol", "v")).select("symbol", F.posexplode("v").alias("sample", "d"))
    side = lambda n, c: s.select("symbol", "sample", F.lit(n).alias("side"), F.explode(f"d.payload.{c}").alias("l"))
    at = lambda i: F.get("l", F.lit(i)).try_cast("decimal(18,8)")
    return side("bid", "bids").unionByName(side("ask", "asks")).select("symbol", "sample", "side", at(0).alias("price"), at(1).alias("quantity"))


#: Samples of complete evidence: of the book, of the tickers. Fixed values.
DEPTH_SAMPLES, TICKER_SAMPLES = 3, 21


def liquidity(spark: SparkSession, path: str) -> DataFrame:
    """Per symbol what its samples show: number of both kinds, least depth within 10 and 50 bps, q95 of the spread, and whether all samples are there.

    Symbols without book samples have no row; without ticker samples the spread is null.
    """
    depth = ranking.thin_depth(book_levels(spark, path), ["symbol"], ["sample"]).withColumnRenamed("samples", "depth_samples")
    t = ticker_spreads(spark, path)
    spread = ranking.percentile(t.withColumn("x", F.col("spread_bps")), ["symbol"], "x", 19, 20, "spread_q95_bps").join(t.groupBy("symbol").agg(F.count(F.lit(1)).alias("ticker_samples")), "symbol")
    out = depth.join(spread, "symbol", "left").fillna(0, ["ticker_samples"])
    return out.withColumn("complete", (F.col("depth_samples") == DEPTH_SAMPLES) & (F.col("ticker_samples") == TICKER_SAMPLES))
