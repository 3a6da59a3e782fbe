"""Structured Streaming twins of the batch operators."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators import exactly_once, late, parse
from tidemark.operators.book import reached
from tidemark.session import cut
from tidemark.sources.sinks import ledger

#: How far behind the newest receive time an event still finds its state. Fixed value.
HORIZON = "10 minutes"
#: Changes that wait for a snapshot at most, per book. Fixed value.
BUFFER = 4_096


def read(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1_000) -> DataFrame:
    """A directory of Parquet files as a stream, so many files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def received_at(df: DataFrame) -> DataFrame:
    return df.withColumn("received_at", F.timestamp_micros(F.expr("app_receive_realtime_ns div 1000")))


def unique(events: DataFrame, horizon: str = HORIZON) -> DataFrame:
    """Typed events without those repeated within the horizon.

    The watermark moves by micro-batch, so this drops what the batch operator flags, up to the
    batch in which it comes. Rows without an identity are all kept.
    """
    key, has = exactly_once.identity()
    src = received_at(events).withColumns({k: F.coalesce(c.cast("string"), F.lit("")) for k, c in key.items()})
    # rows without an identity get one of their own
    own = F.concat_ws("|", "connection_id", F.col("receive_seq").cast("string"))
    src = src.withColumn("__own", F.when(has, F.lit("")).otherwise(own)).withWatermark("received_at", horizon)
    return src.dropDuplicatesWithinWatermark([*key, "__own"]).drop(*key, "__own", "received_at")


def minute_counts(events: DataFrame, key: str = "exchange_symbol", horizon: str = HORIZON) -> DataFrame:
    """Events per key and minute of receipt, each minute once it can no longer change."""
    src = received_at(events).withWatermark("received_at", horizon)
    return src.groupBy(F.window("received_at", "1 minute").alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.expr("unix_millis(w.start) div 60000").alias("slot"), "n")


def silences(events: DataFrame, seconds: int, key: str = "exchange_symbol", horizon: str = HORIZON) -> DataFrame:
    """Stretches of activity per key that no pause of ``seconds`` breaks: first and last receipt, events."""
    src = received_at(events).where(F.col(key).isNotNull()).withWatermark("received_at", horizon)
    return src.groupBy(F.session_window("received_at", f"{seconds} seconds").alias("w"), key).agg(F.min("app_receive_realtime_ns").alias("first_ns"), F.max("app_receive_realtime_ns").alias("last_ns"), F.count(F.lit(1)).alias("n")).drop("w")


def raw_chunks(events: DataFrame, path: str, checkpoint: str, rows_per_file: int = 1_000_000) -> StreamingQuery:
    """Raw events to Parquet by date of receipt and writer group, all there is now."""
    out = events.withColumn("utc_date", F.date_format(F.timestamp_micros(F.expr("app_receive_realtime_ns div 1000")), "yyyy-MM-dd")).withColumn("writer_group", parse.writer_group("stream_type"))
    return out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").partitionBy("utc_date", "writer_group").trigger(availableNow=True).start()


def late_store(events: DataFrame, path: str, checkpoint: str, streams: tuple[str, ...] = ("agg_trade",)) -> StreamingQuery:
    """Partial aggregates of each micro-batch, each message once, one folder per batch: writing a batch again replaces it.

    A message counts when it first arrives: within a batch its first row by receive time,
    connection and number, and only if no earlier batch had it. For that the identities of each
    batch are kept beside its partials (narrow rows; copies can come at any distance in time, so
    none is forgotten). Batches hold rows in the order of their receipt. Rows without an identity
    all count. Read with :func:`read_store`; what came after a minute's cut-off is in stage 2 and in
    no figure.
    """
    key, has = exactly_once.identity(streams)
    spark, names = events.sparkSession, list(key)

    def write(batch: DataFrame, number: int) -> None:
        mine = batch.where(F.col("stream_type").isin(*streams)).withColumns(key)
        one = exactly_once.firsts(mine.where(has), names, ["app_receive_realtime_ns", "connection_id", "receive_seq"])
        earlier = [f"{path}/seen/arrival={n:012d}" for n in arrivals(spark, f"{path}/seen") if n < number]
        if earlier:
            one = one.join(spark.read.parquet(*earlier), names, "left_anti")
        one = cut(one)
        late.partials(one.unionByName(mine.where(~F.coalesce(has, F.lit(False))))).write.mode("overwrite").parquet(f"{path}/partials/arrival={number:012d}")
        one.select(*names).write.mode("overwrite").parquet(f"{path}/seen/arrival={number:012d}")

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the batches that a store has, ascending."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n.removeprefix("arrival=")) for n in names if n.startswith("arrival="))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The store's partial aggregates, merged over all arrivals."""
    return late.merge(spark.read.parquet(f"{path}/partials").drop("arrival"))


def ledger_of(events: DataFrame, path: str, checkpoint: str, time_ns: str, identity: str = "event_id") -> StreamingQuery:
    """Events to a ledger by date, each identity once, also if a batch is repeated after a failure."""
    return events.writeStream.foreachBatch(lambda batch, _: ledger(batch, path, time_ns, identity)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


_STATE = "expected bigint, anchor bigint, held array<struct<seq:bigint,first:bigint,last:bigint,previous:bigint>>"
_OUT = "exchange_symbol string, connection_id string, receive_seq bigint, status string, expected_id bigint, received_id bigint"


def bridges(events: DataFrame) -> DataFrame:
    """Live bridging of snapshots and changes per symbol and connection.

    Rows: BRIDGED when a snapshot meets the changes, STALE_SNAPSHOT when it is too old, and
    SEQUENCE_GAP (with the id expected and the one received) when the chain breaks; after a gap the
    event that broke it stays buffered, with what was buffered behind it. Within a micro-batch rows
    are taken by number.
    """
    src = events.where(F.col("stream_type").isin("depth", "depth_snapshot") & F.col("exchange_symbol").isNotNull()).select(
        "exchange_symbol", "connection_id", "receive_seq", (F.col("stream_type") == "depth_snapshot").alias("base"), F.col("first_update_id").alias("first"), F.coalesce("final_update_id", "last_update_id").alias("last"), F.col("previous_final_update_id").alias("previous")
    )
    src = src.where(F.col("last").isNotNull() & (F.col("base") | (F.col("first").isNotNull() & F.col("previous").isNotNull())))

    def run(key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        expected, anchor, held = state.get if state.exists else (None, None, [])
        buffer = np.array([tuple(h) for h in held or []], np.int64).reshape(-1, 4)
        rows = pd.concat(list(frames)).sort_values("receive_seq", kind="stable")
        base = rows["base"].to_numpy(bool)
        ids = rows[["receive_seq", "first", "last", "previous"]].fillna(-1).to_numpy(np.int64)
        out: list[tuple] = []
        at = 0
        while at < len(ids):
            if expected is not None:  # bridged: on to the first change that does not continue, or the next snapshot
                stop = at + int(np.argmax(np.append(base[at:], True)))
                before = np.concatenate([[expected], ids[at : stop - 1, 2]]) if stop > at else ids[:0, 2]
                torn = np.flatnonzero(ids[at:stop, 3] != before)
                if len(torn):
                    x = at + int(torn[0])
                    out.append((*key, ids[x, 0], "SEQUENCE_GAP", before[torn[0]], ids[x, 3]))
                    expected, anchor, buffer, at = None, None, ids[x : x + 1], x + 1
                    continue
                expected, at = int(ids[stop - 1, 2]) if stop > at else expected, stop
                if at == len(ids):
                    break
            if base[at]:
                anchor, expected = int(ids[at, 2]), None
            else:
                buffer = np.concatenate([buffer, ids[at : at + 1]])[-BUFFER:]
            if anchor is not None:
                buffer = buffer[np.argsort(buffer[:, 0], kind="stable")]
                buffer = buffer[reached(anchor, buffer[:, 2]) :]
                if len(buffer) and buffer[0, 1] > anchor:
                    out.append((*key, ids[at, 0], "STALE_SNAPSHOT", None, None))
                    anchor = None
                elif len(buffer):
                    torn = np.flatnonzero(buffer[1:, 3] != buffer[:-1, 2])
                    anchor = None
                    if len(torn):
                        x = int(torn[0]) + 1
                        out.append((*key, ids[at, 0], "SEQUENCE_GAP", buffer[x - 1, 2], buffer[x, 3]))
                        buffer = buffer[x:]
                    else:
                        out.append((*key, ids[at, 0], "BRIDGED", None, None))
                        expected, buffer = int(buffer[-1, 2]), buffer[:0]
            at += 1
        state.update((expected, anchor, [tuple(int(v) for v in h) for h in buffer]))
        frame = pd.DataFrame(out, columns=["exchange_symbol", "connection_id", "receive_seq", "status", "expected_id", "received_id"])
        yield frame.astype({"receive_seq": "Int64", "expected_id": "Int64", "received_id": "Int64"})

    return src.groupBy("exchange_symbol", "connection_id").applyInPandasWithState(run, _OUT, _STATE, "append", GroupStateTimeout.NoTimeout)
