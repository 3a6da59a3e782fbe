"""Streams run to their end over directories of files, against the batch operators."""

from pyspark.sql import functions as F

from tidemark.operators import late
from tidemark.plans.feeds import p6_revisions
from tidemark.schemas import TYPED
from tidemark.streaming import feeds

SF = "/root/testdata/sf0.001"


def _split(spark, tmp_path, n=3):
    t = spark.read.parquet(f"{SF}/typed_events.parquet").select(*[F.col(f.name).cast(f.dataType) for f in TYPED])
    lo, hi = t.agg(F.min("app_receive_realtime_ns"), F.max("app_receive_realtime_ns")).first()
    src = tmp_path / "src"
    for i in range(n):
        part = t.where((F.col("app_receive_realtime_ns") - lo) * n >= (hi - lo + 1) * i).where((F.col("app_receive_realtime_ns") - lo) * n < (hi - lo + 1) * (i + 1))
        part.coalesce(1).write.mode("append").parquet(f"file://{src}")
    return t, str(src)


def _drain(df, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name)


def test_late_store_equals_batch(spark, tmp_path):
    """Row for row what p6_revisions gives for the same table, which has repeats within and across the batches."""
    t, src = _split(spark, tmp_path, 5)
    at = str(tmp_path / "d")
    t.write.parquet(f"{at}/typed_events.parquet")
    store = str(tmp_path / "store")
    feeds.late_store(feeds.read(spark, src, TYPED, 1), store, str(tmp_path / "ck")).awaitTermination(240)
    assert feeds.arrivals(spark, f"{store}/partials") == [0, 1, 2, 3, 4]
    got, want = (sorted(map(tuple, x.collect()), key=repr) for x in (late.revisions(feeds.read_store(spark, store)), p6_revisions(spark, at)))
    assert len(want) > 10 and got == want
    naive = late.revisions(late.merge(late.partials(t.where("stream_type = 'agg_trade'"))))
    assert sorted(map(tuple, naive.collect()), key=repr) != want  # without the repeats left out it would differ


def test_unique_keeps_one_of_each(spark, tmp_path):
    _, src = _split(spark, tmp_path)
    out = _drain(feeds.unique(feeds.read(spark, src, TYPED)), "unique_rows")
    twice = out.where("stream_type = 'agg_trade' and aggregate_trade_id is not null and exchange_symbol is not null").groupBy("exchange_symbol", "aggregate_trade_id").count().where("count > 1")
    assert out.count() > 0 and twice.count() == 0


def test_minute_counts(spark, tmp_path):
    t, src = _split(spark, tmp_path)
    out = _drain(feeds.minute_counts(feeds.read(spark, src, TYPED)), "minute_rows")
    want = {(r[0], r[1]): r[2] for r in t.groupBy("exchange_symbol", F.expr("app_receive_realtime_ns div 60000000000")).count().collect()}
    got = {(r[0], r[1]): r[2] for r in out.collect()}
    assert got and all(want[k] == n for k, n in got.items())


def test_bridges(spark, tmp_path):
    rows = [("A", "c", s, q, q, a, b, p, last) for s, q, a, b, p, last in [
        ("depth", 1, 90, 99, 89, None), ("depth_snapshot", 2, None, None, None, 105), ("depth", 3, 100, 110, 99, None),
        ("depth", 4, 111, 112, 110, None), ("depth", 5, 120, 121, 119, None), ("depth_snapshot", 6, None, None, None, 50),
    ]]
    cols = "exchange_symbol string, connection_id string, stream_type string, receive_seq bigint, app_receive_realtime_ns bigint, first_update_id bigint, final_update_id bigint, previous_final_update_id bigint, last_update_id bigint"
    df = spark.createDataFrame(rows, cols)
    df.coalesce(1).write.parquet(str(tmp_path / "b"))
    out = _drain(feeds.bridges(feeds.read(spark, str(tmp_path / "b"), df.schema)), "bridge_rows")
    got = [(r.receive_seq, r.status, r.expected_id, r.received_id) for r in out.orderBy("receive_seq").collect()]
    assert got == [(3, "BRIDGED", None, None), (5, "SEQUENCE_GAP", 112, 119), (6, "STALE_SNAPSHOT", None, None)]


def test_chunks_and_ledger(spark, tmp_path):
    raw = spark.read.parquet(f"{SF}/raw_events.parquet")
    raw.coalesce(2).write.parquet(str(tmp_path / "raw"))
    feeds.raw_chunks(feeds.read(spark, str(tmp_path / "raw"), raw.schema), str(tmp_path / "out"), str(tmp_path / "ck1")).awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == raw.count() and {"utc_date", "writer_group"} <= set(out.columns)
    ev = spark.createDataFrame([(i % 5, 10**18 + i) for i in range(10)], "event_id bigint, ns bigint")
    ev.coalesce(1).write.parquet(str(tmp_path / "ev"))
    for k in range(2):
        feeds.ledger_of(feeds.read(spark, str(tmp_path / "ev"), ev.schema), str(tmp_path / "led"), str(tmp_path / f"ck-{k}"), "ns").awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "led")).count() == 5
