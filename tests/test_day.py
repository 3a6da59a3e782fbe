"""A sealed day from raw chunks to its verdict, and what must end it early."""

import hashlib
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.operators import window
from tidemark.sources import sinks

DAY, C = "2026-08-10", "c1"
LO, HI = jobs.bounds(DAY)
S = 10**9


def event(symbol, stream, seq, ns, data, connection="a", request=None):
    return (1, symbol, stream, C, "boot", "seg", connection, seq, ns, ns, json.dumps(data).encode(), "r" if request else None, request)


def depth(u0, u, pu, bids=(("100", "1"),), asks=(("101", "0.00000000"), ("102", "2"))):
    return {"data": {"e": "depthUpdate", "E": 1, "T": 2, "s": "btcusdt", "U": u0, "u": u, "pu": pu, "b": list(bids), "a": list(asks)}}


HASH = "5" * 64


def decided(ns, sequence=3, members=("BTCUSDT",), at="2026-08-09T00:00:00+00:00", sha=HASH):
    return event(None, "universe_decision", 900 + sequence, ns, {"core_generation": 2, "candidate_revision": 1, "decision_sequence": sequence, "universe_version": "2.1", "effective_at": at, "core": list(members), "boundary": [], "probe": [], "universe_hash": sha})


def started(ns, **other):
    said = {"event": "FORMAL_COLLECTION_STARTED", "experiment_id": "x", "core_generation": 2, "candidate_revision": 1, "decision_sequence": 3, "universe_version": "2.1", "universe_hash": HASH, "started_at": "2026-08-10T02:00:00+00:00"}
    return event(None, "formal_collection_started", 990, ns, said | other)


def publish(root, rows, gaps=(), name="chunk-0001", spoil=None, day=DAY, about=None):
    base = root / f"collector={C}"
    at = base / f"date={day}/writer=depth"
    at.mkdir(parents=True, exist_ok=True)
    names = "schema_version exchange_symbol stream_type collector_id boot_id segment_id connection_id receive_seq app_receive_realtime_ns app_receive_monotonic_ns payload_bytes request_id request_realtime_ns".split()
    types = [pa.int16(), *[pa.string()] * 6, *[pa.int64()] * 3, pa.binary(), pa.string(), pa.int64()]
    chunks = []
    path = at / f"{name}.parquet"
    own = {"chunk_id": name, "collector_id": C, "data_contract_hash": "d" * 64, "universe_hash": HASH, "utc_date": day, "writer_group": "depth"}
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
    pq.write_table(table.replace_schema_metadata(own | (about or {})), path)
    ref = {"chunk_id": name, "data_path": f"date={day}/writer=depth/{name}.parquet", "sha256": hashlib.sha256(path.read_bytes()).hexdigest(), "size_bytes": path.stat().st_size, "content_type": "application/x.parquet"}
    manifest = ref | own | {"event_count": len(rows), "min_app_receive_realtime_ns": min(r[8] for r in rows), "max_app_receive_realtime_ns": max(r[8] for r in rows)}
    (at / f"{name}.manifest.json").write_text(json.dumps(manifest | (spoil or {})))
    chunks.append(ref)
    for i, g in enumerate(gaps):
        p = at / f"gap-{i}.json"
        p.write_text(json.dumps({"schema_version": 2, "gap_id": "gap-00001", "collector_id": C, "reason": "CONNECTION_LOST_GAP", "exchange_symbols": [], "stream_types": ["depth"], "detail": ""} | g))
        chunks.append({"chunk_id": f"gapfact-{i}", "data_path": f"date={day}/writer=depth/gap-{i}.json", "sha256": hashlib.sha256(p.read_bytes()).hexdigest(), "size_bytes": p.stat().st_size, "content_type": "application/x.gap+json"})
    seal = base / f"day-manifests/date={day}"
    seal.mkdir(parents=True, exist_ok=True)
    (seal / "SEALED.json").write_text(json.dumps({"schema_version": 1, "collector_id": C, "utc_date": day, "chunks": chunks}))
    return path


ROWS = [
    event("BTCUSDT", "depth_snapshot", 1, LO + 1, {"lastUpdateId": 100, "bids": [["99", "1"]], "asks": [["103", "1"]]}, request=LO),
    event(None, "depth", 2, LO + 2, depth(100, 101, 99)),
    event("btcusdt", "depth", 3, LO + 3, depth(102, 103, 101)),
    event("BTCUSDT", "depth", 1, LO + 4, depth(102, 103, 101), connection="b"),
    event(None, "clock_sample", 4, LO + 5 * S, {"serverTime": LO // 10**6 + 5_000}, request=LO + 5 * S - 200_000),
    event("BTCUSDT", "exchange_info", 5, LO + 6 * S, {"symbols": []}),
    decided(LO),
]


def test_day_is_accepted(spark, tmp_path):
    gaps = [{"state": "OPEN", "observed_at_realtime_ns": LO, "affected_from_realtime_ns": None}, {"state": "CLOSED", "observed_at_realtime_ns": LO + 1}]
    publish(tmp_path / "raw", [*ROWS, started(LO)], gaps)
    got = jobs.normalize(spark, str(tmp_path / "raw"), str(tmp_path / "out"), C, DAY)
    assert (got["raw_events"], got["typed_events"], got["duplicate_events"]) == (8, 5, 1)
    assert (got["collection_window_start_ns"], got["formal_start_realtime_ns"], got["expected_symbols"], got["decision_sequence"]) == (LO, LO, ["BTCUSDT"], 3)
    typed = {(r.connection_id, r.receive_seq): r for r in spark.read.parquet(f"{tmp_path}/out/typed/collector={C}/date={DAY}").collect()}
    assert typed["b", 1].is_duplicate and not typed["a", 3].is_duplicate and typed["a", 2].exchange_symbol == "BTCUSDT"
    assert [(x.price, x.quantity) for x in typed["a", 2].asks] == [("101", "0E-8"), ("102", "2")]
    data = depth(100, 101, 99)["data"]
    assert typed["a", 2].payload_hash == hashlib.sha256(json.dumps(data, sort_keys=True, separators=(",", ":")).encode()).digest()
    clock = spark.read.json(f"{tmp_path}/out/clock/collector={C}/date={DAY}").collect()
    assert [(c.clock_sample_rtt_ns, c.clock_offset_uncertainty_ns, c.status) for c in clock] == [(200_000, 100_000, "VALID")]
    assert jobs.rebuild(spark, str(tmp_path / "out"), C, DAY) == (1, 1)
    verdict = jobs.finalize(spark, str(tmp_path / "out"), C, DAY, ["BTCUSDT"])
    assert verdict["accepted"] and verdict["coverage"]["BTCUSDT"]["unclassified_ns"] == 0 and verdict["coverage"]["BTCUSDT"]["explicit_invalid_ns"] == 2
    for wrong in (["BTCUSDT", "ETHUSDT"], [], ["ETHUSDT"]):
        with pytest.raises(ValueError, match="not the expected"):
            jobs.finalize(spark, str(tmp_path / "out"), C, DAY, wrong)
    assert (tmp_path / f"out/verdict/collector={C}/date={DAY}/_PROCESSED.json").exists()


REFUSED = {
    "hash": "hash", "reference": "collector", "message": "bad|event", "conflict": "conflicting", "missing": "another", "count": "count", "range": "range", "metadata": "metadata", "outside": "outside",
    "gap": "gap artifact", "start_version": "differ", "start_hash": "differ", "start_alone": "no active", "start_broken": "version is broken", "start_local": "not UTC", "decision_hash": "different hashes",
}


@pytest.mark.parametrize("case", REFUSED)
def test_day_is_refused(spark, tmp_path, case):
    rows = list(ROWS)
    if case == "message":
        rows.append(event("BTCUSDT", "depth", 9, LO + 9, {"data": {"e": "depthUpdate", "E": 1}}))
    if case == "conflict":
        rows.append(event("BTCUSDT", "depth", 2, LO + 9, depth(102, 103, 101, bids=[("1", "9")]), connection="b"))
    if case == "outside":
        rows.append(event("BTCUSDT", "exchange_info", 7, HI, {"symbols": []}))
    bad = {"start_version": {"decision_sequence": 4}, "start_hash": {"universe_hash": "6" * 64}, "start_broken": {"universe_version": "2.2"}, "start_local": {"started_at": "2026-08-10T02:00:00+02:00"}, "start_alone": {}}
    if case in bad:
        rows.append(started(LO + 9, **bad[case]))
    if case == "start_alone":
        rows = [r for r in rows if r[2] != "universe_decision"]
    if case == "decision_hash":
        rows.append(decided(LO + 9, 4, sha="7" * 64))
    spoil = {"reference": {"collector_id": "other"}, "count": {"event_count": 99}, "range": {"min_app_receive_realtime_ns": LO - 5}}.get(case)
    gaps = [{"state": "OPEN", "observed_at_realtime_ns": LO, "affected_from_realtime_ns": None}] if case == "gap" else []
    path = publish(tmp_path / "raw", rows, gaps, spoil=spoil, about={"writer_group": "metadata"} if case == "metadata" else None)
    if case == "gap":
        at = path.parent / "gap-0.json"
        at.write_text(at.read_text().replace("OPEN", "SHUT"))
    if case == "hash":
        data = bytearray(path.read_bytes())
        data[len(data) // 2] ^= 1
        path.write_bytes(bytes(data))
    if case == "missing":
        (tmp_path / f"raw/collector={C}/day-manifests/date={DAY}/SEALED.json").write_text(json.dumps({"collector_id": "x", "utc_date": DAY, "chunks": [{"chunk_id": "z"}]}))
    with pytest.raises(ValueError, match=REFUSED[case]):
        jobs.normalize(spark, str(tmp_path / "raw"), str(tmp_path / "out"), C, DAY)
    assert not (tmp_path / f"out/typed/collector={C}/date={DAY}/_NORMALIZED.json").exists()


def test_a_partial_first_day_and_the_next(spark, tmp_path):
    """The window of the first day begins with the formal start; the next day needs the first one's books."""
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    start = LO + 7_200 * S
    late = [(*r[:8], r[8] + 7_200 * S, r[9] + 7_200 * S, *r[10:]) for r in ROWS]
    gaps = [{"state": "OPEN", "observed_at_realtime_ns": LO, "affected_from_realtime_ns": None}, {"state": "CLOSED", "observed_at_realtime_ns": start + 1}]
    publish(raw, [*late, started(start)], gaps)
    got = jobs.normalize(spark, str(raw), out, C, DAY)
    assert (got["collection_window_start_ns"], got["collection_window_end_ns"]) == (start, HI)
    jobs.rebuild(spark, out, C, DAY)
    verdict = jobs.finalize(spark, out, C, DAY, ["BTCUSDT"])
    assert verdict["accepted"] and verdict["coverage"]["BTCUSDT"]["expected_ns"] == HI - start

    after = "2026-08-11"
    rows = [event("BTCUSDT", "depth", 9, HI + 5, depth(104, 105, 103)), decided(HI)]
    publish(raw, rows, day=after)
    jobs.normalize(spark, str(raw), out, C, after)
    books = tmp_path / f"out/books/collector={C}/date={DAY}"
    books.rename(tmp_path / "aside")
    with pytest.raises(FileNotFoundError, match="books of 2026-08-10 are needed for BTCUSDT"):
        jobs.rebuild(spark, out, C, after)
    (tmp_path / "aside").rename(books)
    assert jobs.rebuild(spark, out, C, after)[1] == 1
    # a symbol that was not expected yesterday may start from nothing
    marker = {"formal_start_realtime_ns": None, "expected_symbols": ["A", "B"]}
    assert jobs.may_start(marker, {"expected_symbols": ["B"]}, LO, HI) == ["A"] and jobs.may_start(marker, None, LO, HI) == [] and jobs.may_start(marker | {"formal_start_realtime_ns": LO}, None, LO, HI) is None
    with pytest.raises(ValueError):
        jobs.may_start(marker | {"formal_start_realtime_ns": HI}, None, LO, HI)

    said = jobs.build_inputs(spark, out, C, DAY)
    assert (said["schedule"], said["total_rows"], said["ignored_rows"]) == (["BTCUSDT"], 4, {})
    assert jobs.inputs_of(spark, out, C, DAY, "BTCUSDT").count() == 4
    with pytest.raises(ValueError, match="not in the projection"):
        jobs.inputs_of(spark, out, C, DAY, "ETHUSDT")
    at = tmp_path / f"out/inputs/collector={C}/date={DAY}/_PROJECTION.json"
    sinks.marker(spark, said | {"rows": {"BTCUSDT": 5}}, str(at))
    with pytest.raises(ValueError, match="4 rows instead of 5"):
        jobs.inputs_of(spark, out, C, DAY, "BTCUSDT")

    pinned = jobs.pin(spark, str(raw), out, C, "r1", [DAY])
    assert list(pinned["days"]) == [f"{C}/{DAY}"] and len(jobs.pin(spark, str(raw), out, C, "r1", [after])["days"]) == 2
    assert jobs.retain(spark, str(raw), out, C, "2026-08-12") == []
    sinks.marker(spark, {"days": {f"{C}/{after}": "0"}}, f"{out}/releases/r1.json")
    with pytest.raises(ValueError, match="another seal"):
        jobs.pin(spark, str(raw), out, C, "r1", [after])
    assert jobs.retain(spark, str(raw), out, C, "2026-08-12", apply=True) == [DAY]
    assert not (raw / f"collector={C}/date={DAY}").exists() and (raw / f"collector={C}/date={after}").exists() and jobs.retain(spark, str(raw), out, C, "2026-08-12") == []


def test_decisions_in_force(spark):
    found = spark.createDataFrame([(1, 100, "a"), (3, 200, "b"), (2, 300, "c"), (4, 900, "d"), (None, 1, "x"), (9, None, "y")], "seq bigint, at bigint, v string").withColumn("k", F.lit("s"))
    points = spark.createDataFrame([("s", t) for t in (50, 100, 250, 350, 900, None)], "k string, t bigint")
    got = {r.t: r.v for r in window.as_of_sequence(points, found, ["k"], "t", "at", "seq", ["v"]).collect()}
    assert got == {50: None, 100: "a", 250: "b", 350: "b", 900: "d", None: None}  # a later one of a lower sequence does not count
