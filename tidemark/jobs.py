"""A UTC day from sealed raw chunks to its verdict, stage by stage."""

from __future__ import annotations

import argparse
import hashlib
import json
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import digest
from tidemark.operators import book, exactly_once, manifests, parse, quality, sliding, window
from tidemark.schemas import TYPED
from tidemark.session import build, cut, scratch
from tidemark.sources import days, sinks

DAY_NS = 86_400 * 10**9
_KEY = ["__is", "__iy", "__i0", "__i1", "__i2", "__ih"]


def bounds(day: str) -> tuple[int, int]:
    at = int(datetime.combine(date.fromisoformat(day), datetime.min.time(), UTC).timestamp()) * 10**9
    return at, at + DAY_NS


def before(day: str) -> str:
    return (date.fromisoformat(day) - timedelta(days=1)).isoformat()


def _at(root: str, kind: str, collector: str, day: str) -> str:
    return f"{root.rstrip('/')}/{kind}/collector={collector}/date={day}"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def normalize(spark: SparkSession, raw_root: str, derived_root: str, collector: str, day: str) -> dict:
    """Verify and parse a sealed day, flag duplicates, write the typed day, gaps, clock quality and the state for the next day.

    A broken reference, file, footer, statistic, message, formal start or gap artifact and a
    conflicting duplicate end the day without a marker.
    """
    with scratch(spark):
        return _normalize(spark, raw_root, derived_root, collector, day)


def _normalize(spark: SparkSession, raw_root: str, derived_root: str, collector: str, day: str) -> dict:
    lo, hi = bounds(day)
    refs = days.sealed_day(spark, raw_root, collector, day)
    found = days.chunk_manifests(spark, raw_root, days.parquet_refs(refs), collector, day)
    if (bad := days.verify_files(spark, raw_root, collector, found).limit(1).collect()):
        raise ValueError(f"chunk {bad[0]['chunk_id']}: {bad[0]['why']}")
    if (bad := days.footer_errors(days.footers(spark, raw_root, collector, found), found, lo, hi).limit(1).collect()):
        raise ValueError(f"chunk {bad[0]['chunk_id']}: {bad[0]['why']}")
    raw = days.raw_events(spark, raw_root, collector, found)
    typed = cut(parse.parsed(raw.drop("universe_hash"), ["chunk_ord", "row_ord"]))
    if (bad := typed.where("error is not null").limit(1).collect()):
        raise ValueError(f"message {bad[0]['connection_id']} {bad[0]['receive_seq']}: {bad[0]['error']}")
    key, has = exactly_once.identity()
    named = typed.withColumns({k: F.when(has, c) for k, c in key.items()})
    state = _at(derived_root, "dedup", collector, before(day))
    carry = spark.read.parquet(state) if _exists(spark, state) else None
    flagged = cut(sliding.flag(named, _KEY, "app_receive_realtime_ns", ["row_ord"], "chunk_ord", content="payload_hash", carry=carry))
    if (bad := flagged.where("in_conflict").limit(1).collect()):
        raise ValueError(f"conflicting payload {bad[0]['connection_id']} {bad[0]['receive_seq']}")
    gaps = days.gap_facts(spark, raw_root, collector, refs)
    opened = window.resolve(raw, lo)
    out = _at(derived_root, "typed", collector, day)
    sinks.typed_day(flagged.select(*TYPED.names, "chunk_ord", "row_ord"), out)
    sinks.typed_day(sliding.carried(flagged, _KEY, "app_receive_realtime_ns", ["chunk_ord", "row_ord"], hi, content="payload_hash"), _at(derived_root, "dedup", collector, day))
    sinks.typed_day(gaps, _at(derived_root, "gaps", collector, day))
    sinks.json_lines(quality.clock(flagged), _at(derived_root, "clock", collector, day))
    n = flagged.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.count_if("is_duplicate"), F.lit(0)).alias("d")).first()
    value = {"schema_version": 1, "collector_id": collector, "utc_date": day, "raw_events": raw.count(), "typed_events": n["n"], "duplicate_events": n["d"], "dedup_window_ns": sliding.WINDOW_NS, "collection_window_end_ns": hi, **opened}
    sinks.marker(spark, value, f"{out}/_NORMALIZED.json")
    return value


def _marker(spark: SparkSession, derived_root: str, collector: str, day: str) -> dict | None:
    """What the normalization of a day said; None if there was none."""
    return sinks.read_marker(spark, f"{_at(derived_root, 'typed', collector, day)}/_NORMALIZED.json")


def may_start(marker: dict, earlier: dict | None, lo: int, hi: int) -> list[str] | None:
    """The symbols whose books may start from nothing on a day; None for all of them.

    All where the collection formally starts on it, else those that were not expected the day before.
    """
    start = marker.get("formal_start_realtime_ns")
    if start is not None:
        if not lo <= start < hi:
            raise ValueError("the formal start is not within the day")
        return None
    before_it = (earlier or {}).get("expected_symbols")
    if earlier is not None and not isinstance(before_it, list):
        raise ValueError("the day before has no expected symbols")
    return sorted(set(marker.get("expected_symbols") or []) - set(before_it)) if earlier is not None else []


def rebuild(spark: SparkSession, derived_root: str, collector: str, day: str) -> tuple[int, int]:
    """Book validity of all symbols of a typed day; the numbers of changes and of valid intervals.

    Without the state of the day before only books of symbols that may start from nothing can be
    built: a day with others is an error.
    """
    marker = _marker(spark, derived_root, collector, day)
    if marker is None:
        raise FileNotFoundError(f"{day} is not normalized")
    lo, hi = bounds(day)
    state = _at(derived_root, "books", collector, before(day))
    known = _exists(spark, state)
    fresh = may_start(marker, _marker(spark, derived_root, collector, before(day)), lo, hi)
    with scratch(spark):
        typed = spark.read.parquet(_at(derived_root, "typed", collector, day))
        rows = typed.where(F.col("stream_type").isin("depth", "depth_snapshot")).withColumn("ord", F.col("chunk_ord").cast("bigint") * (1 << 32) + F.col("row_ord"))
        if not known and fresh is not None and (stuck := rows.where(F.col("exchange_symbol").isNotNull() & ~F.col("exchange_symbol").isin(fresh)).limit(1).collect()):
            raise FileNotFoundError(f"the books of {before(day)} are needed for {stuck[0]['exchange_symbol']}")
        gaps = spark.read.parquet(_at(derived_root, "gaps", collector, day))
        changes, intervals, saved = book.rebuild(rows, quality.scoped(gaps, rows.select("exchange_symbol")), lo, hi, carry=spark.read.parquet(state) if known else None)
        for name, df in (("states", changes), ("validity", intervals), ("books", saved)):
            sinks.typed_day(df, _at(derived_root, name, collector, day))
    n = [spark.read.parquet(_at(derived_root, name, collector, day)).count() for name in ("states", "validity")]
    return n[0], n[1]


def finalize(spark: SparkSession, derived_root: str, collector: str, day: str, symbols: list[str]) -> dict:
    """Coverage of each expected symbol over the collection window and the day's verdict, as a marker.

    The symbols asked for must be those of the decision that the day was collected under.
    """
    marker = _marker(spark, derived_root, collector, day)
    if marker is None:
        raise FileNotFoundError(f"{day} is not normalized")
    names = marker.get("expected_symbols")
    if not names or len(set(names)) != len(names):
        raise ValueError("the day has no expected symbols")
    if sorted(symbols) != sorted(names):
        raise ValueError("the symbols asked for are not the expected ones")
    lo, hi = marker["collection_window_start_ns"], marker["collection_window_end_ns"]
    first, last = bounds(day)
    if not first <= lo < hi <= last:
        raise ValueError("the collection window is not within the day")
    with scratch(spark):
        expected = spark.createDataFrame([(s,) for s in symbols], "exchange_symbol string")
        valid = spark.read.parquet(_at(derived_root, "validity", collector, day)).select("exchange_symbol", F.col("valid_from_ns").alias("lo"), F.col("valid_to_ns").alias("hi"))
        broken = quality.invalid(quality.scoped(spark.read.parquet(_at(derived_root, "gaps", collector, day)), expected), lo, hi)
        covered: DataFrame = cut(quality.coverage(expected, valid, broken, lo, hi))
        rows = {r["exchange_symbol"]: {k: v for k, v in r.asDict().items() if k != "exchange_symbol"} for r in covered.collect()}  # one per expected symbol
    ok = bool(rows) and all(r["accepted"] for r in rows.values())
    value = {"schema_version": 1, "collector_id": collector, "utc_date": day, "accepted": ok, "coverage": rows}
    sinks.marker(spark, value, f"{_at(derived_root, 'verdict', collector, day)}/{'_PROCESSED' if ok else '_QUALITY_REJECTED'}.json")
    return value


def build_inputs(spark: SparkSession, derived_root: str, collector: str, day: str) -> dict:
    """The book rows of a day by symbol, and a marker with their counts and the order in which to work on them."""
    said = _marker(spark, derived_root, collector, day)
    if said is None:
        raise FileNotFoundError(f"{day} is not normalized")
    rows = spark.read.parquet(_at(derived_root, "typed", collector, day)).where(F.col("stream_type").isin("depth", "depth_snapshot") & F.col("exchange_symbol").isNotNull())
    universe = spark.createDataFrame([(s,) for s in said.get("expected_symbols") or []], "exchange_symbol string")
    report = manifests.projection_report(rows, universe).collect()  # one row per symbol
    at = _at(derived_root, "inputs", collector, day)
    sinks.projection(rows.join(universe, "exchange_symbol", "left_semi"), at, ["chunk_ord", "row_ord"])
    own = sorted((r for r in report if not r["ignored"]), key=lambda r: r["schedule"])
    value = {
        "schema_version": 1, "collector_id": collector, "utc_date": day, "normalized_sha256": digest(said), "schedule": [r["exchange_symbol"] for r in own], "rows": {r["exchange_symbol"]: r["rows"] for r in own},
        "ignored_rows": {r["exchange_symbol"]: r["rows"] for r in report if r["ignored"]}, "total_rows": sum(r["rows"] for r in own),
    }
    sinks.marker(spark, value, f"{at}/_PROJECTION.json")
    return value


def inputs_of(spark: SparkSession, derived_root: str, collector: str, day: str, symbol: str) -> DataFrame:
    """The book rows of one symbol; an error if the projection is of another normalization, or its rows are not those it counted."""
    at = _at(derived_root, "inputs", collector, day)
    said = sinks.read_marker(spark, f"{at}/_PROJECTION.json") or {}
    if said.get("collector_id") != collector or said.get("utc_date") != day or said.get("normalized_sha256") != digest(_marker(spark, derived_root, collector, day)):
        raise ValueError("the projection is of another day or normalization")
    if symbol not in said["rows"]:
        raise ValueError(f"{symbol} is not in the projection")
    rows = spark.read.parquet(at).where(F.col("exchange_symbol") == symbol)
    if (n := rows.count()) != said["rows"][symbol]:
        raise ValueError(f"{symbol} has {n} rows instead of {said['rows'][symbol]}")
    return rows


def pin(spark: SparkSession, raw_root: str, derived_root: str, collector: str, release: str, dates: list[str]) -> dict:
    """Sealed days that a release rests on, each with the hash of its seal; an error if one was pinned with another hash."""
    at = f"{derived_root.rstrip('/')}/releases/{release}.json"
    known = (sinks.read_marker(spark, at) or {"days": {}})["days"]
    for day in sorted(dates):
        seal = f"{days.collector_root(raw_root, collector)}/day-manifests/date={day}/SEALED.json"
        if not _exists(spark, seal):
            raise FileNotFoundError(f"{day} is not sealed")
        sha = hashlib.sha256(spark.read.format("binaryFile").load(seal).first()["content"]).hexdigest()
        if known.setdefault(f"{collector}/{day}", sha) != sha:
            raise ValueError(f"{day} is pinned with another seal")
    value = {"schema_version": 1, "release_id": release, "days": known}
    sinks.marker(spark, value, at)
    return value


def retain(spark: SparkSession, raw_root: str, derived_root: str, collector: str, keep_from: str, apply: bool = False) -> list[str]:
    """The sealed days before ``keep_from`` that no release pins; with ``apply`` their chunks are deleted, the seals stay."""
    jvm = spark.sparkContext._jvm
    root = days.collector_root(raw_root, collector)
    at = jvm.org.apache.hadoop.fs.Path(f"{root}/day-manifests")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    sealed = [f.getPath().getName().removeprefix("date=") for f in fs.listStatus(at)] if fs.exists(at) else []
    pinned: set[str] = set()
    if _exists(spark, f"{derived_root.rstrip('/')}/releases"):
        for r in spark.read.text(f"{derived_root.rstrip('/')}/releases/*.json", wholetext=True).toLocalIterator():
            pinned |= {k.split("/", 1)[1] for k in json.loads(r[0])["days"] if k.split("/", 1)[0] == collector}
    gone = [d for d in sorted(sealed) if d < keep_from and d not in pinned and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{root}/date={d}"))]
    for d in gone if apply else []:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/date={d}"), True)
    return gone


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tidemark", description="process one sealed UTC day")
    p.add_argument("command", choices=["normalize", "build-l2-inputs", "l2", "d0-audit", "finalize", "pin", "retain"])
    p.add_argument("--raw-root", default="")
    p.add_argument("--derived-root", required=True)
    p.add_argument("--collector", required=True)
    p.add_argument("--date", required=True, help="a day; of pin several with commas; of retain the first day that stays")
    p.add_argument("--release", default="")
    p.add_argument("--apply", action="store_true", help="retain: delete")
    p.add_argument("--symbols", default="")
    a = p.parse_args(args)
    spark = SparkSession.getActiveSession() or build()
    if a.command == "normalize":
        print(json.dumps(normalize(spark, a.raw_root, a.derived_root, a.collector, a.date)))
    elif a.command == "build-l2-inputs":
        print(json.dumps(build_inputs(spark, a.derived_root, a.collector, a.date)))
    elif a.command == "pin":
        print(json.dumps(pin(spark, a.raw_root, a.derived_root, a.collector, a.release, a.date.split(","))))
    elif a.command == "retain":
        print("\n".join(retain(spark, a.raw_root, a.derived_root, a.collector, a.date, a.apply)))
    elif a.command == "l2":
        print("changes %d intervals %d" % rebuild(spark, a.derived_root, a.collector, a.date))
    elif a.command == "d0-audit":
        sinks.json_lines(quality.audit(spark.read.parquet(_at(a.derived_root, "typed", a.collector, a.date))), _at(a.derived_root, "audit", a.collector, a.date))
    else:
        names = sorted({s.strip().upper() for s in a.symbols.split(",") if s.strip()})
        print(json.dumps(finalize(spark, a.derived_root, a.collector, a.date, names)))


if __name__ == "__main__":
    main()
