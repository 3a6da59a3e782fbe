"""Sealed days: manifests, verified chunks, gap facts, clock samples, the parsed rows in source order."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import manifests
from tidemark.schemas import DAY, GAP, GAP_TYPE, MANIFEST, PARQUET_TYPE, RAW
from tidemark.session import small

_SAFE = re.compile(r"(?!.*(^|/)\.\.?(/|$))[\w=.,/-]+")


def collector_root(root: str, collector: str) -> str:
    return f"{root.rstrip('/')}/collector={collector}"


def sealed_day(spark: SparkSession, root: str, collector: str, date: str) -> DataFrame:
    """The chunk references of a sealed day; an error if the seal is of another collector or day, or has a chunk twice."""
    day = spark.read.schema(DAY).json(f"{collector_root(root, collector)}/day-manifests/date={date}/SEALED.json", multiLine=True)
    refs = day.select("collector_id", "utc_date", F.explode_outer("chunks").alias("c")).select("collector_id", "utc_date", "c.*")
    bad = refs.where(~F.col("collector_id").eqNullSafe(collector) | ~F.col("utc_date").eqNullSafe(date)).limit(1).count()
    twice = refs.groupBy("chunk_id", "sha256").count().where("count > 1 and chunk_id is not null").limit(1).count()
    if bad or twice:
        raise ValueError("the seal names another collector or day" if bad else "the seal has a chunk twice")
    return refs.where("chunk_id is not null")


def chunk_manifests(spark: SparkSession, root: str, refs: DataFrame, collector: str, date: str) -> DataFrame:
    """The manifests beside the chunks; an error unless each agrees with its reference, collector, day and path."""
    base = collector_root(root, collector)
    paths = [r[0] for r in refs.select("data_path").collect()]  # one per chunk of a day
    unsafe = [p for p in paths if not _SAFE.fullmatch(p) or p.startswith("/")]
    if unsafe:
        raise ValueError(f"unsafe path {unsafe[0]}")
    if not paths:
        return spark.createDataFrame([], MANIFEST)
    found = spark.read.schema(MANIFEST).json([f"{base}/{re.sub(r'[.][^./]*$', '', p)}.manifest.json" for p in paths], multiLine=True)
    errors = manifests.reference_errors(refs, found)
    wrong = found.where(F.regexp_extract("data_path", "^(.*)/[^/]*$", 1) != F.concat(F.lit(f"date={date}/writer="), F.col("writer_group")))
    for what, df in (("reference", errors.select("chunk_id", "why")), ("path", wrong.select("chunk_id", F.lit("writer").alias("why")))):
        if (first := df.limit(1).collect()):
            raise ValueError(f"{what} of chunk {first[0][0]}: {first[0][1]}")
    return found


def verify_files(spark: SparkSession, root: str, collector: str, found: DataFrame) -> DataFrame:
    """Chunks whose file differs in size or hash from the manifest. Files are hashed where they are read."""
    base = collector_root(root, collector)
    paths = [r[0] for r in found.select("data_path").collect()]
    if not paths:
        return found.select("chunk_id", "data_path", F.lit("").alias("why")).limit(0)
    files = spark.read.format("binaryFile").load([f"{base}/{p}" for p in paths])
    rel = F.regexp_extract("path", f"collector={re.escape(collector)}/(.*)$", 1)
    return manifests.file_errors(files.select(rel.alias("data_path"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256")), found)


_FOOTER = "data_path string, columns string, about map<string,string>, n bigint, lo bigint, hi bigint"


def footers(spark: SparkSession, root: str, collector: str, found: DataFrame, time: str = "app_receive_realtime_ns") -> DataFrame:
    """What the Parquet footers of chunks say: ``columns`` and types, key values ``about``, rows ``n``, least and greatest ``time``.

    The end of each file is cut off where it is read; only footers reach Python. A file that is no
    Parquet has nulls; so have the times if a row group has no statistics of them.
    """
    base = collector_root(root, collector)
    paths = [r[0] for r in found.select("data_path").collect()]
    if not paths:
        return spark.createDataFrame([], _FOOTER)
    byte = lambda back: F.conv(F.hex(F.expr(f"substring(content, cast(length - {back} + 1 as int), 1)")), 16, 10).cast("bigint")
    size = byte(8) + byte(7) * 256 + byte(6) * 65_536 + byte(5) * 16_777_216
    files = spark.read.format("binaryFile").load([f"{base}/{p}" for p in paths]).withColumn("size", F.least(size + 8, F.col("length")))
    tails = files.select(F.regexp_extract("path", f"collector={re.escape(collector)}/(.*)$", 1).alias("data_path"), F.expr("substring(content, cast(length - size + 1 as int), cast(size as int))").alias("tail"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_footer(p, t, time) for p, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            types = [pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[f.split()[0] for f in _FOOTER.replace("map<string,string>", "map").split(", ")])

    return tails.mapInArrow(run, _FOOTER)


def _footer(path: str, tail: bytes, time: str) -> tuple:
    try:
        meta = pq.read_metadata(io.BytesIO(b"PAR1" + tail))
    except (pa.ArrowException, OSError):
        return path, None, None, None, None, None
    schema = meta.schema.to_arrow_schema()
    about = [(k.decode(), v.decode("utf-8", "replace")) for k, v in (schema.metadata or {}).items()]
    at = schema.get_field_index(time)
    stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)] if at >= 0 else []
    known = bool(stats) and all(s is not None and s.has_min_max for s in stats)
    return path, ",".join(f"{f.name}:{f.type}" for f in schema), about, meta.num_rows, min(s.min for s in stats) if known else None, max(s.max for s in stats) if known else None


#: What the footer of a chunk must repeat of its manifest. Fixed values.
_REPEATED = ("chunk_id", "collector_id", "data_contract_hash", "universe_hash", "utc_date", "writer_group")
_COLUMNS = ",".join(f"{f.name}:{ {'smallint': 'int16', 'bigint': 'int64'}.get(f.dataType.simpleString(), f.dataType.simpleString())}" for f in RAW)


def footer_errors(read: DataFrame, found: DataFrame, lo: int, hi: int) -> DataFrame:
    """Chunks whose footer does not bear out their manifest, or whose times leave the day [lo, hi), with ``why``."""
    j = found.join(read, "data_path", "left")
    other = F.lit(False)
    for c in _REPEATED:
        other = other | ~F.col("about")[c].eqNullSafe(F.col(c))
    why = (
        F.when(F.col("n").isNull(), "no Parquet").when(F.col("columns") != _COLUMNS, "schema").when(other, "metadata").when(F.col("n") != F.col("event_count"), "count").when(F.col("lo").isNull(), "no statistics")
        .when((F.col("lo") != F.col("min_app_receive_realtime_ns")) | (F.col("hi") != F.col("max_app_receive_realtime_ns")), "range").when((F.col("lo") < lo) | (F.col("hi") >= hi), "outside the day")
    )
    return j.withColumn("why", why).where(F.col("why").isNotNull()).select("chunk_id", "data_path", "why")


def raw_events(spark: SparkSession, root: str, collector: str, found: DataFrame) -> DataFrame:
    """The raw rows of a day's chunks with ``chunk_ord`` and ``row_ord``, their place in the source, and the chunk's ``universe_hash``.

    Chunks are ordered by first receipt and id; only the columns that are used later are read.
    """
    base = collector_root(root, collector)
    order = manifests.chunk_order(found).select("data_path", "chunk_ord", "universe_hash").collect()
    if not order:
        return spark.createDataFrame([], RAW).withColumn("chunk_ord", F.lit(0)).withColumn("universe_hash", F.lit("")).withColumn("row_ord", F.lit(0).cast("bigint"))
    rows = spark.read.schema(RAW).parquet(*[f"{base}/{r['data_path']}" for r in order])
    rows = rows.select("*", F.regexp_extract("_metadata.file_path", f"collector={re.escape(collector)}/(.*)$", 1).alias("data_path"), F.col("_metadata.row_index").alias("row_ord"))
    names = spark.createDataFrame(order, "data_path string, chunk_ord int, universe_hash string")
    return rows.join(small(names), "data_path").drop("data_path")


def gap_facts(spark: SparkSession, root: str, collector: str, found_refs: DataFrame) -> DataFrame:
    """The gap facts of a day; an error if a file is not of the size and hash that its reference has."""
    base = collector_root(root, collector)
    refs = found_refs.where(F.col("content_type").endswith(GAP_TYPE))
    if (bad := verify_files(spark, root, collector, refs).limit(1).collect()):
        raise ValueError(f"gap artifact {bad[0]['chunk_id']}: {bad[0]['why']}")
    paths = [f"{base}/{r[0]}" for r in refs.select("data_path").collect()]
    if not paths:
        return spark.createDataFrame([], GAP)
    return spark.read.schema(GAP).json(paths, multiLine=True)


def parquet_refs(refs: DataFrame) -> DataFrame:
    return refs.where(F.col("content_type").endswith(PARQUET_TYPE))
