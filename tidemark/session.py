"""Session helpers: building a session, cutting lineage, checking the size of what is broadcast."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side with a counted size may be broadcast.
BROADCAST_ROWS = 200_000


def build(master: str = "local[*]", partitions: int = 8, app: str = "tidemark", **conf: str) -> SparkSession:
    """A session with the settings the plans expect: UTC, adaptive execution, Arrow."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # recording the call site of each expression doubles the time the driver needs for a wide plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Where the session names none, a local master (tests, a laptop) gets a folder of this machine,
    removed again at exit; on a cluster its executors would each write to their own disk, so that
    is an error.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def _tables(spark: SparkSession) -> str:
    """Where this application's tables lie: others that use the same folder have theirs elsewhere."""
    return f"{shared_dir(spark).rstrip('/')}/tidemark/{spark.sparkContext.applicationId}" + "".join(f"/{s}" for s in _scopes)


_scopes: list[str] = []


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage, fixes what a nondeterministic plan gave (range samples, row positions) and
    survives the loss of executors. Columnar, so later reads still prune columns. The table lasts
    until :func:`drop`, the end of its :func:`scratch`, or :func:`sweep`.
    """
    spark = df.sparkSession
    at = f"{_tables(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def drop(table: DataFrame) -> None:
    """Delete a table that :func:`cut` wrote and nothing reads any more."""
    home = f"/tidemark/{table.sparkSession.sparkContext.applicationId}/"
    for at in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        if home in at:
            _delete(table.sparkSession, at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`cut` writes inside are deleted at the end: for jobs that write their result elsewhere."""
    _scopes.append(uuid.uuid4().hex)
    at = _tables(spark)
    try:
        yield
    finally:
        _scopes.pop()
        _delete(spark, at)


def sweep(spark: SparkSession) -> None:
    """Delete all tables that this application has written to the shared folder. Call when no result is read any more."""
    _delete(spark, _tables(spark))


def spread(scan: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores, dealt out to all of them; any other as it is.

    A small file has one row group and would keep one core busy; at scale there are always more splits than cores.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.isStreaming or scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than that many."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted size allows one, else as it is."""
    return F.broadcast(df) if fits(df, rows) else df
