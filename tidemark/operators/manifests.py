"""Chunks, day seals, acknowledgements and retention as relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import canonical_json
from tidemark.operators.quality import effective_ns
from tidemark.schemas import PARQUET_TYPE
from tidemark.session import small


def reference_errors(refs: DataFrame, manifests: DataFrame) -> DataFrame:
    """References of sealed days that their manifests do not bear out, with ``why``."""
    m = manifests.select("chunk_id", F.col("sha256").alias("m_sha"), F.col("collector_id").alias("m_collector"), F.col("utc_date").alias("m_date"))
    j = refs.join(m, "chunk_id", "left")
    why = (
        F.when(F.col("m_sha").isNull(), "no manifest").when(~F.col("m_sha").eqNullSafe(F.col("sha256")), "hash")
        .when(~F.col("m_collector").eqNullSafe(F.col("collector_id")), "collector").when(~F.col("m_date").eqNullSafe(F.col("utc_date")), "date")
    )
    return j.withColumn("why", why).where(F.col("why").isNotNull()).select(*refs.columns, "why")


def chunk_order(manifests: DataFrame) -> DataFrame:
    """Data chunks with ``chunk_ord``, their place by first receipt and id within collector and day."""
    w = Window.partitionBy("collector_id", "utc_date").orderBy("min_app_receive_realtime_ns", "chunk_id")
    return manifests.where(F.col("content_type").endswith(PARQUET_TYPE)).withColumn("chunk_ord", F.row_number().over(w) - 1)


def file_errors(files: DataFrame, manifests: DataFrame) -> DataFrame:
    """Manifests whose file is missing or differs in size or hash. ``files``: data_path, size_bytes, sha256."""
    f = files.select("data_path", F.col("size_bytes").alias("f_size"), F.col("sha256").alias("f_sha"))
    j = manifests.join(f, "data_path", "left")
    why = F.when(F.col("f_sha").isNull(), "missing").when(F.col("f_size") != F.col("size_bytes"), "size").when(F.col("f_sha") != F.col("sha256"), "hash")
    return j.withColumn("why", why).where(F.col("why").isNotNull()).select("chunk_id", "data_path", "why")


def statistics_errors(rows: DataFrame, manifests: DataFrame, path: str = "data_path", time: str = "app_receive_realtime_ns") -> DataFrame:
    """Manifests whose count or range of receive times is not that of the rows in the file."""
    s = rows.groupBy(path).agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("lo"), F.max(time).alias("hi"))
    j = manifests.join(s.withColumnRenamed(path, "data_path"), "data_path", "left")
    same = (F.coalesce("n", F.lit(0)) == F.col("event_count")) & F.col("lo").eqNullSafe(F.col("min_app_receive_realtime_ns")) & F.col("hi").eqNullSafe(F.col("max_app_receive_realtime_ns"))
    return j.where(~same).select("chunk_id", "data_path", "event_count", "n", "lo", "hi")


def conflicts(manifests: DataFrame) -> DataFrame:
    """Chunk ids that are described in different ways; a null differs from every value and equals a null."""
    rest = [c for c in manifests.columns if c != "chunk_id"]
    return manifests.distinct().groupBy("chunk_id").agg(F.count(F.lit(1)).alias("versions")).where(F.col("versions") > 1) if rest else manifests.limit(0).withColumn("versions", F.lit(0).cast("bigint"))


def classify_acks(acks: DataFrame, ready: DataFrame, done: DataFrame) -> DataFrame:
    """``acks`` with ``outcome``: APPLY, REPLAY, HASH_MISMATCH or UNKNOWN.

    ``ready`` and ``done`` are the chunks (``chunk_id``, ``sha256``) that wait for an
    acknowledgement and that had one; ready ones are looked at first.
    """
    r = ready.select("chunk_id", F.col("sha256").alias("r_sha")).dropDuplicates(["chunk_id"])
    d = done.select("chunk_id", F.col("sha256").alias("d_sha")).dropDuplicates(["chunk_id"])
    j = acks.join(r, "chunk_id", "left").join(d, "chunk_id", "left")
    out = F.when(F.col("r_sha") == F.col("sha256"), "APPLY").when(F.col("r_sha").isNotNull(), "HASH_MISMATCH").when(F.col("d_sha") == F.col("sha256"), "REPLAY").when(F.col("d_sha").isNotNull(), "HASH_MISMATCH").otherwise("UNKNOWN")
    return j.withColumn("outcome", out).select(*acks.columns, "outcome")


def complete_days(refs: DataFrame, files: DataFrame) -> DataFrame:
    """Sealed days all of whose chunks are here with the right hash."""
    f = files.select(F.col("chunk_id"), F.col("sha256").alias("f_sha")).dropDuplicates(["chunk_id"])
    j = refs.join(f, "chunk_id", "left")
    return j.groupBy("collector_id", "utc_date").agg(F.bool_and(F.coalesce(F.col("f_sha") == F.col("sha256"), F.lit(False))).alias("ok"), F.count(F.lit(1)).alias("chunks")).where("ok").drop("ok")


def seal(refs: DataFrame) -> DataFrame:
    """The chunks of each collector's day once each by id and hash, in order: one row per day."""
    one = refs.select("collector_id", "utc_date", "chunk_id", "sha256").distinct()
    return one.groupBy("collector_id", "utc_date").agg(F.array_sort(F.collect_list(F.struct("chunk_id", "sha256"))).alias("chunks"))


def expired(days: DataFrame, pinned: DataFrame, cutoff: str) -> DataFrame:
    """Sealed days before the cut-off that no release pins."""
    p = pinned.select("collector_id", "utc_date").distinct()
    return days.where("sealed").where(F.col("utc_date") < F.lit(cutoff)).join(small(p), ["collector_id", "utc_date"], "left_anti")


def over_budget(days: DataFrame, budget: int, keep_from: str) -> DataFrame:
    """The oldest days to remove until the rest fits into ``budget`` bytes; days from ``keep_from`` on stay.

    ``days``: utc_date and size_bytes, one row per day.
    """
    newer = F.sum("size_bytes").over(Window.orderBy(F.desc("utc_date")).rowsBetween(Window.unboundedPreceding, 0))
    return days.withColumn("with_newer", newer).where((F.col("with_newer") > budget) & (F.col("utc_date") < F.lit(keep_from)))


def durable_watermark(chunks: DataFrame, groups: list[str]) -> DataFrame:
    """The time up to which all critical writer groups are stored; null unless each has a chunk."""
    tops = chunks.where(F.col("writer_group").isin(groups)).groupBy("writer_group").agg(F.max("max_app_receive_realtime_ns").alias("top"))
    return tops.agg(F.when(F.count(F.lit(1)) == len(groups), F.min("top")).alias("watermark_ns"))


def projection_report(rows: DataFrame, universe: DataFrame) -> DataFrame:
    """Rows per symbol of a projection, in the order in which to work on them, and those outside the universe."""
    counts = rows.groupBy("exchange_symbol").agg(F.count(F.lit(1)).alias("rows"))
    u = universe.select("exchange_symbol").distinct().withColumn("__in", F.lit(True))
    j = counts.join(u, "exchange_symbol", "left").withColumn("ignored", F.col("__in").isNull()).drop("__in")
    return j.withColumn("schedule", F.row_number().over(Window.partitionBy("ignored").orderBy(F.desc("rows"), "exchange_symbol")))


def manifest_violations(manifests: DataFrame) -> DataFrame:
    """Manifests that break a rule, with ``rule``: one row per rule broken."""
    sha = r"^[0-9a-f]{64}$"
    fails = lambda c: ~F.coalesce(c, F.lit(False))
    rules = {
        "chunk_id": fails(F.length("chunk_id").between(8, 160)),
        "sha256": fails(F.col("sha256").rlike(sha)),
        "data_path": fails(~F.col("data_path").rlike(r"(^/)|(^|/)\.\.?(/|$)")),
        "size_bytes": fails(F.col("size_bytes") > 0),
        "event_count": fails(F.col("event_count") > 0),
        "range": fails((F.col("min_app_receive_realtime_ns") >= 0) & (F.col("max_app_receive_realtime_ns") >= F.col("min_app_receive_realtime_ns"))),
        "data_contract_hash": fails(F.col("data_contract_hash").rlike(sha)),
        "universe_hash": fails(F.col("universe_hash").rlike(sha)),
    }
    return manifests.withColumn("rule", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))))


def pins(days: DataFrame) -> DataFrame:
    """The days of a release, ordered, each with the hash of its seal; days pinned with two hashes have ``conflict``."""
    return days.groupBy("release_id", "collector_id", "utc_date").agg(F.min("sealed_sha256").alias("sealed_sha256"), (F.count_distinct("sealed_sha256") > 1).alias("conflict"))


def missing_days(have: DataFrame, entities: DataFrame, first: int, last: int, entity: str = "exchange_symbol") -> DataFrame:
    """(entity, day) pairs from ``first`` to ``last`` without a bar: what an incremental fetch still has to get."""
    calendar = entities.select(entity).where(F.col(entity).isNotNull()).distinct().withColumn("day", F.explode(F.sequence(F.lit(first).cast("bigint"), F.lit(last).cast("bigint")))) if last >= first else entities.select(entity, F.lit(0).cast("bigint").alias("day")).limit(0)
    return calendar.join(have.select(entity, F.col("day").cast("bigint").alias("day")).distinct(), [entity, "day"], "left_anti")


def not_durable(offered: DataFrame, durable: DataFrame) -> DataFrame:
    """Offered chunks that are not stored yet with the same hash."""
    d = durable.select("chunk_id", "sha256").distinct()
    return offered.join(d, ["chunk_id", "sha256"], "left_anti")


def progress(days: DataFrame, stages: dict[str, DataFrame], expected: int) -> DataFrame:
    """How far each day of ``days`` (``utc_date``) is: the last stage reached, and its number of symbols.

    ``stages`` in their order; each has ``utc_date`` and, where it goes by symbol, ``exchange_symbol``.
    A stage by symbol is reached when ``expected`` symbols are there.
    """
    out, names = days.select("utc_date").distinct(), []
    for name, df in stages.items():
        by_symbol = "exchange_symbol" in df.columns
        n = F.count_distinct("exchange_symbol") if by_symbol else F.count(F.lit(1))
        out = out.join(df.groupBy("utc_date").agg(n.alias(name)), "utc_date", "left").fillna(0, [name])
        names.append((name, F.col(name) >= (expected if by_symbol else 1)))
    state, so_far = F.lit("missing"), F.lit(True)
    for name, done in names:
        so_far = so_far & done
        state = F.when(so_far, name).otherwise(state)
    return out.withColumn("state", state)


def index_conflicts(rows: DataFrame, identity: list[str]) -> DataFrame:
    """Identities of an archived index that are described in several ways, with their number; a null equals a null."""
    return rows.distinct().groupBy(*identity).agg(F.count(F.lit(1)).alias("versions")).where("versions > 1")


def same_members(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: whether two lists have the same members (``same``), and how many only one of them has. Nulls and repeats do not count."""
    side = lambda df, n: df.select(key).where(F.col(key).isNotNull()).distinct().withColumn(n, F.lit(True))
    j = side(a, "__a").join(side(b, "__b"), key, "full")
    return j.agg(F.count_if(F.col("__b").isNull()).alias("only_left"), F.count_if(F.col("__a").isNull()).alias("only_right")).withColumn("same", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def gap_artifacts(facts: DataFrame, collector: str) -> DataFrame:
    """Gap facts as the files they are published as: ``chunk_id``, ``data_path``, ``content`` (canonical JSON), ``sha256``, ``size_bytes`` and time."""
    at = effective_ns()
    name = F.concat_ws("-", "gap_id", F.col("observed_at_realtime_ns").cast("string"), F.lower("state"))
    day = F.date_format(F.timestamp_micros(F.call_function("div", at, F.lit(1000).cast("bigint"))), "yyyy-MM-dd")
    content = F.concat(canonical_json(*[F.col(c) for c in facts.columns]), F.lit("\n"))
    out = facts.select(name.alias("chunk_id"), F.concat(F.lit("date="), day, F.lit("/writer=control/"), name, F.lit(".gap.json")).alias("data_path"), content.alias("content"), at.alias("min_app_receive_realtime_ns"))
    return out.withColumns({"collector_id": F.lit(collector), "sha256": F.sha2(F.col("content").cast("binary"), 256), "size_bytes": F.octet_length("content").cast("bigint"), "max_app_receive_realtime_ns": F.col("min_app_receive_realtime_ns")})
