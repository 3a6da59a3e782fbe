"""Messages delivered more than once (problem 4): winners by narrow shuffle, losers by deletion vectors."""

from __future__ import annotations

import re
from collections.abc import Sequence

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import BROADCAST_ROWS, cut, fits

#: An identity with more than this share of all rows is hot; at most HOT_SHARE ** -1 identities can be.
HOT_SHARE = 1 / 1000
#: Repeated identities up to which they are broadcast.
FEW = BROADCAST_ROWS
#: Bytes of deletion vectors that are broadcast at once.
VECTOR_BYTES = 128 << 20
#: Rows of a file that one deletion vector covers.
VECTOR_SPAN = 4_096

#: The columns that identify a message of each stream, besides stream and symbol.
IDENTITY = {
    "agg_trade": ("aggregate_trade_id",),
    "trade": ("trade_id",),
    "depth": ("first_update_id", "final_update_id", "previous_final_update_id"),
    "rpi_depth": ("first_update_id", "final_update_id", "previous_final_update_id"),
    "book_ticker": ("update_id",),
    "mark_price": ("exchange_event_time_ms", "payload_hash"),
    "contract_info": ("exchange_event_time_ms", "payload_hash"),
    "force_order": ("exchange_event_time_ms", "exchange_transaction_time_ms", "payload_hash"),
}


def _by_stream(part: int, kind: str) -> Column:
    """The part-th numeric identity column (or the hash) of a row's stream, null where it has none."""
    out = F.lit(None).cast(kind)
    for stream, cols in reversed(IDENTITY.items()):
        own = [c for c in cols if (c == "payload_hash") == (kind == "binary")]
        if part < len(own):
            out = F.when(F.col("stream_type") == stream, F.col(own[part])).otherwise(out)
    return out


def identity(streams: Sequence[str] | None = None) -> tuple[dict[str, Column], Column]:
    """Identity columns of a typed event, and the condition under which a row has an identity.

    Streams share four columns (three numbers, a hash); the ones a stream does not use are filled
    with a constant, so equality of the four, stream and symbol is identity.
    """
    has = F.lit(False)
    for s, cols in IDENTITY.items():
        if streams is None or s in streams:
            full = F.col("stream_type") == s
            for c in cols:
                full = full & F.col(c).isNotNull()
            has = has | full
    cols = {f"__i{i}": F.coalesce(_by_stream(i, "bigint"), F.lit(0)) for i in range(3)}
    cols["__ih"] = F.coalesce(_by_stream(0, "binary"), F.lit(b""))
    return {"__is": F.col("stream_type"), "__iy": F.col("exchange_symbol"), **cols}, has & F.col("exchange_symbol").isNotNull()


def _file(path: str) -> Column:
    """A file's name as a number; schemes are followed by one slash or by three in different places."""
    return F.xxhash64(F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/"))


def _number(name: str) -> int:
    """What :func:`_file` gives for a name."""
    n = xxhash.xxh64_intdigest(re.sub("^([A-Za-z0-9+.-]+):/+", r"\1:/", name).encode(), 42)
    return n - (1 << 64) if n >> 63 else n


def with_position(spark: SparkSession, *paths: str) -> DataFrame:
    """A Parquet table with each row's file (hashed name) and place in it."""
    df = spark.read.parquet(*paths)
    return df.select("*", _file("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))


def firsts(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``; each map task hands on no more than one row of a key."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("__place", place).where(F.col("__place") == 1).drop("__place")


def losers(rows: DataFrame, key: dict[str, Column], has: Column, order: Sequence[str], carry: Sequence[str] = ("__file", "__row")) -> DataFrame:
    """``order`` and ``carry`` of each row that is not the first of its identity by ``order``.

    Only identity, order and position are shuffled. The least of the first order column (a number)
    and the number of rows per identity come from one hash aggregation that is combined on the map
    side. What occurs once is never looked at again: rows are held against the identities that
    occur more than once, by a broadcast if they are few (see :func:`session.fits`). Else rows
    whose identity cannot be among them are left out by a bitmap of hashes before the rest is
    joined by identity; identities with more than HOT_SHARE of all rows (at most 1000 can have it)
    are broadcast, so their rows stay where they are. Only rows that share the least time of their
    identity are told apart by the rest of ``order``, then by position, so that one stays.

    Rows without an identity (``has`` false or null) are never losers. A null in the first order
    column is the last there is.
    """
    full = [*order, *[c for c in carry if c not in order]]
    k, at = list(key), order[0]
    narrow = rows.where(has).select(*[c.alias(n) for n, c in key.items()], *full).withColumn(at, F.coalesce(at, F.lit((1 << 63) - 1)))
    repeated = cut(narrow.groupBy(*k).agg(F.min(at).alias("__first"), F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1))
    if fits(repeated, FEW):
        held = narrow.join(F.broadcast(repeated.drop("__n")), k)
    else:
        total, many = repeated.agg(F.sum("__n"), F.count(F.lit(1))).first()
        # the share is of the rows in question: a group above it has at least total * HOT_SHARE of them
        hot = F.col("__n") > max(1000.0, total * HOT_SHARE)
        heavy = F.broadcast(repeated.where(hot).limit(round(1 / HOT_SHARE) + 1).drop("__n"))
        near = narrow.join(heavy, k)
        rest = narrow.join(F.broadcast(heavy.select(*k)), k, "left_anti")
        if many * 4 <= VECTOR_BYTES * 8:  # a fuller bitmap would let most rows pass
            rest = _possible(rest, repeated, k, min(VECTOR_BYTES * 8, 1 << (many * 32).bit_length()))
        held = near.unionByName(rest.join(repeated.where(~hot).drop("__n"), k))
    # rows of repeated identities, once: they are needed for the later ones and for the ties
    held = cut(held.select(*k, *full, (F.col(at) > F.col("__first")).alias("__later")))
    ties = held.where(~F.col("__later"))
    winners = firsts(ties, k, full[1:]).select(*[F.col(c).alias(f"__w_{c}") for c in carry])
    same = F.lit(True)
    for c in carry:
        same = same & (F.col(c) == F.col(f"__w_{c}"))
    return held.where("__later").select(*full).unionByName(ties.select(*full).join(winners, same, "left_anti"))


def _possible(rows: DataFrame, keys: DataFrame, k: Sequence[str], size: int) -> DataFrame:
    """``rows`` without most of those whose key is not in ``keys``: one of ``size`` bits per hash value, broadcast, at most VECTOR_BYTES."""
    place = F.pmod(F.xxhash64(*k), F.lit(size))
    bits = keys.select(place.alias("__row")).withColumn("__file", F.lit(0).cast("bigint"))
    v = deletion_vectors(bits).select(F.col("__slice").alias("__vs"), "__bits")
    marked = rows.withColumn("__keep_row", place)
    joined = marked.join(F.broadcast(v), F.expr(f"__keep_row div {VECTOR_SPAN}") == F.col("__vs"))
    return joined.where(_bit("__keep_row")).select(*rows.columns)


def deletion_vectors(lost: DataFrame) -> DataFrame:
    """Per file and VECTOR_SPAN rows of it one bitmap of the rows to leave out (``__bits``)."""
    bits = F.expr(f"substring(bitmap_construct_agg(__row % {VECTOR_SPAN}), 1, {VECTOR_SPAN // 8})")
    return lost.groupBy("__file", F.expr(f"__row div {VECTOR_SPAN}").alias("__slice")).agg(bits.alias("__bits"))


def _bit(at: str) -> Column:
    """Whether the bit of a row's place is set in ``__bits``; false where there is no vector."""
    byte = F.conv(F.hex(F.substring("__bits", F.expr(f"cast(({at} % {VECTOR_SPAN}) div 8 + 1 as int)"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (F.col(at) % 8).cast("int")) == 1, F.lit(False))


def _groups(spark: SparkSession, path: str, vectors: DataFrame) -> list[tuple[list[str], DataFrame]]:
    """Files to read together, each group with its vectors: at most VECTOR_BYTES of them a group."""
    names = spark.read.parquet(path).inputFiles()  # the driver lists the files anyway
    numbers = {f: _number(f) for f in names}
    if len(set(numbers.values())) < len(numbers):
        raise ValueError("two files of the table share a hash of their names; rename one")
    n = vectors.count()
    if n * VECTOR_SPAN // 8 <= VECTOR_BYTES:
        return [([path], vectors)]
    sizes = {r["__file"]: r["count"] for r in vectors.groupBy("__file").count().toLocalIterator()}  # one per file
    if not sizes.keys() <= set(numbers.values()):
        raise ValueError("deletion vectors for files that the table does not have")
    groups: list[tuple[list[str], int]] = []
    for f in sorted(names):
        k = sizes.get(numbers[f], 0)
        if not groups or groups[-1][1] + k > max(1, VECTOR_BYTES * 8 // VECTOR_SPAN):
            groups.append(([], 0))
        groups[-1] = ([*groups[-1][0], f], groups[-1][1] + k)
    return [(g, vectors.where(F.col("__file").isin([numbers[f] for f in g]))) for g, _ in groups]


def apply_vectors(spark: SparkSession, path: str, vectors: DataFrame, columns: Sequence[str] | None = None, where: Column | None = None, keep: bool = True) -> DataFrame:
    """Read the table without the rows in ``vectors``; with ``keep`` False only those rows.

    The wide rows are never shuffled: vectors are broadcast to the scan. They take a bit per row of
    the files they are for; where that is more than VECTOR_BYTES, files are read in groups that
    hold no more, and what a group gives is written before the next one's vectors are broadcast.
    """
    parts = []
    groups = _groups(spark, path, cut(vectors))
    for files, mine in groups:
        rows = with_position(spark, *files)
        rows = rows if where is None else rows.where(where)
        rows = rows if columns is None else rows.select(*columns, "__file", "__row")
        v = F.broadcast(mine.select(F.col("__file").alias("__vf"), F.col("__slice").alias("__vs"), "__bits"))
        joined = rows.join(v, (F.col("__file") == F.col("__vf")) & (F.expr(f"__row div {VECTOR_SPAN}") == F.col("__vs")), "left" if keep else "inner")
        part = joined.where(~_bit("__row") if keep else _bit("__row")).drop("__vf", "__vs", "__bits", "__file", "__row")
        parts.append(part if len(groups) == 1 else cut(part))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def redundant(spark: SparkSession, path: str, streams: Sequence[str] | None = None) -> DataFrame:
    """Deletion vectors of all rows of a typed table but the first of each message."""
    key, has = identity(streams)
    order = ["app_receive_realtime_ns", "connection_id", "receive_seq"]
    return deletion_vectors(losers(with_position(spark, path), key, has, order))


def deduplicated(spark: SparkSession, path: str, columns: Sequence[str] | None = None, streams: Sequence[str] | None = None) -> DataFrame:
    """The typed table with exactly one row of each message: the first by receive time, connection, number.

    ``is_duplicate`` is not believed. Rows of streams without identity, and rows with a null in
    their identity or symbol, all stay. Empty table: no rows. Further columns are kept as they
    are. ``streams`` restricts the result to rows of these.
    """
    where = F.col("stream_type").isin(*streams) if streams is not None else None
    return apply_vectors(spark, path, redundant(spark, path, streams), columns, where)


def removed(spark: SparkSession, path: str) -> DataFrame:
    """``connection_id`` and ``receive_seq`` of the rows that :func:`deduplicated` leaves out."""
    return apply_vectors(spark, path, redundant(spark, path), ["connection_id", "receive_seq"], keep=False)
