"""Sliding-window duplicate flags with refresh, conflicts, and the state carried to the next day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How long an observation counts, in nanoseconds. Fixed value.
WINDOW_NS = 600 * 10**9


def running_max(df: DataFrame, time: str, order: Sequence[str], to: str, by: str, parts: Sequence[str] = ()) -> DataFrame:
    """``to``: the largest ``time`` so far in the order (by, order), without one task for all rows.

    ``by`` is the leading order column (a file or chunk number). Each of its values is scanned on
    its own; what came before it enters as the maximum of the earlier ones, from one row each.
    Rows that differ in ``parts`` know nothing of each other.
    """
    tops = df.groupBy(*[F.col(p).alias(f"__of_{p}") for p in parts], F.col(by).alias("__at")).agg(F.max(time).alias("__top"))
    before = F.max("__top").over(Window.partitionBy(*[f"__of_{p}" for p in parts]).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1))
    tops = tops.select(*[f"__of_{p}" for p in parts], "__at", before.alias("__before"))
    inside = F.max(time).over(Window.partitionBy(*parts, by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    same = F.col(by).eqNullSafe(F.col("__at"))
    for p in parts:
        same = same & F.col(p).eqNullSafe(F.col(f"__of_{p}"))
    return df.join(tops, same).withColumn(to, F.greatest("__before", inside)).drop("__at", "__before", *[f"__of_{p}" for p in parts])


def before(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, to: str, slice_of: Column) -> DataFrame:
    """``to``: ``value`` of the row before in the order of each key; null for the first.

    ``slice_of`` cuts a key into slices that follow each other in the order, so no task has a whole
    key; what a slice's first row needs comes from one row per slice before it.
    """
    k = list(keys)
    rows = df.withColumn("__slice", slice_of)
    inside = Window.partitionBy(*k, "__slice").orderBy(*order)
    rows = rows.withColumn("__was", F.lag(F.struct(F.col(value).alias("v"))).over(inside))
    ends = rows.groupBy(*k, "__slice").agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("__end"))
    ends = ends.select(*[F.col(c).alias(f"__k_{c}") for c in k], F.col("__slice").alias("__of"), F.lag("__end").over(Window.partitionBy(*k).orderBy("__slice")).alias("__carried"))
    same = F.col("__slice").eqNullSafe(F.col("__of"))
    for c in k:
        same = same & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    got = rows.join(ends, same, "left").withColumn(to, F.coalesce("__was", "__carried")["v"])
    return got.select(*df.columns, to)


def flag(df: DataFrame, identity: Sequence[str], time: str, order: Sequence[str], by: str, window: int = WINDOW_NS, content: str | None = None, carry: DataFrame | None = None, parts: Sequence[str] = ()) -> DataFrame:
    """All rows with ``is_duplicate`` and ``in_conflict``.

    Rows are taken in the order (``by``, ``order``). A row is a duplicate if the row of the same
    identity before it was seen no longer than ``window`` before the largest time so far (the
    boundary counts); each observation, duplicate or not, refreshes its identity. It is in
    conflict if it is a duplicate of other ``content``. Rows with a null in ``identity`` are never
    duplicates and do not move the largest time. ``carry`` are observations of an earlier run
    (identity, time and content, one each), which come first. ``by`` is a whole number from 0 on.
    No task has more of an identity than one part of the source. Rows that differ in ``parts``
    (columns without nulls, ``carry`` has them too) are runs of their own.

    Rows are never dropped. A column ``is_duplicate`` or ``in_conflict`` in the input is replaced.
    """
    known = F.lit(True)
    for c in identity:
        known = known & F.col(c).isNotNull()
    rows = df.drop("is_duplicate", "in_conflict")
    named = rows.where(known).withColumn("__carried", F.lit(False))
    if carry is not None:
        named = named.unionByName(carry.withColumn("__carried", F.lit(True)), allowMissingColumns=True)
    named = named.withColumn("__by", F.when(F.col("__carried"), F.lit(-1)).otherwise(F.col(by)).cast("bigint"))
    named = running_max(named, time, order, "__seen", "__by", parts)
    seen = F.struct(F.col(time).alias("t"), (F.col(content) if content else F.lit(None)).alias("c"))
    # inside a part of the source by its order; what an identity had before it comes from one row per part
    ends = named.groupBy(*parts, *identity, "__by").agg(F.max_by(seen, F.struct(*order)).alias("__end"))
    ends = ends.withColumn("__before", F.lag("__end").over(Window.partitionBy(*parts, *identity).orderBy("__by"))).drop("__end")
    named = named.join(ends, [*parts, *identity, "__by"])
    inside = F.lag(seen).over(Window.partitionBy(*parts, *identity, "__by").orderBy(*order))
    named = named.withColumn("__last", F.coalesce(inside, F.col("__before"))).where(~F.col("__carried"))
    dup = F.coalesce(F.col("__last.t") >= F.col("__seen") - window, F.lit(False))
    named = named.withColumn("__other", F.col("__last.c") != F.col(content) if content else F.lit(False))
    flagged = named.select(*rows.columns, dup.alias("is_duplicate"), (dup & F.coalesce("__other", F.lit(False))).alias("in_conflict"))
    return flagged.unionByName(rows.where(~known | known.isNull()).select("*", F.lit(False).alias("is_duplicate"), F.lit(False).alias("in_conflict")))


def carried(df: DataFrame, identity: Sequence[str], time: str, order: Sequence[str], end: Column | int, window: int = WINDOW_NS, content: str | None = None, parts: Sequence[str] = ()) -> DataFrame:
    """The newest observation of each identity that still counts at ``end`` (of its ``parts``): the next run's ``carry``."""
    keep = [time, *([content] if content else [])]
    known = F.lit(True)
    for c in identity:
        known = known & F.col(c).isNotNull()
    newest = df.where(known).groupBy(*parts, *identity).agg(F.max(F.struct(*order, *[F.col(c).alias(f"__{c}") for c in keep])).alias("r"))
    return newest.select(*parts, *identity, *[F.col(f"r.__{c}").alias(c) for c in keep]).where(F.col(time) >= end - window)
