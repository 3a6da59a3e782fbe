"""As-of joins by an ordered union: no pairs, one pass over both sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import floor_div


def asof(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, take: Sequence[str], forward: bool = False, ties: Sequence[str] = (), slice_of: int | None = None) -> DataFrame:
    """Each left row with ``take`` (and ``right_time``) of the last right row at or before its time.

    ``forward``: of the first at or after it. Of right rows at one time the one largest in
    ``ties`` counts. Left rows without a match have nulls; rows with null times match nothing and
    left ones stay. ``take`` and ``right_time`` must not be columns of the left.

    ``slice_of``: cuts each key into slices of so many time units. Slices are worked on apart, and
    what the slices before leave behind is carried in from one row each, so a heavy key is spread
    over its slices.
    """
    k = list(by)
    picked = F.struct(F.col(right_time).alias(right_time), *[F.col(c) for c in take])
    r = right.where(F.col(right_time).isNotNull()).groupBy(*k, F.col(right_time).alias("__t")).agg(F.max_by(picked, F.struct(*[F.col(c) for c in ties], F.lit(0).alias("z"))).alias("__r"))
    side = F.lit(0 if not forward else 1)
    both = left.withColumn("__t", F.col(left_time)).withColumn("__s", F.lit(1 if not forward else 0)).unionByName(r.withColumn("__s", side), allowMissingColumns=True)
    if slice_of:
        both = both.withColumn("__p", floor_div("__t", slice_of))
    order = Window.partitionBy(*k, *(["__p"] if slice_of else [])).orderBy("__t", "__s")
    frame = order.rowsBetween(0, Window.unboundedFollowing) if forward else order.rowsBetween(Window.unboundedPreceding, 0)
    near: Column = (F.first if forward else F.last)("__r", ignorenulls=True).over(frame)
    both = both.withColumn("__m", near)
    is_left = F.col("__s") == (0 if forward else 1)
    if slice_of:
        ends = both.where(~is_left).groupBy(*k, "__p").agg((F.min_by if forward else F.max_by)("__r", "__t").alias("__e"))
        marks = both.select(*k, "__p").distinct().join(ends, [*k, "__p"], "left")
        w = Window.partitionBy(*k).orderBy("__p")
        frame = w.rowsBetween(1, Window.unboundedFollowing) if forward else w.rowsBetween(Window.unboundedPreceding, -1)
        marks = marks.select(*[F.col(c).alias(f"__k_{c}") for c in k], F.col("__p").alias("__pp"), (F.first if forward else F.last)("__e", ignorenulls=True).over(frame).alias("__c"))
        on = F.col("__p").eqNullSafe(F.col("__pp"))
        for c in k:
            on = on & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
        both = both.where(is_left).join(marks, on, "left").withColumn("__m", F.coalesce("__m", "__c"))
    got = both.where(is_left).withColumn("__m", F.when(F.col("__t").isNotNull(), F.col("__m")))
    return got.select(*left.columns, *[F.col("__m")[c].alias(c) for c in (right_time, *take)])
