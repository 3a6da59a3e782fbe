"""Half-open intervals of whole numbers: pairing, union, intersection, extension, order.

Interval tables have key columns, ``lo`` and ``hi``. Intervals with a null bound or lo >= hi have
no length and are ignored by all operators here. Results keep keys with a null as groups of their
own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import floor_div

DAY_NS = 86_400 * 10**9


def proper(df: DataFrame) -> DataFrame:
    return df.where(F.col("lo").isNotNull() & F.col("hi").isNotNull() & (F.col("lo") < F.col("hi")))


def clip(df: DataFrame, lo: Column | int, hi: Column | int) -> DataFrame:
    """The parts of the intervals that lie within [lo, hi)."""
    c = lambda x: x if isinstance(x, Column) else F.lit(x)
    return proper(df.withColumn("lo", F.greatest("lo", c(lo))).withColumn("hi", F.least("hi", c(hi))))


def pair(events: DataFrame, by: Sequence[str], time: str, state: str, end: Column | int, opened: str = "OPEN", closed: str = "CLOSED", plus: Column | None = None) -> DataFrame:
    """Intervals from facts of opening and closing.

    Facts of a key are ordered by time and then by state as text, so at one time a closing comes
    before an opening. A closing ends the opening right before it; a closing without one is
    ignored; of several openings in a row the last counts; an opening that nothing closes lasts to
    ``end``. ``plus`` is added to the end of the interval that a closing ends.
    """
    e = end if isinstance(end, Column) else F.lit(end)
    w = Window.partitionBy(*by).orderBy(time, state)
    src = events.where(F.col(time).isNotNull() & F.col(state).isin(opened, closed)).withColumn("__plus", plus if plus is not None else F.lit(0))
    step = src.withColumn("__was", F.lag(state).over(w)).withColumn("__at", F.lag(time).over(w)).withColumn("__next", F.lead(state).over(w))
    done = step.where((F.col(state) == closed) & (F.col("__was") == opened)).select(*by, F.col("__at").alias("lo"), (F.col(time) + F.col("__plus")).alias("hi"))
    still = step.where((F.col(state) == opened) & F.col("__next").isNull()).select(*by, F.col(time).alias("lo"), e.cast("bigint").alias("hi"))
    return proper(done.unionByName(still))


def merge(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The union of the intervals of each key as disjoint ones; those that touch become one."""
    w = Window.partitionBy(*by).orderBy("lo", "hi")
    reach = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    src = proper(df).select(*by, "lo", "hi").withColumn("__new", F.when(reach.isNull() | (F.col("lo") > reach), 1).otherwise(0))
    src = src.withColumn("__i", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return src.groupBy(*by, "__i").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("__i")


def length(df: DataFrame, by: Sequence[str], to: str) -> DataFrame:
    """The total length of the union of each key's intervals."""
    return merge(df, by).groupBy(*by).agg(F.sum(F.col("hi") - F.col("lo")).alias(to))


def intersect(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """What both tables' intervals of a key have in common, as disjoint intervals.

    A sweep over the bounds of the two unions instead of a join of all pairs: between two
    neighbouring bounds the number of open intervals of each side is constant.
    """
    ends = F.explode(F.array(F.struct(F.col("lo").alias("t"), F.lit(1).alias("d")), F.struct(F.col("hi").alias("t"), F.lit(-1).alias("d")))).alias("__e")
    sides = [merge(x, by).select(*by, ends, F.lit(i).alias("__side")) for i, x in enumerate((a, b))]
    steps = sides[0].unionByName(sides[1]).groupBy(*by, F.col("__e.t").alias("__t")).agg(*[F.sum(F.when(F.col("__side") == i, F.col("__e.d")).otherwise(0)).alias(f"__d{i}") for i in (0, 1)])
    w = Window.partitionBy(*by).orderBy("__t")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    open_ = steps.select(*by, F.col("__t").alias("lo"), F.lead("__t").over(w).alias("hi"), F.sum("__d0").over(run).alias("__n0"), F.sum("__d1").over(run).alias("__n1"))
    return merge(open_.where((F.col("__n0") > 0) & (F.col("__n1") > 0)).select(*by, "lo", "hi"), by)


def lengths(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per key the total lengths of the unions of both tables' intervals and of what they share: ``a``, ``b``, ``either``, ``both``.

    One sweep over all bounds: between two neighbouring ones the number of open intervals of each
    side is constant. Keys are shuffled once. Keys without intervals have no row.
    """
    ends = F.explode(F.array(F.struct(F.col("lo").alias("t"), F.lit(1).alias("d")), F.struct(F.col("hi").alias("t"), F.lit(-1).alias("d")))).alias("__e")
    sides = [proper(x).select(*by, ends, F.lit(i).alias("__side")).select(*by, F.col("__e.t").alias("__t"), *[F.when(F.col("__side") == k, F.col("__e.d")).otherwise(0).alias(f"__d{k}") for k in (0, 1)]) for i, x in enumerate((a, b))]
    steps = sides[0].unionByName(sides[1]).repartition(*by).groupBy(*by, "__t").agg(F.sum("__d0").alias("__d0"), F.sum("__d1").alias("__d1"))
    w = Window.partitionBy(*by).orderBy("__t")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    runs = steps.select(*by, (F.lead("__t").over(w) - F.col("__t")).alias("__len"), (F.sum("__d0").over(upto) > 0).alias("__a"), (F.sum("__d1").over(upto) > 0).alias("__b"))
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("__len"))), F.lit(0))
    x, y = F.col("__a"), F.col("__b")
    return runs.groupBy(*by).agg(total(x).alias("a"), total(y).alias("b"), total(x | y).alias("either"), total(x & y).alias("both"))


def extend(bad: DataFrame, good: DataFrame, by: Sequence[str], end: Column | int) -> DataFrame:
    """``bad`` intervals prolonged to where a good one resumes.

    One that ends inside a good interval (its start included) stays; else it lasts to the next
    start of a good one, or to ``end``. By an ordered union: each end looks at the good interval
    that reaches furthest among those started before and at the first one to start after.
    """
    e = end if isinstance(end, Column) else F.lit(end)
    null = F.lit(None).cast("bigint")
    g = merge(good, by).select(*by, F.col("lo").alias("__t"), F.lit(0).alias("__kind"), F.col("hi").alias("__until"), null.alias("__lo"))
    b = proper(bad).select(*by, F.col("hi").alias("__t"), F.lit(1).alias("__kind"), null.alias("__until"), F.col("lo").alias("__lo"))
    w = Window.partitionBy(*by).orderBy("__t", "__kind")
    reach = F.max("__until").over(w.rowsBetween(Window.unboundedPreceding, 0))
    nxt = F.min(F.when(F.col("__kind") == 0, F.col("__t"))).over(w.rowsBetween(1, Window.unboundedFollowing))
    both = g.unionByName(b).withColumn("__reach", reach).withColumn("__next", nxt)
    stays = F.coalesce(F.col("__reach") > F.col("__t"), F.lit(False))
    return proper(both.where("__kind = 1").select(*by, F.col("__lo").alias("lo"), F.when(stays, F.col("__t")).otherwise(F.coalesce("__next", e.cast("bigint"))).alias("hi")))


def overlaps(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Intervals that start before the one before them in order of start has ended."""
    w = Window.partitionBy(*by).orderBy("lo", "hi")
    return proper(df).select(*by, "lo", "hi").withColumn("previous_hi", F.lag("hi").over(w)).where(F.col("lo") < F.col("previous_hi"))


def by_day(df: DataFrame, day: int = DAY_NS) -> DataFrame:
    """Each interval cut at the bounds of days; ``day`` numbers them."""
    src = proper(df).withColumn("day", F.explode(F.sequence(floor_div("lo", day), floor_div(F.col("hi") - 1, day))))
    return src.withColumn("lo", F.greatest("lo", F.col("day") * day)).withColumn("hi", F.least("hi", (F.col("day") + 1) * day))
