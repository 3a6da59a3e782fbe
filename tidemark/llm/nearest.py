"""Matching records by nearest time (problem 5): expanding rings of doubled buckets."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import floor_div
from tidemark.session import cut

#: Right times in a bucket of the first round, where they are densest, if they lie evenly.
FEW = 2


def nearest(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, right_value: str, tolerance: int, rings: int | None = None) -> DataFrame:
    """Each distinct (by, left_time) with the nearest right row of the same ``by`` within ``tolerance``.

    Result: by, ``left_time`` and of the match ``right_time`` and ``right_value``; left rows
    without a match are left out. Of equally near rows the earlier counts, of equal times the
    largest ``right_value`` (null lowest). Times are whole numbers. Rows with a null in ``by`` or
    in their time take no part. ``left_time`` and ``right_time`` must differ in name.

    The finest buckets are tolerance / 2^rings wide, where ``rings`` doublings bring the most right
    times that one ``by`` has within a tolerance down to FEW, unless given: a left row meets the
    distinct right times of its own bucket and the adjacent ones, at most three widths of them. A match not further away than
    the bucket is wide is provably nearest; without one, nothing lies within that radius r. So in
    the next round, over buckets r wide, the own bucket must be empty and of the others only the
    last time before or the first after the row can be nearest: right rows shrink to the first and
    last time per bucket, each left row looks at exactly four of them (two on each side), and
    what it finds within 2r is nearest. Radius and buckets double until they reach the tolerance.

    No round emits pairs beyond these, all joins are on (by, bucket), and a key with a third of
    the rows is spread over its buckets. Resolved rows leave; the open ones of each round are
    written to the shared folder.
    """
    k = list(by)
    whole = lambda df, t: df.where(F.col(t).isNotNull() & F.greatest(*[F.col(c).isNull() for c in k], F.lit(False)).eqNullSafe(F.lit(False)))
    bucket = lambda t, w: floor_div(t, w)
    points = whole(right, right_time).groupBy(*k, F.col(right_time).alias("__r")).agg(F.max(right_value).alias("__v"))
    points = cut(points)
    if rings is None:
        densest = points.groupBy(*k, bucket(F.col("__r"), max(1, tolerance)).alias("__b")).count().agg(F.max("count")).first()[0] or 1
        rings = max(0, math.ceil(math.log2(densest / FEW)))
    width = max(1, -(-tolerance // (1 << rings)))
    open_rows = whole(left, left_time).select(*k, F.col(left_time).alias("__l")).distinct()

    gap = F.abs(F.col("__r") - F.col("__l"))
    # nearest first, then the earlier
    best = F.struct(gap.alias("d"), F.col("__r").alias("r"), F.col("__v").alias("v"))

    def look(rows: DataFrame, shifts: Column, w: int, side: DataFrame) -> DataFrame:
        keyed = rows.withColumn("__b", F.explode(shifts)).withColumn("__b", F.col("__b") + bucket(F.col("__l"), w))
        return keyed.join(side, [*k, "__b"], "left").groupBy(*k, "__l").agg(F.min(F.when(F.col("__r").isNotNull() & (gap <= tolerance), best)).alias("__m"))

    found = cut(look(open_rows, F.array(F.lit(-1), F.lit(0), F.lit(1)), width, points.withColumn("__b", bucket(F.col("__r"), width))))
    done = []
    sides = None
    radius = width
    while True:
        near = F.col("__m").isNotNull() & (F.col("__m.d") <= radius)
        done.append(found.where(near))
        if radius >= tolerance:
            break
        rest = found.where(~near).select(*k, "__l")
        if sides is None:
            ends = points.groupBy(*k, bucket(F.col("__r"), radius).alias("__b")).agg(
                F.min("__r").alias("lo"), F.max("__r").alias("hi"), F.min_by("__v", "__r").alias("lo_v"), F.max_by("__v", "__r").alias("hi_v")
            )
        else:
            ends = sides.groupBy(*k, floor_div("__b", 2).alias("__b")).agg(
                F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min_by("lo_v", "lo").alias("lo_v"), F.max_by("hi_v", "hi").alias("hi_v")
            )
        sides = cut(ends)
        keyed = rest.withColumn("__s", F.explode(F.array(*[F.lit(i) for i in (-2, -1, 1, 2)]))).withColumn("__b", bucket(F.col("__l"), radius) + F.col("__s"))
        met = keyed.join(sides, [*k, "__b"], "left").select(
            *k, "__l", F.when(F.col("__s") < 0, F.col("hi")).otherwise(F.col("lo")).alias("__r"), F.when(F.col("__s") < 0, F.col("hi_v")).otherwise(F.col("lo_v")).alias("__v")
        )
        found = cut(met.groupBy(*k, "__l").agg(F.min(F.when(F.col("__r").isNotNull() & (gap <= tolerance), best)).alias("__m")))
        radius *= 2
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.select(*k, F.col("__l").alias(left_time), F.col("__m.r").alias(right_time), F.col("__m.v").alias(right_value))


def marks_with_tickers(events: DataFrame, tolerance_ms: int = 2_000) -> DataFrame:
    """Each mark price time of a symbol with the book ticker nearest to it."""
    t = "exchange_event_time_ms"
    marks = events.where((F.col("stream_type") == "mark_price") & F.col("mark_price").isNotNull()).select("exchange_symbol", F.col(t).alias("mark_event_time_ms"))
    tickers = events.where((F.col("stream_type") == "book_ticker") & F.col("bid_price").isNotNull()).select("exchange_symbol", F.col(t).alias("ticker_event_time_ms"), "update_id")
    return nearest(marks, tickers, ["exchange_symbol"], "mark_event_time_ms", "ticker_event_time_ms", "update_id", tolerance_ms)
