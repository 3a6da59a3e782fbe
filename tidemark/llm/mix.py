"""Mixing sources to target weights (problem 8): subset-sum budget fitting."""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.encode import VOCABULARY, count
from tidemark.session import cut, fits

#: Tokens of a budget that are fitted exactly at first; more if they cannot be met.
EXACT = 1 << 17
#: Buckets of the seeded order in which documents of one length are taken.
ORDER_BUCKETS = 1 << 12

#: Tasks that the documents of one length are spread over where the plan is too large to broadcast.
SALTS = 32


@dataclass
class Plan:
    """What is taken from one source: every document ``whole`` times and one more time of each length ``extra`` many."""

    source: str
    target_share: float
    max_repeats: int
    documents: int
    tokens: int
    budget: int = 0
    whole: int = 0
    extra: dict[int, int] = field(default_factory=dict)

    @property
    def taken(self) -> int:
        return self.whole * self.tokens + sum(n * k for n, k in self.extra.items())


def _sums(items: list[tuple[int, int]], most: int) -> int:
    """All sums up to ``most`` of up to k times n for each (n, k), as the set bits of a number."""
    reach, mask = 1, (1 << (most + 1)) - 1
    for n, k in items:
        k, step = min(k, most // n), 1
        while k > 0:  # powers of two and a rest make every count
            step = min(step, k)
            reach |= (reach << (n * step)) & mask
            k, step = k - step, step * 2
    return reach


_TURNED = bytes(int(f"{x:08b}"[::-1], 2) for x in range(256))


def _mirrored(bits: int, most: int) -> int:
    """Bit i of the result is bit ``most`` - i of ``bits``."""
    size = most // 8 + 1
    return int.from_bytes(bits.to_bytes(size, "little").translate(_TURNED)[::-1], "little") >> (size * 8 - 1 - most)


def _pick(items: list[tuple[int, int]], target: int) -> dict[int, int]:
    """How many of each make ``target``, which must be one of their sums: halves are asked what they can add to each other."""
    if target == 0:
        return {}
    if len(items) == 1:
        return {items[0][0]: target // items[0][0]}
    half = len(items) // 2
    both = _sums(items[:half], target) & _mirrored(_sums(items[half:], target), target)
    left = (both & -both).bit_length() - 1
    return _pick(items[:half], left) | _pick(items[half:], target - left)


def fit(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length to take so that lengths add up to ``budget``, or to the most below it that any choice has.

    ``counts`` has the documents of each length above zero. First every length gives the same
    fraction of its documents, rounded down, so the choice keeps the distribution of lengths, and
    the longest that fit are added while more than EXACT tokens are missing. The remainder is
    fitted by bounded-knapsack dynamic programming over sets of reachable sums. If it cannot be met
    to the token, ever more of what was taken is given back and fitted again, eight times as many
    tokens each time, in the end the whole budget: then the answer is the best there is. With
    lengths of any size nothing is cut off; memory is an eighth of a byte per token of what is fitted.
    """
    counts = {n: k for n, k in counts.items() if n > 0 and k > 0}
    total = sum(n * k for n, k in counts.items())
    if budget >= total:
        return counts
    if budget <= 0 or not counts:
        return {}
    unit = math.gcd(*counts)
    if unit > 1:
        return {n * unit: k for n, k in fit({n // unit: k for n, k in counts.items()}, budget // unit).items()}
    even = {n: k * budget // total for n, k in counts.items()}
    at_once, longest_first = EXACT, sorted(counts, reverse=True)
    while True:
        take = dict(even)
        rest = budget - sum(n * k for n, k in take.items())
        if rest < at_once and at_once > EXACT:
            share = min(Fraction(1), Fraction(at_once - rest, max(1, budget - rest)))
            take = {n: k - math.ceil(k * share) for n, k in even.items()}
            rest = budget - sum(n * k for n, k in take.items())
        for n in longest_first:
            if rest <= at_once:
                break
            more = min(counts[n] - take[n], rest // n if n > EXACT else -(-(rest - at_once) // n), rest // n)
            take[n] += more
            rest -= more * n
        # short lengths last: they close what is left
        items = [(n, counts[n] - take[n]) for n in longest_first if counts[n] > take[n] and n <= rest]
        best = _sums(items, rest).bit_length() - 1
        if best == rest or not any(take.values()):
            for n, k in _pick(items, best).items():
                take[n] += k
            return {n: k for n, k in take.items() if k}
        at_once *= 8


def plan(lengths: dict[str, dict[int, int]], targets: list[tuple[str, float, int]]) -> list[Plan]:
    """Budgets and choices of all sources.

    Only sources with a target share above zero, a cap of at least one and any tokens can
    contribute; their shares are scaled to add up to one. The total is the largest at which no
    source needs more than ``max_repeats`` times its tokens, so shares are met and the scarcest
    source is used up.
    """
    plans = []
    for source, share, cap in targets:
        have = {n: k for n, k in lengths.get(source, {}).items() if n > 0}
        plans.append((Plan(source, share, cap, sum(have.values()), sum(n * k for n, k in have.items())), have))
    able = [p for p, _ in plans if p.tokens and p.target_share > 0 and p.max_repeats >= 1]
    scale = sum(p.target_share for p in able)
    total = min((p.max_repeats * p.tokens * scale / p.target_share for p in able), default=0)
    for p, have in plans:
        if p in able:
            p.budget = min(p.max_repeats * p.tokens, round(total * p.target_share / scale))
            p.whole = p.budget // p.tokens
            p.extra = fit(have, p.budget - p.whole * p.tokens)
    return [p for p, _ in plans]


def _name(c: str):
    return F.lower(F.trim(F.col(c)))


def mixture(documents: DataFrame, targets: DataFrame, seed: int = 1, path: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """The mixture (``doc_id``, ``source``, ``tokens``, ``copies``) and a report per target source.

    Sources are compared in lower case and without outer blanks; several rows of one target count
    as one with the summed share and the lowest cap; null shares, caps or names do not count.
    Documents without tokens (null and empty texts) are never taken: they have no size to share.
    Every document of a source is used ``whole`` or ``whole`` + 1 times, never more than its cap.
    Equal doc_ids are told apart by nothing and taken together; ids should be unique.

    Passes: one to count tokens; the table (source, length, documents) goes to the driver, whose
    size is bounded by the square root of twice the corpus' tokens per source; one to select. Of
    each (source, length) the documents lowest in a seeded hash are taken. So that no task sorts
    one length of a large source, places are counted by bucket of the hash; only the bucket in
    which the number is reached is ordered.
    """
    spark = documents.sparkSession
    t = targets.where(F.col("source").isNotNull() & (F.col("target_share") > 0) & F.col("max_repeats").isNotNull())
    t = t.groupBy(_name("source").alias("source")).agg(F.sum("target_share").alias("share"), F.min("max_repeats").alias("cap"))
    wanted = [(r["source"], r["share"], r["cap"]) for r in t.orderBy("source").collect()]
    named = documents.select("doc_id", _name("source").alias("source"), "text").where(F.col("source").isin([w[0] for w in wanted]))
    sized = cut(count(named, ["doc_id", "source"], path=path).where(F.col("tokens") > 0))

    lengths: dict[str, dict[int, int]] = defaultdict(dict)
    for r in sized.groupBy("source", "tokens").count().toLocalIterator():
        lengths[r["source"]][r["tokens"]] = r["count"]
    plans = plan(lengths, wanted)

    report = spark.createDataFrame(
        [(p.source, p.target_share, p.max_repeats, p.documents, p.tokens, p.budget, p.taken) for p in plans],
        "source string, target_share double, max_repeats int, documents bigint, source_tokens bigint, budget_tokens bigint, mix_tokens bigint",
    )
    everything = sum(p.taken for p in plans)
    report = report.withColumn("actual_share", F.col("mix_tokens") / F.lit(float(everything or 1)))

    whole = spark.createDataFrame([(p.source, p.whole) for p in plans], "source string, whole int")
    extra = spark.createDataFrame([(p.source, n, k) for p in plans for n, k in p.extra.items()], "source string, tokens bigint, extra bigint")
    seeded = sized.withColumn("__h", F.xxhash64("doc_id", F.lit(seed))).withColumn("__b", F.pmod("__h", F.lit(ORDER_BUCKETS)).cast("int"))
    if fits(extra):
        some = seeded.join(F.broadcast(extra), ["source", "tokens"])
    else:  # one length can hold a third of all documents: it is spread over SALTS tasks
        salted = extra.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        some = seeded.withColumn("__s", F.col("__b") % SALTS).join(salted, ["source", "tokens", "__s"]).drop("__s")
    # the place of a bucket among those of its length, from counts alone
    tally = some.groupBy("source", "tokens", "__b").agg(F.count(F.lit(1)).alias("__n"), F.max("extra").alias("extra"))
    upto = F.sum("__n").over(Window.partitionBy("source", "tokens").orderBy("__b"))
    tally = tally.withColumn("__upto", upto).withColumn("__left", F.col("extra") - (F.col("__upto") - F.col("__n"))).where(F.col("__left") > 0)
    full = tally.select("source", "tokens", "__b", F.when(F.col("__left") < F.col("__n"), F.col("__left")).alias("__only"))
    chosen = some.drop("extra").join(full, ["source", "tokens", "__b"])
    all_of = chosen.where(F.col("__only").isNull()).select("doc_id", "source", "tokens")
    place = F.row_number().over(Window.partitionBy("source", "tokens", "__b").orderBy("__h", "doc_id"))
    part_of = chosen.where(F.col("__only").isNotNull()).withColumn("__k", place).where(F.col("__k") <= F.col("__only")).select("doc_id", "source", "tokens")
    once = all_of.unionByName(part_of).withColumn("copies", F.lit(1))
    always = sized.join(F.broadcast(whole), "source").where(F.col("whole") > 0).select("doc_id", "source", "tokens", F.col("whole").alias("copies"))
    mix = always.unionByName(once).groupBy("doc_id", "source", "tokens").agg(F.sum("copies").cast("int").alias("copies"))
    return mix, report
