"""Reading level of what the author of a mail wrote (problem 9)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import mail
from tidemark.session import cut

#: Labelled documents the ranker is fitted on at most, taken by a seeded hash of their id.
SAMPLE = 6_000
#: Pairs drawn from them, and folds of the calibration.
PAIRS, FOLDS = 40_000, 3
#: Words with a weight of their own occur in at least so many fitted documents.
LEAST_DOCUMENTS = 3
#: A document is demanding from this level on.
DEMANDING = 4

_WORD = re.compile(r"[^\W\d_]+")
_STOP = re.compile(r"[.!?]+(?:\s|$)")
_CLAUSE = re.compile(r"[,;:()–—]")
#: Of the syntax features: typical value and spread, so that weights are of one size.
_CENTRE = np.array([2.3, 5.0, 0.1, 0.5, 3.0, 0.3, 1.8, 2.7, 0.4, 0.4])
_SPREAD = np.array([0.8, 1.5, 0.2, 0.7, 1.5, 0.3, 0.6, 0.8, 0.3, 0.2])
_SHAPES = len(_CENTRE)
#: A line is boilerplate if at least this share of all mails have it and at least so many do, of about so many senders or more.
SHARE, LEAST_MAILS, LEAST_SENDERS = 1 / 400, 5, 4


def words_of(prose: str) -> list[str]:
    return _WORD.findall(prose.lower())


def syntax(prose: str, words: list[str]) -> np.ndarray:
    """How sentences are built.

    Sentence length, word length, share of long words, commas per sentence, length of long words,
    repetition; length of clauses, of the longest sentence, unevenness of sentences, share of short
    (mostly function) words.
    """
    n = len(words)
    spans = [k for x in _STOP.split(prose) if (k := len(_WORD.findall(x)))]
    sentences = max(1, len(_STOP.findall(prose)))
    lens = list(map(len, words))
    long = [x for x in lens if x >= 10]
    kinds = len(set(words))
    clauses = sentences + len(_CLAUSE.findall(prose))
    raw = (
        np.log(n / sentences), sum(lens) / n, len(long) / n, prose.count(",") / sentences, np.log1p(sum(long) / max(1, len(long))), 1 - kinds / n,
        np.log(n / clauses), np.log(max(spans)), float(np.std(np.log(spans))), sum(1 for x in lens if x <= 3) / n,
    )
    return (np.array(raw) - _CENTRE) / _SPREAD


class Sparse:
    """A matrix by rows: only what is not zero is kept."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], width: int):
        self.at = np.concatenate([[0], np.cumsum([len(c) for c, _ in rows])]).astype(np.int64)
        self.columns = np.concatenate([c for c, _ in rows])
        self.values = np.concatenate([v for _, v in rows]).astype(np.float32)
        self.row = np.repeat(np.arange(len(rows)), np.diff(self.at))
        self.width = width

    def times(self, w: np.ndarray) -> np.ndarray:
        """The matrix times a column. Every row has its shape, so none is empty."""
        return np.add.reduceat(self.values * w[self.columns], self.at[:-1])

    def turned(self, g: np.ndarray) -> np.ndarray:
        """A row times the matrix."""
        return np.bincount(self.columns, self.values * g[self.row], self.width)


class Ranker:
    """A linear score learnt from pairs of documents, and its isotonic calibration to levels."""

    def __init__(self, vocabulary: dict[str, float], shape: np.ndarray, steps: np.ndarray, levels: np.ndarray):
        self.vocabulary, self.shape, self.steps, self.levels = vocabulary, shape, steps, levels

    def score(self, prose: str) -> float | None:
        words = words_of(prose)
        if not words:
            return None
        get = self.vocabulary.get
        return float(self.shape @ syntax(prose, words)) + sum(get(w, 0.0) for w in words) / len(words)

    def level(self, prose: str) -> float | None:
        s = self.score(prose)
        return None if s is None else float(np.interp(s, self.steps, self.levels))


def isotonic(x: np.ndarray, y: np.ndarray, least: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing fit of y to x by least squares, as points to interpolate.

    Neighbours in x are first put together to at least ``least`` points each, then adjacent groups
    that fall are pooled.
    """
    order = np.argsort(x, kind="stable")
    groups = np.array_split(order, max(1, len(x) // least))
    pools: list[list[float]] = []  # mean of y, weight, mean of x
    for g in groups:
        pools.append([float(y[g].mean()), float(len(g)), float(x[g].mean())])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m, w, at = pools.pop()
            p = pools[-1]
            p[0], p[2], p[1] = (p[0] * p[1] + m * w) / (p[1] + w), (p[2] * p[1] + at * w) / (p[1] + w), p[1] + w
    return np.array([p[2] for p in pools]), np.array([p[0] for p in pools])


def _learn(data: list[tuple[str, list[str], float]], seed: int, rounds: int) -> Ranker:
    """The pairwise ranker itself, not yet calibrated."""
    rng = np.random.default_rng(seed)
    df = Counter(w for _, words, _ in data for w in set(words))
    column = {w: k for k, w in enumerate(sorted(w for w, n in df.items() if n >= LEAST_DOCUMENTS))}
    y = np.array([g for *_, g in data])
    rows = []
    for prose, words, _ in data:
        own = [(column[w], n) for w, n in Counter(words).items() if w in column]
        at = np.array([*range(_SHAPES), *(_SHAPES + c for c, _ in own)], np.int64)
        rows.append((at, np.concatenate([syntax(prose, words), 10 * np.array([n for _, n in own], float) / len(words)])))
    x = Sparse(rows, _SHAPES + len(column))
    a, b = rng.integers(0, len(data), (2, 3 * PAIRS))
    ok = np.abs(y[a] - y[b]) > 0.5
    a, b = a[ok][:PAIRS], b[ok][:PAIRS]
    w = np.zeros(x.width)
    if len(a):
        sign, weight = np.sign(y[a] - y[b]), np.minimum(np.abs(y[a] - y[b]), 2)
        m, v = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, rounds + 1):
            s = x.times(w.astype(np.float32))
            g = -sign * weight / (1 + np.exp(np.clip(sign * (s[a] - s[b]), -30, 30))) / len(a)
            grad = x.turned(np.bincount(a, g, len(data)) - np.bincount(b, g, len(data))) + 1e-4 * w
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Ranker({k: 10 * float(w[_SHAPES + c]) for k, c in column.items()}, w[:_SHAPES].astype(float), np.zeros(1), np.zeros(1))


def fit(proses: list[str], levels: list[float], seed: int = 7, rounds: int = 300) -> Ranker:
    """Learn from graded documents.

    Pairs are drawn among documents whose grades differ by more than half a level; the loss is
    logistic in the difference of scores, weighted by the difference of grades, with the squared
    weights of words as a penalty. The calibration rests on scores that each document gets from a
    ranker fitted without its fold.
    """
    data = [(p, w, y) for p, y in zip(proses, levels, strict=True) if (w := words_of(p))]
    if len({y for _, _, y in data}) < 2 or len(data) < 2 * FOLDS:
        mean = float(np.mean([y for *_, y in data])) if data else 1.0
        return Ranker({}, np.zeros(_SHAPES), np.array([0.0]), np.array([mean]))
    fold = np.random.default_rng(seed).permutation(len(data)) % FOLDS
    scores = np.zeros(len(data))
    for k in range(FOLDS):
        part = _learn([d for d, f in zip(data, fold, strict=True) if f != k], seed, rounds)
        for i in np.flatnonzero(fold == k):
            scores[i] = part.score(data[i][0])
    ranker = _learn(data, seed, rounds)
    ranker.steps, ranker.levels = isotonic(scores, np.array([g for *_, g in data]), min(25, max(5, len(data) // 25)))
    return ranker


def written(documents: DataFrame) -> DataFrame:
    """``doc_id``, the own lines of each mail (:func:`mail.own`) in one text, ``own``, and its ``sender`` as one of 63 bits; written once.

    Mails are taken apart only here: what is learned and what is scored both read this table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(["\n".join(mail.own(t)) for t in texts], pa.string()), pa.array([1 << (mail.sender(t) % 63) for t in texts], pa.int64())], names=["doc_id", "own", "sender"])

    schema = T.StructType([documents.schema["doc_id"], T.StructField("own", T.StringType()), T.StructField("sender", T.LongType())])
    return cut(documents.select("doc_id", "text").mapInArrow(run, schema))


def boilerplate(mails: DataFrame) -> frozenset[int]:
    """Hashes of the lines that many senders write word for word: notices, footers, automatic replies. ``mails``: see :func:`written`.

    All mails are read. Of each own line of some length its hash goes out, with the mail's sender;
    counts and bits are combined on the map side. Lines with at least SHARE of all mails,
    LEAST_MAILS of them and LEAST_SENDERS bits are boilerplate. There are at most lines per mail /
    SHARE of these, so they go to the driver and with the tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, bits = [], []
            for own, sender in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = mail.marks(own.split("\n"))
                at.extend(found)
                bits.extend([sender] * len(found))
                at.append(0)  # one row a mail
                bits.append(0)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(bits, pa.int64())], names=["mark", "bits"])

    seen = mails.select("own", "sender").mapInArrow(run, "mark bigint, bits bigint").groupBy("mark").agg(F.count(F.lit(1)).alias("n"), F.bit_count(F.bit_or("bits")).alias("senders"))
    seen = cut(seen.where(F.col("n") >= LEAST_MAILS))
    n = seen.where("mark = 0").agg(F.max("n")).first()[0] or 0
    often = seen.where((F.col("n") >= n * SHARE) & (F.col("senders") >= LEAST_SENDERS) & (F.col("mark") != 0)).select("mark").collect()
    return frozenset(r[0] for r in often)


def graded(mails: DataFrame, labels: DataFrame, sample: int = SAMPLE, common: frozenset[int] = frozenset()) -> list[tuple[str, float]]:
    """Prose and mean grade of at most ``sample`` labelled mails (see :func:`written`); repeated rows of a rater count once."""
    one = labels.where(F.col("reading_level").between(1, 5) & F.col("doc_id").isNotNull()).groupBy("doc_id", "rater").agg(F.avg("reading_level").alias("g"))
    mean = one.groupBy("doc_id").agg(F.avg("g").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = [(r["doc_id"], mail.prose(r["own"].split("\n"), common), r["grade"]) for r in mails.select("doc_id", "own").join(F.broadcast(mean), "doc_id").collect()]
    return [(prose, grade) for _, prose, grade in sorted(rows)]


def levels(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``level`` (1 to 5, with fractions) and ``words`` of each document's own prose.

    Mails are taken apart once, boilerplate is learned from all of them, then the ranker is fitted on the driver to a bounded
    sample of labelled documents and sent with the tasks; every document is scored over its whole
    text in one scan without a shuffle. Null, empty and blank texts, automatic notices and mails
    that only quote have null level and no words. Without usable labels every document with prose
    gets one level.
    """
    mails = written(documents)
    common = boilerplate(mails)
    known = graded(mails, labels, sample, common)
    ranker = fit([p for p, _ in known], [g for _, g in known])
    schema = T.StructType([documents.schema["doc_id"], T.StructField("level", T.DoubleType()), T.StructField("words", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            proses = [mail.prose(t.split("\n"), common) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([ranker.level(p) for p in proses], pa.float64()), pa.array([len(words_of(p)) for p in proses], pa.int64())], names=["doc_id", "level", "words"])

    return mails.select("doc_id", "own").mapInArrow(run, schema)


def demanding(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose prose is nearer to level 4 or 5 than to a lower one."""
    return levels(documents, labels).where(F.col("level") >= DEMANDING - 0.5).select("doc_id")
