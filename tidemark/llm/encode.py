"""Encoding of a corpus with a public tokenizer (problem 7)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm import vocab

VOCABULARY = f"{vocab.VOCABULARIES}/byte_bpe_50k.tiktoken"


def _texts(column: pa.Array) -> list[str | None]:
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if b is None else b.decode("utf-8", "replace") for b in column.cast(pa.binary()).to_pylist()]


def encode(df: DataFrame, keep: Sequence[str], text: str = "text", path: str = VOCABULARY, offsets: bool = False) -> DataFrame:
    """``keep`` columns, ``ids`` (array of int) and, on request, ``ends`` (byte offset after each token).

    Null and empty texts have the empty list: a document always has a list. Strings that look like
    special tokens are ordinary text; no special token is added. Blank texts are encoded as they
    are. Bytes that are no UTF-8 count as U+FFFD. Very long texts are cut at places where pieces
    start anyway, so their ids are the same. Only ``keep`` and the text are read; nothing is
    shuffled.

    Splitting into pieces is by classes of code points and an associative scan of transition
    functions (:mod:`vocab`), merging by a per-worker cache over the distinct pieces.
    """
    keep = list(keep)
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])
    if offsets:
        schema = schema.add("ends", T.ArrayType(T.LongType(), False), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = vocab.encoder(path)
        widths = enc.widths() if offsets else None
        for whole in batches:
            for lo, n in portions(whole.column(len(keep))):
                b = whole.slice(lo, n)
                flat, at = enc.encode(_texts(b.column(len(keep))))
                at32 = pa.array(at.astype(np.int32))
                cols = [b.column(i) for i in range(len(keep))]
                cols.append(_lists(at32, pa.array(flat, pa.int32())))
                if offsets:
                    upto = np.concatenate([[0], np.cumsum(widths[flat])])
                    ends = upto[1:] - np.repeat(upto[at[:-1]], np.diff(at))
                    cols.append(_lists(at32, pa.array(ends, pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, "ids", *(["ends"] if offsets else [])])

    return df.select(*keep, text).mapInArrow(run, schema)


def portions(texts: pa.Array, most: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Slices of a batch with about ``most`` bytes of text each, so memory does not follow the batch."""
    lens = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    upto = np.cumsum(lens)
    lo = 0
    while lo < len(lens):
        base = upto[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, base + most, "right")))
        yield lo, hi - lo
        lo = hi


def _lists(at: pa.Array, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(at, values)


def count(df: DataFrame, keep: Sequence[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``keep`` columns and ``tokens``, the length of each text in tokens (0 for null and empty)."""
    keep = list(keep)
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("tokens", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = vocab.encoder(path)
        for whole in batches:
            for lo, n in portions(whole.column(len(keep))):
                b = whole.slice(lo, n)
                _, at = enc.encode(_texts(b.column(len(keep))), gather=False)
                yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(np.diff(at))], names=[*keep, "tokens"])

    return df.select(*keep, text).mapInArrow(run, schema)


def decode(df: DataFrame, keep: Sequence[str], ids: str = "ids", path: str = VOCABULARY, to: str = "text") -> DataFrame:
    """The text of each list of ids; null for a null list. Unknown ids are an error."""
    keep = list(keep)
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(to, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = vocab.encoder(path)
        for b in batches:
            texts = [None if x is None else enc.decode(x) for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(texts, pa.string())], names=[*keep, to])

    return df.select(*keep, ids).mapInArrow(run, schema)
