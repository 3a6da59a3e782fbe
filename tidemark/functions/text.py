"""Symbols, canonical JSON and hashes."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Unicode normal form C; null stays null."""
    return s.str.normalize("NFC")


def is_symbol(c: Column | str) -> Column:
    """1 to 30 letters or digits of any script in upper case. Null is no symbol."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.rlike(r"^[\p{L}\p{N}]{1,30}$") & (F.upper(c) == c), F.lit(False))


def canonical_json(*columns: Column) -> Column:
    """JSON text of the columns as one object, keys sorted, nulls kept, no blanks."""
    return F.to_json(F.to_variant_object(F.struct(*columns)))


def sha256_json(*columns: Column) -> Column:
    return F.sha2(canonical_json(*columns), 256)


def dumps(value: Any) -> bytes:
    """Canonical JSON of a small value on the driver: keys sorted, no blanks, a line end."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode() + b"\n"


def digest(value: Any) -> str:
    return hashlib.sha256(dumps(value)).hexdigest()


def utc_text(ns: Column | str) -> Column:
    """Nanoseconds since the epoch as text: UTC to the millisecond, cut, with a Z."""
    ns = F.col(ns) if isinstance(ns, str) else ns
    ms = F.call_function("div", ns - F.pmod(ns, F.lit(1_000_000)), F.lit(1_000_000).cast("bigint"))
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def identity_key(*parts: Column) -> Column:
    """SHA-256 of a list as JSON, of parts that are text (cast numbers) or, for bytes, what :func:`bytes_part` gives."""
    def one(c: Column) -> Column:
        return F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)

    return F.sha2(F.concat(F.lit("["), F.concat_ws(",", *map(one, parts)), F.lit("]")), 256)


def bytes_part(c: Column | str) -> Column:
    """Bytes as a part of an :func:`identity_key`: ``{"bytes": hex}``."""
    return F.struct(F.lower(F.hex(c)).alias("bytes"))


def symbol_list(names: list[str], count: int | None = None) -> list[str]:
    """Names as sorted symbols: trimmed, normal form C, upper case; an error for one that is none, for repeats, or another number than ``count``."""
    out = sorted(unicodedata.normalize("NFC", n.strip()).upper() for n in names)
    bad = [n for n in out if not 1 <= len(n) <= 30 or not n.isalnum()]
    if bad or len(set(out)) < len(out) or count not in (None, len(out)):
        raise ValueError(f"no symbol: {bad[0]}" if bad else "a symbol is repeated" if len(set(out)) < len(out) else f"{len(out)} symbols instead of {count}")
    return out


#: Streams of a collection and what its contract states. Fixed values.
FORMAL_STREAMS = ("agg_trade", "book_ticker", "clock_sample", "contract_info", "daily_klines", "depth", "depth_snapshot", "exchange_info", "force_order", "formal_collection_started", "liquidity_depth", "mark_price", "market_tickers", "open_interest", "universe_decision")
FURTHER_STREAMS = ("rpi_depth", "rpi_depth_snapshot", "trade")
CONTRACT = {"depth_interval_ms": 100, "depth_snapshot_limit": 1000, "exchange": "binance_usdm", "gap_schema": 2, "mark_price_interval_ms": 1000, "raw_schema": 1}


def contract_hash(further: bool = False, open_interest_seconds: int = 30) -> str:
    """The identity of what a collection promises: hash of its contract as canonical JSON."""
    streams = sorted(FORMAL_STREAMS + (FURTHER_STREAMS if further else ()))
    return digest(CONTRACT | {"d0_enabled": further, "open_interest_interval_seconds": open_interest_seconds, "streams": streams})
