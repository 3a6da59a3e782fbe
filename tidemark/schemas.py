"""Schemas of the feed: raw events, typed events, projections, gaps, manifests, evidence.

Field names, their order and types are the feed's format: fixed values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

LEVELS = T.ArrayType(T.StructType([T.StructField("price", T.StringType()), T.StructField("quantity", T.StringType())]))

_SHORT, _STR, _LONG, _BIN, _BOOL = T.ShortType(), T.StringType(), T.LongType(), T.BinaryType(), T.BooleanType()


def _struct(*groups: tuple[T.DataType, str]) -> T.StructType:
    return T.StructType([T.StructField(n, kind) for kind, names in groups for n in names.split()])


RAW = _struct(
    (_SHORT, "schema_version"),
    (_STR, "exchange_symbol stream_type collector_id boot_id segment_id connection_id"),
    (_LONG, "receive_seq app_receive_realtime_ns app_receive_monotonic_ns"),
    (_BIN, "payload_bytes"),
    (_STR, "request_id"),
    (_LONG, "request_realtime_ns"),
)

TYPED = _struct(
    (_SHORT, "schema_version"),
    (_STR, "exchange_symbol stream_type connection_id"),
    (_LONG, "receive_seq app_receive_realtime_ns app_receive_monotonic_ns request_realtime_ns exchange_event_time_ms exchange_transaction_time_ms"),
    (_BIN, "payload_hash"),
    (_BOOL, "is_duplicate"),
    (_LONG, "update_id first_update_id final_update_id previous_final_update_id last_update_id trade_id aggregate_trade_id first_trade_id last_trade_id"),
    (_STR, "price quantity non_rpi_quantity"),
    (_BOOL, "buyer_is_maker"),
    (_STR, "bid_price bid_quantity ask_price ask_quantity mark_price index_price estimated_settle_price funding_rate"),
    (_LONG, "next_funding_time_ms"),
    (_STR, "open_interest side order_type time_in_force order_status average_price last_filled_quantity accumulated_filled_quantity contract_type"),
    (_LONG, "delivery_date_ms onboard_date_ms"),
    (_STR, "contract_status"),
    (LEVELS, "bids asks"),
)

PROJECTION = _struct(
    (_STR, "stream_type connection_id"),
    (_LONG, "receive_seq app_receive_realtime_ns app_receive_monotonic_ns exchange_event_time_ms exchange_transaction_time_ms"),
    (_BIN, "payload_hash"),
    (_BOOL, "is_duplicate"),
    (_LONG, "first_update_id final_update_id previous_final_update_id last_update_id"),
    (LEVELS, "bids asks"),
)

GAP = T.StructType([
    T.StructField("schema_version", T.IntegerType()),
    *[T.StructField(n, _STR) for n in ("gap_id", "collector_id", "connection_id", "state", "reason")],
    T.StructField("observed_at_realtime_ns", _LONG),
    T.StructField("affected_from_realtime_ns", _LONG),
    T.StructField("exchange_symbols", T.ArrayType(_STR)),
    T.StructField("stream_types", T.ArrayType(_STR)),
    T.StructField("detail", _STR),
])

CHUNK = _struct((_STR, "chunk_id data_path sha256"), (_LONG, "size_bytes"), (_STR, "content_type"))
MANIFEST = _struct(
    (_STR, "chunk_id data_path sha256"), (_LONG, "size_bytes"), (_STR, "content_type collector_id writer_group utc_date"),
    (_LONG, "event_count min_app_receive_realtime_ns max_app_receive_realtime_ns"), (_STR, "data_contract_hash universe_hash created_at"),
)
#: What the content type of a chunk of events, and of a gap fact, ends in. Fixed values.
PARQUET_TYPE, GAP_TYPE = "parquet", "gap+json"
DAY = T.StructType([T.StructField("collector_id", _STR), T.StructField("utc_date", _STR), T.StructField("chunks", T.ArrayType(CHUNK))])

#: Streams that give typed rows, and those that are only checked. Fixed values.
TYPED_STREAMS = ("depth", "rpi_depth", "depth_snapshot", "rpi_depth_snapshot", "book_ticker", "agg_trade", "trade", "mark_price", "force_order", "contract_info", "open_interest", "clock_sample")
CHECKED_STREAMS = ("exchange_info", "daily_klines", "liquidity_depth", "formal_collection_started", "universe_decision", "ws_control", "market_tickers", "unknown")
#: Writer groups by stream. Fixed values.
WRITER_GROUPS = {
    "depth": ("depth", "rpi_depth", "depth_snapshot", "rpi_depth_snapshot"),
    "trades_market": ("agg_trade", "trade", "book_ticker", "mark_price", "force_order"),
}
GAP_REASONS = tuple(f"{r}_GAP" for r in ("INGEST_OVERLOAD", "STORAGE_EXHAUSTED", "CONNECTION_LOST", "L2_SEQUENCE", "L2_REANCHOR", "PLANNED_BOUNDARY", "COLLECTOR_STOPPED"))


def require(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema`` in its order; an error if one is missing or of another type.

    Nullability and further columns do not matter: further ones are left out.
    """
    have = dict(df.dtypes)
    bad = [f"{f.name}: {have.get(f.name, 'missing')} instead of {f.dataType.simpleString()}" for f in schema if have.get(f.name) != f.dataType.simpleString()]
    if bad:
        raise ValueError("schema differs: " + "; ".join(bad))
    return df.select(*schema.names)
