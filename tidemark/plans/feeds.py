"""Queries of the general training-data problems, and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import changes, exactly_once, late, rolling, skew


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The columns are bigint: what is beyond it (92 thousand million) comes out as null, its row stays."""
    books = changes.final_books(_t(spark, d, "l2_projection"))
    return books.withColumns({c: F.col(c).try_cast("bigint") for c in ("price_e8", "quantity_e8")})


def p1_contracts(spark: SparkSession, d: str) -> DataFrame:
    """Column-wise last-writer-wins over partial updates: the current figures of each symbol of the typed events.

    A contract that is announced begins anew (insert), one that is settled ends (delete); all else
    updates. The order is total: time of receipt, connection, number.
    """
    rows = _t(spark, d, "typed_events").where(F.col("exchange_symbol").isNotNull() & F.col("stream_type").isin("mark_price", "open_interest", "book_ticker", "contract_info"))
    op = F.when(F.col("contract_status") == "SETTLING", "delete").when(F.col("contract_status") == "PENDING_TRADING", "insert").otherwise("update")
    fields = ["mark_price", "open_interest", "bid_price", "ask_price", "contract_status"]
    seq = F.struct("app_receive_realtime_ns", "connection_id", "receive_seq")
    return changes.last_writer(rows.select("exchange_symbol", seq.alias("seq"), op.alias("op"), *fields), ["exchange_symbol"], "seq", "op", fields)


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return skew.message_blocks(_t(spark, d, "raw_events"), _t(spark, d, "message_rates"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).where("number % message_rate = 0").select(F.col("symbol").alias("exchange_symbol"), "connection_id", "receive_seq")


def p2_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Size and receive times of each block of each segment and symbol."""
    return _blocks(spark, d).groupBy("segment_id", F.col("symbol").alias("exchange_symbol"), "block").agg(F.count(F.lit(1)).alias("messages"), F.min("ns").alias("first_ns"), F.max("ns").alias("last_ns"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return rolling.surges(_t(spark, d, "daily_klines"))


def p3_trailing(spark: SparkSession, d: str) -> DataFrame:
    days = rolling.activity_days(_t(spark, d, "daily_klines"))
    totals = [F.col(f"{m}_sum_{w}").cast("decimal(36,8)" if m == "quote_volume" else "bigint").alias(f"{m}_sum_{w}") for m in ("quote_volume", "trades") for w in (7, 30)]
    means = [F.round(F.col(f"trades_avg_{w}"), 4).alias(f"trades_avg_{w}") for w in (7, 30)]
    return days.select("exchange_symbol", "open_ms", *totals, *means)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return exactly_once.removed(spark, f"{d}/typed_events.parquet")


def p4_kept(spark: SparkSession, d: str) -> DataFrame:
    """The typed events, all columns, each message once; nested columns as JSON for comparison."""
    rows = exactly_once.deduplicated(spark, f"{d}/typed_events.parquet")
    return rows.withColumn("payload_hash", F.hex("payload_hash")).withColumn("bids", F.size("bids").cast("bigint")).withColumn("asks", F.size("asks").cast("bigint"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return late.outcomes(late.trade_minutes(spark, f"{d}/typed_events.parquet"))


def p6_revisions(spark: SparkSession, d: str) -> DataFrame:
    return late.revisions(late.trade_minutes(spark, f"{d}/typed_events.parquet"))


_E8 = lambda x: f"cast(round(try_cast({x} as decimal(30,8)) * 100000000) as bigint)"

P1 = f"""
with src as (select * from l2_projection where stream_type in ('depth', 'depth_snapshot') and exchange_symbol is not null and connection_id is not null),
snap as (select exchange_symbol s, connection_id c, max(last_update_id) l from src where stream_type = 'depth_snapshot' group by all),
msg as (select exchange_symbol s, connection_id c, final_update_id u, max(first_update_id) f, max(previous_final_update_id) p from src
  where stream_type = 'depth' and final_update_id is not null and first_update_id is not null and previous_final_update_id is not null group by all),
seqd as (select msg.*, l, lag(u) over w as before, row_number() over w as n from msg join snap using (s, c) where u >= l window w as (partition by s, c order by u)),
reach as (select s, c, any_value(l) l, min(case when n > 1 and p <> before then u end) until from seqd group by s, c having max(case when n = 1 and f <= l then 1 else 0 end) = 1),
kept as (select x.*, case when stream_type = 'depth' then 2 * final_update_id + 1 else 2 * last_update_id end as o from src x join reach on s = exchange_symbol and c = connection_id
  where (stream_type = 'depth_snapshot' and last_update_id = l) or (stream_type = 'depth' and first_update_id is not null and previous_final_update_id is not null and final_update_id >= l and (until is null or final_update_id < until))),
lev as (select exchange_symbol, connection_id, 'bid' side, o, unnest(bids) v from kept union all select exchange_symbol, connection_id, 'ask', o, unnest(asks) from kept),
num as (select exchange_symbol, connection_id, side, {_E8('v.price')} price_e8, {_E8('v.quantity')} quantity_e8, o from lev)
select exchange_symbol, connection_id, side, price_e8, max_by(quantity_e8, o) quantity_e8 from num where price_e8 is not null and quantity_e8 is not null
group by exchange_symbol, connection_id, side, price_e8 having max_by(quantity_e8, o) > 0"""

_P1_FIELDS = ("mark_price", "open_interest", "bid_price", "ask_price", "contract_status")
P1C = """with f as (select *, {'t': app_receive_realtime_ns, 'c': connection_id, 'r': receive_seq} o, case contract_status when 'SETTLING' then 'delete' when 'PENDING_TRADING' then 'insert' else 'update' end op
 from typed_events where exchange_symbol is not null and stream_type in ('mark_price', 'open_interest', 'book_ticker', 'contract_info')),
b as (select exchange_symbol, max(o) filter (op = 'delete') gone, max(o) filter (op = 'insert') anew, max(o) filter (op <> 'delete') alive from f group by 1)
select exchange_symbol, """ + ", ".join(f"arg_max({c}, o) filter ({c} is not null and op <> 'delete' and (gone is null or o > gone) and (anew is null or o >= anew)) {c}" for c in _P1_FIELDS) + """
from f join b using (exchange_symbol) where gone is null or alive > gone group by 1"""

_P2 = """with sym as (select connection_id, receive_seq, segment_id, app_receive_realtime_ns ns, upper(coalesce(exchange_symbol,
  case when exchange_symbol is null and json_valid(decode(payload_bytes)) then coalesce(json_extract_string(decode(payload_bytes), '$.data.s'), json_extract_string(decode(payload_bytes), '$.data.o.s')) end)) y from raw_events),
one as (select connection_id, receive_seq, min(segment_id) segment_id, min(ns) ns, max(y) y from sym where y is not null and connection_id is not null and receive_seq is not null group by 1, 2),
num as (select one.*, message_rate, row_number() over (partition by segment_id, y order by ns, connection_id, receive_seq) n from one join message_rates r on r.exchange_symbol = y where message_rate >= 1)
"""
P2 = _P2 + "select y exchange_symbol, connection_id, receive_seq from num where n % message_rate = 0"
P2B = _P2 + "select segment_id, y exchange_symbol, (n - 1) // message_rate + 1 block, count(*) messages, min(ns) first_ns, max(ns) last_ns from num group by 1, 2, 3"

_P3 = """with one as (select exchange_symbol s, open_ms // 86400000 d, quote_volume q, trades t,
  row_number() over (partition by exchange_symbol, open_ms // 86400000 order by request_realtime_ns desc nulls last, try_cast(quote_volume as decimal(26,8)) desc nulls last, trades desc nulls last) n
  from daily_klines where exchange_symbol is not null and open_ms is not null),
span as (select s, min(d) lo, max(d) hi from one group by s),
spine as (select s, lo, unnest(range(lo, hi + 1)) d from span),
dense as (select spine.s, spine.d, spine.d - lo age, coalesce(try_cast(q as decimal(26,8)), 0) q, coalesce(t, 0) t from spine left join one on one.s = spine.s and one.d = spine.d and n = 1),
tot as (select *, sum(q) over w7 q7, sum(q) over w30 q30, sum(t) over w7 t7, sum(t) over w30 t30 from dense
  window w7 as (partition by s order by d rows 6 preceding), w30 as (partition by s order by d rows 29 preceding))
"""
P3 = _P3 + """select s exchange_symbol, d * 86400000 open_ms, 'quote_volume' metric from tot where age >= 29 and q30 > 0 and 24 * q7 >= 7 * q30
union all select s, d * 86400000, 'trades' from tot where age >= 29 and t30 > 0 and 24 * t7 >= 7 * t30"""
P3T = _P3 + """select s exchange_symbol, d * 86400000 open_ms, cast(q7 as decimal(36,8)) quote_volume_sum_7, cast(q30 as decimal(36,8)) quote_volume_sum_30, cast(t7 as bigint) trades_sum_7, cast(t30 as bigint) trades_sum_30,
 round(t7 / 7.0::double, 4) trades_avg_7, round(t30 / 30.0::double, 4) trades_avg_30 from tot"""


def _ranked(streams: str = "true") -> str:
    """SQL: typed_events with ``n``, the place of a row among those of its message, null without identity."""
    parts = [" and ".join([f"stream_type = '{s}'", *[f"{c} is not null" for c in cols]]) for s, cols in exactly_once.IDENTITY.items()]
    key = "case stream_type " + " ".join(f"when '{s}' then concat_ws('|', {', '.join('hex(payload_hash)' if c == 'payload_hash' else c for c in cols)})" for s, cols in exactly_once.IDENTITY.items()) + " end"
    return f"""with r as (select *, case when exchange_symbol is not null and ({' or '.join(f'({p})' for p in parts)}) then {key} end k from typed_events where {streams}),
x as (select *, case when k is not null then row_number() over (partition by stream_type, exchange_symbol, k order by app_receive_realtime_ns, connection_id, receive_seq) end n from r) """


P4 = _ranked() + "select connection_id, receive_seq from x where n > 1"
P4K = _ranked() + "select * exclude (k, n) replace (hex(payload_hash) as payload_hash, cast(len(bids) as bigint) as bids, cast(len(asks) as bigint) as asks) from x where n is null or n = 1"
_P6 = _ranked("stream_type = 'agg_trade'") + """, a as (select exchange_symbol, coalesce(exchange_transaction_time_ms, exchange_event_time_ms) // 60000 * 60000 minute_ms, app_receive_realtime_ns ns,
  cast(try_cast(price as decimal(18,8)) as decimal(19,8)) p, cast(try_cast(quantity as decimal(18,8)) as decimal(19,8)) q from x where (n is null or n = 1) and exchange_symbol is not null and coalesce(exchange_transaction_time_ms, exchange_event_time_ms) is not null),
s as (select *, case when ns - (minute_ms + 60000) * 1000000 < 2000000000 then 0 when ns - (minute_ms + 60000) * 1000000 < 300000000000 then 1 else 2 end st from a) """
P6 = _P6 + "select exchange_symbol, minute_ms, case st when 1 then 'corrected' else 'incomplete' end outcome from s where st > 0 group by all"
P6R = _P6 + """select exchange_symbol, minute_ms, count(*) filter (st = 0) first_trades, cast(sum(q) filter (st = 0) as decimal(28,8)) first_quantity, cast(sum(p * q) filter (st = 0) as decimal(38,16)) first_notional,
 count(*) filter (st < 2) final_trades, cast(sum(q) filter (st < 2) as decimal(28,8)) final_quantity, cast(sum(p * q) filter (st < 2) as decimal(38,16)) final_notional, min(p) filter (st < 2) final_low, max(p) filter (st < 2) final_high,
 count(*) filter (st = 1) corrections, count(*) filter (st = 2) refused_trades from s group by all"""

QUERIES = {f.__name__: f for f in (p1_found, p1_contracts, p2_found, p2_blocks, p3_found, p3_trailing, p4_found, p4_kept, p6_found, p6_revisions)}
ORACLES = {"p1_found": P1, "p1_contracts": P1C, "p2_found": P2, "p2_blocks": P2B, "p3_found": P3, "p3_trailing": P3T, "p4_found": P4, "p4_kept": P4K, "p6_found": P6, "p6_revisions": P6R}
