"""Queries of bookkeeping: days, chunks, releases, gaps, decisions, samples; and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import manifests, quality, ranking, traffic, window
from tidemark.plans.market import _DAILY, _EV, _bars, _symbols, _t, _us, query

# -- decisions, samples, statistics


@query(
    """with c as (select exchange_symbol s, exchange_event_time_ms e, receive_seq q, contract_status v from typed_events where stream_type = 'contract_info' and exchange_event_time_ms is not null and receive_seq is not null),
f as (select exchange_symbol s, connection_id k, receive_seq r, exchange_event_time_ms t from typed_events where stream_type = 'force_order')
select s exchange_symbol, k connection_id, r receive_seq, t, (select arg_max(v, {'q': q, 'e': e, 'v': v}) from c where c.s = f.s and c.e <= f.t) contract_status from f where s is not null"""
)
def active_decisions(spark, d):
    """The contract status in force at each forced order: effective, and the last by number."""
    t = _t(spark, d, "typed_events").where("exchange_symbol is not null")
    points = t.where("stream_type = 'force_order'").select("exchange_symbol", "connection_id", "receive_seq", F.col("exchange_event_time_ms").alias("t"))
    found = t.where("stream_type = 'contract_info'").select("exchange_symbol", F.col("exchange_event_time_ms").alias("e"), F.col("receive_seq").alias("q"), "contract_status")
    return window.as_of_sequence(points, found, ["exchange_symbol"], "t", "e", "q", ["contract_status"])


_BAND_OF = lambda b: f"least(coalesce(sum(p::decimal(19,8) * q::decimal(19,8)) filter (side = 'bid' and p::decimal(28,8) * 20000 >= (b + a)::decimal(28,8) * {10000 - b}), 0), coalesce(sum(p::decimal(19,8) * q::decimal(19,8)) filter (side = 'ask' and p::decimal(28,8) * 20000 <= (b + a)::decimal(28,8) * {10000 + b}), 0))"


@query(
    f"""with l as (select exchange_symbol s, connection_id c, receive_seq r, 'bid' side, unnest(bids) x from typed_events where stream_type = 'depth_snapshot' and exchange_symbol is not null union all select exchange_symbol, connection_id, receive_seq, 'ask', unnest(asks) from typed_events where stream_type = 'depth_snapshot' and exchange_symbol is not null),
n as (select s, c, r, side, cast(x.price as decimal(18,8)) p, cast(x.quantity as decimal(18,8)) q from l), b as (select s, c, r, max(p) filter (side = 'bid') b, min(p) filter (side = 'ask') a from n group by all having max(p) filter (side = 'bid') is not null and min(p) filter (side = 'ask') is not null),
e as (select n.s, n.c, n.r, {_BAND_OF(10)} d10, {_BAND_OF(50)} d50 from n join b on n.s = b.s and n.c = b.c and n.r = b.r group by n.s, n.c, n.r)
select s exchange_symbol, count(*) samples, cast(min(d10) as decimal(30,8)) thin_depth_10bps, cast(min(d50) as decimal(30,8)) thin_depth_50bps from e group by 1"""
)
def thin_depths(spark, d):
    t = _t(spark, d, "typed_events").where("stream_type = 'depth_snapshot' and exchange_symbol is not null")
    key = ["exchange_symbol", "connection_id", "receive_seq"]
    side = lambda s, c: t.select(*key, F.lit(s).alias("side"), F.explode(c).alias("x"))
    levels = side("bid", "bids").unionByName(side("ask", "asks")).select(*key, "side", F.col("x.price").cast("decimal(18,8)").alias("price"), F.col("x.quantity").cast("decimal(18,8)").alias("quantity"))
    out = ranking.thin_depth(levels, key[:1], key[1:])
    return out.select("exchange_symbol", "samples", *[F.col(f"thin_depth_{b}bps").cast("decimal(30,8)").alias(f"thin_depth_{b}bps") for b in (10, 50)])


_MEDIAN = lambda c, q="0.5": f"quantile_cont({c}::double, {q})"


@query(
    f"""with {_DAILY}, d as (select *, d // 7 b from k), tot as (select b, d, sum(v) v, sum(t) t from d group by 1, 2), m as (select b, {_MEDIAN('v')} mv, {_MEDIAN('t')} mt from tot group by 1),
o as (select b, s, {_MEDIAN('v')} v, {_MEDIAN('t')} t from d group by 1, 2), n as (select b, count(distinct s) n from d group by 1),
p as (select b, {', '.join(f"{_MEDIAN(c, q)} {c}{i}" for c in 'vt' for i, q in ((25, 0.25), (50, 0.5), (75, 0.75)))} from o group by 1),
u as (select o.b, count(*) filter (o.v > w.v) / nullif(count(o.v) filter (w.v is not null), 0) uv, count(*) filter (o.t > w.t) / nullif(count(o.t) filter (w.t is not null), 0) ut from o join o w on w.s = o.s and w.b = o.b - 1 group by 1)
select n.b block, n symbols, round(mv, 6) market_volume, round(v25, 6) p25_volume, round(v50, 6) p50_volume, round(v75, 6) p75_volume, round(uv, 6) up_volume, round(mt, 6) market_trades, round(t25, 6) p25_trades, round(t50, 6) p50_trades, round(t75, 6) p75_trades, round(ut, 6) up_trades
from n left join m on m.b = n.b left join p on p.b = n.b left join u on u.b = n.b"""
)
def block_statistics(spark, d):
    """Weeks of the daily bars: the market's median day, quartiles of the symbols' medians, breadth against the week before."""
    out = ranking.block_statistics(_bars(spark, d).select(F.col("exchange_symbol").alias("symbol"), "day", F.col("v").alias("volume"), F.col("t").alias("trades")), 7)
    exact = [c for c in out.columns if c not in ("block", "symbols") and not c.startswith("up_")]
    return out.select("block", "symbols", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in exact], *[F.round(c, 6).alias(c) for c in out.columns if c.startswith("up_")])


# -- days and chunks: orders stand for chunks, lineitem for references to them


@query("with h as (select distinct exchange_symbol s, open_ms // 86400000 d from daily_klines where open_ms is not null), m as (select max(d) hi from h), g as (select s, unnest(range(hi - 29, hi + 1)) as day from (select distinct s from h where s is not null), m) select s exchange_symbol, day from g where not exists (select 1 from h where h.s = g.s and h.d = g.day)")
def missing_days(spark, d):
    """What a fetch of the last thirty days still has to get."""
    have = _t(spark, d, "daily_klines").where("open_ms is not null").select("exchange_symbol", F.expr("open_ms div 86400000").alias("day"))
    last = have.agg(F.max("day")).first()[0]
    return manifests.missing_days(have, have, (last or 0) - 29, last if last is not None else -30)


@query("select o_orderkey chunk_id, o_orderstatus sha256 from orders where (o_orderkey, o_orderstatus) not in (select l_orderkey, l_linestatus from lineitem)")
def chunks_not_durable(spark, d):
    offered = _t(spark, d, "orders").select(F.col("o_orderkey").alias("chunk_id"), F.col("o_orderstatus").alias("sha256"))
    return manifests.not_durable(offered, _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("chunk_id"), F.col("l_linestatus").alias("sha256")))


@query("select l_linenumber release_id, l_returnflag collector_id, cast(l_shipdate as date)::varchar utc_date, min(l_linestatus) sealed_sha256, count(distinct l_linestatus) > 1 conflict from lineitem group by 1, 2, 3")
def release_pins(spark, d):
    return manifests.pins(_t(spark, d, "lineitem").select(F.col("l_linenumber").alias("release_id"), F.col("l_returnflag").alias("collector_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("utc_date"), F.col("l_linestatus").alias("sealed_sha256")))


@query(
    """with o as (select cast(o_orderdate as date)::varchar utc_date, o_orderstatus st, o_orderpriority s from orders), d as (select distinct utc_date from o),
a as (select utc_date, count(*) n from o where st = 'O' group by 1), b as (select utc_date, count(distinct s) n from o where st = 'F' group by 1)
select d.utc_date, coalesce(a.n, 0) sealed, coalesce(b.n, 0) books, case when coalesce(a.n, 0) < 1 then 'missing' when coalesce(b.n, 0) < 3 then 'sealed' else 'books' end state from d left join a on a.utc_date = d.utc_date left join b on b.utc_date = d.utc_date"""
)
def day_progress(spark, d):
    """How far each day of orders is: one order that is open seals it, three priorities that are filled complete its books."""
    o = _t(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("utc_date"), "o_orderstatus", F.col("o_orderpriority").alias("exchange_symbol"))
    return manifests.progress(o, {"sealed": o.where("o_orderstatus = 'O'").select("utc_date"), "books": o.where("o_orderstatus = 'F'").select("utc_date", "exchange_symbol")}, 3)


@query("select l_orderkey chunk_id, l_linestatus sha256, count(distinct (l_returnflag, l_suppkey)) versions from lineitem group by 1, 2 having count(distinct (l_returnflag, l_suppkey)) > 1")
def index_conflicts(spark, d):
    return manifests.index_conflicts(_t(spark, d, "lineitem").select(F.col("l_orderkey").alias("chunk_id"), F.col("l_linestatus").alias("sha256"), "l_returnflag", "l_suppkey"), ["chunk_id", "sha256"])


@query(
    """with m as (select o_orderkey k, case when o_orderstatus = 'P' then 'c' || o_orderkey else 'chunk-' || (10000000 + o_orderkey) end chunk_id, sha256(o_orderkey::varchar) h, case when o_custkey % 5 = 0 then '../x' else 'date=1/a' end p, o_custkey - 10 n, o_orderkey a, o_orderkey - o_custkey % 3 + 1 b from orders),
r as (select k, unnest([case when not length(chunk_id) between 8 and 160 then 'chunk_id' end, case when p like '../%' then 'data_path' end, case when not n > 0 then 'size_bytes' end, case when not n > 0 then 'event_count' end, case when not b >= a then 'range' end]) as rule from m)
select rule, count(*) broken from r where rule is not null group by 1"""
)
def manifest_rule_violations(spark, d):
    o = _t(spark, d, "orders")
    key, n = F.col("o_orderkey"), F.col("o_custkey") - 10
    h = F.sha2(key.cast("string"), 256)
    m = o.select(
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("c"), key)).otherwise(F.concat(F.lit("chunk-"), key + 10_000_000)).alias("chunk_id"), h.alias("sha256"), F.when(F.expr("o_custkey % 5 = 0"), "../x").otherwise("date=1/a").alias("data_path"),
        n.alias("size_bytes"), n.alias("event_count"), key.alias("min_app_receive_realtime_ns"), (key - F.expr("o_custkey % 3") + 1).alias("max_app_receive_realtime_ns"), h.alias("data_contract_hash"), h.alias("universe_hash"),
    )
    return manifests.manifest_violations(m).groupBy("rule").agg(F.count(F.lit(1)).alias("broken"))


# -- gaps: errors of a user open one, signups close it

_GAP_NS = f"(select 'gap-user-' || user_id g, case event_type when 'error' then 'OPEN' else 'CLOSED' end st, t * 1000 ns, event_id from {_EV} where event_type in ('error', 'signup'))"


def _gap_facts(spark, d) -> DataFrame:
    ev = _us(spark, d).where(F.col("event_type").isin("error", "signup"))
    state = F.when(F.col("event_type") == "error", "OPEN").otherwise("CLOSED")
    return ev.select(F.concat(F.lit("gap-user-"), "user_id").alias("gap_id"), state.alias("state"), F.lit("CONNECTION_LOST_GAP").alias("reason"), (F.col("t") * 1000).alias("observed_at_realtime_ns"), F.lit(None).cast("bigint").alias("affected_from_realtime_ns"), F.col("event_id"))


@query(f"select g gap_id, st state, ns observed_at_realtime_ns from (select *, row_number() over (partition by g order by ns desc, st desc) n from {_GAP_NS}) where n = 1 and st = 'OPEN'")
def gaps_still_open(spark, d):
    return quality.open_gaps(_gap_facts(spark, d)).select("gap_id", "state", "observed_at_realtime_ns")


@query(
    f"""with f as (select *, case when event_id % 3 = 0 then ns - 5 when event_id % 3 = 1 then ns + 5 end since from {_GAP_NS}), r as (select unnest([case when since > ns then 'affected_after_observed' end, case when st = 'CLOSED' and since is not null then 'closing_with_start' end, case when event_id % 7 = 0 then 'reason' end]) as rule from f)
select rule, count(*) broken from r where rule is not null group by 1"""
)
def gap_rule_violations(spark, d):
    f = _gap_facts(spark, d)
    seen = F.col("observed_at_realtime_ns")
    f = f.withColumn("affected_from_realtime_ns", F.expr("case event_id % 3 when 0 then observed_at_realtime_ns - 5 when 1 then observed_at_realtime_ns + 5 end")).withColumn("reason", F.when(F.expr("event_id % 7 = 0"), "NONE").otherwise(F.col("reason"))).where(seen.isNotNull())
    return quality.gap_violations(f).groupBy("rule").agg(F.count(F.lit(1)).alias("broken"))


@query(
    f"""with f as (select *, '{{"affected_from_realtime_ns":null,"gap_id":"' || g || '","observed_at_realtime_ns":' || ns || ',"reason":"CONNECTION_LOST_GAP","state":"' || st || '"}}' || chr(10) content from {_GAP_NS})
select g || '-' || ns || '-' || lower(st) chunk_id, 'date=' || strftime(make_timestamp(ns // 1000), '%Y-%m-%d') || '/writer=control/' || g || '-' || ns || '-' || lower(st) || '.gap.json' data_path, sha256(content) sha256, cast(strlen(content) as bigint) size_bytes, ns min_app_receive_realtime_ns from f"""
)
def gap_artifacts(spark, d):
    a = manifests.gap_artifacts(_gap_facts(spark, d).drop("event_id"), "c")
    return a.select("chunk_id", "data_path", "sha256", "size_bytes", "min_app_receive_realtime_ns")


@query("with l as (select connection_id, exchange_symbol, max(app_receive_realtime_ns) t from typed_events where app_receive_realtime_ns is not null group by 1, 2) select connection_id, min(t) affected_from_ns, count(*) as keys from l group by 1")
def route_gap_starts(spark, d):
    return quality.route_gap_starts(_t(spark, d, "typed_events"), "connection_id", ["exchange_symbol"], "app_receive_realtime_ns")


@query(
    """with m as (select distinct exchange_symbol s, app_receive_realtime_ns // 60000000000 m from typed_events where stream_type = 'book_ticker' and exchange_symbol is not null), r as (select min(m) a, max(m) b from m), c as (select unnest(range(a, b + 1)) m from r), k as (select count(distinct s) k from m),
g as (select c.m, c.m // 1440 utc_day, (select count(*) from m where m.m = c.m) >= (select least(25, k) from k) good from c), i as (select *, m - row_number() over (partition by utc_day, good order by m) run from g), n as (select utc_day, good, run, count(*) len from i group by all),
o as (select utc_day, coalesce(sum(len) filter (good), 0) / sum(len) share, coalesce(max(len) filter (not good), 0) longest_bad from n group by 1)
select utc_day, round(share, 9) share, longest_bad, case when longest_bad > 3 then 'none' when share >= 0.999 then '99.9' when share >= 0.998 then '99.8' when share >= 0.995 then '99.5' when share >= 0.99 then '99.0' else 'none' end tier from o"""
)
def minute_tiers(spark, d):
    """Minutes in which at least 25 symbols have a book ticker, every minute from the first to the last."""
    has = _t(spark, d, "typed_events").where("stream_type = 'book_ticker' and exchange_symbol is not null").select("exchange_symbol", F.expr(f"app_receive_realtime_ns div {traffic.MINUTE_NS}").alias("minute")).distinct().withColumn("ok", F.lit(True))
    every = has.agg(F.min("minute").alias("a"), F.max("minute").alias("b")).select(F.explode(F.expr("sequence(a, b)")).alias("minute"), F.lit(None).cast("string").alias("exchange_symbol"), F.lit(False).alias("ok"))
    symbols = has.select("exchange_symbol").distinct().count()
    return quality.minute_tiers(has.unionByName(every), symbols, 25).select("utc_day", F.round("share", 9).alias("share"), "longest_bad", "tier")


# -- identities, times, lists


@query(
    """select connection_id, receive_seq, sha256(case stream_type when 'agg_trade' then '["agg_trade","' || exchange_symbol || '","' || aggregate_trade_id || '"]' when 'trade' then '["trade","' || exchange_symbol || '","' || trade_id || '"]' else '["mark_price","' || exchange_symbol || '","' || exchange_event_time_ms || '",{"bytes":"' || lower(hex(payload_hash)) || '"}]' end) identity
from typed_events where exchange_symbol is not null and ((stream_type = 'agg_trade' and aggregate_trade_id is not null) or (stream_type = 'trade' and trade_id is not null) or (stream_type = 'mark_price' and exchange_event_time_ms is not null and payload_hash is not null))"""
)
def identity_keys(spark, d):
    t = _t(spark, d, "typed_events").where("exchange_symbol is not null")
    s = lambda c: F.col(c).cast("string")
    keys = {"agg_trade": ["aggregate_trade_id"], "trade": ["trade_id"], "mark_price": ["exchange_event_time_ms", "payload_hash"]}
    key, has = F.lit(None), F.lit(False)
    for stream, cols in keys.items():
        mine = (F.col("stream_type") == stream) & F.greatest(*[F.col(c).isNull() for c in cols], F.lit(False)).eqNullSafe(False)
        key, has = F.when(mine, text.identity_key(s("stream_type"), s("exchange_symbol"), *[text.bytes_part(c) if c == "payload_hash" else s(c) for c in cols])).otherwise(key), has | mine
    return t.where(has).select("connection_id", "receive_seq", key.alias("identity"))


@query("select connection_id, receive_seq, 'RECEIVED' event, connection_id || '-' || receive_seq event_id, strftime(make_timestamp(app_receive_realtime_ns // 1000000 * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') occurred_at from raw_events")
def transfer_events(spark, d):
    r = _t(spark, d, "raw_events")
    return r.select("connection_id", "receive_seq", F.lit("RECEIVED").alias("event"), F.concat_ws("-", "connection_id", F.col("receive_seq").cast("string")).alias("event_id"), text.utc_text("app_receive_realtime_ns").alias("occurred_at"))


@query(
    """with a as (select distinct upper(exchange_symbol) s from raw_events where exchange_symbol is not null), b as (select distinct upper(exchange_symbol) s from message_rates where exchange_symbol is not null)
select *, only_left = 0 and only_right = 0 same from (select (select count(*) from a where s not in (select s from b)) only_left, (select count(*) from b where s not in (select s from a)) only_right)"""
)
def member_equality(spark, d):
    return manifests.same_members(_symbols(spark, d, "raw_events"), _symbols(spark, d, "message_rates"), "exchange_symbol")


@query("select exchange_symbol, connection_id, receive_seq, (onboard_date_ms + 86399999) // 86400000 * 86400000 first_bar_ms, (exchange_event_time_ms - onboard_date_ms) // 86400000 age_days from typed_events where stream_type = 'contract_info' and onboard_date_ms is not null and exchange_event_time_ms >= onboard_date_ms")
def bar_ages(spark, d):
    """The first whole day of each contract and its age in days when it was told of."""
    t = _t(spark, d, "typed_events").where("stream_type = 'contract_info' and onboard_date_ms is not null and exchange_event_time_ms >= onboard_date_ms")
    return t.select("exchange_symbol", "connection_id", "receive_seq", F.expr("(onboard_date_ms + 86399999) div 86400000 * 86400000").alias("first_bar_ms"), F.expr("(exchange_event_time_ms - onboard_date_ms) div 86400000").alias("age_days"))


_CONTRACT = lambda on, streams: '{"d0_enabled":' + on + ',"depth_interval_ms":100,"depth_snapshot_limit":1000,"exchange":"binance_usdm","gap_schema":2,"mark_price_interval_ms":1000,"open_interest_interval_seconds":30,"raw_schema":1,"streams":["agg_trade","book_ticker","clock_sample","contract_info","daily_klines","depth","depth_snapshot","exchange_info","force_order","formal_collection_started","liquidity_depth","mark_price","market_tickers","open_interest",' + streams + '"universe_decision"]}'


@query(f"""select k d0, sha256(v || chr(10)) contract_hash from (values (false, '{_CONTRACT("false", "")}'), (true, '{_CONTRACT("true", '"rpi_depth","rpi_depth_snapshot","trade",')}')) t(k, v)""")
def contract_hashes(spark, d):
    return spark.createDataFrame([(x, text.contract_hash(x)) for x in (False, True)], "d0 boolean, contract_hash string")


# -- plans of some dozen items, made on the driver


@query()
def lane_balance(spark, d):
    """Symbols over three lanes by the rows they have."""
    sizes = [(r[0], r[1]) for r in _t(spark, d, "l2_projection").where("exchange_symbol is not null").groupBy("exchange_symbol").count().collect()]
    return spark.createDataFrame([(s, n) for n, lane in enumerate(traffic.lanes(sizes, 3)) for s in lane], "exchange_symbol string, lane int")


@query()
def swap_balance(spark, d):
    """Symbols that are dealt out by name, after the one swap that helps most."""
    rates = {r[0]: r[1] for r in _t(spark, d, "message_rates").where("message_rate is not null").collect()}
    names = sorted(rates)
    dealt = [names[i::4] for i in range(min(4, len(names)))]
    return spark.createDataFrame([(s, n) for n, shard in enumerate(traffic.rebalance(names, rates, dealt, 4)) for s in shard], "exchange_symbol string, shard int")
