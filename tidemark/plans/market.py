"""Queries of the engine's own operators over the test tables, and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import spread
from tidemark.operators import asof, book, exactly_once, intervals, manifests, parse, quality, ranking, skew, sliding, traffic

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# -- parsing, routing, constraints

_TXT = "decode(payload_bytes)"
_OK = f"json_valid({_TXT})"
_DATA = f"case when {_OK} then coalesce(json_extract({_TXT}, '$.data'), json({_TXT})) end"


_SORTED = lambda x, inner="": f"""'{{' || array_to_string(list_transform(list_sort(json_keys({x})), lambda k: '"' || k || '":' || {inner or f"cast(json_extract({x}, '$.' || k) as varchar)"}), ',') || '}}'"""
_OF = lambda streams, path, kind="text": f"case when stream_type in ({streams}) then " + {"text": f"d->>'{path}'", "int": f"try_cast(d->>'{path}' as bigint)"}[kind] + " end"
_LEVEL_TEXT = lambda path: f"case when stream_type = 'depth' then array_to_string(list_transform(cast(d->'{path}' as json[]), lambda x: (x->>'$[0]') || '@' || (x->>'$[1]')), ';') end"
# a number with more than six zeros behind its point is written with an exponent
_CANON = lambda x: f"case when regexp_full_match({x}, '-?0[.]0{{6,}}[1-9][0-9]*') then regexp_replace(regexp_replace({x}, '0[.]0*([1-9])([0-9]+)$', '\\1.\\2'), '0[.]0*([1-9])$', '\\1') || 'E-' || (length(regexp_extract({x}, '[.](0*)', 1)) + 1) else {x} end"
_EVENTS = "'depth', 'book_ticker', 'agg_trade', 'trade'"


@query(
    f"""with r as (select *, {_DATA} d from raw_events where case when {_OK} then true else false end),
v as (select *, coalesce(d->>'$.s', d->'$.o'->>'$.s') y, d->'$.o' o from r)
select cast(1 as smallint) schema_version, upper(coalesce(nullif(exchange_symbol, ''), y)) exchange_symbol, stream_type, connection_id, receive_seq, app_receive_realtime_ns, app_receive_monotonic_ns, request_realtime_ns,
 try_cast(case when stream_type = 'clock_sample' then d->>'$.serverTime' else d->>'$.E' end as bigint) exchange_event_time_ms,
 try_cast(case when stream_type = 'force_order' then d->>'$.o.T' when stream_type in ({_EVENTS}) then d->>'$.T' end as bigint) exchange_transaction_time_ms,
 sha256({_SORTED('d', f"case when k = 'o' and stream_type = 'force_order' then {_SORTED('o').replace('lambda k:', 'lambda j:').replace(' k ', ' j ').replace('|| k)', '|| j)')} else cast(json_extract(d, '$.' || k) as varchar) end")}) payload_hash, false is_duplicate,
 {_OF("'book_ticker'", '$.u', 'int')} update_id, {_OF("'depth'", '$.U', 'int')} first_update_id, {_OF("'depth'", '$.u', 'int')} final_update_id, {_OF("'depth'", '$.pu', 'int')} previous_final_update_id, cast(null as bigint) last_update_id,
 {_OF("'trade'", '$.t', 'int')} trade_id, {_OF("'agg_trade'", '$.a', 'int')} aggregate_trade_id, {_OF("'agg_trade'", '$.f', 'int')} first_trade_id, {_OF("'agg_trade'", '$.l', 'int')} last_trade_id,
 case when stream_type = 'force_order' then d->>'$.o.p' when stream_type in ('agg_trade', 'trade') then d->>'$.p' end price, case when stream_type = 'force_order' then d->>'$.o.q' when stream_type in ('agg_trade', 'trade') then d->>'$.q' end quantity,
 {_OF("'agg_trade'", '$.nq')} non_rpi_quantity, case when stream_type in ('agg_trade', 'trade') then (d->>'$.m') = 'true' end buyer_is_maker,
 {_OF("'book_ticker'", '$.b')} bid_price, {_OF("'book_ticker'", '$.B')} bid_quantity, {_OF("'book_ticker'", '$.a')} ask_price, {_OF("'book_ticker'", '$.A')} ask_quantity,
 {_OF("'mark_price'", '$.p')} mark_price, {_OF("'mark_price'", '$.i')} index_price, {_OF("'mark_price'", '$.P')} estimated_settle_price, case when stream_type = 'mark_price' then {_CANON("(d->>'$.r')")} end funding_rate, {_OF("'mark_price'", '$.T', 'int')} next_funding_time_ms,
 {_OF("'open_interest'", '$.openInterest')} open_interest, {_OF("'force_order'", '$.o.S')} side, {_OF("'force_order'", '$.o.o')} order_type, {_OF("'force_order'", '$.o.f')} time_in_force, {_OF("'force_order'", '$.o.X')} order_status,
 {_OF("'force_order'", '$.o.ap')} average_price, {_OF("'force_order'", '$.o.l')} last_filled_quantity, {_OF("'force_order'", '$.o.z')} accumulated_filled_quantity,
 {_OF("'contract_info'", '$.ct')} contract_type, {_OF("'contract_info'", '$.dt', 'int')} delivery_date_ms, {_OF("'contract_info'", '$.ot', 'int')} onboard_date_ms, {_OF("'contract_info'", '$.cs')} contract_status,
 {_LEVEL_TEXT('$.b')} bids, {_LEVEL_TEXT('$.a')} asks from v"""
)
def typed_projection(spark, d):
    """Raw messages parsed into the typed table, every column; hash and levels as text."""
    t = parse.parsed(spread(_t(spark, d, "raw_events"))).where("error is null").drop("error")
    levels = {c: F.concat_ws(";", F.transform(c, lambda x: F.concat_ws("@", x["price"], x["quantity"]))) for c in ("bids", "asks")}
    return t.withColumns({"payload_hash": F.lower(F.hex("payload_hash")), **{c: F.when(F.col(c).isNotNull(), x) for c, x in levels.items()}})


@query(f"select stream_type, 'no JSON' error, count(*) messages from raw_events where not coalesce({_OK}, false) group by 1")
def parse_errors(spark, d):
    return parse.parsed(_t(spark, d, "raw_events")).where("error is not null").groupBy("stream_type", "error").agg(F.count(F.lit(1)).alias("messages"))


@query(
    """select 'exchange_symbol' as rule, stream_type, count(*) broken from raw_events where exchange_symbol is not null and not (regexp_full_match(exchange_symbol, '[\\p{L}\\p{N}]{1,30}') and upper(exchange_symbol) = exchange_symbol) group by 2
union all select 'request', stream_type, count(*) from raw_events where (request_id is null) <> (request_realtime_ns is null) group by 2
union all select 'receive_seq', stream_type, count(*) from raw_events where coalesce(receive_seq, 0) < 1 group by 2"""
)
def constraint_violations(spark, d):
    return parse.violations(_t(spark, d, "raw_events")).groupBy("rule", "stream_type").agg(F.count(F.lit(1)).alias("broken"))


@query("select case when stream_type in ('depth', 'rpi_depth', 'depth_snapshot', 'rpi_depth_snapshot') then 'depth' when stream_type in ('agg_trade', 'trade', 'book_ticker', 'mark_price', 'force_order') then 'trades_market' else 'metadata' end writer_group, count(*) n from typed_events group by 1")
def stream_routing(spark, d):
    return _t(spark, d, "typed_events").groupBy(parse.writer_group("stream_type").alias("writer_group")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""select case when not coalesce({_OK}, false) then 'invalid' when stream_type in ('clock_sample') then 'unknown' else stream_type end frame, count(*) n from raw_events group by 1"""
)
def frame_classes(spark, d):
    text = F.col("payload_bytes").cast("string")
    return _t(spark, d, "raw_events").groupBy(parse.classify_frame(text).alias("frame")).agg(F.count(F.lit(1)).alias("n"))


# -- duplicates in a sliding window

_KEY = ["__is", "__iy", "__i0", "__i1", "__i2", "__ih"]
_ORDER = ["app_receive_realtime_ns", "connection_id", "receive_seq"]
_HOUR = 3_600 * 10**9


def _identified(spark, d) -> DataFrame:
    key, has = exactly_once.identity()
    t = _t(spark, d, "typed_events").withColumns({k: F.when(has, c) for k, c in key.items()})
    return t.withColumn("__chunk", F.expr(f"app_receive_realtime_ns div {_HOUR}"))


def _seen_sql(extra: str = "") -> str:
    from tidemark.plans.feeds import _ranked

    return (
        _ranked()
        + f""", o as (select *, max(app_receive_realtime_ns) over (order by app_receive_realtime_ns, connection_id, receive_seq rows unbounded preceding) wm,
 lag(app_receive_realtime_ns) over w as before, lag(payload_hash) over w as hash_before from x where k is not null window w as (partition by stream_type, exchange_symbol, k order by app_receive_realtime_ns, connection_id, receive_seq)) {extra}"""
    )


@query(_seen_sql() + "select connection_id, receive_seq, coalesce(before >= wm - 600000000000, false) is_duplicate from o union all select connection_id, receive_seq, false from x where k is null")
def sliding_dedup(spark, d):
    t = _identified(spark, d).select("connection_id", "receive_seq", "app_receive_realtime_ns", "__chunk", *_KEY)
    return sliding.flag(t, _KEY, "app_receive_realtime_ns", _ORDER, "__chunk").select("connection_id", "receive_seq", "is_duplicate")


@query(_seen_sql() + "select stream_type, count(*) conflicts from o where before >= wm - 600000000000 and hash_before <> payload_hash group by 1")
def dedup_conflicts(spark, d):
    t = _identified(spark, d).select("stream_type", "payload_hash", *_ORDER, "__chunk", *_KEY)
    return sliding.flag(t, _KEY, "app_receive_realtime_ns", _ORDER, "__chunk", content="payload_hash").where("in_conflict").groupBy("stream_type").agg(F.count(F.lit(1)).alias("conflicts"))


_DAY_TIME = 86_400 * 10**9
# every midnight after the first day; within one day the second in which the middle row was received
_CUTS = f"""sec as (select app_receive_realtime_ns // 1000000000 s, count(*) c from typed_events group by 1), mid as (select min(s) * 1000000000 cut from (select s, 2 * sum(c) over (order by s) >= sum(c) over () half from sec) where half),
days as (select min(app_receive_realtime_ns) // {_DAY_TIME} a, max(app_receive_realtime_ns) // {_DAY_TIME} b from typed_events),
cuts as (select unnest(range(a + 1, b + 1)) * {_DAY_TIME} cut from days where a < b union all select cut from mid, days where a = b)"""


def _parts(spark, d) -> tuple[DataFrame, object]:
    """Typed events with the number of their part, and when a part ends."""
    t = _identified(spark, d)
    lo, hi = t.agg(*[F.expr(f"{f}(app_receive_realtime_ns) div {_DAY_TIME}") for f in ("min", "max")]).first()
    if lo != hi:
        return t.withColumn("__part", F.expr(f"app_receive_realtime_ns div {_DAY_TIME}")), (F.col("__part") + 1) * _DAY_TIME
    # 86,400 seconds at most
    seconds = t.groupBy(F.expr("app_receive_realtime_ns div 1000000000").alias("s")).agg(F.count(F.lit(1)).alias("c"))
    half = F.sum("c").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)) * 2 >= F.sum("c").over(Window.partitionBy())
    cut = (seconds.withColumn("half", half).where("half").agg(F.min("s")).first()[0] or 0) * 10**9
    return t.withColumn("__part", (F.col("app_receive_realtime_ns") >= cut).cast("bigint")), F.when(F.col("__part") == 0, cut)


def _carries(t: DataFrame, end) -> DataFrame:
    """What each part hands to the next, under the next one's number; a part is longer than the window."""
    last = t.agg(F.max("__part").alias("__last"))
    carry = sliding.carried(t, _KEY, "app_receive_realtime_ns", _ORDER, end, parts=["__part"])
    return carry.join(F.broadcast(last), F.col("__part") < F.col("__last")).withColumn("__part", F.col("__part") + 1).drop("__last")


@query(_seen_sql(f", {_CUTS}, l as (select cut, stream_type, exchange_symbol, k, max(app_receive_realtime_ns) last from x join cuts on app_receive_realtime_ns < cut and app_receive_realtime_ns >= cut - 600000000000 where k is not null group by all)") + " select cut, stream_type, count(*) carried from l group by 1, 2")
def dedup_carry_checkpoint(spark, d):
    """Identities carried over each midnight (or the middle of a single day) by stream."""
    t, end = _parts(spark, d)
    carry = sliding.carried(t, _KEY, "app_receive_realtime_ns", _ORDER, end, parts=["__part"]).withColumn("cut", end)
    last = t.agg(F.max("__part").alias("__last"))
    return carry.join(F.broadcast(last), F.col("__part") < F.col("__last")).groupBy("cut", F.col("__is").alias("stream_type")).agg(F.count(F.lit(1)).alias("carried"))


@query(_seen_sql() + "select connection_id, receive_seq, coalesce(before >= wm - 600000000000, false) is_duplicate from o union all select connection_id, receive_seq, false from x where k is null")
def dedup_over_midnight(spark, d):
    """All rows, each day (or half of a single day) flagged with only the carried state of the one before."""
    t, end = _parts(spark, d)
    t = t.select("connection_id", "receive_seq", "app_receive_realtime_ns", "__chunk", "__part", *_KEY)
    return sliding.flag(t, _KEY, "app_receive_realtime_ns", _ORDER, "__chunk", carry=_carries(t, end), parts=["__part"]).select("connection_id", "receive_seq", "is_duplicate")


# -- intervals, coverage, clock, audit: gaps are made of the events table (error opens, signup closes)

_US = "epoch_us(ts)"
_EV = f"(select user_id, event_id, event_type, {_US} t from events)"
_FACTS = f"""f as (select user_id, t, case event_type when 'error' then 'OPEN' else 'CLOSED' end st from {_EV} where event_type in ('error', 'signup')),
lim as (select max(t) + 1 hi, min(t) lo from {_EV}),
s as (select *, lag(st) over w was, lag(t) over w pt, lead(st) over w nx from f window w as (partition by user_id order by t, st)),
g as (select user_id, pt lo, t hi from s where st = 'CLOSED' and was = 'OPEN' and pt < t union all select user_id, t, hi from s, lim where st = 'OPEN' and nx is null and t < hi)"""
_UNION = """u0 as (select *, max(hi) over (partition by user_id order by lo, hi rows between unbounded preceding and 1 preceding) r from {0}),
u1 as (select *, sum(case when r is null or lo > r then 1 else 0 end) over (partition by user_id order by lo, hi rows unbounded preceding) i from u0),
{1} as (select user_id, min(lo) lo, max(hi) hi from u1 group by user_id, i)"""


def _us(spark, d) -> DataFrame:
    return _t(spark, d, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))


def _gaps(spark, d) -> DataFrame:
    ev = _us(spark, d)
    end = (ev.agg(F.max("t")).first()[0] or 0) + 1
    facts = ev.where(F.col("event_type").isin("error", "signup")).select("user_id", "t", F.when(F.col("event_type") == "error", "OPEN").otherwise("CLOSED").alias("st"))
    return intervals.pair(facts, ["user_id"], "t", "st", end)


def _spans(spark, d, kind: str) -> DataFrame:
    """An hour from each event of a kind."""
    return _us(spark, d).where(F.col("event_type") == kind).select("user_id", F.col("t").alias("lo"), (F.col("t") + 3_600_000_000).alias("hi"))


@query(f"with {_FACTS} select user_id, lo, hi from g")
def gap_pairing(spark, d):
    return _gaps(spark, d)


@query(f"with v as (select user_id, t lo, t + 3600000000 hi from {_EV} where event_type = 'view'), {_UNION.format('v', 'u')} select user_id, count(*) islands, cast(sum(hi - lo) as bigint) total_us from u group by 1")
def interval_union(spark, d):
    return intervals.merge(_spans(spark, d, "view"), ["user_id"]).groupBy("user_id").agg(F.count(F.lit(1)).alias("islands"), F.sum(F.col("hi") - F.col("lo")).alias("total_us"))


@query(
    f"""with {_FACTS}, v as (select user_id, t lo, t + 3600000000 hi from {_EV} where event_type = 'view'), p as (select v.user_id, greatest(v.lo, g.lo) lo, least(v.hi, g.hi) hi from v join g on v.user_id = g.user_id and v.lo < g.hi and g.lo < v.hi),
{_UNION.format('p', 'u')} select user_id, cast(sum(hi - lo) as bigint) both_us from u group by 1"""
)
def interval_intersection(spark, d):
    return intervals.length(intervals.intersect(_spans(spark, d, "view"), _gaps(spark, d), ["user_id"]), ["user_id"], "both_us")


_EXT = """v as (select user_id, t lo, t + 3600000000 hi from {0} where event_type = 'view'), {1},
e as (select g.user_id, g.lo, case when exists (select 1 from u where u.user_id = g.user_id and u.lo <= g.hi and g.hi < u.hi) then g.hi else coalesce((select min(u.lo) from u where u.user_id = g.user_id and u.lo >= g.hi), (select hi from lim)) end hi from g)"""


@query(f"with {_FACTS}, {_EXT.format(_EV, _UNION.format('v', 'u'))} select user_id, lo, hi from e")
def forward_asof_extension(spark, d):
    end = (_us(spark, d).agg(F.max("t")).first()[0] or 0) + 1
    return intervals.extend(_gaps(spark, d), _spans(spark, d, "view"), ["user_id"], end)


@query(f"with v as (select user_id, t lo, t + 3600000000 hi from {_EV} where event_type = 'view'), o as (select *, lag(hi) over (partition by user_id order by lo, hi) previous_hi from v) select user_id, lo, hi, previous_hi from o where lo < previous_hi")
def interval_order_violations(spark, d):
    return intervals.overlaps(_spans(spark, d, "view"), ["user_id"])


@query(f"with {_FACTS}, x as (select user_id, lo, hi, unnest(range(lo // 86400000000, (hi - 1) // 86400000000 + 1)) as day from g) select user_id, day, greatest(lo, day * 86400000000) lo, least(hi, (day + 1) * 86400000000) hi from x")
def gap_rollover_days(spark, d):
    return intervals.by_day(_gaps(spark, d), 86_400_000_000).select("user_id", "day", "lo", "hi")


_DAY_US = 86_400_000_000
_BY_DAY = lambda x, to: _UNION.replace("user_id", "user_id, day").replace("u0", to + "0").replace("u1", to + "1").format(*x)
_COV_DAYS = f"""with {_FACTS}, dd as (select unnest(range(lo // {_DAY_US}, (hi - 1) // {_DAY_US} + 1)) as day from lim), vx as (select user_id, t lo, t + 3600000000 hi from {_EV} where event_type = 'view'),
v0 as (select user_id, day, greatest(lo, day * {_DAY_US}) lo, least(hi, (day + 1) * {_DAY_US}) hi from vx join dd on lo < (day + 1) * {_DAY_US} and hi > day * {_DAY_US}), b0 as (select user_id, day, greatest(lo, day * {_DAY_US}) lo, least(hi, (day + 1) * {_DAY_US}) hi from g join dd on lo < (day + 1) * {_DAY_US} and hi > day * {_DAY_US}),
{_BY_DAY(('v0', 'v'), 'x')}, b1 as (select b0.user_id, b0.day, b0.lo, case when exists (select 1 from v where v.user_id = b0.user_id and v.day = b0.day and v.lo <= b0.hi and b0.hi < v.hi) then b0.hi else coalesce((select min(v.lo) from v where v.user_id = b0.user_id and v.day = b0.day and v.lo >= b0.hi), (b0.day + 1) * {_DAY_US}) end hi from b0),
{_BY_DAY(('b1', 'b'), 'y')}, a0 as (select * from v union all select * from b), {_BY_DAY(('a0', 'a'), 'z')}, c0 as (select v.user_id, v.day, greatest(v.lo, b.lo) lo, least(v.hi, b.hi) hi from v join b on v.user_id = b.user_id and v.day = b.day and v.lo < b.hi and b.lo < v.hi),
t as (select 'v' k, user_id, day, sum(hi - lo) x from v group by all union all select 'b', user_id, day, sum(hi - lo) from b group by all union all select 'a', user_id, day, sum(hi - lo) from a group by all union all select 'c', user_id, day, sum(hi - lo) from c0 group by all),
r as (select n.day, cast(n.user_id as varchar) exchange_symbol, cast({_DAY_US} as bigint) expected_ns, cast(coalesce(max(x) filter (k = 'v'), 0) as bigint) valid_ns, cast(coalesce(max(x) filter (k = 'b'), 0) as bigint) explicit_invalid_ns, cast(coalesce(max(x) filter (k = 'a'), 0) as bigint) accounted_ns, cast(coalesce(max(x) filter (k = 'c'), 0) as bigint) conflicting_ns
 from (select distinct user_id, day from events, dd) n left join t on t.user_id = n.user_id and t.day = n.day group by n.user_id, n.day),
q as (select *, expected_ns - accounted_ns unclassified_ns, format('{{:.9f}}', valid_ns / expected_ns) valid_ratio, format('{{:.9f}}', accounted_ns / expected_ns) accounted_ratio, valid_ns * 1000 >= expected_ns * 999 and accounted_ns = expected_ns and conflicting_ns = 0 accepted from r) """


def _covered_days(spark, d) -> DataFrame:
    lo, hi = _us(spark, d).agg(F.min("t"), F.max("t")).first()
    name = lambda df: df.withColumn("exchange_symbol", F.col("user_id").cast("string"))
    return quality.coverage_by_day(name(_us(spark, d)), name(_spans(spark, d, "view")), name(_gaps(spark, d)), (lo or 0) // _DAY_US, (hi or 0) // _DAY_US, _DAY_US)


@query(_COV_DAYS + "select * from q")
def coverage_report(spark, d):
    """Coverage of every UTC day from the first event to the last."""
    return _covered_days(spark, d)


@query(_COV_DAYS + "select day, bool_and(accepted) accepted, count(*) symbols, count(*) filter (not accepted) rejected from q group by day")
def day_verdict(spark, d):
    return quality.verdict(_covered_days(spark, d), ["day"]).withColumn("rejected", F.size("rejected").cast("bigint"))


@query(
    """select app_receive_realtime_ns observed_at_ns, exchange_event_time_ms * 1000000 - (request_realtime_ns + app_receive_realtime_ns) // 2 clock_offset_estimate_ns, greatest(0, app_receive_realtime_ns - request_realtime_ns) // 2 clock_offset_uncertainty_ns,
 app_receive_realtime_ns - request_realtime_ns clock_sample_rtt_ns, case when b <= 100000000 then 'VALID' when b > 1000000000 then 'INVALID' else 'DEGRADED' end status
from (select *, abs(exchange_event_time_ms * 1000000 - (request_realtime_ns + app_receive_realtime_ns) // 2) + greatest(0, app_receive_realtime_ns - request_realtime_ns) // 2 b from typed_events where stream_type = 'clock_sample' and request_realtime_ns is not null and exchange_event_time_ms is not null and app_receive_realtime_ns is not null)"""
)
def clock_quality(spark, d):
    return quality.clock(_t(spark, d, "typed_events"))


_D = lambda c: f"cast(try_cast({c} as decimal(18,8)) as decimal(19,8))"


@query(
    f"""select stream_type, count(*) events, cast(sum({_D('quantity')}) as decimal(28,8)) quantity, cast(sum({_D('price')} * {_D('quantity')}) as decimal(38,16)) notional, cast(sum({_D('non_rpi_quantity')}) as decimal(28,8)) non_rpi_quantity,
 cast(sum(coalesce(len(bids), 0) + coalesce(len(asks), 0)) as bigint) level_updates from typed_events where not coalesce(is_duplicate, false) and stream_type in ('trade', 'agg_trade', 'depth', 'rpi_depth') group by 1"""
)
def d0_audit(spark, d):
    return quality.audit(_t(spark, d, "typed_events"))


@query("select stream_type, app_receive_realtime_ns // 3600000000000 as hour, count(*) events, count(*) filter (is_duplicate) duplicates, min(app_receive_realtime_ns) first_ns, max(app_receive_realtime_ns) last_ns from typed_events group by 1, 2")
def chunk_stats(spark, d):
    return _t(spark, d, "typed_events").groupBy("stream_type", F.expr(f"app_receive_realtime_ns div {_HOUR}").alias("hour")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if("is_duplicate").alias("duplicates"), F.min("app_receive_realtime_ns").alias("first_ns"), F.max("app_receive_realtime_ns").alias("last_ns")
    )


@query("""select exchange_symbol, connection_id, count(*) breaks from (select exchange_symbol, connection_id, previous_final_update_id p, lag(final_update_id) over (partition by exchange_symbol, connection_id order by receive_seq, final_update_id) b from l2_projection where stream_type = 'depth') where p <> b group by 1, 2""")
def sequence_breaks(spark, d):
    rows = _t(spark, d, "l2_projection").where("stream_type = 'depth'").select("exchange_symbol", "connection_id", "receive_seq", "final_update_id", "previous_final_update_id")
    rows = sliding.before(rows, ["exchange_symbol", "connection_id"], ["receive_seq", "final_update_id"], "final_update_id", "before", F.expr("receive_seq div 65536"))
    return rows.where("previous_final_update_id <> before").groupBy("exchange_symbol", "connection_id").agg(F.count(F.lit(1)).alias("breaks"))


# -- books


def _ordered(spark, d) -> tuple[DataFrame, int, int]:
    """Book rows with their place per symbol, and the time they cover."""
    rows = skew.number_in_order(_t(spark, d, "l2_projection"), ["exchange_symbol"], ["app_receive_realtime_ns", "connection_id", "receive_seq"], to="ord")
    lo, hi = rows.agg(F.min("app_receive_realtime_ns"), F.max("app_receive_realtime_ns") + 1).first()
    return rows, lo or 0, hi or 1


def _day(spark, d):
    rows, lo, hi = _ordered(spark, d)
    return book.rebuild(rows, None, lo, hi)


# one event of every book a step; m has the book's state after it, what it changed, and the places of the messages applied
_BOOKS = """with recursive src as (select *, row_number() over (partition by exchange_symbol order by app_receive_realtime_ns nulls first, connection_id nulls first, receive_seq nulls first) pos from l2_projection),
ok as (select exchange_symbol s, connection_id c, pos, stream_type = 'depth' d, app_receive_realtime_ns ns, coalesce(receive_seq, 0) q, first_update_id f, case when stream_type = 'depth' then final_update_id else last_update_id end l, previous_final_update_id p, payload_hash h, bids, asks
 from src where stream_type in ('depth', 'depth_snapshot') and exchange_symbol is not null and connection_id is not null and app_receive_realtime_ns is not null),
one as (select * from ok where l is not null and (not d or (f is not null and p is not null)) qualify not d or row_number() over (partition by s, c, d, f, l, p, h order by pos) = 1),
ev as (select s, c, pos, d, ns, q, f, l, p, row_number() over (partition by s, c order by pos) k from one),
m as (select distinct s, c, 0::bigint k, 0::bigint pos, false valid, null::bigint x, null::bigint a, null::bigint ans, null::bigint apos, []::struct(q bigint, pos bigint, ns bigint, f bigint, l bigint, p bigint)[] held, []::bigint[] used, null::bigint at_ns, null::varchar state, null::bigint uid, null::varchar why from ev
 union all
 select s, c, k, pos, case when valid then not torn else coalesce(met, false) end, case when valid and not torn then l when met then seg[len(seg)].l end, case when torn or len(seg) > 0 then null else a end, ans, apos,
  case when torn then h when valid then [] when not tries then h when len(seg) = 0 then [] when stale then seg when cutoff is not null then [seg[cutoff]] else [] end,
  case when valid and not torn then case when d then list_append(used, pos) else [pos] end when met then list_concat([apos], list_transform(seg, lambda v: v.pos)) else [] end,
  case when torn then ns when cutoff is not null then seg[cutoff].ns when met then greatest(ans, seg[1].ns) end, case when torn or cutoff is not null then 'GAPPED' when met then 'VALID' end,
  case when torn then l when cutoff is not null then seg[cutoff].l when met then seg[len(seg)].l end, case when torn then 'pu_discontinuity' when cutoff is not null then 'buffered_pu_discontinuity' when met then 'snapshot_bridge' end
 from (select *, coalesce(len(seg) > 0 and not stale and cutoff is null, false) met from
  (select *, case when len(seg) > 0 and not stale then list_filter(range(2, len(seg) + 1), lambda i: seg[i].p <> seg[i - 1].l)[1] end cutoff from
   (select *, coalesce(seg[1].f > a, false) stale from
    (select *, case when tries then list_slice(srt, coalesce(nullif(list_position(list_transform(srt, lambda v: v.l >= a), true), 0), len(srt) + 1), len(srt)) else [] end seg from
     (select *, case when tries then list_sort(h) end srt from
      (select m.s, m.c, e.k, e.pos, e.d, e.ns, e.l, m.valid, m.x, m.used, case when not e.d and not m.valid then e.l else m.a end a, case when not e.d and not m.valid then e.ns else m.ans end ans, case when not e.d and not m.valid then e.pos else m.apos end apos,
        case when not e.d then m.held when m.valid then [{'q': e.q, 'pos': e.pos, 'ns': e.ns, 'f': e.f, 'l': e.l, 'p': e.p}] else list_append(m.held, {'q': e.q, 'pos': e.pos, 'ns': e.ns, 'f': e.f, 'l': e.l, 'p': e.p}) end h,
        coalesce(m.valid and e.d and e.p <> m.x, false) torn, not m.valid and (not e.d or coalesce(e.f <= m.a and m.a <= e.l, false)) tries
       from m join ev e on e.s = m.s and e.c = m.c and e.k = m.k + 1)))))) z),
v as (select *, row_number() over (partition by s order by pos) n from m where state is not null),
e as (select v.*, (select min({'n': w.n, 't': w.at_ns, 'p': w.pos, 'y': case when w.state = 'VALID' then 'connection_switch' else w.why end}) from v w where w.s = v.s and w.n > v.n and (w.state = 'VALID' or w.c = v.c)) stop from v where state = 'VALID') """


@query(_BOOKS + "select s exchange_symbol, c connection_id, at_ns, state, uid update_id, why reason from m where state is not null")
def l2_state_changes(spark, d):
    rows, lo, hi = _ordered(spark, d)
    return book.validity(rows, None, lo, hi)[0]


@query(
    _BOOKS
    + """select * from (select s exchange_symbol, at_ns valid_from_ns, coalesce(stop.t, (select max(app_receive_realtime_ns) + 1 from l2_projection)) valid_to_ns, c connection_id, coalesce(stop.y, 'utc_day_end') end_reason from e) where valid_to_ns > valid_from_ns"""
)
def l2_validity(spark, d):
    rows, lo, hi = _ordered(spark, d)
    return book.validity(rows, None, lo, hi)[1]


_SIDE_TEXT = lambda c: f"array_to_string(list_transform({c}, lambda v: coalesce(v.price, '') || '@' || coalesce(v.quantity, '')), ';')"


@query(
    _BOOKS
    + f""", fin as (select * from m qualify row_number() over (partition by s, c order by k desc) = 1), hold as (select distinct s, c from e where stop is null),
held as (select fin.* from fin join hold using (s, c) where valid), msg as (select s, c, x, unnest(used) pos from held), lev as (select msg.s, msg.c, case when o.d then o.l + 1 else 0 end w, 'bid' side, unnest(o.bids) v from msg join one o on o.s = msg.s and o.pos = msg.pos
 union all select msg.s, msg.c, case when o.d then o.l + 1 else 0 end, 'ask', unnest(o.asks) from msg join one o on o.s = msg.s and o.pos = msg.pos),
top as (select s, c, side, try_cast(v.price as decimal(30,12)) price, arg_max(v, w) v from lev where try_cast(v.price as decimal(30,12)) is not null group by 1, 2, 3, 4 having try_cast(arg_max(v, w).quantity as decimal(30,12)) <> 0),
txt as (select s, c, string_agg(v.price || '@' || v.quantity, ';' order by price) filter (side = 'bid') bids, string_agg(v.price || '@' || v.quantity, ';' order by price) filter (side = 'ask') asks from top group by 1, 2),
wait as (select s, c, apos, held from fin where not valid and a is not null and not exists (select 1 from hold where hold.s = fin.s and hold.c = fin.c)), w0 as (select s, c, apos pos from wait union all select s, c, unnest(held).pos from wait),
w1 as (select w0.s, w0.c, case when o.d then 'depth' else 'snapshot' end kind, row_number() over (partition by w0.s, w0.c order by o.d, o.pos) ord, case when o.d then null else o.l end last_update_id, {_SIDE_TEXT('o.bids')} bids, {_SIDE_TEXT('o.asks')} asks from w0 join one o on o.s = w0.s and o.pos = w0.pos)
select s exchange_symbol, c connection_id, 'restore' kind, cast(0 as bigint) ord, x last_update_id, bids, asks from held join txt using (s, c) where bids is not null and asks is not null union all select * from w1"""
)
def l2_checkpoint(spark, d):
    """What the next day starts from: books with their levels, and what waits; levels as text."""
    text = lambda c: F.concat_ws(";", F.transform(c, lambda x: F.concat(F.coalesce(x["price"], F.lit("")), F.lit("@"), F.coalesce(x["quantity"], F.lit("")))))
    sides = [F.when(F.col(c).isNotNull(), text(c)).alias(c) for c in ("bids", "asks")]
    return _day(spark, d)[2].select("exchange_symbol", "connection_id", "kind", "ord", "last_update_id", *sides)


@query(
    _BOOKS
    + """, i as (select s, c, pos a, at_ns valid_from_ns, stop.p b, coalesce(stop.t, (select max(app_receive_realtime_ns) + 1 from l2_projection)) t from e), r as (select i.s, i.c, valid_from_ns, i.a, m.pos, ev.d and m.pos > i.a change, ev.l from i join m on m.s = i.s and m.c = i.c and m.valid and m.pos >= i.a and (i.b is null or m.pos < i.b) join ev on ev.s = m.s and ev.c = m.c and ev.pos = m.pos where t > valid_from_ns),
g as (select *, max(case when not change then pos * 2 + 1 end) over (partition by s, c, a order by pos rows unbounded preceding) segment from r)
select s exchange_symbol, c connection_id, valid_from_ns, segment, count(*) filter (change) changes, max(l) filter (change) last_id from g group by 1, 2, 3, 4"""
)
def l2_replay_segments(spark, d):
    """The stretches of the canonical replay stream: its changes counted, and the id they lead to."""
    rows, lo, hi = _ordered(spark, d)
    r = book.replay_stream(rows, None, lo, hi)
    return r.groupBy("exchange_symbol", "connection_id", "valid_from_ns", "segment").agg(F.count_if(F.col("kind") == "DIFF").alias("changes"), F.max("final_update_id").alias("last_id"))


# -- cross-sections of the daily bars

_DAILY = """b as (select exchange_symbol s, open_ms // 86400000 d, max({'r': coalesce(request_realtime_ns, -1), 'v': coalesce(try_cast(quote_volume as decimal(26,8)), -1), 't': coalesce(trades, -1)}) m from daily_klines where exchange_symbol is not null and open_ms is not null group by 1, 2),
k as (select s, d, nullif(m.v, -1) v, nullif(m.t, -1) t from b)"""


def _bars(spark, d) -> DataFrame:
    from tidemark.operators.rolling import latest_daily

    metrics = {"v": F.coalesce(F.col("quote_volume").try_cast("decimal(26,8)"), F.lit(-1)), "t": F.coalesce("trades", F.lit(-1))}
    one = latest_daily(_t(spark, d, "daily_klines").withColumn("r", F.coalesce("request_realtime_ns", F.lit(-1))), "exchange_symbol", "open_ms", "r", metrics)
    return one.select("exchange_symbol", "day", F.nullif(F.col("v"), F.lit(-1)).cast("decimal(26,8)").alias("v"), F.nullif(F.col("t"), F.lit(-1)).alias("t"))


_PCT = lambda c, by, src, n, m, out: f"""(select {by}, cast((a * ({m} - r) + b * r)::decimal(38,10) / {m} as double) {out} from (select {by}, list_sort(list({c}))[((count(*) - 1) * {n}) // {m} + 1] a, coalesce(list_sort(list({c}))[((count(*) - 1) * {n}) // {m} + 2], list_sort(list({c}))[((count(*) - 1) * {n}) // {m} + 1]) b, ((count(*) - 1) * {n}) % {m} r from {src} where {c} is not null group by {by}))"""


@query(f"with {_DAILY} select s exchange_symbol, round(q25_volume, 6) q25_volume, round(q25_trades, 6) q25_trades from {_PCT('v', 's', 'k', 1, 4, 'q25_volume')} full join {_PCT('t', 's', 'k', 1, 4, 'q25_trades')} using (s)")
def quartile_metrics(spark, d):
    bars = _bars(spark, d).withColumn("t", F.col("t").cast("decimal(20,0)"))
    a, b = (ranking.percentile(bars, ["exchange_symbol"], c, 1, 4, n) for c, n in (("v", "q25_volume"), ("t", "q25_trades")))
    return a.join(b, "exchange_symbol", "full").select("exchange_symbol", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("q25_volume", "q25_trades")])


_SPREAD = "(select exchange_symbol s, cast(round((cast(ask_price as double) - cast(bid_price as double)) / ((cast(ask_price as double) + cast(bid_price as double)) / 2) * 10000, 6) as decimal(20,6)) x from typed_events where stream_type = 'book_ticker' and exchange_symbol is not null and bid_price is not null and ask_price is not null) z"


@query(f"select s exchange_symbol, round(q95, 8) q95_spread_bps from {_PCT('x', 's', _SPREAD, 19, 20, 'q95')}")
def q95_spread(spark, d):
    t = _t(spark, d, "typed_events").where("stream_type = 'book_ticker' and exchange_symbol is not null and bid_price is not null and ask_price is not null")
    a, b = F.col("ask_price").cast("double"), F.col("bid_price").cast("double")
    t = t.select("exchange_symbol", F.round((a - b) / ((a + b) / 2) * 10_000, 6).cast("decimal(20,6)").alias("x"))
    return ranking.percentile(t, ["exchange_symbol"], "x", 19, 20, "q").select("exchange_symbol", F.round(F.col("q").cast("double"), 8).alias("q95_spread_bps"))


_CROSS = f"with {_DAILY}, c as (select s, cast(sum(v) as decimal(36,8)) volume, cast(sum(t) as bigint) trades, max(d) - min(d) + 1 - count(*) missing from k group by s), r as (select *, rank() over (order by volume desc nulls last) r1, rank() over (order by trades desc nulls last) r2, rank() over (order by missing asc nulls last) r3 from c), p as (select *, row_number() over (order by greatest(r1, r2, r3), r1 + r2 + r3, r1, r2, r3, s) n from r) "


def _ranked_symbols(spark, d) -> DataFrame:
    c = _bars(spark, d).groupBy("exchange_symbol").agg(F.sum("v").cast("decimal(36,8)").alias("volume"), F.sum("t").alias("trades"), (F.max("day") - F.min("day") + 1 - F.count(F.lit(1))).alias("missing"))
    return ranking.by_weakest(c, "exchange_symbol", [("volume", True), ("trades", True), ("missing", False)])


@query(_CROSS + "select s exchange_symbol, volume, trades, missing, r1 rank_volume, r2 rank_trades, r3 rank_missing, n position from p")
def rank_cross_section(spark, d):
    return _ranked_symbols(spark, d)


@query(
    """with c as (select l_suppkey s, sum(cast(round(l_extendedprice * 100) as bigint)) volume, count(*) trades, count(distinct l_partkey) parts from lineitem group by 1), p as (select s, row_number() over (order by trades desc, s) n from c), r as (select c.*, rank() over (order by volume desc) r1, rank() over (order by trades desc) r2, rank() over (order by parts desc) r3 from c where s not in (select s from p where n <= 5)),
q as (select s, row_number() over (order by greatest(r1, r2, r3), r1 + r2 + r3, r1, r2, r3, s) n from r) select s supplier, n position, 'probe' slot from p where n <= 5 union all select s, n, case when n <= 50 then 'core' else 'boundary' end from q where n <= 55"""
)
def top_of_cross_section(spark, d):
    """Slots of a cross-section: the five busiest are probes; of the others the best fifty are the core, the next five the boundary."""
    c = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("supplier"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("v"), "l_partkey")
    c = c.groupBy("supplier").agg(F.sum("v").alias("volume"), F.count(F.lit(1)).alias("trades"), F.count_distinct("l_partkey").alias("parts"))
    probes = ranking.by_weakest(c, "supplier", [("trades", True)]).where("position <= 5").select("supplier", "position", F.lit("probe").alias("slot"))
    rest = ranking.by_weakest(c.join(F.broadcast(probes.select("supplier")), "supplier", "left_anti"), "supplier", [("volume", True), ("trades", True), ("parts", True)]).where("position <= 55")
    return probes.unionByName(rest.select("supplier", "position", F.when(F.col("position") <= 50, "core").otherwise("boundary").alias("slot")))


# suppliers stand for instruments and stretches of 70 days for days: a panel that is full at every size
_FACT = """with k as (select l_suppkey s, date_diff('day', date '1970-01-01', cast(l_shipdate as date)) // 70 d, sum(cast(round(l_extendedprice * 100) as bigint))::double / 100 v, count(*)::double t from lineitem group by 1, 2),
x as (select s, d - ((select max(d) from k) - 35) i, v, t from k where d >= (select max(d) from k) - 35 and d < (select max(d) from k)), f as (select s from x group by s having count(*) = 35),
y as (select x.s, median(v) filter (i < 28) bv, median(t) filter (i < 28) bt, median(v) filter (i >= 28) v7, median(t) filter (i >= 28) t7, median(v) filter (i >= 32) v3, median(t) filter (i >= 32) t3, median(v) filter (i >= 34) v1, median(t) filter (i >= 34) t1 from x join f using (s) group by x.s),
m as (select s, 7 horizon, v7 / bv vf, t7 / bt tf from y where bv > 0 and bt > 0 union all select s, 3, v3 / bv, t3 / bt from y where bv > 0 and bt > 0 union all select s, 1, v1 / bv, t1 / bt from y where bv > 0 and bt > 0) """


def _factors(spark, d) -> DataFrame:
    days = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.expr("unix_date(cast(l_shipdate as date)) div 70").alias("day"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("c"))
    days = days.groupBy("symbol", "day").agg((F.sum("c").cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).alias("volume"), F.count(F.lit(1)).alias("trades"))
    return ranking.market_factors(days, days.agg(F.max("day")).first()[0] or 0)


@query(_FACT + "select s symbol, horizon, round(vf, 8) volume_factor, round(tf, 8) trade_factor from m")
def market_factors(spark, d):
    return _factors(spark, d).select("symbol", "horizon", *[F.round(F.col(c).cast("double"), 8).alias(c) for c in ("volume_factor", "trade_factor")])


@query(
    _FACT
    + """, h as (select horizon, count(*) panel, median(vf) mv, median(tf) mt from m group by 1), w as (select h.horizon, panel, mv, mt, avg(case when mv >= 1.25 then (vf >= 1.25)::int else (vf <= 0.8)::int end) vb, avg(case when mv >= 1.25 then (tf >= 1.25)::int else (tf <= 0.8)::int end) tb from m join h using (horizon) group by all),
o as (select *, ((mv >= 1.25 and mt >= 1.25) or (mv <= 0.8 and mt <= 0.8)) and vb >= 0.7 and tb >= 0.7 moved from w), bb as (select *, case when moved and horizon = 7 then 'ACTIVITY_SHIFT_CONFIRMED' when moved then 'ACTIVITY_SHOCK_PENDING' else 'NORMAL' end state from o order by case when moved then 100 - horizon when horizon = 1 then 1000 else 2000 end limit 1)
select case when n >= 60 then bb.state else 'NORMAL' end state, case when n >= 60 then bb.horizon else 0 end horizon_days, n panel_count, case when n >= 60 then round(mv, 8) else 1 end volume_factor, case when n >= 60 then round(mt, 8) else 1 end trade_factor, case when n >= 60 then round(vb, 8) else 0 end volume_breadth, case when n >= 60 then round(tb, 8) else 0 end trade_breadth
from (select coalesce(max(panel), 0) n from h) left join bb on true"""
)
def market_regime(spark, d):
    c = ranking.market_context(_factors(spark, d))
    return c.select("state", "horizon_days", "panel_count", *[F.round(F.col(x).cast("double"), 8).alias(x) for x in ("volume_factor", "trade_factor", "volume_breadth", "trade_breadth")])


_BAND = """with l as (select connection_id c, receive_seq r, 'bid' side, unnest(bids) x from typed_events where stream_type = 'depth_snapshot' union all select connection_id, receive_seq, 'ask', unnest(asks) from typed_events where stream_type = 'depth_snapshot'),
n as (select c, r, side, cast(x.price as decimal(18,8)) p, cast(x.quantity as decimal(18,8)) q from l), b as (select c, r, max(p) filter (side = 'bid') b, min(p) filter (side = 'ask') a from n group by 1, 2 having max(p) filter (side = 'bid') is not null and min(p) filter (side = 'ask') is not null)
select n.c connection_id, n.r receive_seq, cast(least(coalesce(sum(p::decimal(19,8) * q::decimal(19,8)) filter (side = 'bid' and p::decimal(28,8) * 20000 >= (b + a)::decimal(28,8) * 9990), 0), coalesce(sum(p::decimal(19,8) * q::decimal(19,8)) filter (side = 'ask' and p::decimal(28,8) * 20000 <= (b + a)::decimal(28,8) * 10010), 0)) as decimal(30,8)) depth_10bps from n join b on n.c = b.c and n.r = b.r group by 1, 2"""


@query(_BAND)
def band_depth(spark, d):
    t = _t(spark, d, "typed_events").where("stream_type = 'depth_snapshot'")
    side = lambda s, c: t.select("connection_id", "receive_seq", F.lit(s).alias("side"), F.explode(c).alias("x"))
    levels = side("bid", "bids").unionByName(side("ask", "asks")).select("connection_id", "receive_seq", "side", F.col("x.price").cast("decimal(18,8)").alias("price"), F.col("x.quantity").cast("decimal(18,8)").alias("quantity"))
    return ranking.band_depth(levels, ["connection_id", "receive_seq"], 10).select("connection_id", "receive_seq", F.col("depth_10bps").cast("decimal(30,8)").alias("depth_10bps"))


# -- traffic


def _rates(spark, d) -> DataFrame:
    return traffic.per_slot(_t(spark, d, "typed_events"), "exchange_symbol", "app_receive_realtime_ns")


_RATE = "r as (select exchange_symbol s, app_receive_realtime_ns // 60000000000 m, count(*) n from typed_events where exchange_symbol is not null and app_receive_realtime_ns is not null group by 1, 2)"
# users stand for symbols: events span 30 days at every size. The recorder runs through from the first minute to the last;
# the one in which it started is not whole and does not count
_BLOCKS = f"""r as (select cast(user_id as varchar) s, {_US} // 60000000 m, count(*) n from events group by 1, 2), a as (select min(m) lo, max(m) hi from r), i as (select unnest(range(lo + 1, hi + 1)) m from a),
j as (select i.m, lo + 1 + (i.m - lo - 1) // {traffic.BLOCK} * {traffic.BLOCK} st from i, a), w as (select st from j group by st having count(*) = {traffic.BLOCK}), k as (select s, j.st block_start, max(n) peak from r join j using (m) join w on w.st = j.st group by 1, 2)"""


def _peaks(spark, d) -> DataFrame:
    rates = traffic.per_slot(_us(spark, d).withColumn("exchange_symbol", F.col("user_id").cast("string")), "exchange_symbol", "t", 60_000_000)
    seen = rates.agg(F.min("slot").alias("lo"), F.max("slot").alias("hi")).select(F.explode(F.expr("sequence(lo, hi)")).alias("slot"))
    return traffic.blocks(rates, "exchange_symbol", seen)


@query(f"with {_RATE} select s exchange_symbol, m slot, n from r")
def minute_rates(spark, d):
    return _rates(spark, d)


@query(f"with {_BLOCKS} select s exchange_symbol, block_start, peak from k")
def block_peaks(spark, d):
    return _peaks(spark, d)


@query(f"with {_BLOCKS}, l as (select distinct block_start from k order by 1 desc limit {traffic.KEPT}), e as (select count(*) = {traffic.KEPT} enough from l) select s exchange_symbol, max(peak) rate from k, e where enough and block_start in (select * from l) group by 1 union all select exchange_symbol, message_rate from message_rates, e where not enough")
def effective_rates(spark, d):
    """The rate to plan with: the highest peak of the last 24 blocks of 60 minutes; the configured rates while there are fewer blocks."""
    baseline = _t(spark, d, "message_rates").withColumnRenamed("message_rate", "rate")
    return traffic.effective(_peaks(spark, d), "exchange_symbol", baseline=baseline)


@query("select list_sort(list(message_rate))[count(*) // 2 + 1] upper_median from message_rates where message_rate is not null")
def default_rate(spark, d):
    return traffic.upper_median(_t(spark, d, "message_rates"), "message_rate")


@query()
def shard_balance(spark, d):
    """The symbols of raw_events over four shards by their configured rates (a plan for tens of symbols, made on the driver)."""
    rates = {r[0]: r[1] for r in _t(spark, d, "message_rates").where("message_rate is not null").collect()}
    symbols = [r[0] for r in _symbols(spark, d, "raw_events").collect()]
    rows = [(s, n) for n, shard in enumerate(traffic.shards(symbols, rates, 4)) for s in shard]
    return spark.createDataFrame(rows, "exchange_symbol string, shard int")


@query("with c as (select exchange_symbol s, count(*) n from l2_projection group by 1) select s exchange_symbol, n as rows, not exists (select 1 from message_rates r where r.exchange_symbol = s) ignored, row_number() over (partition by not exists (select 1 from message_rates r where r.exchange_symbol = s) order by n desc, s) schedule from c")
def projection_schedule(spark, d):
    return manifests.projection_report(_t(spark, d, "l2_projection"), _t(spark, d, "message_rates"))


# -- as-of joins


@query(
    """with t as (select distinct exchange_symbol s, connection_id c, receive_seq q, exchange_event_time_ms t from typed_events where stream_type = 'force_order' and exchange_symbol is not null and exchange_event_time_ms is not null), m as (select exchange_symbol s, exchange_event_time_ms mt, max(mark_price) mp from typed_events where stream_type = 'mark_price' and exchange_symbol is not null and exchange_event_time_ms is not null group by 1, 2)
select t.s exchange_symbol, t.c connection_id, t.q receive_seq, m.mt mark_time_ms, m.mp mark_price from t asof left join m on t.s = m.s and t.t >= m.mt"""
)
def asof_backward(spark, d):
    return _asof(spark, d, False)


@query(
    """with t as (select distinct exchange_symbol s, connection_id c, receive_seq q, exchange_event_time_ms t from typed_events where stream_type = 'force_order' and exchange_symbol is not null and exchange_event_time_ms is not null), m as (select exchange_symbol s, exchange_event_time_ms mt, max(mark_price) mp from typed_events where stream_type = 'mark_price' and exchange_symbol is not null and exchange_event_time_ms is not null group by 1, 2)
select t.s exchange_symbol, t.c connection_id, t.q receive_seq, m.mt mark_time_ms, m.mp mark_price from t asof left join m on t.s = m.s and t.t <= m.mt"""
)
def asof_forward(spark, d):
    return _asof(spark, d, True)


def _asof(spark, d, forward: bool) -> DataFrame:
    t = _t(spark, d, "typed_events").where("exchange_symbol is not null and exchange_event_time_ms is not null")
    left = t.where("stream_type = 'force_order'").select("exchange_symbol", "connection_id", "receive_seq", F.col("exchange_event_time_ms").alias("t"))
    right = t.where("stream_type = 'mark_price'").select("exchange_symbol", F.col("exchange_event_time_ms").alias("mark_time_ms"), "mark_price")
    return asof.asof(left, right, ["exchange_symbol"], "t", "mark_time_ms", ["mark_price"], forward, ties=["mark_price"], slice_of=600_000).drop("t")


# -- chunks: orders stand for chunks, lineitem for references to them


@query("select o_orderkey chunk_id, o_orderpriority sha256, case when o_orderstatus = 'O' then case when o_custkey % 7 = 0 then 'HASH_MISMATCH' else 'APPLY' end when o_orderstatus = 'F' then case when o_custkey % 7 = 0 then 'HASH_MISMATCH' else 'REPLAY' end else 'UNKNOWN' end outcome from orders")
def ack_classification(spark, d):
    o = _t(spark, d, "orders").withColumn("s", F.when(F.expr("o_custkey % 7 = 0"), "other").otherwise(F.col("o_orderpriority")))
    of = lambda s: o.where(F.col("o_orderstatus") == s).select(F.col("o_orderkey").alias("chunk_id"), F.col("s").alias("sha256"))
    return manifests.classify_acks(o.select(F.col("o_orderkey").alias("chunk_id"), F.col("o_orderpriority").alias("sha256")), of("O"), of("F"))


@query("select l_orderkey chunk_id, count(distinct (l_linenumber, l_partkey)) versions from lineitem group by 1 having count(distinct (l_linenumber, l_partkey)) > 1")
def manifest_conflicts(spark, d):
    return manifests.conflicts(_t(spark, d, "lineitem").select(F.col("l_orderkey").alias("chunk_id"), "l_linenumber", "l_partkey"))


@query("select l_returnflag collector_id, cast(l_shipdate as date)::varchar utc_date, count(*) chunks from lineitem l left join (select o_orderkey k, o_orderstatus s from orders) o on o.k = l_orderkey group by 1, 2 having bool_and(coalesce(o.s <> 'P', false))")
def complete_days(spark, d):
    refs = _t(spark, d, "lineitem").select(F.col("l_returnflag").alias("collector_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("utc_date"), F.col("l_orderkey").alias("chunk_id"), F.lit("x").alias("sha256"))
    files = _t(spark, d, "orders").select(F.col("o_orderkey").alias("chunk_id"), F.when(F.col("o_orderstatus") != "P", "x").otherwise("y").alias("sha256"))
    return manifests.complete_days(refs, files)


@query("select l_returnflag collector_id, cast(l_shipdate as date)::varchar utc_date, count(distinct (l_orderkey, l_linestatus)) chunks, min(l_orderkey) first_chunk from lineitem group by 1, 2")
def day_seal(spark, d):
    refs = _t(spark, d, "lineitem").select(F.col("l_returnflag").alias("collector_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("utc_date"), F.col("l_orderkey").alias("chunk_id"), F.col("l_linestatus").alias("sha256"))
    return manifests.seal(refs).select("collector_id", "utc_date", F.size("chunks").cast("bigint").alias("chunks"), F.get("chunks", F.lit(0))["chunk_id"].alias("first_chunk"))


_SIZES = "d as (select cast(o_orderdate as date)::varchar utc_date, cast(sum(cast(round(o_totalprice) as bigint)) as bigint) size_bytes from orders group by 1)"


def _days(spark, d) -> DataFrame:
    return _t(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("utc_date")).agg(F.sum(F.round("o_totalprice").cast("bigint")).alias("size_bytes"))


@query(f"with {_SIZES} select utc_date, size_bytes, cast(w as bigint) with_newer from (select *, sum(size_bytes) over (order by utc_date desc rows unbounded preceding) w from d) where w > (select sum(size_bytes) // 3 from d) and utc_date < '2001-07-25'")
def byte_budget(spark, d):
    days = _days(spark, d)
    return manifests.over_budget(days, (days.agg(F.sum("size_bytes")).first()[0] or 0) // 3, "2001-07-25")


@query("with d as (select distinct o_orderstatus collector_id, cast(o_orderdate as date)::varchar utc_date from orders), p as (select distinct o_orderstatus collector_id, cast(o_orderdate as date)::varchar utc_date from orders where o_orderpriority like '1%') select * from d where utc_date < '1998-01-01' and not exists (select 1 from p where p.collector_id = d.collector_id and p.utc_date = d.utc_date)")
def retention_expired(spark, d):
    o = _t(spark, d, "orders").select(F.col("o_orderstatus").alias("collector_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("utc_date"), "o_orderpriority")
    pinned = o.where(F.col("o_orderpriority").startswith("1")).select("collector_id", "utc_date")
    return manifests.expired(o.select("collector_id", "utc_date").distinct().withColumn("sealed", F.lit(True)), pinned, "1998-01-01").drop("sealed")


@query("with t as (select case when stream_type in ('depth', 'rpi_depth', 'depth_snapshot', 'rpi_depth_snapshot') then 'depth' when stream_type in ('agg_trade', 'trade', 'book_ticker', 'mark_price', 'force_order') then 'trades_market' else 'metadata' end g, max(app_receive_realtime_ns) m from typed_events group by 1) select case when count(*) = 2 then min(m) end watermark_ns from t where g in ('depth', 'trades_market')")
def durable_watermark(spark, d):
    chunks = _t(spark, d, "typed_events").groupBy(parse.writer_group("stream_type").alias("writer_group"), F.expr(f"app_receive_realtime_ns div {_HOUR}")).agg(F.max("app_receive_realtime_ns").alias("max_app_receive_realtime_ns"))
    return manifests.durable_watermark(chunks, ["depth", "trades_market"])


@query("select l_orderkey, l_linenumber, count(*) copies from lineitem group by 1, 2 having count(*) > 1")
def exact_identity_counts(spark, d):
    return _t(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


# -- joins and sets of symbols


def _symbols(spark, d, table: str) -> DataFrame:
    return _t(spark, d, table).select(F.upper("exchange_symbol").alias("exchange_symbol")).where("exchange_symbol is not null").distinct()


_S = lambda t: f"(select distinct upper(exchange_symbol) exchange_symbol from {t} where exchange_symbol is not null)"


@query(f"select exchange_symbol from {_S('raw_events')} a where exists (select 1 from {_S('typed_events')} b where b.exchange_symbol = a.exchange_symbol)")
def two_snapshot_members(spark, d):
    return _symbols(spark, d, "raw_events").join(_symbols(spark, d, "typed_events"), "exchange_symbol", "left_semi")


@query(f"select exchange_symbol from {_S('message_rates')} a where not exists (select 1 from {_S('raw_events')} b where b.exchange_symbol = a.exchange_symbol)")
def inactive_members(spark, d):
    return _symbols(spark, d, "message_rates").join(_symbols(spark, d, "raw_events"), "exchange_symbol", "left_anti")


@query(f"select a.exchange_symbol, coalesce(message_rate, 0) message_rate, message_rate is not null known from {_S('raw_events')} a left join message_rates r on r.exchange_symbol = a.exchange_symbol")
def rates_with_defaults(spark, d):
    return _symbols(spark, d, "raw_events").join(_t(spark, d, "message_rates"), "exchange_symbol", "left").select("exchange_symbol", F.coalesce("message_rate", F.lit(0)).alias("message_rate"), F.col("message_rate").isNotNull().alias("known"))


@query(f"select * from {_S('message_rates')} union select * from {_S('raw_events')}")
def tracked_union(spark, d):
    return _symbols(spark, d, "message_rates").union(_symbols(spark, d, "raw_events")).distinct()


@query(f"(select * from {_S('message_rates')} except select * from {_S('raw_events')}) union all (select * from {_S('raw_events')} except select * from {_S('message_rates')})")
def symmetric_difference(spark, d):
    a, b = _symbols(spark, d, "message_rates"), _symbols(spark, d, "raw_events")
    return a.exceptAll(b).union(b.exceptAll(a))


@query(f"select * from {_S('l2_projection')} intersect select * from {_S('message_rates')}")
def common_members(spark, d):
    return _symbols(spark, d, "l2_projection").intersect(_symbols(spark, d, "message_rates"))


@query("""with c as (select max(open_ms // 86400000) + 1 hi from daily_klines), a as (select exchange_symbol s, count(distinct open_ms // 86400000) n from daily_klines, c where exchange_symbol is not null and open_ms // 86400000 >= hi - 14 and close_ms < hi * 86400000 group by 1) select s exchange_symbol, n complete_days, n = 14 mature from a""")
def mature_pool(spark, d):
    """Complete days among the last fourteen: with a bar that opens in the calendar and closes before its end."""
    k = _t(spark, d, "daily_klines").where("exchange_symbol is not null and open_ms is not null").select("exchange_symbol", F.expr("open_ms div 86400000").alias("day"), "close_ms")
    calendar = k.agg(F.max("day").alias("hi")).select(F.explode(F.expr("sequence(hi - 13, hi)")).alias("day"), ((F.col("hi") + 1) * 86_400_000).alias("end"))  # fourteen rows
    bars = k.join(F.broadcast(calendar), "day").where("close_ms < end")
    return bars.select("exchange_symbol", "day").distinct().groupBy("exchange_symbol").agg(F.count(F.lit(1)).alias("complete_days")).withColumn("mature", F.col("complete_days") == 14)


# -- silence and minute eligibility


@query("""with o as (select exchange_symbol s, app_receive_realtime_ns t, lag(app_receive_realtime_ns) over (partition by exchange_symbol order by app_receive_realtime_ns) p from typed_events where stream_type = 'mark_price' and exchange_symbol is not null),
l as (select s, max(t) t from o group by 1) select s exchange_symbol, p affected_from_ns, t closed_ns from o where t - p > 15000000000 union all select s, t, null from l where (select max(app_receive_realtime_ns) from typed_events) - t > 15000000000""")
def liveness_gaps(spark, d):
    """Silences of the mark price beyond 15 s: from the last event to the first new one; null where it lasts at the end of the table."""
    t = _t(spark, d, "typed_events")
    until = t.agg(F.max("app_receive_realtime_ns")).first()[0]
    return quality.liveness(t.where("stream_type = 'mark_price'"), "exchange_symbol", "app_receive_realtime_ns", 15 * 10**9, until)


_ELIG = """with m as (select distinct exchange_symbol s, app_receive_realtime_ns // 60000000000 m from typed_events where stream_type = 'book_ticker' and exchange_symbol is not null), r as (select min(m) a, max(m) b from m), g as (select s, unnest(range(a, b + 1)) m from (select distinct s from m), r),
v as (select g.s, g.m, (m.m is not null)::int ok from g left join m on m.s = g.s and m.m = g.m), e as (select *, min(ok) over (partition by s order by m rows 4 preceding) lb, count(*) over (partition by s order by m rows 4 preceding) nb, min(ok) over (partition by s order by m rows between 1 following and 2 following) fw, count(*) over (partition by s order by m rows between 1 following and 2 following) nf from v)
select s exchange_symbol, count(*) as minutes, count(*) filter (ok = 1) valid_minutes, count(*) filter (lb = 1 and nb = 5 and fw = 1 and nf = 2) eligible_minutes from e group by 1"""


@query(_ELIG)
def minute_eligibility(spark, d):
    """Minutes with five valid ones up to it and two after it, per symbol."""
    has = _t(spark, d, "typed_events").where("stream_type = 'book_ticker' and exchange_symbol is not null").select("exchange_symbol", F.expr(f"app_receive_realtime_ns div {traffic.MINUTE_NS}").alias("m")).distinct()
    span = has.agg(F.min("m").alias("a"), F.max("m").alias("b"))
    grid = has.select("exchange_symbol").distinct().join(F.broadcast(span), F.col("a").isNotNull()).select("exchange_symbol", F.explode(F.expr("sequence(a, b)")).alias("m"))
    v = grid.join(has.withColumn("ok", F.lit(1)), ["exchange_symbol", "m"], "left").fillna(0, ["ok"])
    w = Window.partitionBy("exchange_symbol").orderBy("m")
    back, ahead = w.rowsBetween(-4, 0), w.rowsBetween(1, 2)
    good = (F.min("ok").over(back) == 1) & (F.count("ok").over(back) == 5) & (F.min("ok").over(ahead) == 1) & (F.count("ok").over(ahead) == 2)
    v = v.withColumn("e", good.cast("int"))
    return v.groupBy("exchange_symbol").agg(F.count(F.lit(1)).alias("minutes"), F.sum("ok").alias("valid_minutes"), F.coalesce(F.sum("e"), F.lit(0)).alias("eligible_minutes"))
