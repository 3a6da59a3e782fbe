"""Scenarios of single operators: boundaries, ties, nulls, long inputs."""

import random
from decimal import ROUND_DOWN, Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.numbers import canonical, exact_percentile, floor_div, is_zero, nine_decimals
from tidemark.functions.text import canonical_json, is_symbol, nfc
from tidemark.operators import asof, intervals, manifests, parse, quality, ranking, sliding, traffic
from tidemark.plans import market
from tidemark.sources import evidence

S = 10**9


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_canonical_decimals(spark):
    texts = ["0.00000000", "0.0000001", "1e3", "+5", " 1 ", "1_000", "12.50", "007", "-0.0001", "0.000000", "0.0000012", "abc", None, ".5", "5.", "1.5e-10", "9" * 40 + ".123", "-0", "0e5", "1.0E+2", ""]
    df = spark.createDataFrame([(x,) for x in texts], "x string").select("x", canonical("x"), is_zero(F.col("x")))
    for x, c, z in df.collect():
        try:
            want = str(Decimal(x)) if x is not None else None
        except ArithmeticError:
            want = None
        assert c == want
        if want is not None and x == x.strip() and "_" not in x:
            assert z == (Decimal(x) == 0)


def test_percentiles_are_exact(spark):
    rng = random.Random(0)
    data = [(k, Decimal(rng.randint(0, 10**6)).scaleb(-3)) for k in "ab" for _ in range(rng.randint(1, 40))] + [("c", None), ("d", Decimal("1.5")), ("d", None)]
    df = spark.createDataFrame(data, "k string, v decimal(26,8)")
    got = {r.k: r.p for r in ranking.percentile(df, ["k"], "v", 1, 4, "p").collect()}
    lists = {r.k: r.p for r in df.groupBy("k").agg(exact_percentile(F.collect_list("v"), 1, 4).alias("p")).collect()}
    for k in "abd":
        v = sorted(x for n, x in data if n == k and x is not None)
        pos, rem = divmod((len(v) - 1), 4)
        want = v[pos] if not rem else (v[pos] * (4 - rem) + v[pos + 1] * rem) / 4
        assert got[k] == want == lists[k]
    assert "c" not in got and lists["c"] is None


def test_text_functions(spark):
    df = spark.createDataFrame([("BTCUSDT",), ("btc",), ("",), ("A B",), (None,), ("币安",), ("É" * 31,)], "s string")
    assert [r[0] for r in df.select(is_symbol("s")).collect()] == [True, False, False, False, False, True, False]
    assert [r[0] for r in spark.createDataFrame([("é",), (None,)], "s string").select(nfc("s")).collect()] == ["é", None]
    assert df.limit(1).select(canonical_json(F.lit(1).alias("b"), F.lit(None).cast("string").alias("a"))).first()[0] == '{"a":null,"b":1}'
    assert [r[0] for r in spark.createDataFrame([(-1,), (10**18 + 59,), (None,)], "x bigint").select(floor_div("x", 60)).collect()] == [-1, (10**18 + 59) // 60, None]


def test_sliding_window_refreshes_and_includes_its_bound(spark):
    w = 600 * S
    data = [("k", 0, 0), ("k", 600 * S, 1), ("k", 1_200 * S + 1, 2), (None, 5, 3), (None, 5, 4)]
    df = spark.createDataFrame(data, "i string, t bigint, o bigint").withColumn("chunk", F.lit(0)).withColumn("is_duplicate", F.lit("old"))
    got = {r.o: r.is_duplicate for r in sliding.flag(df, ["i"], "t", ["o"], "chunk", w).collect()}
    assert got == {0: False, 1: True, 2: False, 3: False, 4: False}


@pytest.mark.parametrize("seed", range(3))
def test_sliding_equals_sequential(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "b", "c", None]), rng.randint(0, 400), n // 20, n, rng.choice(["x", "y"])) for n in range(160)]
    seen, top, want = {}, 0, {}
    for i, t, _, n, h in data:
        if i is None:
            want[n] = (False, False)
            continue
        top = max(top, t)
        dup = i in seen and seen[i][0] >= top - 50
        want[n] = (dup, dup and seen[i][1] != h)
        seen[i] = (t, h)
    df = spark.createDataFrame(data, "i string, t bigint, chunk int, o bigint, h string")
    assert {r.o: (r.is_duplicate, r.in_conflict) for r in sliding.flag(df, ["i"], "t", ["o"], "chunk", 50, "h").collect()} == want


@pytest.mark.parametrize("seed", range(3))
def test_intervals_equal_sets_of_points(spark, seed):
    rng = random.Random(seed)
    make = lambda n: [(rng.choice(["A", "B", None]), rng.choice([None, rng.randint(0, 60)]), rng.choice([None, rng.randint(0, 60)])) for _ in range(n)]
    a, b = make(25), make(25)
    points = lambda rs, k: {x for y, lo, hi in rs if y == k and lo is not None and hi is not None for x in range(lo, hi)}
    da, db = (spark.createDataFrame(x, "k string, lo bigint, hi bigint") for x in (a, b))
    expand = lambda df, k: sorted(x for y, lo, hi in map(tuple, df.select("k", "lo", "hi").collect()) if y == k for x in range(lo, hi))
    merged, both, longer = intervals.merge(da, ["k"]), intervals.intersect(da, db, ["k"]), intervals.extend(da, db, ["k"], 70)
    for k in ("A", "B", None):
        assert expand(merged, k) == sorted(points(a, k))
        assert expand(both, k) == sorted(points(a, k) & points(b, k))
    for k in ("A", "B"):
        good = points(b, k)
        want = set()
        for y, lo, hi in a:
            if y == k and lo is not None and hi is not None and lo < hi:
                end = hi if hi in good else next((x for x in range(hi, 70) if x in good), 70)
                want |= set(range(lo, end))
        assert set(expand(longer, k)) == want
    assert rows(intervals.overlaps(merged, ["k"])) == []


def test_pairing(spark):
    facts = [("g", 1, "OPEN"), ("g", 3, "OPEN"), ("g", 5, "CLOSED"), ("g", 6, "CLOSED"), ("g", 9, "OPEN"), ("h", 2, "CLOSED"), ("i", 4, "CLOSED"), ("i", 4, "OPEN"), ("j", None, "OPEN"), (None, 1, "OPEN")]
    got = intervals.pair(spark.createDataFrame(facts, "g string, t bigint, s string"), ["g"], "t", "s", 10)
    assert rows(got) == sorted([("g", 3, 5), ("g", 9, 10), ("i", 4, 10), (None, 1, 10)], key=repr)


def test_coverage_of_a_minute_gap(spark):
    hi = 86_400 * S
    expected = spark.createDataFrame([("A",), ("B",)], "exchange_symbol string")
    valid = spark.createDataFrame([("A", 0, 1000 * S), ("A", 1060 * S, hi)], "exchange_symbol string, lo bigint, hi bigint")
    facts = spark.createDataFrame([("gap-1", "OPEN", 1000 * S, None, [], [], ""), ("gap-1", "CLOSED", 1060 * S, None, [], [], ""), ("gap-2", "OPEN", 5, None, ["X"], [], ""), ("gap-3", "OPEN", 5, None, [], ["trade"], "")], "gap_id string, state string, observed_at_realtime_ns bigint, affected_from_realtime_ns bigint, exchange_symbols array<string>, stream_types array<string>, detail string")
    broken = quality.invalid(quality.scoped(facts, expected), 0, hi)
    got = {r.exchange_symbol: r for r in quality.coverage(expected, valid, broken, 0, hi).collect()}
    assert got["A"].accepted and got["A"].valid_ratio == "0.999305556" and got["A"].accounted_ratio == "1.000000000"
    assert not got["B"].accepted and got["B"].valid_ns == 0 and got["B"].explicit_invalid_ns == hi - 1000 * S


def test_coverage_of_every_day(spark):
    rng, day = random.Random(5), 100
    table = lambda n: spark.createDataFrame([(rng.choice("AB"), lo, lo + rng.randint(1, 150)) for lo in (rng.randint(0, 1_180) for _ in range(n))], "exchange_symbol string, lo bigint, hi bigint")
    expected, valid, broken = spark.createDataFrame([("A",), ("B",), ("C",)], "exchange_symbol string"), table(20), table(12)
    got = quality.coverage_by_day(expected, valid, broken, 0, 11, day)
    assert got.count() == 36
    for k in (0, 8, 11):  # each as a window of its own, those after the first week too
        alone = quality.coverage(expected, valid, intervals.clip(broken, k * day, (k + 1) * day), k * day, (k + 1) * day)
        assert rows(got.where(got.day == k).select(alone.columns)) == rows(alone)
    assert quality.verdict(got, ["day"]).count() == 12


def test_nine_decimals_round_the_binary_value(spark):
    rng = random.Random(6)
    parts = [21794562216, 83100232152, 0, 1, 43, 44, 86400000000, 43200000000, *(rng.randrange(0, 10**9) * 864 // 10 for _ in range(300)), *(rng.randint(0, 86400000000) for _ in range(300))]
    df = spark.createDataFrame([(n / 86400000000,) for n in parts] + [(1 / 1024,), (2.0**-10 * 3,)], "x double")
    assert all(r.s == f"{r.x:.9f}" for r in df.select("x", nine_decimals(F.col("x")).alias("s")).collect())


def test_state_is_carried_over_every_midnight(spark, tmp_path):
    day = 86_400 * S
    made = spark.read.parquet("/root/testdata/sf0.001/typed_events.parquet").where("stream_type = 'agg_trade' and exchange_symbol is not null and aggregate_trade_id is not null").limit(1).cache()
    times = [k * day + x * S for k in (1, 2, 3) for x in (-60, 60)]  # each midnight is crossed by one message
    df = made.crossJoin(spark.createDataFrame(list(enumerate(times)), "n bigint, at bigint")).withColumn("receive_seq", F.col("n")).withColumn("app_receive_realtime_ns", F.col("at")).drop("n", "at")
    df.write.parquet(f"{tmp_path}/typed_events.parquet")
    got = {r.receive_seq: r.is_duplicate for r in market.dedup_over_midnight(spark, str(tmp_path)).collect()}
    assert got == {n: n % 2 == 1 for n in range(6)}
    assert sorted((r.cut // day, r.carried) for r in market.dedup_carry_checkpoint(spark, str(tmp_path)).collect()) == [(1, 1), (2, 1), (3, 1)]


def test_weakest_metric_decides(spark):
    data = [("A", 100, 100, 100, 100, 1), ("B", 80, 80, 80, 80, 80), ("C", 10, 10, 10, 10, 10)]
    df = spark.createDataFrame(data, "s string, a int, b int, c int, d int, e int")
    got = ranking.by_weakest(df, "s", [(x, True) for x in "abcde"])
    assert [r.s for r in got.orderBy("position").collect()] == ["B", "A", "C"]


def test_blocks_need_every_minute(spark):
    seen = spark.createDataFrame([(m,) for m in [*range(0, 7), *range(9, 15)]], "slot bigint")
    rates = spark.createDataFrame([("A", 1, 5), ("A", 5, 9), ("A", 10, 2), ("B", 13, 4)], "k string, slot bigint, n bigint")
    peaks = traffic.blocks(rates, "k", seen, 3)
    # slot 0, in which the recording started, does not count
    assert rows(peaks) == [("A", 1, 5), ("A", 4, 9), ("A", 9, 2), ("B", 12, 4)]
    assert rows(traffic.effective(peaks, "k", 2)) == [("A", 2), ("B", 4)]


def test_planning_rates_rest_on_a_whole_day(spark):
    def peaks(blocks):
        # an early peak and a symbol that is silent later: both are lost if only the last blocks count
        t = [("A", m * 60 * S) for m in range(60 * blocks + 1)] + [("A", 5 * 60 * S)] * 9 + [("B", 60 * S)]
        rates = traffic.per_slot(spark.createDataFrame(t, "k string, at bigint"), "k", "at").cache()
        return traffic.blocks(rates, "k", rates.select("slot"))

    assert rows(traffic.effective(peaks(24), "k")) == [("A", 10), ("B", 1)]
    assert len(rows(peaks(2))) == 3
    assert not rows(traffic.effective(peaks(23), "k"))  # too few blocks


def plain_swaps(shards, rate, most=None):
    """Every pair of all shards is tried; the one with the smallest spread is made, for as long as the spread falls."""
    n = 0
    while most is None or n < most:
        load = [sum(rate[s] for s in x) for x in shards]
        best, spread = None, max(load) - min(load)
        for a in range(len(shards)):
            for b in range(a + 1, len(shards)):
                for i, x in enumerate(shards[a]):
                    for j, y in enumerate(shards[b]):
                        new = list(load)
                        new[a] += rate[y] - rate[x]
                        new[b] += rate[x] - rate[y]
                        if max(new) - min(new) < spread:
                            best, spread = (a, b, i, j), max(new) - min(new)
        if best is None:
            break
        a, b, i, j = best
        x, y = shards[a].pop(i), shards[b].pop(j)
        shards[a].append(y)
        shards[b].append(x)
        n += 1
    return [sorted(x) for x in shards]


def plain_shards(symbols, rates, count):
    ordered = sorted(rates.values())
    rate = {s: rates.get(s, ordered[len(ordered) // 2] if ordered else 1) for s in symbols}
    count = min(count, len(symbols))
    out = [[] for _ in range(count)]
    for s in sorted(symbols, key=lambda s: (-rate[s], s)):
        free = [i for i in range(count) if len(out[i]) < -(-len(symbols) // count) + 1]
        out[min(free, key=lambda i: (sum(rate[s] for s in out[i]), i))].append(s)
    return plain_swaps(out, rate)


def test_sharding():
    rng = random.Random(5)
    for case in range(60):
        symbols = [f"s{i}" for i in range(rng.randint(1, 14))]
        rates = {s: rng.randint(1, 9 if case % 3 == 0 else 500) for s in symbols if rng.random() < 0.8} | ({"gone": 40} if case % 2 else {})
        count = rng.randint(1, 5)
        got = traffic.shards(symbols, rates, count)
        assert got == plain_shards(symbols, rates, count), (symbols, rates, count)
        if len(got) > 1:
            dealt = [sorted(x) for x in np.array_split(rng.sample(symbols, len(symbols)), len(got))]
            dealt = [[str(s) for s in x] for x in dealt]
            rate = traffic._known(symbols, rates)
            load = [sum(rate[s] for s in x) for x in dealt]
            want = plain_swaps([list(x) for x in dealt], rate, 1) if max(load) * len(load) > 1.25 * sum(load) else dealt
            assert traffic.rebalance(symbols, rates, dealt, count) == want
    # what has a shard stays; no swaps then
    assert traffic.shards(["a", "b", "c"], {"a": 9, "b": 1, "c": 5}, 2, {"a": 0, "b": 0, "z": 1}) == [["a", "b"], ["c"]]
    assert traffic.shards([], {}, 3) == [] and traffic.shards(["x"], {}, 3) == [["x"]]
    with pytest.raises(ValueError):
        traffic.rebalance(["a", "b"], {}, [["a"], ["a"]], 2)
    assert traffic.lanes([("a", 5), ("b", 4), ("c", 3), ("d", 3)], 2) == [["a", "d"], ["b", "c"]]


def test_market_regime_on_a_full_panel(spark):
    def context(recent, symbols=61):
        days = [(f"s{k}", d, float(100 * (recent(k, d) if d >= 28 else 1)), 10 * int(20 * (recent(k, d) if d >= 28 else 1)) // 20) for k in range(symbols) for d in range(35)]
        f = ranking.market_factors(spark.createDataFrame(days, "symbol string, day bigint, volume double, trades bigint"), 35)
        return ranking.market_context(f).first()

    up = context(lambda k, d: 1.5)
    assert (up.state, up.horizon_days, up.panel_count) == ("ACTIVITY_SHIFT_CONFIRMED", 7, 61) and up.volume_factor == Decimal("1.5") and up.trade_breadth == 1
    assert [context(lambda k, d, n=n: 1.5 if d >= 35 - n else 1)[:2] for n in (3, 1)] == [("ACTIVITY_SHOCK_PENDING", 3), ("ACTIVITY_SHOCK_PENDING", 1)]
    assert context(lambda k, d: 0.8)[:2] == ("ACTIVITY_SHIFT_CONFIRMED", 7)  # the limit itself counts, downward too
    assert context(lambda k, d: 1.25 if k < 30 else 1)[:2] == ("NORMAL", 1)
    small = context(lambda k, d: 1.5, 59)
    assert (small.state, small.horizon_days, small.panel_count, small.volume_factor, small.volume_breadth) == ("NORMAL", 0, 59, 1, 0)
    empty = ranking.market_context(spark.createDataFrame([], "symbol string, horizon int, volume_factor decimal(36,18), trade_factor decimal(36,18)")).first()
    assert (empty.state, empty.horizon_days, empty.panel_count) == ("NORMAL", 0, 0)
    # exact to 18 digits
    q = spark.createDataFrame([(Decimal("1"), Decimal("3")), (Decimal("123456789012345678.123456789"), Decimal("0.7")), (Decimal("0"), Decimal("5"))], "a decimal(27,9), b decimal(27,9)")
    with localcontext(prec=60, rounding=ROUND_DOWN):
        assert [r[0] for r in q.select(ranking.quotient(F.col("a"), F.col("b"))).collect()] == [(r.a / r.b).quantize(Decimal("1e-18")) for r in q.collect()]


def test_effective_rates_fall_back(spark):
    rates = spark.createDataFrame([("A", m, m % 7 + 1) for m in range(10)], "k string, slot bigint, n bigint")
    peaks = traffic.blocks(rates, "k", rates.select("slot"), 4)
    assert rows(peaks) == [("A", 1, 5), ("A", 5, 7)]  # minute 0 is where the recording started
    base = spark.createDataFrame([("B", 3)], "k string, rate bigint")
    assert rows(traffic.effective(peaks, "k", 2, base)) == [("A", 7)] and rows(traffic.effective(peaks, "k", 3, base)) == [("B", 3)] and rows(traffic.effective(peaks, "k", 3)) == []
    assert rows(traffic.effective(peaks.limit(0), "k", 2, base)) == [("B", 3)]


def test_conflicts_with_nulls(spark):
    m = spark.createDataFrame([("a", None, 5), ("a", 5, None), ("b", None, 1), ("b", None, 1), ("c", 1, 1), ("c", 1, 2)], "chunk_id string, x int, y int")
    assert rows(manifests.conflicts(m)) == [("a", 2), ("c", 2)]


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("slice_of", [None, 7])
def test_asof(spark, forward, slice_of):
    rng = random.Random(1)
    left = [(rng.choice(["A", "B", None]), rng.choice([None, rng.randint(-40, 80)]), n) for n in range(120)]
    right = [(rng.choice(["A", "B"]), rng.choice([None, rng.randint(-30, 60)]), rng.randint(0, 9)) for _ in range(25)]
    got = asof.asof(spark.createDataFrame(left, "k string, t bigint, n int"), spark.createDataFrame(right, "k string, r bigint, v int"), ["k"], "t", "r", ["v"], forward, ["v"], slice_of)
    want = []
    for k, t, n in left:
        near = [(r, v) for y, r, v in right if y == k and r is not None and t is not None and (r >= t if forward else r <= t)]
        best = (min(near, key=lambda x: (x[0], -x[1])) if forward else max(near)) if near else (None, None)
        want.append((k, t, n, *best))
    assert rows(got) == sorted(want, key=repr)


def test_manifests(spark):
    refs = spark.createDataFrame([("c", "d", "1", "h1"), ("c", "d", "2", "h2"), ("c", "d", "3", "h3")], "collector_id string, utc_date string, chunk_id string, sha256 string")
    known = spark.createDataFrame([("1", "h1", "c", "d"), ("2", "xx", "c", "d")], "chunk_id string, sha256 string, collector_id string, utc_date string")
    assert sorted((r.chunk_id, r.why) for r in manifests.reference_errors(refs, known).collect()) == [("2", "hash"), ("3", "no manifest")]
    acks = spark.createDataFrame([("1", "h1"), ("2", "zz"), ("8", "h8"), ("9", None)], "chunk_id string, sha256 string")
    ready, done = spark.createDataFrame([("1", "h1"), ("2", "h2")], "chunk_id string, sha256 string"), spark.createDataFrame([("8", "h8")], "chunk_id string, sha256 string")
    assert sorted((r.chunk_id, r.outcome) for r in manifests.classify_acks(acks, ready, done).collect()) == [("1", "APPLY"), ("2", "HASH_MISMATCH"), ("8", "REPLAY"), ("9", "UNKNOWN")]
    assert rows(manifests.complete_days(refs, known)) == []


def test_parse_errors_and_schema(spark):
    body = lambda **d: __import__("json").dumps({"data": d}).encode()
    good = dict(e="aggTrade", E=1, T=2, s="a", a=3, p="100", q="1", f=4, l=5, m=True)
    data = [("agg_trade", body(**good)), ("agg_trade", body(**(good | {"p": "0"}))), ("agg_trade", body(**(good | {"m": "x"}))), ("agg_trade", body(**(good | {"e": "trade"}))), ("agg_trade", b"{"), ("agg_trade", None), ("nope", b"{}"), ("market_tickers", b"{}"), ("market_tickers", b"[]"), ("unknown", b"1"), (None, b"{}"), ("clock_sample", b'{"serverTime":5}'), ("open_interest", b'{"symbol":"A","openInterest":"123.45","time":2}')]
    df = spark.createDataFrame([(1, None, s, "c", "b", "g", "x", n, 5, 5, p, None, None) for n, (s, p) in enumerate(data)], schemas.RAW)
    got = {r.receive_seq: r for r in parse.parsed(df).collect()}
    assert {n: r.error for n, r in got.items()} == {0: None, 1: "bad price", 2: "bad buyer_is_maker", 3: "event is not aggTrade", 4: "no JSON", 5: "no JSON", 6: "unknown stream", 7: "no array", 10: "unknown stream", 11: None, 12: "no symbol"}
    assert got[0].exchange_symbol == "A" and got[0].price == "100" and got[0].buyer_is_maker
    assert schemas.require(df.withColumn("more", F.lit(1)), schemas.RAW).columns == schemas.RAW.names
    with pytest.raises(ValueError, match="receive_seq"):
        schemas.require(df.drop("receive_seq"), schemas.RAW)


def test_evidence_files(spark, tmp_path):
    (tmp_path / "i.json").write_text('{"symbols":[{"symbol":"A","contractType":"PERPETUAL","status":"TRADING","quoteAsset":"USDT","marginAsset":"USDT","onboardDate":5}]}')
    assert evidence.instruments(spark, f"{tmp_path}/i.json").first().symbol == "A"
    (tmp_path / "k.json").write_text('{"window_start_ms":0,"window_end_exclusive_ms":172800000,"symbols":{"A":{"payload":[[0,"1","1","1","1","2",86399999,"7.5",3],[172800000,"1","1","1","1","2",259199999,"1",1]]}}}')
    assert rows(evidence.daily_bars(spark, f"{tmp_path}/k.json").select("symbol", "open_ms", "trades", "complete")) == [("A", 0, 3, True), ("A", 172800000, 1, False)]
    (tmp_path / "d.json").write_text('{"book_tickers":[{"sample":0,"payload":[{"symbol":"A","bidPrice":"99.99","askPrice":"100.01"}]}],"symbols":{"A":[{"payload":{"bids":[["99.99","1000"]],"asks":[["100.01","1000"]]}}]}}')
    assert float(evidence.ticker_spreads(spark, f"{tmp_path}/d.json").first().spread_bps) == pytest.approx(2.0)
    assert ranking.band_depth(evidence.book_levels(spark, f"{tmp_path}/d.json"), ["symbol", "sample"], 10).first()["depth_10bps"] == Decimal(99990)


def test_gap_journal_and_constraints(spark):
    cols = "gap_id string, state string, reason string, observed_at_realtime_ns bigint, affected_from_realtime_ns bigint"
    facts = spark.createDataFrame([("gap-00001", "OPEN", "CONNECTION_LOST_GAP", 5, 3), ("gap-00001", "CLOSED", "CONNECTION_LOST_GAP", 9, None), ("gap-00002", "OPEN", "L2_SEQUENCE_GAP", 7, None), ("bad", "WHAT", None, None, 3), ("gap-00003", "CLOSED", "L2_SEQUENCE_GAP", 1, 2)], cols)
    assert [r.gap_id for r in quality.open_gaps(facts).collect()] == ["gap-00002"]
    got = sorted((r.gap_id, r.rule) for r in quality.gap_violations(facts).collect())
    assert got == [("bad", "gap_id"), ("bad", "observed_at"), ("bad", "reason"), ("bad", "state"), ("gap-00003", "affected_after_observed"), ("gap-00003", "closing_with_start")]


def test_minute_tiers(spark):
    data = [(m, s, not (day == 1 and m % 1440 in (5, 6, 7, 8)) and not (day == 0 and m == 9 and s == "A")) for day in (0, 1) for m in range(day * 1440, day * 1440 + 1440) for s in "AB"]
    got = {r.utc_day: r for r in quality.minute_tiers(spark.createDataFrame(data, "minute bigint, exchange_symbol string, ok boolean"), 2, 2).collect()}
    assert got[0].tier == "99.9" and got[0].longest_bad == 1 and got[1].tier == "none" and got[1].longest_bad == 4


def test_day_bookkeeping(spark):
    sym = spark.createDataFrame([("A",), ("B",), (None,)], "exchange_symbol string")
    have = spark.createDataFrame([("A", 1), ("A", 2), ("B", 2), ("C", 1)], "exchange_symbol string, day bigint")
    assert rows(manifests.missing_days(have, sym, 1, 2)) == [("B", 1)] and not manifests.missing_days(have, sym, 3, 2).count()
    h = "a" * 64
    cols = "chunk_id string, sha256 string, data_path string, size_bytes bigint, event_count bigint, min_app_receive_realtime_ns bigint, max_app_receive_realtime_ns bigint, data_contract_hash string, universe_hash string"
    m = spark.createDataFrame([("chunk-001", h, "date=1/writer=x/a.parquet", 1, 1, 1, 2, h, h), ("x", "q", "../a", 0, None, 3, 2, h, None)], cols)
    assert sorted(r.rule for r in manifests.manifest_violations(m).collect()) == sorted(["chunk_id", "sha256", "data_path", "size_bytes", "event_count", "range", "universe_hash"])
    p = spark.createDataFrame([("r", "c", "d1", "h"), ("r", "c", "d1", "h"), ("r", "c", "d2", "h"), ("r", "c", "d2", "i")], "release_id string, collector_id string, utc_date string, sealed_sha256 string")
    assert sorted((r.utc_date, r.conflict) for r in manifests.pins(p).collect()) == [("d1", False), ("d2", True)]
    days = spark.createDataFrame([("d1",), ("d2",), ("d3",)], "utc_date string")
    sealed, norm = spark.createDataFrame([("d1",), ("d2",)], "utc_date string"), spark.createDataFrame([("d1",)], "utc_date string")
    books = spark.createDataFrame([("d1", "A"), ("d2", "A"), ("d2", "B")], "utc_date string, exchange_symbol string")
    assert sorted((r.utc_date, r.state) for r in manifests.progress(days, {"sealed": sealed, "normalized": norm, "books": books}, 2).collect()) == [("d1", "normalized"), ("d2", "sealed"), ("d3", "missing")]
    off, dur = spark.createDataFrame([("1", "a"), ("2", "b")], "chunk_id string, sha256 string"), spark.createDataFrame([("1", "a"), ("2", "x")], "chunk_id string, sha256 string")
    assert rows(manifests.not_durable(off, dur)) == [("2", "b")]


def test_every_stream_is_typed(spark):
    """One message of each stream, wrapped and bare, with every column it sets; and what breaks each kind of field."""
    dumps = __import__("json").dumps
    order = {"s": "a", "S": "SELL", "o": "LIMIT", "f": "IOC", "q": "1.50", "p": "0", "ap": "0.0", "X": "NEW", "l": "0.00000000", "z": "1e3", "T": 8}
    depth = {"e": "depthUpdate", "E": 1, "T": 2, "s": "a", "U": 3, "u": 4, "pu": 2, "b": [["1", "0.000", "x"], [" 2 ", "0.00000001"]], "a": []}
    snap = {"lastUpdateId": 9, "bids": [["1.10", "2"]], "asks": [["3", "4"]], "s": "a"}
    trade = {"e": "trade", "E": 1, "T": 2, "s": "a", "t": 5, "p": "+7", "q": "1_000", "m": False}
    lev = lambda *x: [(p, q) for p, q in x]
    both = {"bids": lev(("1", "0.000"), ("2", "1E-8")), "asks": []}
    said = {
        "depth": (depth, {"exchange_event_time_ms": 1, "exchange_transaction_time_ms": 2, "first_update_id": 3, "final_update_id": 4, "previous_final_update_id": 2} | both),
        "rpi_depth": (depth, {"exchange_event_time_ms": 1, "exchange_transaction_time_ms": 2, "first_update_id": 3, "final_update_id": 4, "previous_final_update_id": 2} | both),
        "depth_snapshot": (snap, {"last_update_id": 9, "bids": lev(("1.10", "2")), "asks": lev(("3", "4"))}),
        "rpi_depth_snapshot": (snap | {"E": 5, "T": "6"}, {"exchange_event_time_ms": 5, "exchange_transaction_time_ms": 6, "last_update_id": 9, "bids": lev(("1.10", "2")), "asks": lev(("3", "4"))}),
        "book_ticker": ({"e": "bookTicker", "u": 7, "s": "a", "b": "1.0", "B": "0", "a": "1.1", "A": "5", "T": 2, "E": 1}, {"exchange_event_time_ms": 1, "exchange_transaction_time_ms": 2, "update_id": 7, "bid_price": "1.0", "bid_quantity": "0", "ask_price": "1.1", "ask_quantity": "5"}),
        "agg_trade": ({"e": "aggTrade", "E": 1, "T": 2, "s": "a", "a": 3, "p": "1", "q": "2", "nq": "0", "f": 4, "l": 5, "m": True}, {"exchange_event_time_ms": 1, "exchange_transaction_time_ms": 2, "aggregate_trade_id": 3, "first_trade_id": 4, "last_trade_id": 5, "price": "1", "quantity": "2", "non_rpi_quantity": "0", "buyer_is_maker": True}),
        "trade": (trade, {"exchange_event_time_ms": 1, "exchange_transaction_time_ms": 2, "trade_id": 5, "price": "7", "quantity": "1000", "buyer_is_maker": False}),
        "mark_price": ({"e": "markPriceUpdate", "E": 1, "s": "a", "p": "2", "i": "3", "P": "0", "r": "-0.00000017", "T": 4}, {"exchange_event_time_ms": 1, "mark_price": "2", "index_price": "3", "estimated_settle_price": "0", "funding_rate": "-1.7E-7", "next_funding_time_ms": 4}),
        "force_order": ({"e": "forceOrder", "E": 1, "o": order}, {"exchange_event_time_ms": 1, "exchange_transaction_time_ms": 8, "side": "SELL", "order_type": "LIMIT", "time_in_force": "IOC", "order_status": "NEW", "price": "0", "quantity": "1.50", "average_price": "0.0", "last_filled_quantity": "0E-8", "accumulated_filled_quantity": "1E+3"}),
        "contract_info": ({"e": "contractInfo", "E": 1, "s": "a", "ct": "PERPETUAL", "dt": 2, "ot": 3, "cs": "TRADING"}, {"exchange_event_time_ms": 1, "contract_type": "PERPETUAL", "delivery_date_ms": 2, "onboard_date_ms": 3, "contract_status": "TRADING"}),
        "open_interest": ({"symbol": "a", "openInterest": "12.5", "time": 6, "s": "a"}, {"exchange_event_time_ms": 6, "open_interest": "12.5"}),
        "clock_sample": ({"serverTime": 5}, {"exchange_event_time_ms": 5}),
    }
    broken = [
        ("depth", depth | {"b": [["1"]]}, "bad bids"), ("depth", depth | {"a": [["1", "-1"]]}, "bad asks"), ("depth", depth | {"a": None}, "bad asks"), ("depth", {k: v for k, v in depth.items() if k != "pu"}, "bad previous_final_update_id"),
        ("depth", depth | {"b": [["0", "1"]]}, "bad bids"), ("depth", depth | {"E": True}, "bad exchange_event_time_ms"), ("depth_snapshot", snap | {"E": "x"}, "bad exchange_event_time_ms"), ("trade", trade | {"p": "0.0"}, "bad price"), ("trade", trade | {"q": "NaN"}, "bad quantity"),
        ("trade", trade | {"m": "no"}, "bad buyer_is_maker"), ("agg_trade", said["agg_trade"][0] | {"nq": "-1"}, "bad non_rpi_quantity"), ("mark_price", said["mark_price"][0] | {"i": "-3"}, "bad index_price"), ("force_order", {"e": "forceOrder", "E": 1, "s": "a"}, "bad exchange_transaction_time_ms"),
        ("contract_info", {k: v for k, v in said["contract_info"][0].items() if k != "cs"}, "bad contract_status"), ("trade", {"data": None}, "no object"), ("trade", {"data": [1]}, "no object"), ("trade", trade | {"s": ""}, "no symbol"),
    ]
    data, want = [], {}
    for stream, (payload, columns) in said.items():
        for body in (payload, {"stream": "x", "data": payload}):
            want[len(data)] = (stream, None, columns, payload)
            data.append((stream, dumps(body).encode()))
    for stream, body, why in broken:
        want[len(data)] = (stream, why, None, None)
        data.append((stream, dumps(body).encode()))
    df = spark.createDataFrame([(1, None, s, "c", "b", "g", "x", n, 5, 5, p, None, None) for n, (s, p) in enumerate(data)], schemas.RAW)
    got = {r.receive_seq: r for r in parse.parsed(df).collect()}
    assert len(got) == len(data)
    for n, (stream, why, columns, payload) in want.items():
        r = got[n].asDict(recursive=True)
        assert r["error"] == why, (n, stream, r["error"], why)
        if why is None:
            told = {k: [(x["price"], x["quantity"]) for x in v] if k in ("bids", "asks") else v for k, v in r.items() if v is not None and k not in ("schema_version", "exchange_symbol", "stream_type", "connection_id", "receive_seq", "app_receive_realtime_ns", "app_receive_monotonic_ns", "payload_hash", "is_duplicate")}
            assert told == columns, (stream, told)
            assert r["exchange_symbol"] == (None if stream == "clock_sample" else "A")
            assert bytes(r["payload_hash"]) == __import__("hashlib").sha256(dumps(payload, sort_keys=True, separators=(",", ":")).encode()).digest(), stream
