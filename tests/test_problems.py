"""The feed operators of problems 1 to 4 and 6 against plain Python on small, dirty random tables."""

import random
from collections import defaultdict
from decimal import Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes, exactly_once, late, quality, rolling, skew

LEV = "array<struct<price:string,quantity:string>>"
BOOK = f"exchange_symbol string, connection_id string, stream_type string, receive_seq bigint, first_update_id bigint, final_update_id bigint, previous_final_update_id bigint, last_update_id bigint, bids {LEV}, asks {LEV}"
CLASH = {"seq": 1, "op": "x", "side": "y", "price_e8": "z", "number": 2, "block": 3, "symbol": "s", "ns": 4, "day": "d", "age": 5, "anchor": 6, "until": 7, "n": 8, "minute_ms": "m", "batch": 1, "stage": 1}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def clash(df):
    return df.withColumns({k: F.lit(v) for k, v in CLASH.items() if k not in df.columns})


# -- 1


def e8(x):
    try:
        return int((Decimal(x) * 10**8).quantize(Decimal(1))) if x is not None else None
    except InvalidOperation:
        return None


def brute_books(data):
    out = []
    books = defaultdict(list)
    for r in data:
        if r[0] is not None and r[1] is not None:
            books[r[0], r[1]].append(r)
    for (s, c), rs in books.items():
        snaps = [r for r in rs if r[2] == "depth_snapshot" and r[7] is not None]
        if not snaps:
            continue
        last = max(r[7] for r in snaps)
        msgs = {}
        for r in sorted(rs, key=lambda r: -r[3]):
            if r[2] == "depth" and None not in r[4:7] and r[5] >= last:
                msgs[r[5]] = r
        chain = [msgs[k] for k in sorted(msgs)]
        if not chain or chain[0][4] > last:
            continue
        use = [max((r for r in snaps if r[7] == last), key=lambda r: r[3])]
        for i, m in enumerate(chain):
            if i and m[6] != chain[i - 1][5]:
                break
            use.append(m)
        for side, k in (("bid", 8), ("ask", 9)):
            book = {}
            for r in use:
                for p, q in r[k] or []:
                    if e8(p) is not None and e8(q) is not None:
                        book[e8(p)] = e8(q)
            out += [(s, c, side, p, q) for p, q in book.items() if q > 0]
    return sorted(out, key=repr)


def random_books(seed):
    rng = random.Random(seed)
    data = []
    num = lambda x: rng.choice([f"{x:.2f}", f"{x:.4f}", f"{x:.1f}0"])
    for s in ("A", "B", None):
        for c in ("c1", "c2", "c3"):
            u = 100
            msgs = []
            levels = lambda: rng.choice([None, [], [(num(rng.randint(1, 9)), rng.choice(["0", "0E-8", "0.00", num(rng.randint(1, 5)), "x", None])) for _ in range(rng.randint(1, 4))]])
            for _ in range(rng.randint(0, 25)):
                first, last = u + rng.choice([0, 1]), u + rng.randint(1, 5)
                msgs.append((s, c, "depth", 0, first, last, u if rng.random() < 0.97 else u - 1, None, levels(), levels()))
                u = last
            for _ in range(rng.randint(0, 3)):
                msgs.append((s, c, "depth_snapshot", 0, None, None, None, rng.choice([None, 95, 101, 105, 110, u, u + 9]), levels(), levels()))
            msgs += [m for m in msgs if rng.random() < 0.2]
            msgs.append((s, c, "depth", 0, None, u + 1, u, None, [("1", "1")], None))
            msgs.append((s, c, "rpi_depth", 0, u, u + 1, u, None, [("77", "1")], None))
            rng.shuffle(msgs)
            data += [(*m[:3], i, *m[4:]) for i, m in enumerate(msgs)]
    return data


@pytest.mark.parametrize("seed", range(4))
def test_books(spark, seed):
    data = random_books(seed)
    assert rows(changes.final_books(clash(spark.createDataFrame(data, BOOK)))) == brute_books(data)


def test_books_across_blocks(spark):
    """Chains that are cut into many blocks break where whole ones do."""
    data = [("A", "c", i * 3, i * 3 + 2, i * 3 - 1 if i != 40 else 7) for i in range(1, 60)]
    spans = spark.createDataFrame(data, "k string, c string, f bigint, l bigint, p bigint")
    anchors = spark.createDataFrame([("A", "c", 4), ("B", "c", 1)], "k string, c string, a bigint")
    got = changes.chains(spans, anchors, ["k", "c"], "f", "l", "p", "a", span=10, salts=3)
    assert rows(got) == [("A", "c", 4, 122)]


def test_last_writer(spark):
    feed = [("k", 1, "insert", "a", None), ("k", 5, "update", None, "x"), ("k", 3, "delete", None, None), ("k", 4, "update", "b", None), ("k", 4, "update", "b", None),
            ("gone", 1, "insert", "a", "b"), ("gone", 9, "delete", None, None), ("new", 2, "update", "old", "old"), ("new", 7, "replace", None, "n"), ("z", None, "insert", "a", "a"), (None, 1, "insert", "q", None), ("t", 5, "delete", None, None), ("t", 5, "update", "w", None)]
    df = spark.createDataFrame(feed, "k string, s bigint, o string, f string, g string")
    assert rows(changes.last_writer(df, ["k"], "s", "o", ["f", "g"])) == [("k", "b", "x"), ("new", None, "n"), (None, "q", None)]


# -- 2

RAW = "exchange_symbol string, segment_id string, connection_id string, receive_seq bigint, app_receive_realtime_ns bigint, payload_bytes binary"


@pytest.mark.parametrize("seed", range(3))
def test_blocks_of_skewed_keys(spark, seed):
    rng = random.Random(seed)
    data = []
    for i in range(600):
        y = rng.choice(["HOT"] * 6 + ["b", "C", None, None])
        body = rng.choice([b'{"data":{"s":"hot"}}', b'{"data":{"o":{"s":"c"}}}', b'{"data":{"s":', b"", None])
        data.append((y, rng.choice(["s1", "s2"]), f"c{rng.randint(1, 3)}", i, rng.randint(1, 90), body))
    data += [d for d in data if rng.random() < 0.1]
    rates = [("HOT", 7), ("B", 2), ("C", 0), ("NEVER", 3), (None, 4), ("D", None)]
    one = {}
    for y, seg, c, q, ns, body in data:
        y = y or {b'{"data":{"s":"hot"}}': "HOT", b'{"data":{"o":{"s":"c"}}}': "C"}.get(body)
        if y:
            one[c, q] = (seg, y.upper(), ns)
    groups = defaultdict(list)
    for (c, q), (seg, y, ns) in one.items():
        groups[seg, y].append((ns, c, q))
    want = sorted((y, c, q, n, (n - 1) // dict(rates)[y] + 1) for (seg, y), ms in groups.items() if (dict(rates).get(y) or 0) >= 1 for n, (_, c, q) in enumerate(sorted(ms), 1))
    got = skew.message_blocks(clash(spark.createDataFrame(data, RAW)), spark.createDataFrame(rates, "exchange_symbol string, message_rate bigint"))
    assert sorted(map(tuple, got.select("symbol", "connection_id", "receive_seq", "number", "block").collect())) == want


def test_numbers_are_whole_over_many_partitions(spark):
    df = spark.range(5_000).select(F.when(F.col("id") % 3 == 0, None).otherwise("h").alias("k"), (F.col("id") * 7919 % 5003).alias("o"))
    got = skew.number_in_order(df, ["k"], ["o"], partitions=13).groupBy("k").agg(F.min("number"), F.max("number"), F.count_distinct("number"), F.count("*"))
    assert rows(got) == sorted([("h", 1, 3333, 3333, 3333), (None, 1, 1667, 1667, 1667)], key=repr)


# -- 3

BARS = "exchange_symbol string, open_ms bigint, quote_volume string, trades bigint, request_realtime_ns bigint"


@pytest.mark.parametrize("seed", range(3))
def test_trailing(spark, seed):
    rng = random.Random(seed)
    data = []
    for s in ("A", "B", "C", None):
        base = rng.choice([-20, 0, 19_000])
        for d in range(0, rng.choice([1, 40, 95])):
            for _ in range(rng.choice([0, 1, 1, 2])):
                data.append((s, (base + d) * rolling.DAY_MS, rng.choice([None, "0E-8", f"{rng.randint(0, 400)}.5", "bad"]), rng.choice([None, 0, rng.randint(1, 50)]), rng.choice([None, rng.randint(1, 9)])))
    data += [("A", None, "1", 1, 1)]
    rng.shuffle(data)
    best = {}
    low = lambda v: (v is not None, v if v is not None else 0)
    num = lambda q: None if q in (None, "bad") else Decimal(q)
    for s, t, q, n, r in data:
        if s is not None and t is not None:
            k, v = (s, t // rolling.DAY_MS), (low(r), low(num(q)), low(n))
            best[k] = max(best.get(k, v), v)
    want = []
    for s in {k[0] for k in best}:
        days = [d for y, d in best if y == s]
        for d in range(min(days), max(days) + 1):
            at = lambda w, i: sum(best[s, x][i][1] for x in range(d - w + 1, d + 1) if (s, x) in best)  # noqa: B023, E731
            want.append((s, d, d - min(days), *[Decimal(at(w, i)) for w in (7, 30) for i in (1, 2)]))
    got = rolling.activity_days(clash(spark.createDataFrame(data, BARS))).select("exchange_symbol", "day", "age", *[f"{m}_sum_{w}" for w in (7, 30) for m in ("quote_volume", "trades")])
    assert sorted(map(tuple, got.collect())) == sorted(want)


# -- 4 and 6


def typed(spark, seed, tmp_path, n=500):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        stream = rng.choice(["agg_trade", "agg_trade", "trade", "depth", "rpi_depth", "book_ticker", "mark_price", "force_order", "contract_info", "open_interest"])
        few = lambda k: rng.choice([None, *range(k), *range(k)])
        data.append((stream, rng.choice(["A", "B", None]), f"c{rng.randint(1, 3)}", i, 10**9 * (120 + rng.randint(-70, 700)), few(3), few(2), few(3), few(2), few(2), few(8), few(8), few(4), rng.choice([b"a", b"b", None]), rng.choice(["1.5", "2", None, "x"]), rng.choice(["1", "0.25", None])))
    # one message with a third of all rows
    data += [("agg_trade", "A", "hot", i, 10**9 * 500 + i, None, None, None, None, None, None, None, 77, None, "1", "1") for i in range(n // 2)]
    cols = "stream_type string, exchange_symbol string, connection_id string, receive_seq bigint, app_receive_realtime_ns bigint, exchange_event_time_ms bigint, exchange_transaction_time_ms bigint, first_update_id bigint, final_update_id bigint, previous_final_update_id bigint, update_id bigint, trade_id bigint, aggregate_trade_id bigint, payload_hash binary, price string, quantity string"
    at = str(tmp_path / "typed")
    clash(spark.createDataFrame(data, cols)).repartition(3).write.parquet(at)
    names = [c.split()[0] for c in cols.split(", ")]
    return at, [dict(zip(names, r, strict=True)) for r in data]


def duplicates(data):
    seen, lost = set(), set()
    for r in sorted(data, key=lambda r: (r["app_receive_realtime_ns"], r["connection_id"], r["receive_seq"])):
        ids = exactly_once.IDENTITY.get(r["stream_type"])
        key = ids and (r["stream_type"], r["exchange_symbol"], *[r[c] for c in ids])
        if not ids or None in key:
            continue
        if key in seen:
            lost.add((r["connection_id"], r["receive_seq"]))
        seen.add(key)
    return lost


@pytest.mark.parametrize("seed", range(2))
def test_exactly_once(spark, seed, tmp_path, monkeypatch):
    at, data = typed(spark, seed, tmp_path)
    monkeypatch.setattr(exactly_once, "HOT_SHARE", 1 / 4)
    lost = duplicates(data)
    assert set(map(tuple, exactly_once.removed(spark, at).collect())) == lost
    kept = exactly_once.deduplicated(spark, at)
    assert kept.columns == spark.read.parquet(at).columns
    assert sorted((r.connection_id, r.receive_seq) for r in kept.collect()) == sorted({(r["connection_id"], r["receive_seq"]) for r in data} - lost)


def test_vectors_by_groups_of_files(spark, tmp_path, monkeypatch):
    at, data = typed(spark, 5, tmp_path)
    monkeypatch.setattr(exactly_once, "VECTOR_BYTES", 512)
    for got, want in ((exactly_once.removed(spark, at), duplicates(data)), (exactly_once.deduplicated(spark, at, ["connection_id", "receive_seq"]), {(r["connection_id"], r["receive_seq"]) for r in data} - duplicates(data))):
        # each group is written before the next: no vectors are left in what is read
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString() and len(got.inputFiles()) >= 2
        assert set(map(tuple, got.collect())) == want


@pytest.mark.parametrize("room", [1 << 20, 1 << 9, 1])
def test_many_repeated_identities_are_joined(spark, tmp_path, monkeypatch, room):
    """Beyond what may be broadcast: by bitmap and shuffle, or by shuffle alone."""
    at, data = typed(spark, 7, tmp_path)
    monkeypatch.setattr(exactly_once, "FEW", 0)
    monkeypatch.setattr(exactly_once, "HOT_SHARE", 1 / 4)
    monkeypatch.setattr(exactly_once, "VECTOR_BYTES", room)
    key, has = exactly_once.identity()
    lost = exactly_once.losers(exactly_once.with_position(spark, at), key, has, ["app_receive_realtime_ns", "connection_id", "receive_seq"])
    assert sorted((r.connection_id, r.receive_seq) for r in lost.collect()) == sorted(duplicates(data))


def test_ties_and_null_times(spark, tmp_path):
    cols = "stream_type string, exchange_symbol string, connection_id string, receive_seq bigint, app_receive_realtime_ns bigint, trade_id bigint"
    data = [("trade", "A", "b", 1, 5, 1), ("trade", "A", "a", 9, 5, 1), ("trade", "A", "a", 7, 5, 1), ("trade", "A", "c", 1, None, 1), ("trade", "A", "x", 1, None, 2), ("trade", "A", "w", 1, None, 2), ("trade", "A", "z", 1, 3, 3)]
    at = f"{tmp_path}/t"
    src = spark.createDataFrame(data, cols)
    for c in ("exchange_event_time_ms", "exchange_transaction_time_ms", "first_update_id", "final_update_id", "previous_final_update_id", "update_id", "aggregate_trade_id"):
        src = src.withColumn(c, F.lit(None).cast("bigint"))
    src.withColumn("payload_hash", F.lit(None).cast("binary")).repartition(3).write.parquet(at)
    assert sorted(map(tuple, exactly_once.removed(spark, at).collect())) == [("a", 9), ("b", 1), ("c", 1), ("x", 1)]


def test_file_numbers(spark):
    names = ["file:///a/b c.parquet", "s3a://bucket/x/part-0.parquet", "hdfs://n:8020/ä"]
    got = spark.createDataFrame([(n,) for n in names], "f string").select(exactly_once._file("f")).collect()
    assert [r[0] for r in got] == [exactly_once._number(n) for n in names]


def test_figures_beyond_ten_digits(spark):
    data = [("A", 0, 0, 0, "123456789012.5", "2"), ("A", 0, 0, 0, "0.00000001", "123456789012345678"), ("A", 0, 0, 0, "x", "1"), ("A", 0, 0, 0, "3", "0.00000001")]
    df = spark.createDataFrame(data, "exchange_symbol string, exchange_transaction_time_ms bigint, exchange_event_time_ms bigint, app_receive_realtime_ns bigint, price string, quantity string")
    r = late.partials(df).first()
    assert r.trades == 4 and r.unread == 1 and r.quantity == Decimal("123456789012345681.00000001") and r.notional == Decimal("246913578025") + Decimal("1234567890.12345678").quantize(Decimal("1e-6")) + Decimal("3E-8")
    rows_ = df.select(F.lit("trade").alias("stream_type"), F.lit(False).alias("is_duplicate"), "price", "quantity", F.lit(None).cast("string").alias("non_rpi_quantity"), F.array().alias("bids"), F.array().alias("asks"))
    assert quality.audit(rows_).first().quantity == r.quantity


def test_books_keep_large_ids_and_numbers(spark):
    """Ids, receive numbers and values far beyond what was packed into one number before."""
    big = (1 << 62) + 5
    lev = lambda *x: [dict(price=p, quantity=q) for p, q in x]
    data = [
        ("A", "c", "depth_snapshot", big, None, None, None, big, lev(("92233720368547", "3")), lev()),
        ("A", "c", "depth", 10**15 + 1, big, big + 1, big, None, lev(("5", "1")), lev()),
        ("A", "c", "depth", 10**13, big, big + 1, big, None, lev(("5", "2")), lev()),  # the same message, received first
    ]
    cols = "exchange_symbol string, connection_id string, stream_type string, receive_seq bigint, first_update_id bigint, final_update_id bigint, previous_final_update_id bigint, last_update_id bigint, bids array<struct<price:string,quantity:string>>, asks array<struct<price:string,quantity:string>>"
    got = sorted((r.price_e8, r.quantity_e8) for r in changes.final_books(spark.createDataFrame(data, cols)).collect())
    assert got == [(5 * 10**8, 2 * 10**8), (92233720368547 * 10**8, 3 * 10**8)]


def test_hot_group_is_broadcast_not_shuffled(spark, tmp_path, monkeypatch):
    at, data = typed(spark, 6, tmp_path, 4_000)
    assert len(duplicates(data)) > 2_000  # above the least size of a hot group
    assert set(map(tuple, exactly_once.removed(spark, at).collect())) == duplicates(data)


def test_late_corrections(spark, tmp_path):
    at, data = typed(spark, 3, tmp_path)
    lost = duplicates(data)
    want = defaultdict(lambda: [0, 0, 0])
    for r in data:
        t = r["exchange_transaction_time_ms"] if r["exchange_transaction_time_ms"] is not None else r["exchange_event_time_ms"]
        if r["stream_type"] != "agg_trade" or r["exchange_symbol"] is None or t is None or (r["connection_id"], r["receive_seq"]) in lost:
            continue
        m = t // 60_000 * 60_000
        late_ns = r["app_receive_realtime_ns"] - (m + 60_000) * 10**6
        want[r["exchange_symbol"], m][0 if late_ns < 2 * 10**9 else 1 if late_ns < 300 * 10**9 else 2] += 1
    store = late.trade_minutes(spark, at)
    got = {(r.exchange_symbol, r.minute_ms): [r.first_trades, r.corrections, r.refused_trades] for r in late.revisions(store).collect()}
    assert got == dict(want)
    raw = late.partials(exactly_once.deduplicated(spark, at, streams=["agg_trade"]))
    parts = [late.merge(raw.where("batch % 3 = 0")), raw.where("batch % 3 = 1"), raw.where("batch % 3 = 2")]
    assert rows(late.revisions(late.merge(*parts))) == rows(late.revisions(store))
    assert {(r[0], r[1], r[2]) for r in late.outcomes(store).collect()} == {(*k, o) for k, v in want.items() for o, n in (("corrected", v[1]), ("incomplete", v[2])) if n}


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], BOOK)
    assert not changes.final_books(none).count()
    assert not skew.message_blocks(spark.createDataFrame([], RAW), spark.createDataFrame([], "exchange_symbol string, message_rate bigint")).count()
    assert not rolling.surges(spark.createDataFrame([], BARS)).count()
    at, _ = typed(spark, 1, tmp_path, 0)
    assert not exactly_once.removed(spark, at).count() and not late.outcomes(late.trade_minutes(spark, at)).count()
