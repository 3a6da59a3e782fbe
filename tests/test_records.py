"""Guards, states and lists that SQL has no data for."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import numbers, text
from tidemark.operators import manifests, quality, traffic
from tidemark.sources import evidence


def test_strict_numbers(spark):
    values = ["5", "0", "-1", "true", "1.0", "1.5", '"7"', "null", '"inf"', '"x"', "1e400", '"0.00000001"']
    df = spark.createDataFrame([(v,) for v in values], "j string").withColumn("v", F.try_parse_json("j"))
    got = {r.j: (r.w, r.w1, None if r.d is None else float(r.d), None if r.z is None else float(r.z)) for r in df.select("j", numbers.strict_whole(F.col("v")).alias("w"), numbers.strict_whole(F.col("v"), 1).alias("w1"), numbers.strict_decimal(F.col("v")).alias("d"), numbers.strict_decimal(F.col("v"), True).alias("z")).collect()}
    assert got["5"] == (5, 5, 5.0, 5.0) and got["0"] == (0, None, None, 0.0) and got["-1"] == (None, None, None, None)
    assert got["true"] == (None,) * 4 and got["null"] == (None,) * 4 and got['"inf"'] == (None,) * 4 and got['"x"'] == (None,) * 4 and got["1e400"] == (None,) * 4
    assert got["1.5"] == (None, None, 1.5, 1.5) and got['"7"'] == (None, None, 7.0, 7.0) and got['"0.00000001"'][2] == 1e-8


def test_saved_traffic_is_whole_or_nothing():
    good = {"version": 1, "blocks": [{"start_minute": 60 * i, "end_minute": 60 * i + 59, "rates": {"A": i + 1}} for i in range(30)]}
    got = traffic.load_blocks(json.dumps(good))
    assert len(got) == 24 and got[-1]["start_minute"] == 29 * 60 and traffic.load_blocks(json.dumps({"version": 1, "blocks": []})) == []
    for broken in ({"version": 2, "blocks": good["blocks"]}, {"version": 1}, [], {"version": 1, "blocks": [{"start_minute": 0, "end_minute": 58, "rates": {}}]}, {"version": 1, "blocks": good["blocks"][:2][::-1]}, {"version": 1, "blocks": [{"start_minute": 0, "end_minute": 59, "rates": {"a": 1}}]}, {"version": 1, "blocks": [{"start_minute": 0, "end_minute": 59, "rates": {"A": True}}]}, {"version": 1, "blocks": [{"start_minute": 0, "end_minute": 59, "rates": {"A": 0}}]}):
        assert traffic.load_blocks(json.dumps(broken)) == []
    assert traffic.load_blocks(None) == [] and traffic.load_blocks("{") == []


def test_rasters():
    assert traffic.offsets(4, 60) == [0, 15, 30, 45]
    assert traffic.next_deadline(10, 5, 12) == 15 and traffic.next_deadline(10, 5, 15) == 20 and traffic.next_deadline(10, 5, 31) == 35 and traffic.next_deadline(10, 5, 3) == 15


def test_lists_of_symbols():
    assert text.symbol_list([" btcusdt", "ÄU"], 2) == ["BTCUSDT", "ÄU"]
    for names, count in ((["A", "a"], None), (["A-B"], None), ([""], None), (["A"], 2)):
        with pytest.raises(ValueError):
            text.symbol_list(names, count)


def test_open_silence(spark):
    df = spark.createDataFrame([("a", 0), ("a", 5), ("a", 30), ("b", 100), (None, 3), ("c", None)], "k string, t bigint")
    assert sorted(map(tuple, quality.liveness(df, "k", "t", 10, 45).collect()), key=repr) == [("a", 30, None), ("a", 5, 30)]
    assert not quality.liveness(df.limit(0), "k", "t", 10, None).count()


def test_equal_lists(spark):
    df = lambda *x: spark.createDataFrame([(v,) for v in x], "s string")
    assert tuple(manifests.same_members(df("a", "b", "b", None), df("b", "a"), "s").first()) == (0, 0, True)
    assert tuple(manifests.same_members(df("a"), df("b", "c"), "s").first()) == (1, 2, False)


def test_samples_of_liquidity(spark, tmp_path):
    book = lambda q: {"payload": {"bids": [["99.99", q], ["99.6", "10"]], "asks": [["100.01", "7"], ["100.4", "10"]]}}
    ticks = lambda n: [{"sample": i, "payload": [{"symbol": "A", "bidPrice": "99.99", "askPrice": "100.01"}]} for i in range(n)]
    (tmp_path / "d.json").write_text(json.dumps({"book_tickers": ticks(21), "symbols": {"A": [book("5"), book("3"), book("9")], "B": [book("1")]}}))
    got = {r.symbol: r for r in evidence.liquidity(spark, f"{tmp_path}/d.json").collect()}
    assert got["A"].complete and float(got["A"].thin_depth_10bps) == pytest.approx(299.97) and float(got["A"].thin_depth_50bps) == pytest.approx(299.97 + 996)
    assert not got["B"].complete and got["B"].ticker_samples == 0 and got["B"].spread_q95_bps is None
