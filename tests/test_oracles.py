"""Every core query beside its SQL on the smallest tables, and on tables without rows."""

import pytest

import oracle_check
from tidemark.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, con, name):
    said = oracle_check.compare(spark, con, SF, name)
    assert said.startswith(("ok", "rows-only")), said


def test_every_query_of_a_relation_has_sql():
    without = set(registry.queries()) - set(registry.oracle_sql())
    assert without == {"shard_balance", "lane_balance", "swap_balance"}  # plans made on the driver, tested against a plain version


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("empty")
    for t in ("typed_events", "l2_projection", "raw_events", "message_rates", "daily_klines", "events", "orders", "lineitem"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).coalesce(1).write.parquet(f"{at}/{t}.parquet")
    return str(at)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_of_empty_tables(spark, empty, name):
    df = registry.queries()[name](spark, empty)
    assert df.count() <= (2 if name == "contract_hashes" else 1)  # that one reads no table
