"""Tables in the shared folder."""

from pathlib import Path
from types import SimpleNamespace

import pytest

from tidemark import session


def test_a_cluster_needs_a_shared_folder():
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None), sparkContext=SimpleNamespace(master="spark://h:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(fake)


def test_tables_are_deleted_with_their_scope(spark):
    kept = session.cut(spark.range(3))
    gone = session.cut(spark.range(4))
    with session.scratch(spark):
        inner = session.cut(spark.range(5))
        at = Path(inner.inputFiles()[0].removeprefix("file:")).parent
        assert inner.count() == 5 and at.exists()
    assert not at.exists() and kept.count() == 3
    path = Path(gone.inputFiles()[0].removeprefix("file:")).parent
    session.drop(gone)
    assert not path.exists() and kept.count() == 3


def test_spread_and_fits(spark):
    assert session.spread(spark.range(8, numPartitions=1)).rdd.getNumPartitions() == 4
    assert session.spread(spark.range(8, numPartitions=6)).rdd.getNumPartitions() == 6
    assert session.fits(spark.range(3), 3) and not session.fits(spark.range(4), 3)
