import pytest

from tidemark.session import build


@pytest.fixture(scope="session")
def spark():
    s = build("local[4]", 4, spark__driver__memory="3g", spark__default__parallelism="4", spark__sql__adaptive__coalescePartitions__enabled="true")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
