import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitrine.session import build_session  # noqa: E402
from vitrine.sources.catalog import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false",
                            spark__driver__memory="6g",
                            spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def house(spark, tmp_path, request):
    prefix = "t" + "".join(ch for ch in request.node.name.lower() if ch.isalnum())[:40] + "_"
    return Warehouse(spark, prefix, str(tmp_path / "tables"), buckets=2)


def rows(df, *order):
    """The rows as tuples, sorted."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
