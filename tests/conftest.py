import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from reviewlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "reviewlens-tests",
        "local[8]",
        spark_sql_shuffle_partitions="8",
        spark_ui_enabled="false",
        spark_driver_memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of one expression over one string column ``x``."""

    def run(expr, *values, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
        return [r.y for r in df.select("i", expr.alias("y")).orderBy("i").collect()]

    return run
