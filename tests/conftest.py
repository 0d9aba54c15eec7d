import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from dropforge.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("tests", **{
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.sql.maxMetadataStringLength": "20000",
        "spark.sql.debug.maxToStringFields": "300",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def texts(spark):
    """One-column DataFrame ``c`` of texts."""
    return lambda *values: spark.createDataFrame([(v,) for v in values], "c string")


@pytest.fixture
def evaluate(spark):
    """Values of a Column built by ``make`` over texts, in order."""

    def run(make, *values):
        df = spark.createDataFrame(list(enumerate(values)), "i int, c string").orderBy("i")
        return [r[0] for r in df.select(make("c")).collect()]

    return run
