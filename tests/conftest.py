import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("footfall-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{TESTDATA}/sf0.001"


# The hand fixture: 2024-01-01 00:00:00, a Monday.
B = 1704067200
H1 = [
    (1, 10, 1, "pv", B),
    (1, 11, 1, "cart", B),
    (1, 10, 1, "buy", B + 3600),
    (1, 12, 2, "fav", B + 86400),
    (2, 10, 1, "pv", B + 172800),
    (3, 13, 2, "buy", B + 864000),
    (1, 10, 1, "pv", B),
    (1, 11, None, "cart", B),
    (1, 10, 1, "PV", B + 5),
    (None, 10, 1, "pv", B),
]


@pytest.fixture(scope="session")
def raw(spark):
    from footfall.schema import RAW_LOG

    return spark.createDataFrame(H1, RAW_LOG)


@pytest.fixture(scope="session")
def cleaned(raw):
    from footfall.operators.clean import clean_events

    return clean_events(raw)


def rows(df, *columns):
    """Rows as plain tuples, in order."""
    picked = df.select(*columns) if columns else df
    return [tuple(r) for r in picked.collect()]
