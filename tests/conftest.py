import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockloom.session import tune  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("stockloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="stockloom-test-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture
def setting(spark):
    """Set a session setting for one test."""
    changed = []

    def change(key, value):
        changed.append(key)
        spark.conf.set(key, str(value))

    yield change
    for key in changed:
        spark.conf.unset(key)


@pytest.fixture
def frame(spark):
    def build(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build


def rows_of(df):
    """Rows as sorted tuples in the frame's column order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is None, str(v)) for v in t])


@pytest.fixture
def files_kept(spark):
    """Files in each folder that a call leaves below the shared folder, with 64 partitions in each shuffle."""

    def count():
        top = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
        return {d: n for d, _, names in os.walk(top) if (n := sum(x.startswith("part-") for x in names))}

    changed = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}

    def run(call):
        old = count()
        call()
        return [n for d, n in count().items() if d not in old]

    for k, v in changed.items():
        spark.conf.set(k, v)
    yield run
    for k, v in before.items():
        spark.conf.set(k, v)
