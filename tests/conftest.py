import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tablewright.session import ensure_checkpoint_dir

    s = (
        SparkSession.builder.master("local[*]")
        .appName("tablewright-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tw-test-")


def text_frame(spark, cols: dict):
    """A frame of text columns from {name: [cells]} (equal lengths)."""
    names = list(cols)
    n = len(next(iter(cols.values())))
    rows = [tuple(cols[c][i] for c in names) + (i,) for i in range(n)]
    schema = ", ".join(f"`{c}` string" for c in names) + ", _o long"
    return spark.createDataFrame(rows, schema)
