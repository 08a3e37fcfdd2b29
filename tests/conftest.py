import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def frame_of(spark, cells, rows=None):
    from termloom.frame import CELLS_SCHEMA, SparseFrame

    table = spark.createDataFrame(cells, CELLS_SCHEMA)
    ids = rows or sorted({(c[0], c[1]) for c in cells})
    return SparseFrame(spark.createDataFrame(ids, "row_id string, target string"), table)


@pytest.fixture
def small(spark):
    """Four rows, two labels, three terms; row r4 is empty."""
    cells = [
        ("r1", "A", "x", 1.0), ("r1", "A", "y", 3.0), ("r2", "A", "x", 2.0),
        ("r3", "B", "y", 5.0), ("r3", "B", "z", 5.0),
    ]
    return frame_of(spark, cells, [("r1", "A"), ("r2", "A"), ("r3", "B"), ("r4", "B")])
