import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from innkeeper.session import build_session, checkpoint_root
    s = build_session("local[4]", app="innkeeper-tests", shuffle_partitions=4)
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture
def lines_of(spark):
    """(file, ord, value) frame from a list of lines (one logical file)."""
    def make(lines, file="t.jl"):
        rows = [(file, i, v) for i, v in enumerate(lines)]
        df = spark.createDataFrame(rows, "file string, i int, value string")
        from pyspark.sql import functions as F
        return df.select("file", F.struct(F.lit(0).alias("file_rank"), F.col("i")).alias("ord"), "value")
    return make
