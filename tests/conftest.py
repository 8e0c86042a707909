import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]").appName("tickerlens-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


def make_posts(spark, rows):
    """rows: (id, created_at, text[, followers, friends])"""
    from tickerlens.schemas import POST

    data = []
    for r in rows:
        fo, fr = (r[3], r[4]) if len(r) > 3 else (10, 5)
        data.append((r[0], r[1], r[2], (fo, fr, "d", f"u{r[0]}")))
    return spark.createDataFrame(data, POST)
