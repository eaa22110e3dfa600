import os
import sys
import tempfile
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from tidemark import schemas  # noqa: E402

T1 = datetime(2026, 1, 1)
T2 = datetime(2026, 2, 1)
T3 = datetime(2026, 3, 1)
SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    yield session


DIM_SCHEMA = ("sk bigint, customer_id string, customer_name string, segment string, country string, "
              "valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
STG_SCHEMA = "customer_id string, customer_name string, segment string, country string"
ATTRS = ["customer_name", "segment", "country"]


def empty_dim(spark):
    return spark.createDataFrame([], DIM_SCHEMA)


def stg(spark, rows):
    return spark.createDataFrame(rows, STG_SCHEMA)


def load(spark, dim, rows, at):
    """One Type 2 load; returns (next dimension, stats)."""
    from tidemark.operators.scd import load_type_2
    from tidemark.session import stage
    result = load_type_2(dim, stg(spark, rows), "customer_id", ATTRS, effective_at=at)
    return stage(result.dimension, "test_dim"), result.stats


END_OF_TIME = schemas.END_OF_TIME
BEGINNING_OF_TIME = schemas.BEGINNING_OF_TIME
