from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from pitchside.session import RECOMMENDED_CONF

    builder = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    session = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="pitchside-test-wh-")).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # tests own their checkpoint folder (set only because it is unset here)
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pitchside-test-ckpt-"))
    yield session


@pytest.fixture(scope="session")
def wh(spark):
    from pitchside.plans.layers import Warehouse

    return Warehouse.from_star(spark, SF_SMALL, materialize=True)
