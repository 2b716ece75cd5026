"""Materialisation in the cluster's shared checkpoint folder.

A frame that several branches of a plan read (the scoped match table, the
classes of the bootstrap) is written once as Parquet under
``spark.checkpoint.dir`` and read back: lineage is cut, a lost executor
re-reads files instead of recomputing joins, and later scans get column
pruning and filter pushdown. What an application writes lies in a folder and in
databases of its own, which ``discard`` deletes once the results are consumed.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pitchside.session import checkpoint_dir
from pitchside.sources import hadoop


def folder(spark: SparkSession) -> str:
    """This application's folder for intermediate files."""
    return f"{checkpoint_dir(spark).rstrip('/')}/pitchside/{spark.sparkContext.applicationId}"


def database_prefix(spark: SparkSession) -> str:
    """How the names of this application's own databases begin."""
    return "pitchside_" + re.sub(r"\W", "_", spark.sparkContext.applicationId).lower() + "_"


def write_observed(df: DataFrame, path: str, *more: Column) -> dict:
    """Write ``df`` and return its row count (``n_rows``) and the aggregates ``more``, taken by
    the tasks that write it: no second scan."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *more).write.parquet(path)
    return seen.get


def materialize(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> None:
    """Delete this application's intermediate files and databases. Frames that still read them
    fail afterwards, so call it when their results have been written or collected."""
    for db in spark.catalog.listDatabases(f"{database_prefix(spark)}*"):
        spark.sql(f"DROP DATABASE `{db.name}` CASCADE")
    hadoop.delete(spark, folder(spark))
