"""Star tables laid out for the match join: orders and line items bucketed by order key.

Both tables are written once, each task one bucket sorted by the key, so every later join of the two
reads equal buckets side by side: no exchange, and date ranges still prune the scan of orders. Worth
it where the tables are read more than about twice. The tables live in a database of the
application (dropped with ``store.discard``) unless another one is named.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pitchside.sources import hadoop, store
from pitchside.sources.bridge import StarTables

KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
BUCKET_BYTES = 128 << 20


def bucket_count(spark: SparkSession, sf_dir: str, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of about ``bucket_bytes`` of the larger table's files, at least one per core."""
    most = max(sum(size for _, size, _ in hadoop.files(spark, f"{sf_dir}/{t}.parquet")) for t in KEYS)
    return max(spark.sparkContext.defaultParallelism, -(-most // bucket_bytes))


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """``df`` as a table of ``buckets`` sorted files, one per bucket."""
    spark = df.sparkSession
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)


def colocated_star(spark: SparkSession, sf_dir: str, database: str | None = None, buckets: int | None = None) -> StarTables:
    """The star tables with ``orders`` and ``lineitem`` read from bucketed copies."""
    run = uuid.uuid4().hex
    database = database or f"{store.database_prefix(spark)}star_{run}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    star = StarTables(spark, sf_dir)
    n = buckets or bucket_count(spark, sf_dir)
    for name, key in KEYS.items():
        star[name] = write_bucketed(star[name], f"`{database}`.{name}", f"{store.folder(spark)}/star-{run}/{name}", key, n)
    return star
