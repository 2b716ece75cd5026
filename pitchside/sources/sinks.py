"""Sinks (S7-S9): prediction CSV, idempotent tables and the published snapshot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from pitchside.sources.versions import KEEP, Draft, Version, Versions

TABLE = "table"  # name of the only table of a versioned table folder


def write_csv(df: DataFrame, out_dir: str) -> None:
    """Header CSV files under ``out_dir`` (one directory, overwritten).

    No coalesce to a single file: each task writes its part, so the sink
    scales with the data."""
    df.write.mode("overwrite").option("header", True).csv(out_dir)


def write_clustered(df: DataFrame, path: str, by: Sequence[str], lookups: Sequence[str] = (), files: int | None = None, row_group_bytes: int = 8 << 20) -> None:
    """Parquet files that are ranges of ``by``, sorted inside, with bloom filters on the
    ``lookups`` columns: a reader with a range or an equality on them skips files and row groups.

    Without ``files`` the number follows the shuffle partitions that the session sets, which adaptive
    execution coalesces by size."""
    ranged = df.repartitionByRange(*by) if files is None else df.repartitionByRange(files, *by)
    writer = ranged.sortWithinPartitions(*by).write.option("parquet.block.size", row_group_bytes)
    for c in lookups:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", True)
    writer.parquet(path)


def save_table(spark: SparkSession, df: DataFrame, table: str, path: str, keep: int = KEEP) -> DataFrame:
    """Write a new version of the table under ``path`` and switch the name to it:
    running twice gives the same rows, a failed write leaves the old table, of two writers at
    once the second is refused, and the newest ``keep`` versions stay."""
    version = Versions(spark, path, keep).write({TABLE: df})
    register_table(spark, table, version.tables[TABLE])
    return spark.table(table)


def register_table(spark: SparkSession, table: str, path: str) -> None:
    """Point catalog name ``db.table`` at Parquet files (an external table).

    A table of the same schema is switched by one change of its location; only a change
    of schema drops and creates the name (its files stay)."""
    db, _, _name = table.rpartition(".")
    if db:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    if spark.catalog.tableExists(table):
        if spark.table(table).schema == spark.read.parquet(path).schema:
            spark.sql(f"ALTER TABLE {_quote(table)} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {_quote(table)}")
    spark.catalog.createTable(table, path=path, source="parquet")


def _quote(table: str) -> str:
    return ".".join(f"`{p}`" for p in table.split("."))


def publish(spark: SparkSession, relations: Mapping[str, DataFrame], snapshot_dir: str, keep: int = KEEP) -> dict[str, str]:
    """Write every published relation under the snapshot folder and make all of them
    current by one commit; then point their catalog names at them. Returns name -> path.

    Readers that must not see a mix of two snapshots take ``open_snapshot``; the catalog
    names (for SQL) follow one by one after the commit, and ``attach`` repeats that."""
    if not relations:
        raise ValueError("nothing to publish")
    return attach(spark, Versions(spark, snapshot_dir, keep).write(relations))


def publish_draft(spark: SparkSession, draft: Draft, names: Mapping[str, str], info: Mapping | None = None) -> Version:
    """S9 for relations that were written into ``draft`` before. ``names``: catalog name by table."""
    version = draft.commit(list(names), info)
    attach(spark, version, names)
    return version


def attach(spark: SparkSession, version: Version, names: Mapping[str, str] | None = None) -> dict[str, str]:
    """Point the catalog names at one version's files."""
    for table, path in version.tables.items():
        register_table(spark, (names or {}).get(table, table), path)
    return dict(version.tables)


def open_snapshot(spark: SparkSession, snapshot_dir: str, number: int | None = None) -> dict[str, DataFrame]:
    """All relations of one published snapshot (the newest without a number)."""
    return Versions(spark, snapshot_dir).tables(number)
