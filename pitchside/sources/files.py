"""File sources and the raw layer."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchside.sources import hadoop, store
from pitchside.sources.schemas import RAW_SOURCES
from pitchside.sources.versions import KEEP, Versions


def check_sources(spark: SparkSession, raw_dir: str, sources: Mapping[str, tuple[str, T.StructType]] = RAW_SOURCES) -> None:
    """Fail before any read if a registered source file is missing."""
    missing = [f for f, _ in sources.values() if not hadoop.exists(spark, os.path.join(raw_dir, f))]
    if missing:
        raise FileNotFoundError(f"missing raw sources in {raw_dir}: {missing}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Header CSV, columns by their header names.

    With a schema there is no inference pass: the header gives the order, the schema
    the types; columns that the schema does not name are left out, and one that the file
    lacks is an error. Without a schema the whole file is sampled."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if schema is not None:
        in_file = _in_file(reader.csv(path).columns, path, schema)  # reads the first line only
        return reader.option("enforceSchema", False).schema(in_file).csv(path).select(*[f"`{f.name}`" for f in schema.fields])
    return reader.option("inferSchema", True).option("samplingRatio", 1.0).csv(path)


def _in_file(header: list[str], path: str, schema: T.StructType) -> T.StructType:
    """The schema in the order of the file's header; columns it does not name are strings."""
    wanted = {f.name: f for f in schema.fields}
    if lacking := [c for c in wanted if header.count(c) != 1]:
        raise ValueError(f"{path}: columns missing or repeated in the header: {lacking}")
    return T.StructType([wanted.get(c, T.StructField(c, T.StringType())) for c in header])


class TooManyRejects(ValueError):
    """More of a file's rows are unreadable than the load allows."""


def load_csv(spark: SparkSession, path: str, schema: T.StructType, staged: str, max_error_share: float = 0.0) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """S1 with a reject channel: (rows that fit the schema, rejects, counts of both).

    The file is read once, into Parquet under ``staged``, with the raw text of the rows that do
    not fit; the counts are taken while that is written. A reject has its ``file``,
    ``record`` and ``reason``: the number of fields, or the columns whose text is no value of
    their type. A share of rejects above ``max_error_share`` fails the load; the staged
    rows stay for inspection."""
    header = spark.read.option("header", True).csv(path).columns
    typed, raw, at = _in_file(header, path, schema), unused(header, "_record"), unused(header, "_file")
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", raw).option("enforceSchema", False)
    rows = reader.schema(T.StructType([*typed.fields, T.StructField(raw, T.StringType())])).csv(path)
    seen = store.write_observed(rows.withColumn(at, F.col("_metadata.file_path")), staged, F.count(raw).alias("n_rejects"))
    counts = {"n_rows": seen["n_rows"] - seen["n_rejects"], "n_rejects": seen["n_rejects"]}
    every = spark.read.parquet(staged)
    good = every.where(F.col(raw).isNull()).select(*[f"`{f.name}`" for f in schema.fields])
    if seen["n_rejects"] > max_error_share * seen["n_rows"]:
        raise TooManyRejects(f"{path}: {seen['n_rejects']} of {seen['n_rows']} rows do not fit the schema; they are in {staged}")
    return good, _rejects(every, header, raw, at), counts


def _rejects(every: DataFrame, header: list[str], raw: str, at: str) -> DataFrame:
    """file, record, reason of the rows that have a raw text."""
    count, given = unused(header, "_count"), unused(header, "_given")
    texts = T.StructType([*[T.StructField(f"c{i}", T.StringType()) for i in range(len(header))], T.StructField(count, T.StringType())])
    # the same text split into strings, which fails on the number of fields only
    split = F.from_csv(raw, F.lit(texts.simpleString()), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": count})
    bad = every.where(F.col(raw).isNotNull()).withColumn(given, split)
    named = F.concat_ws(", ", *[F.when(F.col(given)[f"c{i}"].isNotNull() & F.col(f"`{c}`").isNull(), F.lit(c)) for i, c in enumerate(header)])
    reason = F.when(F.col(given)[count].isNotNull(), F.lit(f"not {len(header)} fields")).otherwise(F.concat(F.lit("no value of its type: "), named))
    return bad.select(F.col(at).alias("file"), F.col(raw).alias("record"), reason.alias("reason"))


def unused(have: list[str], name: str) -> str:
    """A column name like ``name`` that is not among ``have``."""
    while name.lower() in {c.lower() for c in have}:
        name += "_"
    return name


def read_raw_csv(spark: SparkSession, raw_dir: str, sources: Mapping[str, tuple[str, T.StructType]] = RAW_SOURCES) -> dict[str, DataFrame]:
    """S1 + S2: every registered raw source, read with its explicit schema."""
    check_sources(spark, raw_dir, sources)
    return {name: read_csv(spark, os.path.join(raw_dir, f), schema) for name, (f, schema) in sources.items()}


def replace_table(df: DataFrame, root: str, keep: int = KEEP) -> tuple[DataFrame, str]:
    """S3: a new version of the table under ``root``, read back, and its path. The version
    before is current until the new one is whole; a second writer at the same time is refused, and
    the newest ``keep`` versions stay."""
    path = Versions(df.sparkSession, root, keep).write({"table": df}).tables["table"]
    return df.sparkSession.read.parquet(path), path


def current_table(spark: SparkSession, root: str) -> DataFrame:
    """The current version of a table that ``replace_table`` or ``save_table`` writes."""
    return Versions(spark, root).tables()["table"]


def catalog_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table its row count and (position, column, type) list.

    Counts run as Spark aggregates, unioned into one job; the column list
    comes from the schemas (no data read)."""
    spark = next(iter(tables.values())).sparkSession
    cols = [
        (name, i, f.name, f.dataType.simpleString())
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    columns = spark.createDataFrame(cols, "table string, position int, column string, type string")
    counts = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        counts = c if counts is None else counts.unionByName(c)
    return columns.join(counts, "table").orderBy("table", "position")


def scalar(df: DataFrame):
    """First column of the first row; an error when there is none.

    Only for one-row aggregates (a count, a sum): it moves one value to the driver."""
    row = df.limit(1).first()
    if row is None:
        raise ValueError("scalar query returned no rows")
    return row[0]
