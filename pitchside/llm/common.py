"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside.llm import kernels as K
from pitchside.sources import store

# A null doc_id is one more document that sorts after all others; inside the
# operators it is carried as this value and turned back into null on the way out.
NULL_ID = (1 << 63) - 1
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def identified(docs: DataFrame, *more: str) -> DataFrame:
    """``_id`` (doc_id, never null) and text, with nothing else to clash with."""
    return docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("_id"), docs["text"].cast("string").alias("text"), *[docs[c] for c in more])


def public_id(col: str = "_id"):
    return F.when(F.col(col) != NULL_ID, F.col(col)).alias("doc_id")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: lineage is cut, and a
    lost executor re-reads files."""
    return store.materialize(df, f"llm-{name}")


def with_decisions(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Documents left-joined with one decision row per ``_id``.

    The decision side is the hashed one, so the texts are exchanged once and never
    sorted; it holds one small row per document of the partition.
    """
    return docs.join(decisions.hint("SHUFFLE_HASH"), "_id", "left")


MAP_BITS = 1 << 27  # at most: 16 MB


def bit_map(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bit map of a long column's low bits: one OR per 64-bit word on the cluster, at
    most bits / 64 rows to the driver."""
    bit = f"({column} & {bits - 1}L)"
    rows = keys.groupBy(F.expr(f"shiftright({bit}, 6)").alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, CAST({bit} & 63 AS INT)))").alias("v")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[rows["word"].to_numpy()] = rows["v"].to_numpy().view(np.uint64)
    return out


def bits_set(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys.astype(np.uint64) & np.uint64(len(table) * 64 - 1)
    return (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


SHARE = 1024


def with_group(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """``rows`` joined with the row of their group (inner join on ``keys``).

    ``size`` of ``groups`` counts a group's rows among the ``total`` rows. Fewer than ``SHARE``
    groups can hold more than that share of them: these are broadcast, and their rows stay
    where they are; the others meet in an exchange where no group is large.
    """
    large = F.col(size) * SHARE > total
    mine = rows.join(F.broadcast(groups.where(large)), keys)
    rest = rows.join(F.broadcast(groups.where(large).select(*keys)), keys, "left_anti")
    return mine.unionByName(rest.join(groups.where(~large), keys))


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame does not have (in any case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def split_by_ids(docs: DataFrame, ids: DataFrame, n: int, column: str = "_id") -> tuple[DataFrame, DataFrame]:
    """(documents whose id may be among ``ids`` (_id), documents whose id is not).

    A bounded bit map over hashed ids is sent to the tasks, so that texts which no
    decision touches are not exchanged. It lets some others through, which the join
    that follows sorts out; the second part is exact.
    """
    bits = min(MAP_BITS, max(1 << 12, 1 << (16 * n).bit_length()))
    hashed = ids.select(F.xxhash64("_id").alias("k"))
    sent = docs.sparkSession.sparkContext.broadcast(bit_map(hashed, "k", bits))

    def part(inside: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = bits_set(sent.value, b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)) == inside
                yield b.filter(pa.array(keep)).select(range(1, b.num_columns))

        return work

    hashed_id = F.xxhash64(docs[column]).alias(unused(docs, "_k"))
    rows = docs.select(hashed_id, *[docs[c] for c in docs.columns])
    return rows.mapInArrow(K.tidy(part(True)), docs.schema), rows.mapInArrow(K.tidy(part(False)), docs.schema)


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` with all their columns, less the documents whose id is in ``rejected`` (_id).
    Only documents that may be rejected are exchanged."""
    rejected = stored(rejected.select("_id").distinct(), "rejected")
    key = unused(docs, "_id")
    base = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)))
    maybe, clean = split_by_ids(base, rejected, rejected.count(), key)
    gone = unused(base, "_rejected")
    left = maybe.join(rejected.withColumnRenamed("_id", gone).hint("SHUFFLE_HASH"), F.col(key) == F.col(gone), "left_anti")
    return left.unionByName(clean).drop(key)


def _own_numbers(docs: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """None where every row has a doc_id of its own or the same text as the others of its doc_id.

    Else (``docs`` whose doc_id stands for one text, numbers given: doc, number). Rows without
    a doc_id, and those whose doc_id also has a text that sorts before theirs, get numbers above
    all doc_ids, one per (doc_id, 128-bit hash of the text): equal rows share theirs. Where no
    numbers are left above the largest doc_id, all documents are numbered in that order. Only
    doc_ids are read to find such rows, and only their texts are hashed and exchanged."""
    given = docs.select(docs["doc_id"].cast("long").alias("doc"))
    shared = stored(given.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc IS NULL").select(F.coalesce("doc", F.lit(NULL_ID)).alias("_id")), "shared_ids")
    n_shared, last = shared.count(), given.agg(F.max("doc")).first()[0] or 0
    if not n_shared and last < NULL_ID:
        return None
    key, at, null = unused(docs, "_id"), unused(docs, "_number"), unused(docs, "_null")
    digest = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    keyed = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), null: F.col("doc_id").isNull()})
    maybe, clean = split_by_ids(keyed, shared, n_shared, key)
    rows = stored(maybe.select(F.col(null).alias("no_id"), F.col(key).alias("doc"), digest.alias("text")).distinct(), "row_keys")
    clash = rows.where("NOT no_id").groupBy("doc").agg(F.min("text").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("doc", "first")
    later = rows.where("NOT no_id").join(clash, "doc").where("text <> first").select("no_id", "doc", "text")
    todo = later.unionByName(rows.where("no_id"))
    start = last + 1
    if start + todo.count() >= NULL_ID:
        todo = keyed.select(F.col(null).alias("no_id"), F.col(key).alias("doc"), digest.alias("text")).distinct()
        maybe, clean, start = keyed, keyed.limit(0), 0
    # ranks by (doc, text), rows without a doc_id last: the same in every run
    order = todo.repartitionByRange("no_id", "doc", "text").sortWithinPartitions("no_id", "doc", "text")
    placed = stored(order.withColumn("at", F.monotonically_increasing_id()), "row_ranks")
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())  # one row per partition
    if not sizes:
        return None
    starts = []
    for part, size in sizes:
        starts.append((part, start))
        start += size
    begin = docs.sparkSession.createDataFrame(starts, "part long, start long")
    numbers = stored(
        placed.join(F.broadcast(begin), F.shiftright(placed["at"], 33) == begin["part"]).select(
            "no_id", "doc", "text", (F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("number")
        ),
        "row_numbers",
    )
    theirs = numbers.select(F.col("no_id").alias(f"{at}null"), F.col("doc").alias(f"{at}doc"), F.col("text").alias(f"{at}text"), F.col("number").alias(at))
    same = (F.col(null) == F.col(f"{at}null")) & (F.col(key) == F.col(f"{at}doc")) & (digest == F.col(f"{at}text"))
    found = maybe.join(theirs.hint("SHUFFLE_HASH"), same, "left")
    columns = lambda number: [number.alias(c) if c == "doc_id" else F.col(c) for c in docs.columns]
    numbered = found.select(*columns(F.coalesce(F.col(at), F.col(key)))).unionByName(clean.select(*columns(F.col(key))))
    return numbered, numbers.select("number", F.when(~F.col("no_id"), F.col("doc")).alias("doc"))


def by_text(docs: DataFrame, work: Callable[[DataFrame], DataFrame], *more: str) -> DataFrame:
    """``work(docs)`` with every text judged for itself: inside, a doc_id stands for one text.

    ``work`` returns rows with a doc_id (and ids in the columns ``more``), which come back as
    given: null, or the doc_id that several texts share."""
    own = _own_numbers(docs)
    if own is None:
        return work(docs)
    numbered, numbers = own
    out = work(numbered)
    columns = out.columns
    for c in ("doc_id", *more):
        number, doc = unused(out, "_number"), unused(out, "_doc")
        mine = numbers.select(F.col("number").alias(number), F.col("doc").alias(doc))
        out = out.join(mine, F.col(c) == F.col(number), "left").withColumn(c, F.when(F.col(number).isNotNull(), F.col(doc)).otherwise(F.col(c))).select(*columns)
    return out


def with_own_ids(docs: DataFrame) -> tuple[DataFrame, str]:
    """(``docs`` where a doc_id stands for one text, see ``_own_numbers``; name of an added column
    with the doc_id as it was)."""
    own = unused(docs, "_doc")
    base = docs.withColumn(own, docs["doc_id"])
    found = _own_numbers(base)
    return (base if found is None else found[0]), own


def with_given_ids(docs: DataFrame, own: str, columns: list[str]) -> DataFrame:
    """The rows of ``with_own_ids`` under the doc_ids they came with."""
    return docs.select(*[F.col(own).alias(c) if c == "doc_id" else F.col(c) for c in columns])
