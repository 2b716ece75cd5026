"""Line dedup: exact reference-count tables with sharded cuckoo filters in front.

The exact state is a table of holders, one row per (line key, document). Its
reference counts decide; inserting or deleting documents adds or removes their
holder rows and changes the counts of their keys only, so every decision can be
taken back. The cuckoo filters hold the keys that are over the limit, one filter
per shard of the key space, and are maintained by inserts and deletes of those
keys as their counts cross it. A document's lines are probed against the filters
first; only the positives (and the filter's rare false positives) are joined with
the exact table.

Line key: the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lowered; held as
the 128 bits of its MD5. Null or empty text is one empty line. Rows that repeat a
doc_id are one holder. A null doc_id is a document that sorts after all others.
An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm.common import NULL_ID, identified, public_id, split_by_ids, stored, unused, with_decisions
from pitchside.llm.kernels import mix, slices, tidy

STRIP = " \t\n\x0b\x0c\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MIN_POINTS = 40
MIN_DOCS = 5
SLOTS = 4
# all filters together may be sent to the executors up to this size; beyond it
# the lines go to the exact join unfiltered (same result, more exchanged)
FILTER_BYTES = 64 << 20
SHARD_KEYS = 20_000


def line_key(line: str, min_points: int) -> bytes | None:
    key = line.strip(STRIP)
    return hashlib.md5(key.translate(FOLD).encode()).digest() if len(key) >= min_points else None


class CuckooFilter:
    """Partial-key cuckoo filter over 64-bit key halves, with deletion.

    16-bit fingerprints in buckets of four; the alternative bucket is the bucket
    XOR a hash of the fingerprint. A full filter doubles and is rebuilt from
    its exact keys by the caller.
    """

    def __init__(self, buckets: int) -> None:
        self.n = 1 << max(2, int(buckets - 1).bit_length())
        self.table = np.zeros((self.n, SLOTS), np.uint16)

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        size = max(4, len(keys) // 3)
        while True:
            f = cls(size)
            if all(f.insert(int(k)) for k in keys):
                return f
            size = f.n * 2

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        f = cls.__new__(cls)
        f.table = np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy()
        f.n = len(f.table)
        return f

    def dump(self) -> bytes:
        return self.table.tobytes()

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = mix(keys.astype(np.uint64))
        finger = (h >> np.uint64(48)).astype(np.uint16)
        finger[finger == 0] = 1
        one = (h & np.uint64(self.n - 1)).astype(np.int64)
        return finger, one, one ^ self._shift(finger)

    def _shift(self, finger: np.ndarray) -> np.ndarray:
        return (mix(finger.astype(np.uint64)) & np.uint64(self.n - 1)).astype(np.int64)

    def insert(self, key: int) -> bool:
        finger, one, two = (x[0] for x in self.places(np.array([key], np.uint64)))
        for b in (one, two):
            free = np.flatnonzero(self.table[b] == 0)
            if len(free):
                self.table[b, free[0]] = finger
                return True
        b = one
        for kick in range(500):
            slot = kick % SLOTS
            finger, self.table[b, slot] = self.table[b, slot], finger
            b = b ^ int(self._shift(np.array([finger]))[0])
            free = np.flatnonzero(self.table[b] == 0)
            if len(free):
                self.table[b, free[0]] = finger
                return True
        return False

    def delete(self, key: int) -> bool:
        finger, one, two = (x[0] for x in self.places(np.array([key], np.uint64)))
        for b in (one, two):
            at = np.flatnonzero(self.table[b] == finger)
            if len(at):
                self.table[b, at[0]] = 0
                return True
        return False

    def contains(self, keys: np.ndarray) -> np.ndarray:
        finger, one, two = self.places(keys)
        return ((self.table[one] == finger[:, None]) | (self.table[two] == finger[:, None])).any(1)


def holders(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """(hi, lo, _id): one row for each line key a document row holds."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            hi, lo, ids = [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                keys = {k for line in (text or "").split("\n") if len(line) >= min_points and (k := line_key(line, min_points))}
                for k in keys:
                    hi.append(int.from_bytes(k[:8], "little", signed=True))
                    lo.append(int.from_bytes(k[8:], "little", signed=True))
                    ids.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(ids, pa.int64())], ["hi", "lo", "_id"])

    return docs.mapInArrow(tidy(work), "hi long, lo long, _id long")


def counts(held: DataFrame) -> DataFrame:
    """Exact reference counts: documents that hold a key, and the largest of them."""
    return held.groupBy("hi", "lo").agg(F.count_distinct("_id").alias("n_docs"), F.max("_id").alias("last"))


def reference_counts(held: DataFrame, unique: bool = False) -> DataFrame:
    """As ``counts``; ``unique``: the holder rows are known to be distinct, so partial
    counts can be added up without exchanging a row per holder."""
    if not unique:
        return counts(held)
    return held.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n_docs"), F.max("_id").alias("last"))


def insert_documents(held: DataFrame, docs: DataFrame) -> DataFrame:
    """Holder table after adding documents."""
    return held.unionByName(holders(identified(docs))).distinct()


def delete_documents(held: DataFrame, doc_ids: DataFrame) -> DataFrame:
    """Holder table after deleting documents (``doc_ids``: a doc_id column): exactly the
    table that never saw them."""
    gone = doc_ids.select(F.coalesce(doc_ids["doc_id"].cast("long"), F.lit(NULL_ID)).alias("_id"))
    return held.join(gone, "_id", "left_anti").select("hi", "lo", "_id")


def build_filters(hot: DataFrame, n_hot: int) -> DataFrame:
    """(shard, filter): a cuckoo filter for each shard of the over-limit keys."""
    shards = max(1, -(-n_hot // SHARD_KEYS))

    def build(key, t):
        keys = t["hi"].to_numpy().view(np.uint64)
        return pa.table({"shard": [key[0].as_py()], "shards": [shards], "filter": pa.array([CuckooFilter.of(keys).dump()], pa.binary())})

    return hot.select("hi", F.pmod("lo", F.lit(shards)).alias("shard")).groupBy("shard").applyInArrow(build, "shard long, shards long, filter binary")


def update_filters(filters: DataFrame, hot_before: DataFrame, hot_after: DataFrame) -> DataFrame:
    """Filters after the over-limit keys changed: deletes the keys that fell below
    and inserts those that rose above, in the shards they belong to."""
    one = filters.first()
    if one is None:
        return build_filters(hot_after, hot_after.count())
    shards = one["shards"]
    k = ["hi", "lo"]
    change = hot_before.join(hot_after, k, "left_anti").select(*k, F.lit(-1).alias("change")).unionByName(hot_after.join(hot_before, k, "left_anti").select(*k, F.lit(1).alias("change")))
    change = change.select("hi", "change", F.pmod("lo", F.lit(shards)).alias("shard"))

    def apply(key, old, new):
        f = CuckooFilter.load(old["filter"][0].as_py()) if old.num_rows else CuckooFilter(4)
        for h, c in zip(new["hi"].to_numpy().view(np.uint64), new["change"].to_pylist()):
            if c < 0:
                f.delete(int(h))
            elif not f.insert(int(h)):
                raise RuntimeError("a filter shard is full: rebuild the filters with build_filters")
        return pa.table({"shard": [key[0].as_py()], "shards": [shards], "filter": pa.array([f.dump()], pa.binary())})

    return filters.groupBy("shard").cogroup(change.groupBy("shard")).applyInArrow(apply, "shard long, shards long, filter binary")


def _probe(held: DataFrame, filters: DataFrame) -> DataFrame:
    """Holder rows whose key is in the filter of its shard."""
    tables = {r["shard"]: r["filter"] for r in filters.collect()}  # at most FILTER_BYTES
    shards = filters.first()["shards"]
    sent = held.sparkSession.sparkContext.broadcast(tables)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = {s: CuckooFilter.load(f) for s, f in sent.value.items()}
        for b in batches:
            hi = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            shard = b.column(1).to_numpy(zero_copy_only=False) % shards
            keep = np.zeros(len(hi), bool)
            for s, f in loaded.items():
                at = np.flatnonzero(shard == s)
                keep[at] = f.contains(hi[at])
            yield b.filter(pa.array(keep))

    return held.mapInArrow(tidy(work), held.schema)


def dropped_keys(held: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(_id, hi, lo) of lines to drop: keys held by ``min_docs`` documents or more, in
    every document but the last that holds them. ``held`` is distinct and stored."""
    hot = stored(reference_counts(held, unique=True).where(F.col("n_docs") >= min_docs), "line_counts")
    n_hot = hot.count()
    if n_hot == 0:
        return held.limit(0).select("_id", "hi", "lo")
    filters = build_filters(hot, n_hot)
    likely = _probe(held, stored(filters, "line_filters")) if n_hot * 16 <= FILTER_BYTES else held
    return likely.join(hot, ["hi", "lo"]).where(F.col("_id") != F.col("last")).select("_id", "hi", "lo")


def kept_lines(text: str | None, keys: list[dict] | None, min_points: int) -> tuple[list[str], int]:
    """(lines that stay, number of lines) of a text whose keys to drop are given."""
    lines = (text or "").split("\n")
    if not keys:
        return lines, len(lines)
    gone = {k["hi"].to_bytes(8, "little", signed=True) + k["lo"].to_bytes(8, "little", signed=True) for k in keys}
    return [x for x in lines if len(x) < min_points or line_key(x, min_points) not in gone], len(lines)


def documents_without(docs: DataFrame, min_docs: int = MIN_DOCS, min_points: int = MIN_POINTS) -> DataFrame:
    """``docs`` with all their columns and the text without its repeated lines (n_chars
    follows). Only documents that lose lines are exchanged."""
    held = stored(holders(identified(docs), min_points).distinct(), "line_holders")
    drops = stored(dropped_keys(held, min_docs), "line_drops")
    key = unused(docs, "_id")
    base = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)))
    maybe, clean = split_by_ids(base, drops.select("_id"), drops.count(), key)
    lost, at = unused(base, "_drops"), unused(base, "_drop_id")
    keys = drops.groupBy("_id").agg(F.collect_list(F.struct("hi", "lo")).alias(lost)).withColumnRenamed("_id", at)
    i_text, names = base.columns.index("text"), [*base.columns]
    i_chars = names.index("n_chars") if "n_chars" in names else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            cols = list(b.columns[: len(names)])
            texts, chars = [], cols[i_chars].to_pylist() if i_chars is not None else None
            for i, (text, keys) in enumerate(zip(cols[i_text].to_pylist(), b.column(len(names)).to_pylist())):
                stay, n = kept_lines(text, keys, min_points)
                if len(stay) < n:
                    text = "\n".join(stay)
                    if chars is not None:
                        chars[i] = len(text)
                texts.append(text)
            cols[i_text] = pa.array(texts, cols[i_text].type)
            if chars is not None:
                cols[i_chars] = pa.array(chars, cols[i_chars].type)
            yield pa.RecordBatch.from_arrays(cols, names)

    joined = maybe.join(keys.hint("SHUFFLE_HASH"), F.col(key) == F.col(at), "left").select(*[maybe[c] for c in names], lost)
    return joined.mapInArrow(tidy(cut), base.schema).unionByName(clean).drop(key)


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_points: int = MIN_POINTS) -> DataFrame:
    """``_id``, text, kept text, n_lines, n_dropped of every document row."""
    base = identified(docs)
    held = stored(holders(base, min_points).distinct(), "line_holders")
    drops = dropped_keys(held, min_docs).groupBy("_id").agg(F.collect_list(F.struct("hi", "lo")).alias("drops"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            kept, n_lines, n_dropped = [], [], []
            for text, keys in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                stay, n = kept_lines(text, keys, min_points)
                n_lines.append(n)
                n_dropped.append(n - len(stay))
                kept.append("\n".join(stay) if len(stay) < n else text)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], ["_id", "kept_text", "n_lines", "n_dropped"])

    return with_decisions(base, drops).mapInArrow(tidy(cut), "_id long, kept_text string, n_lines long, n_dropped long")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = dedup_lines(docs)
    return out.select(public_id(), "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), hot AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT keyed.doc_id, i, line, last IS NOT NULL AND keyed.doc_id <> last AS gone FROM keyed LEFT JOIN hot USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
