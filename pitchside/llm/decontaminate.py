"""Benchmark decontamination by winnowing.

Every document and item is reduced to fingerprints: of each window of ``w`` successive
k-grams the minimum hash is kept. With k = 5 and w = 6 any shared span of k + w - 1 = 10
words holds a k-gram that both sides keep, so no shared 10-word window is missed. Kept
k-grams are joined on their hash and each hit is extended word by word to both
sides; spans of 10 or more equal words cover whole windows. An item of fewer than 10
words is one window of its own length: it is fingerprinted as a whole, and documents
add the grams of the short lengths that occur.

The benchmark's fingerprints are summed into a bit map whose size is bounded
(``MAP_BITS``); documents are tested against it where they are read, and only k-grams
whose bit is set leave the task, with the few words around them. Against a benchmark
of any size the join stays exact; a fuller map only lets more rows through.

Edge cases: null or empty texts have no words; such items never occur. The query judges every text
for itself: rows without a doc_id, or with one doc_id and different texts, have their own results,
equal rows equal ones. The operator below it takes a doc_id for one text. Items
are told apart by item_id; repeated items count once, an item without item_id is
ignored. Empty tables give no hits. Only doc_id, text and item_id, text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm import kernels as K
from pitchside.llm.common import MAP_BITS, bit_map, bits_set, by_text, identified, public_id, stored

WINDOW = 10
GRAM = 5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = np.arange(97, 123, dtype=np.uint8)


def _prints(w: K.Words, window: int, gram: int, short: list[int], whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word position, gram length, hash) of the fingerprints of a run.

    ``whole``: items, where a text shorter than a window is one gram; else documents,
    which give all grams of the lengths in ``short``.
    """
    pos, size, out = [], [], []
    h, ok = K.gram_hashes(w.hash, w.bounds, gram)
    at = K.winnow(h, ok, window - gram + 1)
    pos.append(at), size.append(np.full(len(at), gram)), out.append(h[at])
    count = np.diff(w.bounds)
    for n in short:
        h, ok = K.gram_hashes(w.hash, w.bounds, n)
        at = np.flatnonzero(ok)
        if whole:
            at = at[np.isin(at, w.bounds[:-1][count == n])]
        pos.append(at), size.append(np.full(len(at), -n)), out.append(h[at])  # negative: a whole short item
    size = np.concatenate(size)
    return np.concatenate(pos), size, K.mix(np.concatenate(out) ^ size.astype(np.int64).view(np.uint64))


def _contexts(t: K.Texts, w: K.Words, pos: np.ndarray, size: np.ndarray, window: int, gram: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Folded words around each fingerprint, how many stand before it, and the first word's position."""
    doc = w.doc[pos]
    reach = np.where(size > 0, window - gram, 0)
    a = np.maximum(w.bounds[doc], pos - reach)
    b = np.minimum(w.bounds[doc + 1], pos + np.abs(size) + reach)
    folded = _LOWER[t.data].tobytes()
    starts, ends = w.start.tolist(), w.end.tolist()
    texts = [b" ".join([folded[starts[i] : ends[i]] for i in range(x, y)]).decode() for x, y in zip(a.tolist(), b.tolist())]
    return texts, pos - a, a - w.bounds[doc]


def item_prints(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(fp, size, before, words, item_id): fingerprints of the items with their surroundings."""
    items = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in K.runs(b.column(1)):
                w = K.words(t, K.ALNUM, K.FOLDED_VALUES)
                pos, size, fp = _prints(w, window, gram, list(range(1, window)), True)
                texts, before, _ = _contexts(t, w, pos, size, window, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp.view(np.int64)), pa.array(size, pa.int32()), pa.array(before, pa.int32()), pa.array(texts, pa.string()), b.column(0).take(pa.array(w.doc[pos] + t.first))],
                    ["fp", "size", "before", "words", "item_id"],
                )

    return items.mapInArrow(K.tidy(work), "fp long, size int, before int, words string, item_id string").distinct()


def document_hits(docs: DataFrame, table: np.ndarray, short: list[int], window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document (its word count, fp null) and one per fingerprint whose bit is set."""
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bit = sent.value
        for b in batches:
            for t in K.runs(b.column(1)):
                w = K.words(t, K.ALNUM, K.FOLDED_VALUES)
                pos, size, fp = _prints(w, window, gram, short, False)
                hit = bits_set(bit, fp)
                pos, size, fp = pos[hit], size[hit], fp[hit]
                texts, before, start = _contexts(t, w, pos, size, window, gram)
                n, m = len(t), len(pos)
                row = np.concatenate([np.arange(n), w.doc[pos]]) + t.first
                none = np.zeros(n, bool)
                col = lambda x, kind: pa.array(np.concatenate([np.zeros(n, np.int64), x]), kind, mask=np.concatenate([~none, np.zeros(m, bool)]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row)), pa.array(np.concatenate([np.diff(w.bounds), np.zeros(m, np.int64)])), col(fp.view(np.int64), pa.int64()), col(size, pa.int32()), col(before, pa.int32()), pa.array([None] * n + texts, pa.string()), col(start, pa.int64())],
                    ["_id", "n_words", "fp", "size", "before", "words", "start"],
                )

    return identified(docs).mapInArrow(K.tidy(work), "_id long, n_words long, fp long, size int, before int, words string, start long")


def extended(pairs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Extend joined fingerprints word by word: _id, ctx, from, to (word positions of the
    shared span) where the span covers a window."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            c = [b.column(k).to_pylist() for k in ("_id", "ctx", "size", "before", "words", "start", "item_before", "item_words")]
            for doc, ctx, size, before, mine, start, item_before, theirs in zip(*c):
                mine, theirs, n = mine.split(" "), theirs.split(" "), abs(size)
                if mine[before : before + n] != theirs[item_before : item_before + n]:
                    continue  # two grams with one hash
                left = 0
                while left < min(before, item_before) and mine[before - left - 1] == theirs[item_before - left - 1]:
                    left += 1
                right = n
                while before + right < len(mine) and item_before + right < len(theirs) and mine[before + right] == theirs[item_before + right]:
                    right += 1
                if size < 0 or left + right >= window:
                    out.append((doc, ctx, start + before - left, start + before + right))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())], ["_id", "ctx", "from", "to"])

    return pairs.select("_id", "ctx", "size", "before", "words", "start", "item_before", "item_words").mapInArrow(K.tidy(work), "_id long, ctx long, from long, to long")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(word counts: _id, n_words; shared spans: _id, from, to; items: _id, item_id)."""
    prints = stored(item_prints(benchmark, window, gram), "item_prints")
    # items with the same surroundings of a fingerprint are one context
    key = ["fp", "size", "before", "words"]
    contexts = stored(prints.select(*key).distinct().withColumn("ctx", F.xxhash64(*key)), "item_contexts")
    n = contexts.count()
    short = [-r["size"] for r in contexts.where("size < 0").select("size").distinct().collect()]  # at most window - 1 rows
    bits = min(MAP_BITS, max(1 << 16, 1 << (1024 * n).bit_length()))
    hits = stored(document_hits(docs, bit_map(contexts, "fp", bits), sorted(short), window, gram), "document_hits")
    theirs = contexts.select("fp", "size", F.col("before").alias("item_before"), F.col("words").alias("item_words"), "ctx")
    spans = stored(extended(hits.where("fp IS NOT NULL").join(theirs, ["fp", "size"]), window), "shared_spans")
    items = spans.select("_id", "ctx").distinct().join(prints.select(F.xxhash64(*key).alias("ctx"), "item_id").distinct(), "ctx").select("_id", "item_id").distinct()
    return hits.where("fp IS NULL").select("_id", "n_words"), spans.select("_id", "from", "to").distinct(), items


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document row: _id, n_words, n_hit, items (sorted item_ids that occur)."""
    words, spans, items = contamination(docs, benchmark, window, gram)
    hit = spans.select("_id", F.explode(F.sequence("from", F.col("to") - 1)).alias("i")).groupBy("_id").agg(F.count_distinct("i").alias("n_hit"))
    found = items.groupBy("_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    return words.join(hit, "_id", "left").join(found, "_id", "left").select(
        "_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")

    def digest(docs: DataFrame) -> DataFrame:
        return decontaminate(docs, benchmark).select(
            public_id(), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        )

    return by_text(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest)


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL
), bw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, ws[i : i + least(len(ws), 10) - 1] AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
), dw AS (
  SELECT doc_id, n, i, ws[i : i + n - 1] AS g FROM (
    SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)
), hit AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
hw AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT doc_id, n, i FROM hit), range(0, 10) AS r(k) WHERE k < n GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN it USING (doc_id)
"""
