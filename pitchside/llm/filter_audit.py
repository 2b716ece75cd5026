"""Interaction audit of filters in every order, by wide packed counters.

A document fails some of the five filters: its mask. In an order of the filters, the
first failing one removes it. For each mask one big integer holds the outcome of all
600 steps (120 orders of five steps) in fields of ``FIELD`` bits: kept after the step,
removed by it, or failing it after an earlier step removed the document, and one field
per filter for masks that fail only that one. Adding such integers adds all 1,805
counts at once. Rows are first counted per (part, mask, labels) where they are read, so a
part's sum has at most 128 terms, each an integer times its count. A field has 63 bits and
counts are longs, so no field reaches the next one. The sums of a part are unpacked to
its 600 rows in one task.

Filters: A, under ``min_words`` words; B, distinct words under ``min_distinct`` % of the
words; C, capital letters over ``max_capitals`` % of the code points; D, a symbol of
``SYMBOLS``; E, a text that a smaller doc_id has. Words are compared by 64-bit hashes,
texts by MD5.

Edge cases: a null text is an empty one and fails A (and E, if it is repeated). A null source is
the part of the empty string. Rows without a doc_id come after all others: a text that any
numbered row has is repeated in them, but not by one another; the same holds for rows that
repeat a doc_id and its text. A doc_id with several label rows is good (or toxic) if any of
them says so; null labels say nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm import kernels as K
from pitchside.llm.common import identified, stored

LETTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(LETTERS)]
SYMBOLS = "#$%&*|"
FIELD = 63  # bits
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    min_distinct: int = 65  # percent of the words
    max_capitals: int = 5  # percent of the code points


def _per_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def text_masks(t: K.Texts, limits: Limits) -> np.ndarray:
    """Bits 0 to 3 of every document of a run: it fails A, B, C, D."""
    w = K.words(t, K.NON_SPACE)
    n = np.diff(w.bounds)
    keys = w.hash ^ K.mix(np.arange(1, len(t) + 1, dtype=np.uint64))[w.doc]  # documents of a run stay apart
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    distinct = np.bincount(w.doc[order[new]], minlength=len(t))
    capitals = _per_doc(_CAPITAL[t.data], t.offsets)
    points = _per_doc(_LEAD[t.data], t.offsets)
    fails = [n < limits.min_words, 100 * distinct < limits.min_distinct * n, 100 * capitals > limits.max_capitals * points, _per_doc(_SYMBOL[t.data], t.offsets) > 0]
    return sum(f.astype(np.int64) << k for k, f in enumerate(fails))


def masks(docs: DataFrame, part: str = "source", limits: Limits = Limits()) -> DataFrame:
    """Per row: _id, part and mask of all five filters."""
    base = identified(docs, part)
    rows = base.select("_id", F.coalesce(base[part].cast("string"), F.lit("")).alias("part"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [text_masks(t, limits) for t in K.runs(b.column(3))]
            mask = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(mask, pa.int64())], ["_id", "part", "digest", "mask"])

    seen = stored(rows.mapInArrow(work, "_id long, part string, digest binary, mask long"), "audit_masks")
    # written: joins with an aggregate on the same key take its partitions, which Spark cannot
    # split where a group of copies is large
    first = stored(seen.groupBy("digest").agg(F.min("_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "audit_repeats")
    late = F.coalesce(F.col("_id") > F.col("first"), F.lit(False)).cast("long")
    return seen.join(first, "digest", "left").select("_id", "part", (F.col("mask") + F.lit(1 << LETTERS.index("E")) * late).alias("mask"))


def _step(mask: int, order: str, at: int) -> tuple[bool, bool, bool]:
    """(kept after the step, removed by it, fails it but was removed before)."""
    fails = [bool(mask >> LETTERS.index(x) & 1) for x in order[: at + 1]]
    return not any(fails), fails[at] and not any(fails[:at]), fails[at] and any(fails[:at])


@functools.cache
def packed(mask: int) -> int:
    """The mask's big integer: kept, removed, redundant of the 600 steps, then its only failure."""
    fields = [x for order in ORDERS for at in range(len(order)) for x in _step(mask, order, at)]
    fields += [mask == 1 << k for k in range(len(LETTERS))]
    return sum(1 << FIELD * k for k, on in enumerate(fields) if on)


def unpacked(total: int) -> list[int]:
    low = (1 << FIELD) - 1
    fields = 3 * len(ORDERS) * len(LETTERS) + len(LETTERS)
    raw = total.to_bytes((FIELD * fields + 7) // 8 + 1, "little")
    out = []
    for k in range(fields):
        at = FIELD * k
        out.append(int.from_bytes(raw[at >> 3 : (at + FIELD + 7 >> 3) + 1], "little") >> (at & 7) & low)
    return out


_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def part_rows(counts: pa.Table) -> pa.Table:
    """The 600 rows of a part from its counts per (mask, good, toxic)."""
    numbers = {m: packed(m) for m in set(counts["mask"].to_pylist())}
    every = good = toxic = 0
    for mask, g, t, n in zip(*[counts[c].to_pylist() for c in ("mask", "good", "toxic", "n")]):
        x = numbers[mask] * n
        every += x
        good += x if g else 0
        toxic += x if t else 0
    f, g, t = unpacked(every), unpacked(good), unpacked(toxic)
    alone = f[3 * len(ORDERS) * len(LETTERS) :]
    shapley = dict.fromkeys(LETTERS, 0)
    for k, order in enumerate(ORDERS):
        for at, x in enumerate(order):
            shapley[x] += f[3 * (len(LETTERS) * k + at) + 1]
    part, rows = counts["part"][0].as_py(), []
    for k, order in enumerate(ORDERS):
        for at, x in enumerate(order):
            i = 3 * (len(LETTERS) * k + at)
            rows.append((part, order, at + 1, *f[i : i + 3], alone[LETTERS.index(x)], g[i + 1], t[i + 1], shapley[x]))
    types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * len(_COUNTS)]
    return pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), types)], ["part", "filter_order", "step", *_COUNTS])


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", limits: Limits = Limits()) -> DataFrame:
    """One row per part, order of the filters and step."""
    said = labels.where(labels["doc_id"].isNotNull()).groupBy(labels["doc_id"].cast("long").alias("_id")).agg(
        F.coalesce(F.max(labels["quality"] == 1), F.lit(False)).alias("good"), F.coalesce(F.max(labels["toxic"] == 1), F.lit(False)).alias("toxic")
    )
    rows = masks(docs, part, limits).join(stored(said, "audit_labels"), "_id", "left")
    no = F.lit(False)
    counts = rows.groupBy("part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("part").applyInArrow(part_rows, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), firsts AS (SELECT text, min(doc_id) AS first_id FROM d GROUP BY text),
l AS (SELECT doc_id, coalesce(max(quality) = 1, false) AS good, coalesce(max(toxic) = 1, false) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CAST(len(w) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INT)
    + 4 * CAST(100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) AS INT)
    + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > first_id, first_id IS NOT NULL) AS INT) AS mask
  FROM d JOIN firsts USING (text) LEFT JOIN l USING (doc_id)
), c AS (SELECT part, mask, count(*) AS n, count_if(good) AS g, count_if(toxic) AS t FROM m GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
p AS (
  SELECT f1.x || f2.x || f3.x || f4.x || f5.x AS filter_order, [f1.b, f2.b, f3.b, f4.b, f5.b] AS bits
  FROM f f1, f f2, f f3, f f4, f f5 WHERE f1.b + f2.b + f3.b + f4.b + f5.b = 31 AND len(list_distinct([f1.b, f2.b, f3.b, f4.b, f5.b])) = 5
), steps AS (
  SELECT filter_order, CAST(s AS INT) AS step, bits[s] AS bit, coalesce(list_sum(bits[1 : s - 1]), 0) AS before FROM p, range(1, 6) AS r(s)
), r AS (
  SELECT part, filter_order, step, bit,
    CAST(coalesce(sum(n) FILTER ((mask & (before + bit)::INT) = 0), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER ((mask & bit) <> 0 AND (mask & before::INT) = 0), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER ((mask & bit) <> 0 AND (mask & before::INT) <> 0), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(g) FILTER ((mask & bit) <> 0 AND (mask & before::INT) = 0), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(t) FILTER ((mask & bit) <> 0 AND (mask & before::INT) = 0), 0) AS BIGINT) AS toxic_lost
  FROM c, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r
"""
