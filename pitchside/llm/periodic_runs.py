"""Maximal periodic runs of words by a dictionary of basic factors.

The words of a document are a sequence of numbers. For each power of two L, every
factor of L words has a name: the rank of the pair of names of its halves, so equal
factors have equal names and nothing is compared twice. Positions whose factor occurs
once are dropped, as no longer factor there can repeat.

The occurrences of a factor, in order, form arithmetic progressions of equal gaps.
From each occurrence the ends of its progression and of the next ones lie within 2 L; the
distances to them, from L on, are proposed as periods (a distance inside a progression
is a multiple of its gap and no smallest period). A run of smallest period q is
proposed at the L with L <= q <= 2 L. Proposals are extended both ways by binary search
over prefix hashes, equal stretches are merged, and the smallest period of a stretch stays.

A document is one row, and a run of rows is held as flat arrays (a document longer than
the run is held alone), a few numbers per word whatever the number of levels. Words
are compared by 64-bit hashes. There is no exchange.

Edge cases: a null or empty text has no words and no runs. Rows are judged one by one, so
rows that repeat a doc_id each have a result. Extra columns do not matter. An
empty table gives an empty result. With ``plant``, a row without a doc_id is not rewritten.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm import kernels as K

MIN_LENGTH = 12
STEPS = 3  # progressions that are followed from each occurrence
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(first word, period) of the periodic tail that the query's documents get, or None:
    word i from there on becomes word first + (i - first) mod period."""
    if doc_id is None or n == 0 or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return None
    g = h // 10
    first = g % n
    return first, 1 + (n - first) // (3 + g % 8)


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries in order of key, their names, whether the key occurs again): equal keys keep
    the order they came in."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    again = np.ones(len(s) + 1, bool)
    again[:-1] = new
    return order, np.cumsum(new) - 1, ~(again[:-1] & again[1:])


def _progression_ends(pos: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For occurrences sorted by (name, position): the index of the next occurrence (-1: none)
    and of the last one reached by steps of the same gap."""
    n = len(pos)
    linked = np.zeros(n, bool)
    linked[:-1] = name[1:] == name[:-1]
    gap = np.zeros(n, np.int64)
    gap[:-1] = pos[1:] - pos[:-1]
    on = np.zeros(n, bool)  # the next step has the same gap as this one
    on[:-1] = linked[:-1] & linked[1:] & (gap[1:] == gap[:-1])
    stops = np.flatnonzero(~on)
    at = stops[np.searchsorted(stops, np.arange(n))]
    return np.where(linked, np.arange(n) + 1, -1), np.where(linked[at], at + 1, at)


def proposals(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) pairs: the L words at the position are those one period later.

    ``words``: numbers that differ between documents; ``ends``: the end of each word's document."""
    order, name, again = _named(words)
    pos, name = order[again], name[again]
    n, size, found = len(words), 1, []
    while len(pos):
        after, last = _progression_ends(pos, name)
        at, origin = np.arange(len(pos)), np.arange(len(pos))
        for _ in range(STEPS):
            head = after[at]
            inside = head >= 0
            at, origin, head = at[inside], origin[inside], head[inside]
            for target in (head, last[at]):
                d = pos[target] - pos[origin]
                ok = (d >= size) & (d <= 2 * size)
                found.append(np.stack([d[ok], pos[origin[ok]], np.full(ok.sum(), size)]))
            near = pos[last[at]] - pos[origin] <= 2 * size
            at, origin = last[at][near], origin[near]
        # names of twice the length from the names of the halves
        names = np.full(n, -1, np.int64)
        names[pos] = name
        pos = np.sort(pos)
        pos = pos[pos + 2 * size <= ends[pos]]
        pos = pos[names[pos + size] >= 0]
        order, name, again = _named(names[pos] * (n + 1) + names[pos + size])
        pos, name = pos[order][again], name[again]
        size *= 2
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    d, i, length = np.concatenate(found, axis=1)
    order = np.lexsort((i, d))
    d, i, length = d[order], i[order], length[order]
    # a proposal that touches the one before with the same period is in the same stretch
    first = np.ones(len(d), bool)
    first[1:] = (d[1:] != d[:-1]) | (i[1:] > i[:-1] + length[:-1])
    return i[first], d[first]


def _same(pre: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    return K.span_hash(pre, a, a + n, K.WORD_POWERS) == K.span_hash(pre, b, b + n, K.WORD_POWERS)


def _extent(most: np.ndarray, holds) -> np.ndarray:
    """Largest n <= most with holds(n), which is true at 0 and monotone, for each entry."""
    low, high = np.zeros_like(most), most.copy()
    while (low < high).any():
        mid = (low + high + 1) // 2
        good = holds(mid)
        low, high = np.where(good, mid, low), np.where(good, high, mid - 1)
    return low


def find_runs(words: np.ndarray, doc: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """(document, start in it, length, period) of every maximal run of at least two periods
    and ``min_length`` words, by document, start and period. ``words``: word hashes."""
    salted = words ^ K.mix(np.arange(1, len(bounds), dtype=np.uint64))[doc]
    i, d = proposals(salted, np.repeat(bounds[1:], np.diff(bounds)))
    pre = K.prefix(words, K.WORD_POWERS)
    left = _extent(i - bounds[doc[i]], lambda n: _same(pre, i - n, i - n + d, n))
    right = _extent(bounds[doc[i] + 1] - i - d, lambda n: _same(pre, i, i + d, n))
    start, length = i - left, left + right + d
    ok = length >= np.maximum(min_length, 2 * d)
    start, length, d = start[ok], length[ok], d[ok]
    order = np.lexsort((d, length, start))
    start, length, d = start[order], length[order], d[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, d = start[first], length[first], d[first]
    order = np.lexsort((d, start))
    start, length, d = start[order], length[order], d[order]
    return np.stack([doc[start], start - bounds[doc[start]], length, d], axis=1) if len(start) else np.zeros((0, 4), np.int64)


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, plant: bool = False) -> DataFrame:
    """doc_id, number of words, all runs (by start and period), and the text whose runs are
    cut to their first period, its words joined by one space. ``plant``: periodic tails
    (see ``planted``) are written into a tenth of the documents first."""

    def rows(ids: list[int | None], t: K.Texts) -> pa.RecordBatch:
        w = K.words(t, K.NON_SPACE)
        source = np.arange(len(w.start))
        if plant:
            for k, (doc_id, n) in enumerate(zip(ids, np.diff(w.bounds).tolist())):
                if tail := planted(doc_id, n):
                    first, period = int(w.bounds[k]) + tail[0], tail[1]
                    size = int(w.bounds[k + 1]) - first
                    source[first : first + size] = first + np.arange(size) % period
        found = find_runs(w.hash[source], w.doc, w.bounds, min_length)
        at = w.bounds[found[:, 0]] + found[:, 1]
        stay = ~K.marked(at + found[:, 3], at + found[:, 2], len(source))
        texts = []
        for k in range(len(t)):
            a, b = int(w.bounds[k]), int(w.bounds[k + 1])
            every = t.raw(k).split()  # bytes: at the same six white-space characters
            texts.append(b" ".join([every[j] for j in (source[a:b][stay[a:b]] - a).tolist()]).decode())
        n_runs = np.bincount(found[:, 0], minlength=len(t))
        off = np.zeros(len(t) + 1, np.int32)
        np.cumsum(n_runs, out=off[1:])
        runs = pa.ListArray.from_arrays(pa.array(off), pa.StructArray.from_arrays([pa.array(found[:, c]) for c in (1, 2, 3)], fields=list(_RUNS.value_type)))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.diff(w.bounds)), runs, pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for t in K.runs(batch.column(1)):
                yield rows(ids[t.first : t.first + len(t)], t)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(work, SCHEMA)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of ``periodic_runs`` for every document with its planted tail."""
    found = periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), plant=True)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    out = found.withColumn("_longest", longest)
    length, period = F.col("_longest.length"), -F.col("_longest.period")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_longest.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.expr("(1000 * _longest.length) div (- _longest.period)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
