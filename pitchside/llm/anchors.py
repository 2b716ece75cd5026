"""Anchored contexts: how equal windows of a corpus are brought together.

Of every run of ``window - gram + 1`` successive grams the minimum hash is an anchor, so
two equal windows have the same anchors at the same offsets. An anchor carries a
context: the items around it that a window holding it can reach. Occurrences of an
anchor with equal contexts are settled at once by their hashes; only where an anchor
has different contexts are these cut out of the texts and compared, anchor by
anchor. What is shuffled is one row per anchor, about two in ``window - gram`` items.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside.llm import kernels as K
from pitchside.llm.common import MAP_BITS, bit_map, bits_set, split_by_ids, stored, with_group


@dataclass(frozen=True)
class Scheme:
    """What an item is, how long a repeated window is, and the gram of the anchors."""

    words: bool  # items are white-space separated words; else bytes
    window: int
    gram: int
    hot: int  # more different contexts than this under one anchor are split by window content
    run_bytes: int = K.CHUNK_BYTES  # texts worked on at once

    def items(self, t: K.Texts) -> tuple[np.ndarray, np.ndarray, K.Words | None]:
        """(value per item, item offsets of documents, word borders)."""
        if self.words:
            w = K.words(t, K.NON_SPACE)
            return w.hash, w.bounds, w
        return K.BYTE_VALUES[t.data], t.offsets, None


def anchors_of(values: np.ndarray, bounds: np.ndarray, s: Scheme) -> dict[str, np.ndarray]:
    h, ok = K.gram_hashes(values, bounds, s.gram)
    pos = K.winnow(h, ok, s.window - s.gram + 1)
    doc = np.searchsorted(bounds, pos, "right") - 1
    reach = s.window - s.gram
    before = np.minimum(pos - bounds[doc], reach)
    after = np.minimum(bounds[doc + 1] - pos, s.window)
    pre = K.prefix(values, K.WORD_POWERS)
    ctx = K.mix(K.span_hash(pre, pos - before, pos + after, K.WORD_POWERS) + before.astype(np.uint64))
    return {"doc": doc, "anchor": h[pos], "ctx": ctx, "pos": pos - bounds[doc], "before": before, "after": after}


def anchors(docs: DataFrame, s: Scheme, known: np.ndarray | None = None) -> DataFrame:
    """(anchor, ctx, _id, pos, before, after) of every text; positions in items of the text.

    ``known``: a bit map of contexts; anchors whose context is not in it are left out."""
    sent = None if known is None else docs.sparkSession.sparkContext.broadcast(known)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in K.runs(b.column(1), s.run_bytes):
                values, bounds, _ = s.items(t)
                a = anchors_of(values, bounds, s)
                if sent is not None:
                    keep = bits_set(sent.value, a["ctx"])
                    a = {k: v[keep] for k, v in a.items()}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a["anchor"].view(np.int64)), pa.array(a["ctx"].view(np.int64)), b.column(0).take(pa.array(a["doc"] + t.first)),
                     pa.array(a["pos"], pa.int32()), pa.array(a["before"], pa.int16()), pa.array(a["after"], pa.int16())],
                    ["anchor", "ctx", "_id", "pos", "before", "after"],
                )

    return docs.mapInArrow(K.tidy(work), "anchor long, ctx long, _id long, pos int, before short, after short")


def repeated(docs: DataFrame, s: Scheme) -> tuple[DataFrame, DataFrame]:
    """(contexts to compare with others, occurrences of contexts that stand more than once).

    The first: the first place (_id, pos) of every context of an anchor that has several;
    ``n_ctx`` counts them. The second: anchors whose context also stands at another
    place; ``later``: at an earlier one. Places are found by partial aggregates, and rows meet
    them by joins that take no large group into one task, so an anchor or a context that a
    third of all documents hold is no task of its own. The second is read from the texts
    again behind a bounded bit map, so other anchors are neither written nor exchanged.
    """
    place = F.struct("_id", "pos")
    both = anchors(docs, s).groupBy("anchor", "ctx").agg(F.min(place).alias("least"), F.max(place).alias("most"), F.min("before").alias("before"), F.min("after").alias("after"), F.count(F.lit(1)).alias("n"))
    seen = stored(both.withColumn("twin", F.col("least") != F.col("most")).drop("most"), "contexts")
    several = stored(seen.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_ctx")).where("n_ctx > 1"), "several")
    n_seen, n_copied = seen.agg(F.count(F.lit(1)), F.count_if("twin")).first()
    checks = with_group(seen, several, ["anchor"], "n_ctx", n_seen).select("anchor", "ctx", "least._id", "least.pos", "before", "after", "n_ctx")
    copied = seen.where("twin").select("anchor", "ctx", "least", "n")
    known = bit_map(copied, "ctx", min(MAP_BITS, max(1 << 12, 1 << (16 * n_copied).bit_length())))
    found = stored(anchors(docs, s, known), "occurrences")
    copies = with_group(found, copied, ["anchor", "ctx"], "n", found.count()).withColumn("later", F.struct("_id", "pos") != F.col("least"))
    return stored(checks, "checks"), copies.select("anchor", "ctx", "_id", "pos", "before", "after", "later")


def item_slices(t: K.Texts, s: Scheme, w: K.Words | None, doc: int, start: int, end: int) -> bytes:
    """Bytes of the items [start, end) of a document (words joined by one space)."""
    if not s.words:
        o = t.offsets[doc]
        return t.data[o + start : o + end].tobytes()
    o = int(w.bounds[doc])
    return b" ".join(t.data[a:b].tobytes() for a, b in zip(w.start[o + start : o + end].tolist(), w.end[o + start : o + end].tolist()))


def contexts(docs: DataFrame, checks: DataFrame, s: Scheme) -> DataFrame:
    """The contexts to compare, cut out of the texts: (anchor, _id, pos, before, content).

    Under an anchor with too many contexts for a task, every window of the context is a row
    of its own with null content, keyed by anchor and window hash: equal keys are equal windows.
    Those rows are settled by Spark aggregates (``shards_and_windows``), not in one task.
    """
    wanted = checks.groupBy("_id").agg(F.collect_list(F.struct("anchor", "pos", "before", "after", (F.col("n_ctx") > s.hot).alias("hot"))).alias("at"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column(2)
            off = at.offsets.to_numpy()
            f = at.values
            cols = {k: f.field(k).to_numpy(zero_copy_only=False) for k in ("anchor", "pos", "before", "after", "hot")}
            for t in K.runs(b.column(1), s.run_bytes):
                values, bounds, w = s.items(t)
                pre = K.prefix(values, K.WORD_POWERS)
                rows, hot_rows = [], []
                for i in range(len(t)):
                    n = int(bounds[i + 1] - bounds[i])
                    for k in range(off[t.first + i], off[t.first + i + 1]):
                        anchor, pos, before, after = (int(cols[c][k]) for c in ("anchor", "pos", "before", "after"))
                        if pos + after > n:
                            continue  # another text under a repeated doc_id
                        if not cols["hot"][k]:
                            rows.append((t.first + i, anchor, pos, before, item_slices(t, s, w, i, pos - before, pos + after)))
                            continue
                        starts = np.arange(pos - before, pos + after - s.window + 1)
                        if len(starts):
                            h = K.span_hash(pre, bounds[i] + starts, bounds[i] + starts + s.window, K.WORD_POWERS)
                            hot_rows.append((t.first + i, K.mix(h ^ np.uint64(anchor & 0xFFFFFFFFFFFFFFFF)), starts))
                row = [r[0] for r in rows] + [r[0] for r in hot_rows for _ in r[1]]
                key = np.concatenate([np.array([r[1] for r in rows], np.int64), *[r[1].view(np.int64) for r in hot_rows]])
                pos = np.concatenate([np.array([r[2] for r in rows], np.int64), *[r[2] for r in hot_rows]])
                m = len(row) - len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.int64()), b.column(0).take(pa.array(row, pa.int64())), pa.array(pos, pa.int32()), pa.array([r[3] for r in rows] + [0] * m, pa.int16()), pa.array([r[4] for r in rows] + [None] * m, pa.binary())],
                    ["anchor", "_id", "pos", "before", "content"],
                )

    return docs.join(wanted.hint("SHUFFLE_HASH"), "_id").select("_id", "text", "at").mapInArrow(K.tidy(work), "anchor long, _id long, pos int, before short, content binary")


def shards_and_windows(docs: DataFrame, checks: DataFrame, s: Scheme) -> tuple[DataFrame, DataFrame]:
    """(contexts to compare, sorted by anchor, one task an anchor; places of the windows of hot
    anchors that repeat: anchor, _id, pos, first)."""
    split = {r["hot"]: r["n"] for r in checks.groupBy((F.col("n_ctx") > s.hot).alias("hot")).agg(F.count(F.lit(1)).alias("n")).collect()}

    def part(hot: bool) -> DataFrame:
        mine = checks.where(F.col("n_ctx") > s.hot) if hot else checks.where(F.col("n_ctx") <= s.hot)
        near, _ = split_by_ids(docs, mine.select("_id"), split.get(hot, 0))
        return contexts(near, mine, s)

    shards = part(False).repartition("anchor").sortWithinPartitions("anchor", "_id", "pos")
    if True not in split:
        return shards, docs.sparkSession.createDataFrame([], "anchor long, _id long, pos int, first boolean")
    windows = stored(part(True).select("anchor", "_id", "pos").distinct(), "hot_windows")
    place = F.struct("_id", "pos")
    ends = stored(windows.groupBy("anchor").agg(F.min(place).alias("least"), F.max(place).alias("most"), F.count(F.lit(1)).alias("n")).where("least <> most").drop("most"), "hot_ends")
    return shards, with_group(windows, ends, ["anchor"], "n", windows.count()).select("anchor", "_id", "pos", (F.struct("_id", "pos") == F.col("least")).alias("first"))


def group_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Groups of equal first column from batches sorted by (anchor, _id, pos), as lists of row tuples."""
    group: list[tuple] = []
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns]):
            if group and group[0][0] != row[0]:
                yield group
                group = []
            if not group or group[-1][1:3] != row[1:3]:  # else a row that repeats a document
                group.append(row)
    if group:
        yield group


def spans_by_document(spans: DataFrame) -> DataFrame:
    """(_id, spans): the marked item ranges of each document."""
    return spans.select("_id", "from", "to").distinct().groupBy("_id").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
