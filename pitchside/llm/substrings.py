"""Substring dedup with suffix automata over reference shards.

A word is removed where it is covered by a window of 20 words whose word sequence
also starts earlier (a smaller doc_id, or earlier in the same document). Each shard of
the reference, the contexts of one anchor in corpus order, is a suffix automaton over
words; contexts are streamed through it for their matching statistics, the length at
each word of the longest suffix that occurs earlier, and words under a statistic of 20 or
more are marked. A context is then added to the automaton unless it brought nothing
new, so the automaton holds different text only and copies cost no memory.

The automata of all shards together grow with the corpus, so none is broadcast;
contexts are sent to their shard instead (see ``anchors``). A context that is an exact
copy of an earlier one is marked whole beforehand; an anchor with more different
contexts than a shard should hold is split by window content.

Edge cases: null or empty texts have no words. Rows that repeat a doc_id with its text count as one
document and get one result each. The query judges every text for itself: rows without a doc_id
come after all others, in the order of their texts' hashes, as do the further texts of a doc_id
that has several. The operator below it takes a doc_id for one text. An empty table
gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm import anchors as A
from pitchside.llm import kernels as K
from pitchside.llm.common import by_text, identified, public_id, split_by_ids, stored

SCHEME = A.Scheme(words=True, window=20, gram=6, hot=8_000)


class SuffixAutomaton:
    """Suffix automaton of several word sequences, built online."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _clone(self, p: int, q: int, word: bytes) -> int:
        c = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.link[q] = c
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = c
            p = self.link[p]
        return c

    def _extend(self, last: int, word: bytes) -> tuple[int, int]:
        """(state of the longer prefix, length of its longest suffix that was there before)."""
        q = self.next[last].get(word)
        if q is not None:
            if self.length[q] != self.length[last] + 1:
                q = self._clone(last, q, word)
            return q, self.length[q]
        cur = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, word)
        return cur, self.length[self.link[cur]]

    def add(self, words: list[bytes]) -> list[int]:
        """Add a sequence; at each word the longest suffix that occurred before,
        in earlier sequences or earlier in this one."""
        out, state = [], 0
        for w in words:
            state, n = self._extend(state, w)
            out.append(n)
        return out

    def statistics(self, words: list[bytes]) -> list[int]:
        """Matching statistics of a sequence, which is not added."""
        out, state, n = [], 0, 0
        nxt, link, length = self.next, self.link, self.length
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                n = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                n += 1
            out.append(n)
        return out


def _stretches(group: list[tuple]) -> Iterator[tuple[int, int, list[bytes]]]:
    """(_id, first word's position, words): contexts of one document that overlap are one
    stretch, so that no word of the corpus is met twice."""
    doc, start, words = None, 0, []
    for _, d, pos, before, content in group:
        new, at = content.split(b" "), pos - before
        if d == doc and at <= start + len(words):
            words = words + new[start + len(words) - at :]
            continue
        if doc is not None:
            yield doc, start, words
        doc, start, words = d, at, new
    if doc is not None:
        yield doc, start, words


def shard_spans(group: list[tuple], window: int) -> list[tuple[int, int, int]]:
    """(_id, from, to) of repeated words in the contexts of one anchor, in corpus order."""
    auto, out = SuffixAutomaton(), []
    for doc, start, words in _stretches(group):
        stats = auto.statistics(words)
        if min(stats[window - 1 :]) < window:
            stats = auto.add(words)
        run = None
        for i, n in enumerate(stats):
            if n >= window:
                a, b = start + i + 1 - window, start + i + 1
                if run and a > run[1]:
                    out.append((doc, *run))
                    run = None
                run = (run[0] if run else a, b)
        if run:
            out.append((doc, *run))
    return out


def repeated_spans(docs: DataFrame, s: A.Scheme = SCHEME) -> DataFrame:
    """(_id, from, to) word ranges whose windows all start earlier in the corpus. ``docs``: _id, text."""
    checks, again = A.repeated(docs, s)
    copies = again.where("later").select("_id", (F.col("pos") - F.col("before")).alias("from"), (F.col("pos") + F.col("after")).alias("to"))
    shards, windows = A.shards_and_windows(docs, checks, s)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch():
            cols = list(zip(*out)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32())], ["_id", "from", "to"])

        for group in A.group_stream(batches):
            out += shard_spans(group, s.window)
            if len(out) > 20_000:
                yield batch()
                out.clear()
        yield batch()

    hot = windows.where("NOT first").select("_id", F.col("pos").alias("from"), (F.col("pos") + s.window).alias("to"))
    return copies.unionByName(shards.mapInArrow(K.tidy(work), "_id long, from int, to int")).unionByName(hot)


def apply_spans(docs: DataFrame, spans: DataFrame, s: A.Scheme) -> DataFrame:
    """Documents without the marked items: _id, n_items, n_removed, n_spans, kept (bytes)."""
    spans = stored(spans, "repeat_spans")
    schema = "_id long, n_items long, n_removed long, n_spans long, kept binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = None
            if b.num_columns > 2:
                col = b.column(2)  # null rows have no entries
                off, frm, to = col.offsets.to_numpy(), col.values.field("from").to_numpy().astype(np.int64), col.values.field("to").to_numpy().astype(np.int64)
                marks = (off, frm, to)
            for t in K.runs(b.column(1), s.run_bytes):
                _, bounds, w = s.items(t)
                rows = []
                for i in range(len(t)):
                    o, n = int(bounds[i]), int(bounds[i + 1] - bounds[i])
                    gone = np.zeros(n, bool)
                    if marks:
                        lo, hi = marks[0][t.first + i], marks[0][t.first + i + 1]
                        if hi > lo:
                            gone = K.marked(np.minimum(marks[1][lo:hi], n), np.minimum(marks[2][lo:hi], n), n)
                    removed = int(gone.sum())
                    n_spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                    if s.words:
                        stay = np.flatnonzero(~gone) + o
                        raw = t.data
                        kept = b" ".join([raw[x:y].tobytes() for x, y in zip(w.start[stay].tolist(), w.end[stay].tolist())])
                    else:
                        kept = t.data[o : o + n][~gone].tobytes()
                    rows.append((n, removed, n_spans, kept))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(t.first, len(t)), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.binary())],
                    ["_id", "n_items", "n_removed", "n_spans", "kept"],
                )

    touched, clean = split_by_ids(docs, spans.select("_id"), spans.count())
    joined = touched.join(A.spans_by_document(spans).hint("SHUFFLE_HASH"), "_id", "left").select("_id", "text", "spans")
    return joined.mapInArrow(K.tidy(work), schema).unionByName(clean.mapInArrow(K.tidy(work), schema))


def dedup_substrings(docs: DataFrame, s: A.Scheme = SCHEME) -> DataFrame:
    """Documents without the words of windows that start earlier: _id, n_items, n_removed, n_spans, kept."""
    base = identified(docs)
    return apply_spans(base, repeated_spans(base, s), s)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest(docs: DataFrame) -> DataFrame:
        out = dedup_substrings(docs)
        return out.select(public_id(), F.col("n_items").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

    return by_text(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest)


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT doc_id, i, md5(array_to_string(ws[i : i + 19], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d WHERE len(ws) >= 20)
), later AS (
  SELECT doc_id, i FROM g QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM later, range(0, 20) AS r(k)
), w AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d
), j AS (
  SELECT w.doc_id, w.i, word, gone.i IS NOT NULL AS x FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.i = gone.i
), r AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (x) AS gone, string_agg(word, ' ' ORDER BY i) FILTER (NOT x) AS kept FROM j GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r USING (doc_id)
"""
