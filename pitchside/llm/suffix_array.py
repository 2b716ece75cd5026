"""Suffix-array dedup: maximal repeats from the common-prefix interval tree.

Texts are bytes; every byte covered by a 200-byte string that also starts anywhere
else is removed, at all occurrences. The suffix array is sparse and distributed: its
suffixes start at anchors (see ``anchors``), a suffix belongs to the task of its
anchor, and equal 200-byte strings hold the same anchors at the same offsets. Per
anchor the suffixes are sorted, the longest common prefixes of neighbours give the
interval tree by one scan with a stack, and in each interval (prefix length R) the
left contexts are sorted from the anchor backwards, and their common prefixes give a second
tree: members that share L bytes to the left, L + R >= 200, form a repeat. A repeat is maximal
where its members come from different children of the interval (they differ, or end, to the
right) and differ, or end, to the left. Removed is what the occurrences of maximal repeats
cover (``repeat_groups`` returns them).

Contexts that are exact copies of each other are settled by their hashes and enter
the tree once; an anchor with more different contexts than a task should hold is
split by window content.

Edge cases: null or empty texts have no bytes. Rows that repeat a doc_id with its text
count as one document and get one result each. The query judges every text for itself, also
under one doc_id or none; the operator below it takes a doc_id for one text. Removed ranges may cut a character; the kept bytes
are exact. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm import anchors as A
from pitchside.llm import kernels as K
from pitchside.llm.common import by_text, identified, public_id, stored
from pitchside.llm.substrings import apply_spans

# a context is about 1.5 KB in the tree, so the largest takes some 75 MB
SCHEME = A.Scheme(words=False, window=200, gram=32, hot=50_000, run_bytes=(1 << 18) - 64)


def lcp_intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(prefix length, first, last) of every interval of the tree; ``lcp[i]`` is between
    suffixes i and i + 1. One scan with a stack."""
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > value:
            length, first = stack.pop()
            yield length, first, i
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, first))


@dataclass
class Repeat:
    """A maximal repeat around one anchor: bytes to its left and right, and its members:
    ``order[first : last + 1]``, sorted by their left contexts."""

    left: int
    right: int
    order: list[int]
    first: int
    last: int

    @property
    def members(self) -> list[int]:
        return self.order[self.first : self.last + 1]


def _common(a: int, b: int, width: int) -> int:
    """Equal leading bytes of two numbers of ``width`` bytes."""
    return width - ((a ^ b).bit_length() + 7) // 8


class AnchorTree:
    """The sorted suffixes of one anchor, with their left contexts as numbers (read backwards from
    the anchor, padded), so that order and common prefixes of any two are plain arithmetic."""

    def __init__(self, parts: list[tuple[bytes, bytes]], window: int) -> None:
        self.window = window
        self.right = [r for _, r in parts]
        self.n_left = [len(left) for left, _ in parts]
        self.wide = max([window, *self.n_left])
        self.left = [int.from_bytes(left[::-1].ljust(self.wide, b"\0"), "big") for left, _ in parts]
        self.rank = [0] * len(parts)
        for k, i in enumerate(sorted(range(len(parts)), key=self.left.__getitem__)):
            self.rank[i] = k

    def intervals(self) -> Iterator[tuple[int, list[int]]]:
        """(prefix length, members) of the intervals of the suffix array."""
        right, wide = self.right, max([self.window, *map(len, self.right)])
        order = sorted(range(len(right)), key=right.__getitem__)
        lcp, before = [], None
        for i in order:
            number = int.from_bytes(right[i].ljust(wide, b"\0"), "big")
            if before is not None:
                lcp.append(min(_common(number, before[0], wide), len(right[i]), before[1]))
            before = number, len(right[i])
        for length, first, last in lcp_intervals(lcp):
            yield length, order[first : last + 1]

    def repeats(self) -> Iterator[Repeat]:
        """Maximal repeats: different to the right and to the left among their members."""
        left, n_left, nexts = self.left, self.n_left, self.right
        for right, members in self.intervals():
            need = max(0, self.window - right)
            order = sorted((m for m in members if n_left[m] >= need), key=self.rank.__getitem__)
            if len(order) < 2:
                continue
            near = [min(_common(left[a], left[b], self.wide), n_left[a], n_left[b]) for a, b in zip(order, order[1:])]
            if max(near) < need:
                continue
            # members of different children of the interval: the next byte differs, or a suffix ends
            byte = [nexts[m][right] if right < len(nexts[m]) else 256 + m for m in order]
            changes = [0]
            for x, y in zip(byte, byte[1:]):
                changes.append(changes[-1] + (x != y))
            for length, first, last in lcp_intervals(near):
                if length >= need and changes[last] > changes[first]:
                    yield Repeat(length, right, order, first, last)

    def covered(self) -> dict[int, tuple[int, int]]:
        """Member to the bytes left and right of its anchor that its maximal repeats cover (each
        holds the anchor, so they are one range). Two members that share a window share the
        maximal repeat that it extends to, so no repeated byte is missing.

        Repeats of one interval come inner ones first, with more to the left; a member
        takes the first that it is in and is passed over after that."""
        most_left, most_right = [-1] * len(self.right), [0] * len(self.right)
        order, free = None, []
        for r in self.repeats():
            if r.order is not order:
                order, free = r.order, list(range(len(r.order) + 1))  # the next place not taken
            k = r.first
            while True:
                while free[k] != k:
                    free[k] = free[free[k]]
                    k = free[k]
                if k > r.last:
                    break
                m = order[k]
                most_left[m], most_right[m] = max(most_left[m], r.left), max(most_right[m], r.right)
                free[k] = k + 1
        return {m: (a, b) for m, (a, b) in enumerate(zip(most_left, most_right)) if a >= 0}


def _tree(group: list[tuple], window: int) -> AnchorTree:
    return AnchorTree([(g[4][: g[3]], g[4][g[3] :]) for g in group], window)


def anchor_spans(group: list[tuple], window: int) -> list[tuple[int, int, int]]:
    """(_id, from, to) of repeated bytes in the contexts of one anchor."""
    return [(group[m][1], group[m][2] - a, group[m][2] + b) for m, (a, b) in _tree(group, window).covered().items()]


def compared(docs: DataFrame, s: A.Scheme = SCHEME) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(first places of contexts to compare, occurrences of contexts that stand more than once, contexts to
    compare sorted by anchor, places of the windows of hot anchors that repeat)."""
    checks, again = A.repeated(docs, s)
    return checks, again, *A.shards_and_windows(docs, checks, s)


def repeated_spans(docs: DataFrame, s: A.Scheme = SCHEME) -> DataFrame:
    """(_id, from, to) byte ranges that the occurrences of maximal repeats cover. ``docs``: _id, text.

    Occurrences of a context that stands more than once are covered whole; that holds what
    the trees find for it, so their members need not be joined back here."""
    _, again, trees, windows = compared(docs, s)
    copies = again.select("_id", (F.col("pos") - F.col("before")).alias("from"), (F.col("pos") + F.col("after")).alias("to"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch():
            cols = list(zip(*out)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32())], ["_id", "from", "to"])

        for group in A.group_stream(batches):
            out += anchor_spans(group, s.window)
            if len(out) > 20_000:
                yield batch()
                out.clear()
        yield batch()

    hot = windows.select("_id", F.col("pos").alias("from"), (F.col("pos") + s.window).alias("to"))
    return copies.unionByName(trees.mapInArrow(K.tidy(work), "_id long, from int, to int")).unionByName(hot)


def repeat_groups(docs: DataFrame, s: A.Scheme = SCHEME) -> DataFrame:
    """Maximal repeat groups with all their occurrences, one row each: anchor, group (text, unique
    within the anchor), length, _id, start. ``docs``: rows whose doc_id stands for one text.

    Repeats are maximal within the contexts of their anchor: one that is longer than a context comes
    as a group per anchor in it. Groups are the trees' (of different contexts, whose copies
    are joined back), the contexts that stand more than once, and, under hot anchors, windows."""
    checks, again, trees, windows = compared(identified(docs), s)
    again = stored(again.distinct(), "copies")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in A.group_stream(batches):
            rows = [(group[0][0], k, r.left, r.right, group[m][1], group[m][2]) for k, r in enumerate(_tree(group, s.window).repeats()) for m in r.members]
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["anchor", "k", "left", "right", "_id", "pos"])

    found = trees.mapInArrow(K.tidy(work), "anchor long, k long, left long, right long, _id long, pos long")
    contexts = checks.select("anchor", "ctx", "_id", "pos")
    members = found.join(contexts, ["anchor", "_id", "pos"]).select("anchor", F.concat(F.lit("tree "), "k").alias("group"), "left", "right", "ctx")
    whole = again.where("NOT later").select("anchor", F.concat(F.lit("context "), "ctx").alias("group"), F.col("before").alias("left"), F.col("after").alias("right"), "ctx")
    groups = stored(members.unionByName(whole), "repeat_groups")
    every = contexts.unionByName(again.select("anchor", "ctx", "_id", "pos")).distinct().join(groups, ["anchor", "ctx"])
    out = every.select("anchor", "group", (F.col("left") + F.col("right")).cast("long").alias("length"), "_id", (F.col("pos") - F.col("left")).cast("long").alias("start"))
    hot = windows.select("anchor", F.lit("window").alias("group"), F.lit(s.window).cast("long").alias("length"), "_id", F.col("pos").cast("long").alias("start"))
    return out.unionByName(hot)


def dedup_bytes(docs: DataFrame, s: A.Scheme = SCHEME) -> DataFrame:
    """Documents without repeated bytes: _id, n_items, n_removed, n_spans, kept."""
    base = identified(docs)
    return apply_spans(base, repeated_spans(base, s), s)


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest(docs: DataFrame) -> DataFrame:
        out = dedup_bytes(docs)
        return out.select(public_id(), F.col("n_items").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

    return by_text(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest)
