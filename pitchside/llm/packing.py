"""Best-fit packing with Martello-Toth dominance reduction.

Documents become pieces of at most ``capacity`` tokens. What decides the packing is
the histogram of piece lengths, at most ``capacity`` numbers however large the
corpus, so it is solved once on the driver: item sets that provably dominate every
alternative are fixed for good (with as many copies as there are), the reduced
instance goes to best-fit decreasing, and the result is a short list of patterns
with multiplicities. Pieces are then ranked within their length on the cluster and
the rank names the sequence and the offset.

Dominance used, for an item j, the largest item k that fits beside it, and any other
set S that fits beside j: if sum(S) <= k for every such S, then {j, k} dominates, as S
can go where k was. That holds when j + k fills the sequence, when no two items fit
beside j, and when three do not fit and the best two sum to at most k. An
item beside which nothing fits is fixed alone.

Edge cases: null or empty text is one piece holding only the end id. Rows that repeat
a doc_id are packed each on its own; a null doc_id is packed like any other. An empty
table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchside.llm import kernels as K
from pitchside.llm import tokens
from pitchside.llm.common import identified, public_id, stored

CAPACITY = 2048
Pattern = tuple[tuple[int, int], ...]  # (length, copies), longest first


def reduce_instance(count: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Fix dominating sets; ``count`` (by length) is left with the remainder."""
    fixed: list[tuple[Pattern, int]] = []
    changed = True
    while changed:
        changed = False
        for j in range(capacity, 0, -1):
            while count[j] > 0:
                count[j] -= 1  # the other items, without one j
                have = np.flatnonzero(count)
                room = capacity - j
                fits = have[have <= room]
                count[j] += 1
                if not len(fits):
                    times = int(count[j])
                    # copies of j may fit beside each other; here they do not
                    fixed.append((((j, 1),), times))
                    count[j] = 0
                    changed = True
                    break
                k = int(fits[-1])
                small: list[int] = []
                for x in fits[:3]:
                    small += [int(x)] * int(min(3, count[x] - (x == j)))
                small.sort()
                ok = j + k == capacity or len(small) < 2 or sum(small[:2]) > room
                if not ok and (len(small) < 3 or sum(small[:3]) > room):
                    below = np.zeros(room + 1, np.int64)
                    below[fits] = fits
                    below = np.maximum.accumulate(below)
                    other = below[room - fits]
                    ok = int(np.max(np.where(other > 0, fits + other, 0))) <= k
                if not ok:
                    break
                times = int(count[j] // 2 if j == k else min(count[j], count[k]))
                fixed.append((((j, 2),) if j == k else ((max(j, k), 1), (min(j, k), 1)), times))
                count[j] -= times
                count[k] -= times
                changed = True
    return fixed


def best_fit(count: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing of whole length classes: bins with equal contents are one
    class with a multiplicity. Ends with ``count`` empty."""
    classes: dict[int, list[list]] = {}  # room left -> [[contents, bins]]
    rooms: list[int] = []

    def put(contents: tuple, room: int, bins: int) -> None:
        if room not in classes:
            classes[room] = []
            insort(rooms, room)
        classes[room].append([contents, bins])

    for length in range(capacity, 0, -1):
        left = int(count[length])
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                contents, bins = classes[room][-1]
                used = min(bins, left)
                if used == bins:
                    classes[room].pop()
                    if not classes[room]:
                        del classes[room]
                        rooms.pop(i)
                else:
                    classes[room][-1][1] -= used
                put((*contents, length), room - length, used)
                left -= used
            else:
                each = capacity // length
                if left >= each:
                    put((length,) * each, capacity - each * length, left // each)
                    left %= each
                else:
                    put((length,) * left, capacity - left * length, 1)
                    left = 0
        count[length] = 0
    out = []
    for room in rooms:
        for contents, bins in classes[room]:
            sizes, copies = np.unique(np.array(contents, np.int64), return_counts=True)
            out.append((tuple(zip(sizes[::-1].tolist(), copies[::-1].tolist())), bins))
    return out


def solve(histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns and how many sequences have each."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        count[length] = n
    return reduce_instance(count, capacity) + best_fit(count, capacity)


def slots(patterns: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """Slot ranges by (length, rank): where the pieces of each length go.

    Of a length's slots in order, entry i covers [lo, lo + copies * bins); the sequence is
    seq + slot // copies, the offset at + (slot % copies) * length.
    """
    rows, seen, seq = [], {}, 0
    for pattern, bins in patterns:
        at = 0
        for length, copies in pattern:
            lo = seen.get(length, 0)
            rows.append((length, lo, copies, seq, at))
            seen[length] = lo + copies * bins
            at += copies * length
        seq += bins
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 5)
    return {"length": a[:, 0], "lo": a[:, 1], "copies": a[:, 2], "seq": a[:, 3], "at": a[:, 4]}


def place(table: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = np.int64(1) << np.int64(44)  # ranks stay below
    i = np.searchsorted(table["length"] * wide + table["lo"], length * wide + rank, "right") - 1
    k = rank - table["lo"][i]
    return table["seq"][i] + k // table["copies"][i], table["at"][i] + k % table["copies"][i] * length


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize every text and cut it: _id, piece, start, length, ids_crc32."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(vocabulary, spaced=True)
        for b in batches:
            for t in K.runs(b.column(1)):
                ids, off = enc.encode(t)
                rows = []
                for i in range(len(t)):
                    own = np.append(ids[off[i] : off[i + 1]], np.uint32(end_id)).astype("<u4")
                    n = len(own)
                    first = (n - 1) % capacity + 1
                    cuts = [0, *range(first, n + 1, capacity)]
                    rows += [(t.first + i, p, s, e - s, zlib.crc32(own[s:e].tobytes())) for p, (s, e) in enumerate(zip(cuts, cuts[1:]))]
                row, *rest = zip(*rows)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(rest[0], pa.int32()), *[pa.array(c, pa.int64()) for c in rest[1:]]], ["_id", "piece", "start", "length", "ids_crc32"])

    return identified(docs).mapInArrow(K.tidy(work, keeps=tokens.ENCODERS), "_id long, piece int, start long, length long, ids_crc32 long")


def ranked(cut: DataFrame, n: int) -> DataFrame:
    """Adds ``rank``, 0.. within each length. Rows are dealt to buckets by hash, so a
    length that a third of all pieces have is many windows, not one."""
    buckets = max(64, n // 50_000)
    rows = cut.withColumn("bucket", F.pmod(F.xxhash64("_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("_id", "piece", "ids_crc32")) - 1
    return rows.withColumn("own", own).join(before, ["length", "bucket"]).withColumn("rank", (F.col("own") + F.col("before")).cast("long")).drop("own", "before", "bucket")


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their sequence and place: _id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = stored(pieces(docs, vocabulary, end_id, capacity), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    table = docs.sparkSession.sparkContext.broadcast(slots(solve(histogram, capacity)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
                seq, at = place(table.value, length, rank)
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("_id", "piece", "start", "length", "ids_crc32")], pa.array(seq), pa.array(at)], ["_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked(cut, sum(histogram.values())).mapInArrow(K.tidy(work, keeps=tokens.ENCODERS), "_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = pack(docs, tokens.vocabulary("byte_bpe_50k.json"))
    return out.select(public_id(), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
