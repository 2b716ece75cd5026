"""MinHash near-duplicates by a multi-index Hamming join.

A document is the set of its word shingles. Its signature has 80 minimum hashes of
16 bits; the distance of two signatures is the number of hashes that differ. It is
split into 16 chunks of five; by the pigeonhole principle two signatures at a distance of
31 or less have a chunk with at most one error, so each chunk is indexed once with
each of its five hashes left out: all pairs within 31 meet in a bucket. At a
similarity of 0.8 the distance is 16 on average (standard deviation 3.6), and as
errors are not spread evenly a pair at 0.8 misses all 16 chunks with probability
5e-10. Bucket pairs within ``MAX_DISTANCE`` are confirmed on the full shingle sets.

Documents with equal sets are one class beforehand. Confirming runs in steps, so
that a bucket of n documents costs about n pairs, not n squared: first each class with the
nearest of the smallest members of its buckets; the links give components. Then, a few
times, every class outside the commonest component of a large bucket with its nearest
bucket mates of other components. Last, every pair of a bucket whose members are still in
different components, so that no link is lost (a pair inside a component could add
nothing to it): those of small buckets as pairs, those of large ones inside tasks that
hold a component's texts, so that no task emits the pairs of a group.

Edge cases: null or empty texts, and texts without words, have an empty set and are
linked with nothing. A text of fewer words than a shingle is one shingle. Rows that repeat
a doc_id with its text are one document and get one result each. The query judges every text for
itself: rows without a doc_id, and further texts of a doc_id, come after all others and
have components of their own. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchside.llm import kernels as K
from pitchside.llm.common import by_text, identified, public_id, split_by_ids, stored

CHUNKS = 16
CHUNK = 5
HASHES = CHUNKS * CHUNK
MAX_DISTANCE = 36  # 5.6 standard deviations above the mean at 0.8
BLOCK = 4096  # bucket members compared in one task at once ...
ACTIVE = 1024  # ... with so many that are outside the bucket's commonest component
SMALL = 32  # buckets up to this size are compared whole, many at a time
NEAREST = 4  # mates tried per round before all are ...
PER_BUCKET = 2  # ... the nearest of so many from each bucket that a member is in
ROUNDS = 1
SET_BYTES = 32 << 20  # shingle sets a task keeps while it confirms pairs
_MULT = K.stream(101, HASHES) | np.uint64(1)
_ADD = K.stream(102, HASHES)
_SALT = K.stream(103, HASHES)


def shingle_sets(t: K.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, sorted by document and hash; offsets of documents)."""
    w = K.words(t, K.NON_SPACE, K.FOLDED_VALUES)
    n = len(t)
    h, ok = K.gram_hashes(w.hash, w.bounds, size)
    at = np.flatnonzero(ok)
    parts, docs = [h[at]], [w.doc[at]]
    count = np.diff(w.bounds)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        pre = K.prefix(w.hash, K.WORD_POWERS)
        parts.append(K.span_hash(pre, w.bounds[short], w.bounds[short + 1], K.WORD_POWERS))
        docs.append(short)
    h, doc = np.concatenate(parts), np.concatenate(docs)
    order = np.argsort(h, kind="stable")
    order = order[np.argsort(doc[order].astype(np.uint16) if n < 65536 else doc[order], kind="stable")]
    h, doc = h[order], doc[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[first], doc[first]
    return h, np.searchsorted(doc, np.arange(n + 1))


def signatures(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(documents, HASHES) of 16-bit minimum hashes; zeros for an empty set."""
    n = len(off) - 1
    out = np.zeros((n, HASHES), np.uint16)
    full = np.flatnonzero(off[1:] > off[:-1])
    if len(full):
        starts = off[full]
        for i in range(HASHES):
            low = np.minimum.reduceat(h * _MULT[i] + _ADD[i], starts)
            out[full, i] = (K.mix(low) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """(documents, HASHES) bucket keys: each chunk with each of its hashes left out."""
    wide = sig.astype(np.uint64)
    out = np.zeros((len(sig), HASHES), np.uint64)
    for c in range(CHUNKS):
        for skip in range(CHUNK):
            k = np.full(len(sig), _SALT[c * CHUNK + skip])
            for j in range(CHUNK):
                if j != skip:
                    k = K.mix(k ^ wide[:, c * CHUNK + j]) * _MULT[j]
            out[:, c * CHUNK + skip] = k
    return out


def features(docs: DataFrame, size: int) -> DataFrame:
    """_id, n_shingles, h1, h2 (128 bits that name the set), sig."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in K.runs(b.column(1)):
                h, off = shingle_sets(t, size)
                sums = []
                for salt in (_SALT[0], _SALT[1]):
                    total = np.zeros(len(h) + 1, np.uint64)
                    np.cumsum(K.mix(h ^ salt), out=total[1:])
                    sums.append((total[off[1:]] - total[off[:-1]]).view(np.int64))
                sig = signatures(h, off)
                raw = [row.tobytes() for row in sig]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(t.first, len(t)), pa.array(np.diff(off).astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]), pa.array(raw, pa.binary())],
                    ["_id", "n_shingles", "h1", "h2", "sig"],
                )

    return docs.mapInArrow(K.tidy(work), "_id long, n_shingles long, h1 long, h2 long, sig binary")


def _sig_matrix(col) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(-1, HASHES)


def buckets(classes: DataFrame) -> DataFrame:
    """(key, rep, center, n) of every bucket with two members or more; center: its smallest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keys = chunk_keys(_sig_matrix(b.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), HASHES)))], ["key", "rep"])

    rows = classes.select("rep", "sig").mapInArrow(K.tidy(work), "key long, rep long")
    group = Window.partitionBy("key")
    return rows.withColumns({"center": F.min("rep").over(group), "n": F.count(F.lit(1)).over(group)}).where("n > 1")


def near_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with their signature distance, where sizes and signatures allow the similarity."""
    c = classes.select("rep", "n_shingles", "sig")
    a = c.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa"))
    b = c.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                d = (_sig_matrix(x.column(2)) != _sig_matrix(x.column(3))).sum(1)
                out = pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array(d, pa.int32())], ["a", "b", "distance"])
                yield out.filter(pa.array(d <= MAX_DISTANCE))

    both = pairs.join(a, "a").join(b, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return both.select("a", "b", "sa", "sb").mapInArrow(K.tidy(work), "a long, b long, distance int")


def confirmed(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have the similarity."""
    pairs = stored(pairs.select("a", "b"), "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("_id"))
    near, _ = split_by_ids(docs, ids, 2 * pairs.count())
    side = lambda x: near.select(F.col("_id").alias(x), F.col("text").alias(f"text_{x}"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}  # of documents met; started afresh when full
        held = 0

        def set_of(doc: int, texts: pa.Array, i: int) -> np.ndarray:
            nonlocal held
            if doc not in sets:
                if held > SET_BYTES:
                    sets.clear()
                    held = 0
                sets[doc] = shingle_sets(next(K.runs(texts.slice(i, 1))), size)[0]
                held += sets[doc].nbytes
            return sets[doc]

        for x in batches:
            keep = np.zeros(x.num_rows, bool)
            for i, (a, b) in enumerate(zip(x.column(0).to_pylist(), x.column(1).to_pylist())):
                mine, theirs = set_of(a, x.column(2), i), set_of(b, x.column(3), i)
                both = len(np.intersect1d(mine, theirs, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(mine) + len(theirs) - both)
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1)], ["a", "b"]).filter(pa.array(keep))

    with_b = side("b").join(pairs.hint("SHUFFLE_HASH"), "b")
    rows = with_b.join(side("a"), "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(K.tidy(work), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of the links; comp: the smallest node reachable.

    Contraction: in each round every node moves to the neighbour (or itself) with the
    smallest random rank, and the links are rewritten; about half the nodes or more
    vanish in a round, whatever the shape. Each round is written, which cuts lineage.
    """
    edges = stored(links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v"), "links")
    labels = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("at", F.col("node"))
    turn = 0
    while not edges.isEmpty():
        turn += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("r"), F.col(c).alias("x"))  # noqa: E731, B023
        sides = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        to = sides.groupBy("u").agg(F.min(rank("v")).alias("best"))
        to = stored(to.select(F.col("u").alias("from"), F.least("best", rank("u"))["x"].alias("to")), "moves")
        labels = stored(labels.join(to, labels["at"] == to["from"], "left").select("node", F.coalesce("to", "at").alias("at")), "labels")
        u, v = to.select(F.col("from").alias("u"), F.col("to").alias("nu")), to.select(F.col("from").alias("v"), F.col("to").alias("nv"))
        edges = stored(edges.join(u, "u").join(v, "v").where("nu <> nv").select(F.col("nu").alias("u"), F.col("nv").alias("v")).distinct(), "links")
    low = labels.groupBy("at").agg(F.min("node").alias("comp"))
    return labels.join(low, "at").select("node", "comp")


def small_bucket_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) of all pairs of buckets up to SMALL members that are in different components
    and that sizes and signatures allow. Buckets are streamed from sorted partitions; all pairs of a batch are compared at once."""

    def pairs(t: pa.Table) -> pa.RecordBatch:
        key, rep, comp, size = (t[c].to_numpy() for c in ("key", "rep", "comp", "size"))
        sig = _sig_matrix(t["sig"])
        found = [np.zeros((2, 0), np.int64)]
        for shift in range(1, SMALL):
            i = np.flatnonzero(key[shift:] == key[:-shift])
            if not len(i):
                break
            j = i + shift
            ok = (comp[i] != comp[j]) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
            i, j = i[ok], j[ok]
            same = sig[i] == sig[j]
            ok = HASHES - same.sum(1) <= MAX_DISTANCE
            i, j = i[ok], j[ok]
            found.append(np.stack([np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j])]))
        a, b = np.concatenate(found, 1)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
            if not t.num_rows:
                continue
            t = t.combine_chunks()
            key = t["key"].to_numpy()
            cut = int(np.searchsorted(key, key[-1]))  # the last bucket may go on
            rest = t.slice(cut)
            if cut:
                yield pairs(t.slice(0, cut))
        if rest is not None:
            yield pairs(rest)

    return rows.repartition("key").sortWithinPartitions("key").select("key", "rep", "comp", "size", "sig").mapInArrow(K.tidy(work), "a long, b long")


def _labelled(members: DataFrame, comps: DataFrame) -> DataFrame:
    """(key, rep, n, comp) of buckets with several components, and their commonest one:
    main, with m members."""
    rows = members.select("key", "rep", "n").join(comps.select(F.col("node").alias("rep"), "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    sizes = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"))
    main = sizes.groupBy("key").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.max("m").alias("m"), F.count(F.lit(1)).alias("parts"))
    return rows.join(main.where("parts > 1").select(F.col("key").alias("mixed"), "main", "m"), F.col("key") == F.col("mixed")).drop("mixed")


def _dealt(rows: DataFrame, n, outside, *columns: str) -> DataFrame:
    """Deal the members of large groups to tasks: every member is a mate in one of the
    group's blocks of BLOCK, every outside member is active in one of its ACTIVE parts; each
    (block, part) is a task. ``n`` members, ``outside`` of them active."""
    last = F.ceil(n / F.lit(BLOCK)).cast("int") - 1
    subs = F.ceil(outside / F.lit(ACTIVE)).cast("int") - 1
    spot = lambda block, sub, active: F.struct(block.alias("block"), sub.alias("sub"), F.lit(active).alias("active"))
    as_mate = F.transform(F.sequence(F.lit(0), subs), lambda i: spot(F.pmod(F.hash("rep"), last + 1), i, False))
    as_active = F.transform(F.sequence(F.lit(0), last), lambda i: spot(i, F.pmod(F.hash("rep"), subs + 1), True))
    rows = rows.select(F.explode(F.when(F.col("outside"), F.concat(as_mate, as_active)).otherwise(as_mate)).alias("at"), "outside", *columns)
    return rows.select("at.block", "at.sub", "at.active", "outside", *columns)


def _sized(rows: DataFrame, classes: DataFrame) -> DataFrame:
    return rows.join(classes.select(F.col("rep").alias("r"), F.col("n_shingles").alias("size"), "sig"), F.col("rep") == F.col("r")).drop("r")


def _likely(i: int, mate: np.ndarray, comp, size, sig, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Mates of member i in other components that sizes and signatures allow; distances."""
    at = mate[(comp[mate] != comp[i]) & (100 * np.minimum(size[mate], size[i]) >= percent * np.maximum(size[mate], size[i]))]
    d = (sig[at] != sig[i]).sum(1)
    return at[d <= MAX_DISTANCE], d[d <= MAX_DISTANCE]


def nearest_pairs(members: DataFrame, comps: DataFrame, classes: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """(a, b): members outside the commonest component of a bucket over SMALL, each with
    its NEAREST untested mates of other components."""
    rows = _labelled(members.where(F.col("n") > SMALL), comps).withColumn("outside", F.col("comp") != F.col("main"))
    rows = _dealt(_sized(rows, classes), F.col("n"), F.col("n") - F.col("m"), "key", "rep", "comp", "size", "sig")

    def work(key, t):
        rep, comp, size, active = (t[c].to_numpy() for c in ("rep", "comp", "size", "active"))
        sig = _sig_matrix(t["sig"])
        mate = np.flatnonzero(~active)
        found = [np.zeros((3, 0), np.int64)]
        for i in np.flatnonzero(active):
            at, d = _likely(i, mate, comp, size, sig, percent)
            best = np.lexsort((rep[at], d))[:PER_BUCKET]
            found.append(np.stack([np.full(len(best), rep[i]), rep[at[best]], d[best]]))
        a, b, d = np.concatenate(found, 1)
        return pa.table({"active": pa.array(a, pa.int64()), "mate": pa.array(b, pa.int64()), "distance": pa.array(d, pa.int64())})

    pairs = rows.groupBy("key", "block", "sub").applyInArrow(work, "active long, mate long, distance long")
    ordered = (F.least("active", "mate").alias("a"), F.greatest("active", "mate").alias("b"))
    near = lambda df, n: df.withColumn("place", F.row_number().over(Window.partitionBy("active").orderBy("distance", "a", "b"))).where(F.col("place") <= n)
    # a member is met in many buckets: its nearest over all of them first, with one to spare for the
    # pair that the first step tested
    best = near(pairs.groupBy("active", "mate").agg(F.min("distance").alias("distance")).select("active", "distance", *ordered), NEAREST + 1)
    return near(best.drop("place").join(tested, ["a", "b"], "left_anti"), NEAREST).select("a", "b").distinct()


def group_links(docs: DataFrame, members: DataFrame, comps: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Links (a, b) of buckets over SMALL that are still in several components.

    A bucket's outside members are compared, on the full sets, with all members of its
    commonest component and with the others that are outside of a bucket of that
    component. Texts go to the tasks of the component once, and only links leave them, so
    what is exchanged grows with the members, not with their pairs."""
    related = stored(_labelled(members.where(F.col("n") > SMALL), comps).where("comp <> main").select("rep", "main").distinct(), "near_outside")
    if related.isEmpty():
        return None
    label = classes.select("rep").join(comps.select(F.col("node").alias("rep"), "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    mains = related.select(F.col("main").alias("comp")).distinct()
    inside = label.join(mains, "comp").select("rep", F.col("comp").alias("main"), F.lit(False).alias("outside"))
    rows = stored(inside.unionByName(related.withColumn("outside", F.lit(True))).join(label, "rep"), "near_groups")
    counts = rows.groupBy("main").agg(F.count(F.lit(1)).alias("n"), F.count_if("outside").alias("n_out"))
    near, _ = split_by_ids(docs, rows.select(F.col("rep").alias("_id")), rows.count())
    rows = _sized(rows.join(counts, "main"), classes).join(near.withColumnRenamed("_id", "rep"), "rep")
    rows = _dealt(rows, F.col("n"), F.col("n_out"), "main", "rep", "comp", "size", "sig", "text")

    def work(key, t):
        rep, comp, n, active, outside = (t[c].to_numpy() for c in ("rep", "comp", "size", "active", "outside"))
        sig, texts, sets = _sig_matrix(t["sig"]), t["text"].combine_chunks(), {}

        def set_of(i):
            if i not in sets:
                sets[i] = shingle_sets(next(K.runs(texts.slice(i, 1))), size)[0]
            return sets[i]

        mate, a, b = np.flatnonzero(~active), [], []
        for i in np.flatnonzero(active).tolist():
            at, _ = _likely(i, mate, comp, n, sig, percent)
            for j in at[~outside[at] | (rep[at] > rep[i])].tolist():
                both = len(np.intersect1d(set_of(i), set_of(j), assume_unique=True))
                if 100 * both >= percent * (len(set_of(i)) + len(set_of(j)) - both):
                    a.append(min(rep[i], rep[j]))
                    b.append(max(rep[i], rep[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("main", "block", "sub").applyInArrow(work, "a long, b long").distinct()


def small_pairs(members: DataFrame, comps: DataFrame, classes: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """(a, b): untested pairs of buckets up to SMALL that are in different components."""
    rows = _sized(_labelled(members.where(F.col("n") <= SMALL), comps), classes)
    return stored(small_bucket_pairs(rows, percent).distinct(), "near_open").join(tested, ["a", "b"], "left_anti")


def joined_components(comps: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp) after more links, which may name nodes without a component so far."""
    c = lambda x: comps.select(F.col("node").alias(x), F.col("comp").alias(f"c{x}"))
    raised = links.join(c("a"), "a", "left").join(c("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    top = components(raised).select(F.col("node").alias("comp"), F.col("comp").alias("top"))
    known = comps.join(top, "comp", "left").select("node", F.coalesce("top", "comp").alias("comp"))
    fresh = top.join(comps, top["comp"] == comps["node"], "left_anti").select(F.col("comp").alias("node"), F.col("top").alias("comp"))
    return stored(known.unionByName(fresh), "near_components")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per document row: _id, n_shingles, class_id (smallest _id with the same set), comp
    (smallest _id reachable by links)."""
    base = identified(docs)
    feats = stored(features(base, size), "near_features")
    name = ["h1", "h2", "n_shingles"]
    classes = stored(feats.where("n_shingles > 0").groupBy(*name).agg(F.min("_id").alias("rep"), F.first("sig").alias("sig")), "near_classes")
    members = stored(buckets(classes), "near_buckets")
    stars = near_pairs(members.where("rep <> center").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct(), classes, percent)
    tested = stored(stars.groupBy("b").agg(F.min_by("a", F.struct("distance", "a")).alias("a")).select("a", "b"), "near_stars")
    comps = stored(components(stored(confirmed(base, tested, size, percent), "near_links")), "near_components")
    for _ in range(ROUNDS):
        pairs = stored(nearest_pairs(members, comps, classes, tested, percent), "near_pairs")
        if pairs.isEmpty():
            break
        comps = joined_components(comps, stored(confirmed(base, pairs, size, percent), "near_links"))
        tested = tested.unionByName(pairs)
    links = confirmed(base, small_pairs(members, comps, classes, tested, percent), size, percent)
    large = group_links(base, members, comps, classes, size, percent)
    comps = joined_components(comps, stored(links if large is None else links.unionByName(large), "near_links"))
    every = classes.select(*name, "rep").join(comps.select(F.col("node").alias("rep"), "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    every = every.select(*name, F.col("rep").alias("class_id"), "comp")
    return feats.select("_id", *name).join(every, name, "left").select(
        "_id", "n_shingles", F.coalesce("class_id", "_id").alias("class_id"), F.coalesce("comp", "_id").alias("comp")
    )


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest(docs: DataFrame) -> DataFrame:
        out = near_duplicates(docs, size=2, percent=80)
        return out.select(public_id(), "n_shingles", public_id("comp").alias("component_id"), (F.col("_id") == F.col("comp")).alias("kept"))

    return by_text(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest, "component_id")
