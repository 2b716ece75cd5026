"""Quality rules with cross-document line frequency.

Lines are normalised (lower case, white space collapsed) and hashed; distinct
documents are counted per host (the ``source`` column) and line. A line held by
more than ``max_share`` of a host's documents (and more than ``min_docs``) is boilerplate there
and is removed; the limit follows the host, so a corpus of any size is judged alike. A
document that keeps less than ``min_left`` of its word characters is depleted
and rejected, as is one that fails the base rules (fewer than 10 words, or over
20 % of the words inside 5-word windows that occur twice in the text). The pipeline
counts the different texts that hold a line, not the documents (``copies_once``): copies
of one text are for its near-dedup stage to settle, and no boilerplate.

Edge cases: a null or empty text has no words and fails the base rules. A null
host is one host of its own. Rows that repeat a doc_id with its text count as one document in
the line counts, and each gets a result. The query and the pipeline judge every text for itself: rows
without a doc_id, or with one doc_id and different texts, are documents of their own; the
operator below them takes a doc_id for one text. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.llm import kernels as K
from pitchside.llm.common import NULL_ID, by_text, identified, public_id, split_by_ids, stored, unused


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    max_share: float = 0.1  # of a host's documents that may hold a line ...
    min_docs: int = 10  # ... and so many may in any case
    min_left: float = 0.3  # share of word characters that has to stay


SYMBOLS = "#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_LEAD = np.ones(256, bool)  # first bytes of code points
_LEAD[0x80:0xC0] = False
_FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _per_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _seen(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: whether its key occurs again anywhere, whether it is not the first."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    again, later = np.zeros(len(s), bool), np.zeros(len(s), bool)
    again[order] = same[:-1] | same[1:]
    later[order] = same[:-1]
    return again, later


def base_features(t: K.Texts, window: int) -> dict[str, np.ndarray]:
    """The five counts of every document of a run, and its normalised lines' hashes."""
    w = K.words(t, K.NON_SPACE)
    n = len(t)
    salt = K.mix(np.arange(1, n + 1, dtype=np.uint64))  # keeps the documents of a run apart
    lead = K.NON_SPACE[t.data] & _LEAD[t.data]
    out = {"n_words": np.diff(w.bounds), "word_chars": _per_doc(lead, t.offsets), "n_symbols": _per_doc(_SYMBOL[t.data], t.offsets)}

    # lines: every newline and every document end closes one
    cut = np.flatnonzero(t.data == 10)
    ends = np.sort(np.concatenate([cut, t.offsets[1:]]), kind="stable")
    line_doc = np.repeat(np.arange(n), _per_doc(t.data == 10, t.offsets) + 1)
    first = np.ones(len(ends), bool)
    first[1:] = line_doc[1:] != line_doc[:-1]
    starts = np.where(first, t.offsets[line_doc], np.concatenate([[0], ends[:-1] + 1]))
    a, b = np.searchsorted(w.start, starts), np.searchsorted(w.start, ends)
    full = b > a
    raw = K.prefix(K.BYTE_VALUES[t.data], K.BYTE_POWERS)
    key = K.span_hash(raw, starts, ends, K.BYTE_POWERS)[full] ^ salt[line_doc[full]]
    out["n_dup_lines"] = np.bincount(line_doc[full][_seen(key)[1]], minlength=n)

    # windows that occur twice or more in their document
    h, ok = K.gram_hashes(w.hash, w.bounds, window)
    at = np.flatnonzero(ok)
    again = at[_seen(h[at] ^ salt[w.doc[at]])[0]]
    covered = K.marked(again, again + window, len(w.start))
    out["n_repeat_words"] = _per_doc(covered, w.bounds)

    # normalised lines: the hash of the folded words, white space does not count
    folded = K.prefix(K.FOLDED_VALUES[t.data], K.BYTE_POWERS)
    words = K.prefix(K.span_hash(folded, w.start, w.end, K.BYTE_POWERS), K.WORD_POWERS)
    leads = np.zeros(len(lead) + 1, np.int64)
    np.cumsum(lead, out=leads[1:])
    out["line"] = K.span_hash(words, a[full], b[full], K.WORD_POWERS).view(np.int64)
    out["line_chars"] = leads[ends[full]] - leads[starts[full]]
    out["line_bounds"] = np.searchsorted(line_doc[full], np.arange(n + 1))
    return out


def features(docs: DataFrame, host: str = "source", window: int = 5) -> DataFrame:
    """Per row: _id, host, the five counts, and arrays of line hashes and their characters."""
    base = identified(docs, host).withColumnRenamed(host, "host")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, hosts = batch.column(0), batch.column(1), batch.column(2)
            for t in K.runs(texts):
                f = base_features(t, window)
                off = pa.array(f["line_bounds"], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(t.first, len(t)), hosts.slice(t.first, len(t)), *[pa.array(f[c], pa.int64()) for c in _FEATURES],
                     pa.ListArray.from_arrays(off, pa.array(f["line"], pa.int64())), pa.ListArray.from_arrays(off, pa.array(f["line_chars"], pa.int64()))],
                    ["_id", "host", *_FEATURES, "line", "line_chars"],
                )

    return base.withColumn("host", F.col("host").cast("string")).select("_id", "text", "host").mapInArrow(
        K.tidy(work), "_id long, host string, " + ", ".join(f"{c} long" for c in _FEATURES) + ", line array<long>, line_chars array<long>"
    )


def frequent_lines(rows: DataFrame, rules: Rules, copies_once: bool = False) -> DataFrame:
    """(host, line) held by more documents of the host than the rules allow, or with
    ``copies_once`` by more different texts (128-bit hashes of their normalised lines). Each
    task sends one partial count per host, and one per line it saw."""
    held = rows.select("host", "_id", "line")
    if copies_once:
        text = [F.xxhash64("line").alias("t1"), F.xxhash64(F.lit(1), "line").alias("t2")]
        held = held.select("host", *text, "line").dropDuplicates(["host", "t1", "t2"])
    size = held.groupBy(F.col("host").alias("of_host")).agg(F.greatest(F.lit(float(rules.min_docs)), F.count(F.lit(1)) * F.lit(rules.max_share)).alias("limit"))
    lines = held.select("host", F.explode(F.array_distinct("line")).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"))
    many = lines.where(F.col("n_docs") > rules.min_docs)  # most lines end here
    return many.join(size, F.col("host").eqNullSafe(F.col("of_host"))).where(F.col("n_docs") > F.col("limit")).select("host", "line", "n_docs")


def judged(docs: DataFrame, host: str = "source", rules: Rules = Rules(), copies_once: bool = False) -> DataFrame:
    """The features of every document row, what frequent lines take, and the verdict."""
    rows = stored(features(docs, host, rules.window), "quality_features")
    one = rows.dropDuplicates(["_id"])
    hot = frequent_lines(one, rules, copies_once).select(F.col("host").alias("hot_host"), F.col("line").alias("hot_line"))
    lines = one.select("_id", "host", F.explode(F.arrays_zip("line", "line_chars")).alias("l")).select("_id", "host", "l.line", "l.line_chars")
    lost = (
        lines.join(hot, F.col("host").eqNullSafe(F.col("hot_host")) & (F.col("line") == F.col("hot_line")))
        .groupBy("_id").agg(F.sum("line_chars").alias("lost_chars"), F.count(F.lit(1)).alias("n_frequent_lines"), F.collect_set("line").alias("frequent"))
    )
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    left = F.col("word_chars") - F.coalesce("lost_chars", F.lit(0))
    return rows.drop("line", "line_chars").join(lost, "_id", "left").select(
        "_id", *_FEATURES, failed.alias("base_failed"),
        (~failed & (left >= F.lit(rules.min_left) * F.col("word_chars"))).alias("kept"),
        F.coalesce("n_frequent_lines", F.lit(0).cast("long")).alias("n_frequent_lines"), "frequent",
    )


def without_lines(text: str | None, gone: list[int] | None, window: int) -> str | None:
    """The text less its lines whose hashes are given."""
    if not gone or not text:
        return text
    every = text.split("\n")
    data, off = K.buffers(pa.array(every))
    f = base_features(K.Texts(data, off, 0), window)
    at, bad = f["line_bounds"], set(gone)
    return "\n".join(x for i, x in enumerate(every) if at[i] == at[i + 1] or int(f["line"][at[i]]) not in bad)


def kept_documents(docs: DataFrame, host: str = "source", rules: Rules = Rules(), copies_once: bool = False) -> DataFrame:
    """``docs`` that stay, with all their columns and the text without its frequent lines
    (n_chars follows). Only documents that go or lose lines are exchanged."""
    verdict = judged(docs, host, rules, copies_once).where(~F.col("kept") | F.col("frequent").isNotNull())
    verdict = stored(verdict.select("_id", "kept", "frequent").dropDuplicates(["_id"]), "quality_verdicts")
    key = unused(docs, "_id")
    base = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)))
    maybe, clean = split_by_ids(base, verdict, verdict.count(), key)
    at, stay, gone = unused(base, "_at"), unused(base, "_stay"), unused(base, "_gone")
    names = base.columns
    i_text, i_chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in K.slices(batches):
            cols = list(b.columns[: len(names)])
            old = cols[i_text].to_pylist()
            new = [without_lines(text, lines, rules.window) for text, lines in zip(old, b.column(len(names)).to_pylist())]
            cols[i_text] = pa.array(new, cols[i_text].type)
            if i_chars is not None:
                chars = [n if x == y else len(y) for n, x, y in zip(cols[i_chars].to_pylist(), old, new)]
                cols[i_chars] = pa.array(chars, cols[i_chars].type)
            yield pa.RecordBatch.from_arrays(cols, names)

    decided = verdict.select(F.col("_id").alias(at), F.col("kept").alias(stay), F.col("frequent").alias(gone))
    joined = maybe.join(decided.hint("SHUFFLE_HASH"), F.col(key) == F.col(at), "left").where(F.coalesce(stay, F.lit(True)))
    return joined.select(*[maybe[c] for c in names], gone).mapInArrow(K.tidy(cut), base.schema).unionByName(clean).drop(key)


def remove_frequent_lines(docs: DataFrame, host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """doc_id, text without the lines over the limit, and whether the document stays."""
    rows = stored(features(docs, host, rules.window), "quality_features")
    one = rows.dropDuplicates(["_id"])
    hot = frequent_lines(one, rules)
    lines = one.select("_id", "host", F.explode(F.array_distinct("line")).alias("line"))
    gone = lines.join(hot.withColumnsRenamed({"host": "hot_host", "line": "hot_line"}), F.col("host").eqNullSafe(F.col("hot_host")) & (F.col("line") == F.col("hot_line")))
    gone = gone.groupBy("_id").agg(F.collect_list("line").alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in K.slices(batches):
            out = []
            for text, bad in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                out.append(without_lines(text, bad, rules.window))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["_id", "text"])

    stay = judged(docs, host, rules).select("_id", "kept").dropDuplicates(["_id"])
    cleaned = identified(docs).join(gone.hint("SHUFFLE_HASH"), "_id", "left").mapInArrow(K.tidy(cut), "_id long, text string")
    return cleaned.join(stay, "_id").select(public_id(), "text", "kept")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return by_text(docs, lambda rows: judged(rows).select(public_id(), *_FEATURES, "base_failed", "kept"))


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), grams AS (
  SELECT doc_id, i, ws[i : i + 4] AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1))) AS i FROM w)
), twice AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(0, 5) AS r(k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, host, generate_subscripts(l, 1) AS i, unnest(l) AS line FROM (SELECT doc_id, host, string_split(text, chr(10)) AS l FROM w)
), full_lines AS (
  SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw FROM lines
), norm AS (
  SELECT doc_id, host, i, line, translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k, length(array_to_string(lw, '')) AS n
  FROM full_lines WHERE len(lw) > 0
), dup AS (
  SELECT doc_id, count(*) AS n_dup_lines FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS r FROM norm) WHERE r > 1 GROUP BY doc_id
), sizes AS (SELECT host, count(DISTINCT doc_id) AS n FROM w GROUP BY host),
hot AS (SELECT host, k FROM norm JOIN sizes USING (host) GROUP BY host, k, sizes.n HAVING count(DISTINCT doc_id) > greatest(10, 1e-1 * sizes.n)),
lost AS (SELECT doc_id, sum(n) AS lost FROM norm JOIN hot USING (host, k) GROUP BY doc_id),
f AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN lost USING (doc_id)
), j AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars - lost >= 0.3 * word_chars AS kept FROM j
"""
