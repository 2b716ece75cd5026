"""Mixing sources to target weights by Pareto order sampling.

Every source has a target in words (see ``targets``). A document's expected number of
copies is target / source size: its whole part is allocated to every document for certain,
the rest is sampled. Documents of a source are split into size classes (32 to a doubling, so
sizes within one differ by at most 1/32), and each class gives a sample of fixed size. The
sizes are set from the largest class down, by randomised rounding within what the smaller
classes can make up for: what one class gives too much or too little they give less or more, so a
source misses its target by little more than its smallest document. Inside a class documents have inclusion probabilities in proportion to
their size (at most 1 - (1 - f) / 4, with f the sampled share of the class), and
those with the smallest random odds / inclusion odds are taken.

Ranks are found without a window over a source: the order statistic is cut into ``BUCKETS``
intervals, their counts are summed up, and rows are numbered inside their interval. Random
numbers are MD5 digests of the seed, the doc_id and the text, so reruns agree. DataFrame
expressions only.

Edge cases: a null or empty text has size 0 and is taken 0 times. A null source is one source,
after all others. Rows without a doc_id, or with one doc_id and different texts, are documents of
their own; equal rows are interchangeable. Equal order statistics (equal rows) are ordered
in any way. An empty table gives an empty result; if all sizes are 0, so are all targets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchside.llm.common import stored, unused

SEED = 20
WEIGHTS = (3, 1, 2)  # of the sources in code point order, repeating
TOTAL = 1.5  # of all sizes
MOST = 2.0  # copies of a document, and target of a source as a multiple of its size
BUCKETS = 1024
# Java reads a class of all but six ASCII characters code point by code point
_WORDS = r"size(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 0))"


def uniform(text: Column) -> Column:
    """A number between 0 and 1 from 52 bits of the text's digest."""
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def size_class() -> Column:
    """0 for empty documents; the bit length of the size and its next five bits otherwise."""
    return F.expr("CASE WHEN size > 0 THEN 32 * length(bin(size)) + shiftright(32 * size, length(bin(size)) - 1) - 63 ELSE 0 END").cast("long")


def sizes(docs: DataFrame, source: str = "source", seed: int = SEED) -> DataFrame:
    """Per row: doc_id, part ('=' and the source; empty for null), size, digest of the text, u."""
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs[source].cast("string").alias("part"))
    rows = base.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), "part"), F.lit("")).alias("part"),
        F.expr(_WORDS).cast("long").alias("size"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"),
    )
    return rows.withColumn("u", uniform(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest"))).withColumn("class", size_class())


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """One row per source: part, source_size, target.

    The sources share ``total`` times all words by weight; a target stops at ``most`` times its
    source's size, and the others share the excess by weight. That ends at one level
    L with target = min(most x size, L x weight). In the order of most x size / weight, the sources
    that stop come first, so L is found by running sums over the source table (one small row
    per source)."""
    per_source = rows.groupBy("part").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("part") == "", "part")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most))
    per_source = per_source.withColumn("weight", weight).withColumn("cap", cap).withColumn("full", F.col("cap") / F.col("weight"))
    order = Window.orderBy("full", "part")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.orderBy("full", "part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) * F.lit(float(total)) - before) / rest
    per_source = per_source.withColumn("at", F.row_number().over(order)).withColumn("level", level)
    first = F.min(F.when(F.col("level") <= F.col("full"), F.struct("at", "level"))).over(everything)
    return per_source.select("part", "source_size", F.least("cap", F.coalesce(first["level"], F.lit(0.0)) * F.col("weight")).alias("target"))


def class_samples(rows: DataFrame, goals: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per source and size class: the target columns, whole copies, the class's count and
    words, and how many of its documents get one copy more."""
    square = F.col("size").cast("decimal(38,0)") * F.col("size")
    cells = rows.where("size > 0").groupBy("part", "class").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"), F.sum(square.cast("decimal(38,0)")).cast("double").alias("squares"))
    cells = cells.withColumn("u", uniform(F.concat_ws("|", F.lit(str(seed)), "part", "class")))
    smaller = Window.partitionBy("part").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("below", F.coalesce(F.sum("words").over(smaller), F.lit(0)))
    # one entry per size class
    lists = cells.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("class", "n", "words", "squares", "u", "below")), asc=False).alias("cells"))
    share = F.col("target") / F.col("source_size")
    lists = lists.join(goals, "part").withColumn("whole", F.floor(share)).withColumn("share", share - F.floor(share))
    # a.left: the words that this class and the smaller ones are to give
    wanted = "floor((a.left - share * c.below) * c.words / c.squares + c.u)"
    least = "ceil((a.left - c.below) * c.words / c.squares)"
    nearest = "floor((a.left - c.below / 2D) * c.words / c.squares + 0.5D)"  # where no number can be made up for
    most = f"greatest(floor(a.left * c.words / c.squares), least({least}, {nearest}))"
    take = f"greatest(0L, least(c.n, greatest(least({least}, {most}), least({most}, {wanted}))))"
    planned = F.expr(
        f"""aggregate(cells, named_struct('left', share * source_size, 'out', cast(array() AS array<struct<class: bigint, n: bigint, words: bigint, take: bigint>>)),
        (a, c) -> named_struct('left', a.left - {take} * (c.squares / c.words), 'out', concat(a.out, array(named_struct('class', c.class, 'n', c.n, 'words', c.words, 'take', {take}))))).out"""
    )
    return lists.select("part", "source_size", "target", "whole", F.explode(planned).alias("c")).select("part", "source_size", "target", "whole", "c.*")


def copies(docs: DataFrame, source: str = "source", weights: Sequence[int] = WEIGHTS, total: float = TOTAL, most: float = MOST, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, digest, size, source_size, target and its copies in the mix."""
    rows = stored(sizes(docs, source, seed), "mixture_sizes")
    goals = stored(targets(rows, weights, total, most), "mixture_targets")
    cells = stored(class_samples(rows, goals, seed), "mixture_classes")

    full = rows.where("size > 0").join(cells, ["part", "class"])
    f = F.col("take") / F.col("n")
    p = F.least(F.col("take") * F.col("size") / F.col("words"), F.lit(1.0) - (F.lit(1.0) - f) / F.lit(4.0))
    ranked = full.withColumn("f", f).withColumn("p", p).withColumn("odds", F.col("u") / (F.lit(1.0) - F.col("u")))
    statistic = F.when(F.col("f").between(1e-12, 1 - 1e-12), F.col("odds") * (F.lit(1.0) - F.col("p")) / F.col("p")).otherwise(F.col("odds"))
    ranked = ranked.withColumn("x", statistic)
    # in units of the class's own odds the statistic is near u / (1 - u): buckets are even
    scaled = F.when(F.col("f").between(1e-12, 1 - 1e-12), F.col("x") * F.col("f") / (F.lit(1.0) - F.col("f"))).otherwise(F.col("x"))
    ranked = ranked.withColumn("bucket", F.least(F.floor(scaled / (F.lit(1.0) + scaled) * F.lit(BUCKETS)), F.lit(BUCKETS - 1)).cast("int"))
    cell = ["part", "class", "bucket"]
    ranked = ranked.select(*cell, "doc_id", "digest", "size", "source_size", "target", "whole", "take", "x")
    counts = ranked.groupBy(*cell).agg(F.count(F.lit(1)).alias("inside"))
    earlier = Window.partitionBy("part", "class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*cell, F.coalesce(F.sum("inside").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy(*cell).orderBy("x", "digest", "doc_id"))
    chosen = ranked.withColumn("place", place).join(counts, cell)
    extra = (F.col("before") + F.col("place") <= F.col("take")).cast("long")
    taken = chosen.select("doc_id", "digest", "size", "source_size", "target", (F.col("whole") + extra).alias("copies"))
    empty = rows.where("size = 0").join(goals, "part").select("doc_id", "digest", "size", "source_size", "target", F.lit(0).cast("long").alias("copies"))
    return taken.unionByName(empty)


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix, with all their columns: each document as often as it is taken."""
    plan = copies(docs, **options).groupBy("doc_id", "digest").agg(F.sum("copies").alias("n")).where("n > 0")
    at, times, k = unused(docs, "_digest"), unused(docs, "_copies"), unused(docs, "_id")
    plan = plan.select(F.col("doc_id").alias(k), F.col("digest").alias(at), F.col("n").alias(times))
    rows = docs.withColumn(at, F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    rows = rows.dropDuplicates(["doc_id", at])  # equal rows have their copies together
    found = rows.join(plan, rows["doc_id"].cast("long").eqNullSafe(plan[k]) & (rows[at] == plan[at]))
    return found.select(*[rows[c] for c in docs.columns], F.explode(F.sequence(F.lit(1).cast("long"), plan[times])).alias(times)).drop(times)


def op12_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP12_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || source, '') AS part, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(coalesce(text, '')) AS digest FROM documents
), r AS (
  SELECT *, (CAST('0x' || md5('20|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || digest)[1:13] AS BIGINT) + 5e-1) / 4503599627370496e0 AS u,
    CASE WHEN size > 0 THEN 32 * length(to_base(size, 2)) + ((32 * size) >> (length(to_base(size, 2)) - 1)) - 63 ELSE 0 END AS class FROM d
), w AS (
  SELECT part, source_size, CAST([3, 1, 2][(row_number() OVER (ORDER BY part = '', part) - 1) % 3 + 1] AS DOUBLE) AS weight
  FROM (SELECT part, CAST(sum(size) AS BIGINT) AS source_size FROM r GROUP BY part)
), o AS (
  SELECT *, (1.5e0 * sum(source_size) OVER () - coalesce(sum(2e0 * source_size) OVER (ORDER BY 2e0 * source_size / weight, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY 2e0 * source_size / weight, part ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
    row_number() OVER (ORDER BY 2e0 * source_size / weight, part) AS pos FROM w
), t AS (
  SELECT part, source_size, least(2e0 * source_size, coalesce((SELECT arg_min(level, pos) FROM o WHERE level <= 2e0 * source_size / weight), 0e0) * weight) AS target FROM o
), g AS (SELECT *, CAST(floor(target / source_size) AS BIGINT) AS whole, target / source_size - floor(target / source_size) AS share FROM t),
cells AS (
  SELECT part, class, count(*) AS n, CAST(sum(size) AS BIGINT) AS words, CAST(sum(size * size) AS DOUBLE) AS squares,
    (CAST('0x' || md5('20|' || part || '|' || CAST(class AS VARCHAR))[1:13] AS BIGINT) + 5e-1) / 4503599627370496e0 AS u,
    row_number() OVER (PARTITION BY part ORDER BY class DESC) AS i,
    CAST(coalesce(sum(sum(size)) OVER (PARTITION BY part ORDER BY class ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS below
  FROM r WHERE size > 0 GROUP BY part, class
), planned AS (
  SELECT part, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS class, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS words, CAST(0 AS BIGINT) AS take, share * source_size AS left_over FROM g
  UNION ALL
  SELECT part, i, class, n, words, take, left_over - take * (squares / words) FROM (
    SELECT part, i, class, n, words, squares, left_over, CAST(greatest(0, least(n, greatest(least(lo, hi), least(hi, wanted)))) AS BIGINT) AS take FROM (
      SELECT *, greatest(floor(left_over * words / squares), least(lo, floor((left_over - below / 2e0) * words / squares + 5e-1))) AS hi FROM (
        SELECT c.*, p.left_over, ceil((p.left_over - c.below) * c.words / c.squares) AS lo, floor((p.left_over - g.share * c.below) * c.words / c.squares + c.u) AS wanted
        FROM planned p JOIN cells c ON c.part = p.part AND c.i = p.i + 1 JOIN g ON g.part = c.part
      )
    )
  )
), x AS (
  SELECT r.*, p.take, CASE WHEN take > 0 AND take < n THEN u / (1e0 - u) * (1e0 - q) / q ELSE u / (1e0 - u) END AS x FROM r JOIN planned p USING (part, class),
    LATERAL (SELECT least(CAST(p.take AS DOUBLE) * r.size / p.words, 1e0 - (1e0 - CAST(p.take AS DOUBLE) / p.n) / 4e0) AS q)
  WHERE r.size > 0
), ranked AS (SELECT *, row_number() OVER (PARTITION BY part, class ORDER BY x, digest, doc_id) <= take AS extra FROM x)
SELECT doc_id, size, source_size, target, size * (whole + CAST(extra AS BIGINT)) AS taken FROM ranked JOIN g USING (part)
UNION ALL SELECT doc_id, size, source_size, target, CAST(0 AS BIGINT) FROM r JOIN g USING (part) WHERE size = 0
"""
