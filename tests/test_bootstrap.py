"""Bootstrap and rank ranges: properties of the intervals, draws and ranks."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchside.operators import resample


def _classes(spark, values, counts=None):
    """Classes of ``counts`` rows (1 if not given) with values v and their negatives w."""
    start, rows = 0, []
    for v, n in zip(values, counts or [1] * len(values)):
        rows.append((start, n, v, -v if v is not None else None))
        start += n
    return spark.createDataFrame(rows, "start long, n long, v double, w double")


def _cis(df, metrics=("v",), **kw):
    return {r["metric"]: (r["ci_lo"], r["ci_hi"]) for r in resample.bootstrap_cis(df, list(metrics), **kw).collect()}


def _waves(n):
    """Values in [0, 3) without a pattern that a linear pick could match."""
    return [(i * i * 37 % 101) / 101 * 3 for i in range(n)]


def test_same_seed_same_interval_other_seed_another(spark):
    df = _classes(spark, _waves(90))
    first = _cis(df, n_resamples=200, seed=3)
    assert first == _cis(df.repartition(5), n_resamples=200, seed=3)
    assert first != _cis(df, n_resamples=200, seed=4)


def test_interval_narrows_with_the_square_root_of_n(spark):
    width = []
    for n in (60, 960):
        lo, hi = _cis(_classes(spark, _waves(n)), n_resamples=500, seed=8)["v"]
        assert lo < sum(_waves(n)) / n < hi
        width.append(hi - lo)
    assert 3 < width[0] / width[1] < 5.3


def test_interval_shifts_scales_and_mirrors_with_the_data(spark):
    base = _waves(150)
    lo, hi = _cis(_classes(spark, base), n_resamples=150, seed=2)["v"]
    moved = _cis(_classes(spark, [5 * x + 7 for x in base]), ("v", "w"), n_resamples=150, seed=2)
    assert moved["v"] == pytest.approx((5 * lo + 7, 5 * hi + 7))
    assert moved["w"] == pytest.approx((-moved["v"][1], -moved["v"][0]))  # the same draws serve every metric


def test_classes_and_their_single_rows_give_the_same_means(spark):
    values, counts = [0.25, 4.0, None, 1.5], [40, 1, 17, 200]
    rows = [v for v, n in zip(values, counts) for _ in range(n)]
    means = lambda df: {r["resample"]: round(r["v"], 9) for r in resample.bootstrap_means(df, ["v"], 60, 11).collect()}
    assert means(_classes(spark, values, counts)) == means(_classes(spark, rows))


def test_class_counts_are_multinomial(spark):
    """Every resample draws n rows; a class is drawn in proportion to its rows."""
    counts = [300, 1, 0, 99, 600]
    rows = resample.class_counts(_classes(spark, [0.0] * 5, counts), 400, 21).collect()
    total, by_class = {}, {}
    for r in rows:
        total[r["resample"]] = total.get(r["resample"], 0) + r["c"]
        by_class[r["class"]] = by_class.get(r["class"], 0) + r["c"]
    assert len(total) == 400 and set(total.values()) == {1000}
    for start, n in zip((0, 300, 301, 400), (300, 1, 99, 600)):
        assert abs(by_class[start] - 400 * n) < 5 * (400 * n) ** 0.5


def test_no_rows_no_intervals(spark):
    assert _cis(_classes(spark, [1.0], [0])) == {}
    assert _cis(_classes(spark, [1.0]).limit(0)) == {}


def test_ranges_and_intervals_do_not_depend_on_the_buckets(spark):
    df = spark.range(300).select((F.col("id") % 11).alias("g"), (F.col("id") * 7).alias("x"), (F.col("id") % 9 + 1).alias("n"), (F.col("id") % 5).cast("double").alias("v"))
    got = []
    for buckets in (1, 64, 128, 4096):
        ranked = resample.rank_ranges(df, ["g", "x"], ["g", "x"], "n", buckets)
        rows = sorted(map(tuple, ranked.select("start", "n", "g", "x").collect()))
        at = 0
        for start, n, _, _ in rows:
            assert start == at
            at += n
        got.append((rows, _cis(ranked, n_resamples=50, seed=5)))
    assert all(x == got[0] for x in got[1:])


def test_dense_index_is_a_bijection(spark):
    df = spark.range(1000).select(
        (F.col("id") % 7).alias("g"), (F.col("id") * 13 % 101).cast("string").alias("s"), F.col("id").alias("v")
    )
    idx = resample.dense_index(df, ["g", "s", "v"], ["g", "s", "v"], buckets=16)
    got = sorted(r[0] for r in idx.select("row_idx").collect())
    assert got == list(range(1000))
    # same input, same index (no dependence on partitioning)
    again = resample.dense_index(df.repartition(3), ["g", "s", "v"], ["g", "s", "v"], buckets=16)
    key = lambda d: sorted((r["v"], r["row_idx"]) for r in d.select("v", "row_idx").collect())
    assert key(idx) == key(again)


def test_poisson_weights_have_unit_mean(spark):
    u = spark.range(200_000).select((F.col("id").cast("double") + 0.5) / F.lit(200_000.0)).toDF("u")
    mean = u.select(resample.poisson_weight(F.col("u")).alias("w")).agg(F.avg("w")).first()[0]
    assert abs(mean - 1.0) < 1e-3


def test_dense_index_splits_a_hot_group_of_copies(spark):
    """A third of the rows are exact copies; they keep contiguous ranks and the
    index is still the same bijection as without the split."""
    base = spark.range(600).select((F.col("id") % 11).alias("g"), F.col("id").cast("string").alias("s"))
    copies = spark.range(300).select(F.lit(5).cast("bigint").alias("g"), F.lit("hot").alias("s"))
    df = base.unionByName(copies)
    small_blocks = resample.dense_index(df, ["g", "s"], ["g", "s"], buckets=8, block=7)
    one_block = resample.dense_index(df, ["g", "s"], ["g", "s"], buckets=8, block=10_000)
    rows = lambda d: sorted((r["row_idx"], r["g"], r["s"]) for r in d.collect())
    got = rows(small_blocks)
    assert [r[0] for r in got] == list(range(900))
    assert got == rows(one_block)
    hot = [r[0] for r in got if r[2] == "hot"]
    assert hot == list(range(hot[0], hot[0] + 300))


def test_keys_of_copies_differ_and_are_stable(spark):
    df = spark.range(900).select((F.col("id") % 3).alias("g"), F.lit("x").alias("s"))
    keys = sorted(r[0] for r in resample.keyed_rows(df, ["g", "s"], block=50).select("row_key").collect())
    assert len(set(keys)) == 900
    assert keys == sorted(r[0] for r in resample.keyed_rows(df.repartition(5), ["g", "s"]).select("row_key").collect())


def test_poisson_table_reaches_double_precision():
    cdf = resample.POISSON1_CDF
    assert 1.0 - cdf[-1] < 1e-15 and list(cdf) == sorted(set(cdf))


def test_poisson_method_repeats_and_covers_the_mean(spark):
    values = _waves(200)
    df = _classes(spark, values).withColumnRenamed("start", "row_key")
    first = _cis(df, ("v", "w"), n_resamples=300, seed=6, method="poisson")
    assert first == _cis(df.repartition(3), ("v", "w"), n_resamples=300, seed=6, method="poisson")
    lo, hi = first["v"]
    assert lo < sum(values) / len(values) < hi
    assert first["w"] == pytest.approx((-hi, -lo))


def test_poisson_means_leave_out_null_metrics(spark):
    df = spark.createDataFrame([(i, 2.5 if i % 3 else None) for i in range(60)], "row_key long, v double")
    assert {round(r["v"], 12) for r in resample.poisson_bootstrap_means(df, ["v"], 20, 1).collect()} == {2.5}


def _plain_poisson_means(df, metrics, n_resamples, seed):
    """One row per weight, in Spark's own arithmetic."""
    rows = df.select("row_key", *metrics, F.explode(F.sequence(F.lit(0), F.lit(n_resamples - 1))).alias("resample"))
    rows = resample.with_mix_hash(rows, seed, "resample", "row_key", "_u")
    w = resample.poisson_weight(F.col("_u").cast("double") / F.lit(2.0**63))
    rows = rows.select("resample", *metrics, w.alias("w"))
    mean = lambda m: F.sum(F.col("w") * F.col(m)) / F.nullif(F.sum(F.when(F.col(m).isNotNull(), F.col("w"))), F.lit(0))
    return rows.groupBy("resample").agg(*[mean(m).alias(m) for m in metrics])


def test_poisson_means_are_those_of_a_row_per_weight(spark):
    rng = random.Random(3)
    keys = [0, 1, -1, 2**63 - 1, -(2**63), None, 5, 5] + [rng.randrange(-(2**63), 2**63) for _ in range(300)] + [rng.randrange(1 << 60) for _ in range(500)]
    rows = [(k, rng.choice([None, float(i), 0.25]), i if i % 7 else None, None) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "row_key long, v double, i int, never double").repartition(3)
    metrics = ["v", "i", "never"]
    got, want = (
        {r["resample"]: tuple(r[m] for m in metrics) for r in f(df, metrics, 130, 77).collect()}
        for f in (resample.poisson_bootstrap_means, _plain_poisson_means)
    )
    assert got.keys() == want.keys() == set(range(130))
    for b in got:
        assert got[b][2] is None and want[b][2] is None
        assert got[b][:2] == pytest.approx(want[b][:2], rel=1e-12)
    one = [spark.createDataFrame([(9, 4.0)], "row_key long, v double"), spark.createDataFrame([], "row_key long, v double"), spark.createDataFrame([(None, 4.0)], "row_key long, v double")]
    for d in one:  # resamples without a row, no rows, no key
        assert sorted(map(tuple, resample.poisson_bootstrap_means(d, ["v"], 20, 1).collect())) == sorted(map(tuple, _plain_poisson_means(d, ["v"], 20, 1).collect()))


def test_poisson_weights_where_the_leading_bits_do_not_tell():
    """Numbers at the borders of the weights, and the weights of many keys."""
    u = np.array([int(c * 2**63) + d for c in resample.POISSON1_CDF[:12] for d in (-1025, -1024, -1, 0, 1, 1024)], np.int64)
    want = [sum(float(int(x)) / 2.0**63 >= c for c in resample.POISSON1_CDF) for x in u]
    assert resample._weight_of(u).tolist() == want
    keys = np.arange(5000, dtype=np.int64) * 0x9E3779B97F4A7
    total = sum(w.sum() for _, w in resample.poisson_weights(keys, 100, 3))
    assert total / 500_000 == pytest.approx(1.0, abs=0.01)


def test_no_row_per_weight_is_made(spark):
    df = spark.createDataFrame([(1, 2.0)], "row_key long, v double")
    plan = resample.poisson_bootstrap_means(df, ["v"], 20, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_unknown_method_is_refused(spark):
    with pytest.raises(ValueError, match="jackknife"):
        resample.bootstrap_cis(_classes(spark, [1.0]), ["v"], method="jackknife")


def test_draws_are_counted_where_they_are_made(spark):
    """No exchange carries n x B rows: what leaves the range is a partial count per class."""
    from pitchside.sources.store import materialize

    n, resamples, classes = 30_000, 100, 12
    df = materialize(_classes(spark, _waves(classes), [n // classes] * classes), "test_classes")
    counts = resample.class_counts(df, resamples, 1)
    counts.collect()
    plan = counts._jdf.queryExecution().executedPlan()
    written = []

    def walk(node):
        if "Exchange" in node.nodeName():
            m = node.metrics()
            for key in ("shuffleRecordsWritten", "numOutputRows"):
                if m.contains(key):
                    written.append(m.apply(key).value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        if "QueryStage" in node.getClass().getSimpleName():
            walk(node.plan())

    walk(plan)
    # two tasks may share a resample: far below n x B = 3,000,000
    assert written and max(written) <= 2 * resamples * classes
