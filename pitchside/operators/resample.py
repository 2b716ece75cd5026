"""Dense row index and the percentile bootstrap.

Both are built from hashing, joins and aggregates, so they run distributed
and give the same numbers on every run, cluster size and bucket count.

Rank ranges. Rows are ordered by (hash of their columns, their columns), and equal rows
are one class with a count, which takes a contiguous range of ranks. A bucket is a range
of the hash (its high bits), so buckets follow each other in that order: classes are
placed inside their bucket and shifted by the row count of the lower buckets, and the
number of buckets changes the work, never the ranks. ``dense_index`` gives every copy
its own rank, expanded in blocks, so a hot group of copies is split over tasks.

Bootstrap. Draw ``d`` of resample ``b`` is the rank ``mix(seed, b, d) mod n`` (an integer mixing
hash, three multiply-xorshift rounds kept below 2^63 so no engine overflows). The metrics of a
row depend on its class only, so a draw is looked up in the classes' ranges where it is made, and
what leaves the task is a count per (resample, class). The ranks are cut into cells of about
n / classes ranks, each class has a row per cell that it reaches, and the lookup is an equi-join on
the cell with the range as a condition: at most two rows a class, in plain columns inside
codegen. Spark broadcasts that table by its own size check (it does not grow with the rows,
only with the classes); where it is larger, the draws are exchanged by cell. The same draws
serve every metric, so the intervals are jointly consistent.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchside import config
from pitchside.sources import store

DRAWS_PER_TASK = 4_000_000
HASH_BITS = 32


def md5_int(text: Column, hex_digits: int = 8) -> Column:
    """Leading ``hex_digits`` of an MD5 digest as a non-negative integer."""
    return F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("bigint")


def row_text(hash_cols: Sequence[str | Column]) -> Column:
    return F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in hash_cols])


def _expanded(starts: DataFrame, cols: Sequence[str], name: str, block: int) -> DataFrame:
    """One row per copy: ``_start`` + 0.. of each row's ``_m`` copies, as ``name``.

    Small groups expand where they are. Large ones are cut into blocks that are spread
    over tasks (only the few block rows are exchanged) and expanded there."""
    small = starts.where(F.col("_m") <= block).select(
        *cols, "_start", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)).alias("_t")
    ).select(*cols, (F.col("_start") + F.col("_t")).alias(name))
    blocks = starts.where(F.col("_m") > block).select(
        *cols, "_start", "_m",
        F.explode(F.sequence(F.lit(0), ((F.col("_m") - 1) / F.lit(block)).cast("bigint"))).alias("_j"),
    ).select(
        *cols,
        (F.col("_start") + F.col("_j") * F.lit(block)).alias("_from"),
        F.least(F.lit(block), F.col("_m") - F.col("_j") * F.lit(block)).alias("_len"),
    )
    large = (
        blocks.repartition("_from")
        .select(*cols, "_from", F.explode(F.sequence(F.lit(0), F.col("_len") - 1)).alias("_t"))
        .select(*cols, (F.col("_from") + F.col("_t")).alias(name))
    )
    return small.unionByName(large)


def rank_ranges(
    classes: DataFrame, order_cols: Sequence[str], hash_cols: Sequence[str | Column], count: str, buckets: int = 256, name: str = "start"
) -> DataFrame:
    """Add ``name`` = the first of the ``count`` ranks (0-based) that each row takes in the
    order (hash, order_cols). ``buckets``: a power of two, the number of windows the ranks
    are spread over; the result does not depend on it."""
    if buckets & (buckets - 1) or not 0 < buckets <= 1 << 20:
        raise ValueError("buckets must be a power of two, at most 2^20")
    shift = HASH_BITS - (buckets.bit_length() - 1)
    cols = list(classes.columns)
    order = [F.col("_h").asc(), *[F.col(c).asc_nulls_first() for c in order_cols]]
    placed = classes.withColumn("_h", md5_int(row_text(hash_cols))).withColumn("_bucket", F.shiftright("_h", shift))
    w = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.withColumn("_local", F.sum(count).over(w) - F.col(count))
    counts = placed.groupBy("_bucket").agg(F.sum(count).alias("_n"))
    # at most ``buckets`` rows: a one-task running sum and a bounded broadcast
    offsets = counts.select(
        "_bucket",
        (F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_off"),
    )
    return local.join(F.broadcast(offsets), "_bucket").select(*cols, (F.col("_off") + F.col("_local")).alias(name))


def dense_index(
    df: DataFrame,
    order_cols: Sequence[str],
    hash_cols: Sequence[str | Column],
    buckets: int = 256,
    name: str = "row_idx",
    block: int = 100_000,
) -> DataFrame:
    """Add ``name`` = rank of the row (0-based) in the order (hash, order_cols). Copies take
    the contiguous range of ranks they would have had one by one."""
    cols = list(df.columns)
    distinct = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
    return _expanded(rank_ranges(distinct, order_cols, hash_cols, "_m", buckets, "_start"), cols, name, block)


def keyed_rows(df: DataFrame, hash_cols: Sequence[str | Column], name: str = "row_key", block: int = 100_000) -> DataFrame:
    """Add ``name`` = a 60-bit key from the row's content and its copy number: stable, and
    different for copies, without ranking or counting the rows."""
    cols = list(df.columns)
    starts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m")).withColumn("_start", F.lit(0).cast("bigint"))
    copies = _expanded(starts, cols, "_copy", block)
    return copies.select(*cols, md5_int(F.concat_ws("|", row_text(hash_cols), F.col("_copy").cast("string")), 15).alias(name))


_M32 = 0xFFFFFFFF
_MIX = 0x45D9F3B  # odd multiplier below 2^27: products stay below 2^59
_SALT = 0x9E3779B9


def _mix32(df: DataFrame, c: str) -> DataFrame:
    """Two multiply-xorshift rounds and a final xorshift on column ``c``.

    Each round is its own projection: a round reads its input twice, and
    nesting them in one expression would grow the tree exponentially."""
    x = F.col(c)
    for _ in range(2):
        df = df.withColumn(c, (F.shiftright(x, 16).bitwiseXOR(x) * F.lit(_MIX)).bitwiseAND(F.lit(_M32)))
    return df.withColumn(c, F.shiftright(x, 16).bitwiseXOR(x))


def with_mix_hash(df: DataFrame, seed: int, b: str, d: str, out: str) -> DataFrame:
    """Add ``out`` = non-negative 63-bit hash of (seed, b, d), exact in 64-bit integers."""
    m32 = F.lit(_M32)
    df = _mix32(df.withColumn("_h", F.lit(seed & _M32).cast("bigint").bitwiseXOR(F.col(b).bitwiseAND(m32))), "_h")
    df = _mix32(df.withColumn("_h", F.col("_h").bitwiseXOR(F.col(d).bitwiseAND(m32))), "_h")
    df = _mix32(df.withColumn("_h", F.col("_h").bitwiseXOR(F.shiftright(F.col(d), 32))), "_h")
    df = _mix32(df.withColumn("_hi", F.col("_h").bitwiseXOR(F.lit(_SALT))), "_hi")
    return df.withColumn(
        out, F.col("_hi").bitwiseAND(F.lit(0x7FFFFFFF)) * F.lit(1 << 32) + F.col("_h")
    ).drop("_h", "_hi")


def draws(spark: SparkSession, n: int, n_resamples: int, seed: int) -> DataFrame:
    """(resample, rank): n draws with replacement from the ranks 0..n-1 for each resample."""
    total = n * n_resamples
    parts = max(spark.sparkContext.defaultParallelism, -(-total // DRAWS_PER_TASK))
    made = spark.range(0, total, 1, parts).select(
        (F.col("id") / F.lit(n)).cast("bigint").alias("resample"),
        (F.col("id") % F.lit(n)).alias("_d"),
    )
    # non-nullable: otherwise a join's inferred IS NOT NULL filter is pushed below the staged
    # projections with every alias substituted
    rank = F.coalesce(F.pmod(F.col("_u"), F.lit(n)), F.lit(-1))
    return with_mix_hash(made, seed, "resample", "_d", "_u").select("resample", rank.alias("rank"))


def cells(classes: DataFrame, width: int, start: str = "start", count: str = "n") -> DataFrame:
    """(cell, class, end): one row for every cell of ``width`` ranks that a class's range
    [class, end) reaches."""
    last = ((F.col(start) + F.col(count) - 1) / F.lit(width)).cast("bigint")
    first = (F.col(start) / F.lit(width)).cast("bigint")
    return classes.where(F.col(count) > 0).select(
        F.explode(F.sequence(first, last)).alias("cell"), F.col(start).alias("class"), (F.col(start) + F.col(count)).alias("end")
    )


def class_counts(classes: DataFrame, n_resamples: int, seed: int, start: str = "start", count: str = "n") -> DataFrame:
    """(resample, class, c): how often each resample draws from each class; a class is named by its
    first rank. Partial counts are taken where the draws are made."""
    spark = classes.sparkSession
    size = classes.agg(F.sum(count), F.count(F.lit(1))).first()  # two numbers to the driver
    n, n_classes = size[0] or 0, size[1]
    if n == 0:
        return spark.createDataFrame([], "resample long, class long, c long")
    width = max(1, n // n_classes)
    # written, so that its true size decides how it is joined
    table = store.materialize(cells(classes, width, start, count), "bootstrap_cells")
    made = draws(spark, n, n_resamples, seed)
    made = made.withColumn("cell", F.coalesce((F.col("rank") / F.lit(width)).cast("bigint"), F.lit(-1)))
    found = made.join(table, (made["cell"] == table["cell"]) & (made["rank"] >= table["class"]) & (made["rank"] < table["end"]))
    return found.groupBy("resample", "class").agg(F.count(F.lit(1)).alias("c"))


def bootstrap_means(
    classes: DataFrame, metrics: Sequence[str], n_resamples: int, seed: int, start: str = "start", count: str = "n"
) -> DataFrame:
    """Mean of each metric per resample: columns ``resample`` and the metrics.

    ``classes``: rows of equal metrics, ``count`` of them with the ranks from ``start`` on. A
    metric that is NULL in a class is left out of its means, as AVG does."""
    counts = class_counts(classes, n_resamples, seed, start, count)
    values = classes.select(F.col(start).alias("class"), *metrics)
    mean = lambda m: F.sum(F.col("c") * F.col(m)) / F.nullif(F.sum(F.when(F.col(m).isNotNull(), F.col("c"))), F.lit(0))
    return counts.join(values, "class").groupBy("resample").agg(*[mean(m).alias(m) for m in metrics])


def _poisson1_cdf() -> tuple[float, ...]:
    """Cumulative probabilities P(X <= k), k = 0.., until a term no longer changes the
    double sum: no weight that a double can tell is cut off."""
    out, total, k = [], 0.0, 0
    while not out or total + math.exp(-1.0) / math.factorial(k) != out[-1]:
        total += math.exp(-1.0) / math.factorial(k)
        out.append(total)
        k += 1
    return tuple(out)


POISSON1_CDF = _poisson1_cdf()
_TWO63 = float(2**63)


def poisson_weight(u: Column) -> Column:
    """Poisson(1) draw from a uniform ``u`` in [0, 1) by the inverse CDF."""
    w = None
    for c in POISSON1_CDF:
        term = (u >= F.lit(c)).cast("int")
        w = term if w is None else w + term
    return w


_WEIGHT_BITS = 16  # leading bits of a hash that nearly always tell its weight
_BLOCK = 64  # rows whose weights are made at once: the numbers stay in the processor's cache


def _mix32_np(x: np.ndarray, spare: np.ndarray) -> None:
    """``_mix32`` on unsigned 32-bit integers, in place."""
    for _ in range(2):
        np.right_shift(x, 16, out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, np.uint32(_MIX), out=x)
    np.right_shift(x, 16, out=spare)
    np.bitwise_xor(x, spare, out=x)


def _weight_of(u: np.ndarray) -> np.ndarray:
    """``poisson_weight`` of 63-bit integers as numbers in [0, 1)."""
    return np.searchsorted(np.array(POISSON1_CDF), u.astype(np.float64) / _TWO63, side="right")


def poisson_weights(keys: np.ndarray, n_resamples: int, seed: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Weights of rows (64-bit keys) by resample, as float matrices for a few rows at a time: the
    numbers that ``with_mix_hash`` and ``poisson_weight`` give. A matrix is used again."""
    rest = 63 - _WEIGHT_BITS
    cell = np.arange(1 << _WEIGHT_BITS, dtype=np.int64) << rest
    low, high = _weight_of(cell), _weight_of(cell + ((1 << rest) - 1))
    table = np.where(low == high, low, 255).astype(np.uint8)  # 255: the rest of the hash decides
    resample = np.arange(n_resamples, dtype=np.int64).astype(np.uint32) ^ np.uint32(seed & _M32)
    _mix32_np(resample, np.empty_like(resample))
    bits = keys.astype(np.int64).view(np.uint64)
    first = (bits & np.uint64(_M32)).astype(np.uint32)
    # the signed shift of a negative key has its ones above bit 31 as well: they come down in the first shift
    second, signs = (bits >> np.uint64(32)).astype(np.uint32), keys < 0
    shape = (min(_BLOCK, len(keys)), n_resamples)
    h_, hi_, spare_ = (np.empty(shape, np.uint32) for _ in range(3))
    w_, out_ = np.empty(shape, np.uint8), np.empty(shape, np.float64)
    for lo in range(0, len(keys), _BLOCK):
        part = slice(lo, min(lo + _BLOCK, len(keys)))
        n = part.stop - lo
        h, hi, spare, w, out = h_[:n], hi_[:n], spare_[:n], w_[:n], out_[:n]
        np.bitwise_xor(resample[None, :], first[part, None], out=h)
        _mix32_np(h, spare)
        np.bitwise_xor(h, second[part, None], out=h)
        if signs[part].any():
            spare[:] = h >> np.uint32(16)
            spare[signs[part]] |= np.uint32(0xFFFF0000)
            np.bitwise_xor(h, spare, out=h)
            np.multiply(h, np.uint32(_MIX), out=h)
            np.bitwise_xor(h, h >> np.uint32(16), out=h)
            np.multiply(h, np.uint32(_MIX), out=h)
            np.bitwise_xor(h, h >> np.uint32(16), out=h)
        else:
            _mix32_np(h, spare)
        np.bitwise_xor(h, np.uint32(_SALT), out=hi)
        _mix32_np(hi, spare)
        np.bitwise_and(hi, np.uint32(0x7FFFFFFF), out=hi)
        np.right_shift(hi, 31 - _WEIGHT_BITS, out=spare)
        np.take(table, spare, out=w, mode="clip")
        out[:] = w
        open_ = np.flatnonzero(w.ravel() == 255)
        if len(open_):
            i, j = np.divmod(open_, n_resamples)
            out[i, j] = _weight_of((hi[i, j].astype(np.int64) << 32) | h[i, j].astype(np.int64))
        yield part, out


def poisson_bootstrap_means(indexed: DataFrame, metrics: Sequence[str], n_resamples: int, seed: int, idx: str = "row_key") -> DataFrame:
    """Poisson bootstrap: every row gets an independent Poisson(1) weight per
    resample, from a hash of its key ``idx``; the resample mean is sum(w * x) / sum(w), over
    the rows whose metric is known.
    Neither index nor row count is needed (see ``keyed_rows``): the n x B weights are generated next to their rows, as
    matrices of a few rows, and added up there, so only B rows per task are shuffled. An
    approximation of the multinomial draw, for data too large for it."""
    m = len(metrics)
    names = [f"_{kind}{i}" for kind in "sn" for i in range(m)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros((n_resamples, 2 * m)), 0
        for b in batches:
            rows += b.num_rows
            known = np.ones((b.num_rows, m), bool)
            x = np.zeros((b.num_rows, m))
            keyed = b.column(0).is_valid().to_numpy(zero_copy_only=False)
            for i in range(m):
                known[:, i] = keyed & b.column(i + 1).is_valid().to_numpy(zero_copy_only=False)
                x[known[:, i], i] = b.column(i + 1).fill_null(0.0).to_numpy(zero_copy_only=False)[known[:, i]]
            whole = bool(known.all())  # then the weights themselves are the count of each metric
            right = np.concatenate([x, np.ones((b.num_rows, 1)) if whole else known.astype(np.float64)], axis=1)
            for part, w in poisson_weights(b.column(0).fill_null(0).to_numpy(zero_copy_only=False), n_resamples, seed):
                got = w.T @ right[part]
                sums[:, :m] += got[:, :m]
                sums[:, m:] += got[:, m:]  # one column counts for all where all are known
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_resamples)), *[pa.array(c) for c in sums.T.copy()]], ["resample", *names])

    numbers = indexed.select(F.col(idx).cast("long").alias(idx), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(metrics)])
    sums = numbers.mapInArrow(work, "resample long, " + ", ".join(f"{n} double" for n in names))
    mean = lambda i: F.sum(f"_s{i}") / F.nullif(F.sum(f"_n{i}"), F.lit(0.0))
    return sums.groupBy("resample").agg(*[mean(i).alias(c) for i, c in enumerate(metrics)])


def bootstrap_cis(
    rows: DataFrame,
    metrics: Sequence[str],
    n_resamples: int = config.BOOTSTRAP_RESAMPLES,
    seed: int = config.BOOTSTRAP_SEED,
    percentiles: tuple[float, float] = config.BOOTSTRAP_PERCENTILES,
    idx: str = "row_key",
    method: str = "exact",
) -> DataFrame:
    """Percentile interval of the mean of each metric: (metric, ci_lo, ci_hi).

    ``method="exact"`` resamples n rows with replacement (the reference's method): ``rows``
    are classes with ``start`` and ``n`` (see ``rank_ranges``; single rows are classes of one).
    ``method="poisson"`` uses independent Poisson(1) weights: one row per observation, with a key
    ``idx`` that differs between rows."""
    if method == "exact":
        means = bootstrap_means(rows, metrics, n_resamples, seed)
    elif method == "poisson":
        means = poisson_bootstrap_means(rows, metrics, n_resamples, seed, idx)
    else:
        raise ValueError(f"unknown bootstrap method {method!r}")
    long = means.select(
        F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("mean")) for m in metrics]))
    )
    lo, hi = (p / 100.0 for p in percentiles)
    return long.groupBy("metric").agg(
        F.percentile("mean", F.lit(lo)).alias("ci_lo"),
        F.percentile("mean", F.lit(hi)).alias("ci_hi"),
    )
