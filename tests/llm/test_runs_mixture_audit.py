"""Periodic runs, source mixture and filter audit against plain versions."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from pitchside.llm import filter_audit, kernels as K, mixture, periodic_runs

from . import brute
from .test_operators import run, same


def plain_runs(w, least=12):
    """(start, length, period) of the maximal runs, by trying every period."""
    best: dict = {}
    for q in range(len(w) // 2, 0, -1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j + q - i >= least:
                best[i, j + q - i] = q
            i = j + 1
    return sorted((s, n, q) for (s, n), q in best.items())


def plain_op11(doc_id, text):
    w = brute.words(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    first = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = 1000 * first[1] // first[2] if runs else None
    return (doc_id, len(runs), *first, milli, brute.sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), brute.sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_op11(spark, corpus, docs):
    cols, rows = run(spark, "op11", corpus)
    assert cols == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    short = [(d, t) for d, t, _ in docs if len(t or "") < 30_000]  # the plain version is quadratic
    ids = {d for d, _ in short}
    same([r for r in rows if r[0] in ids], [plain_op11(d, t) for d, t in short])
    assert any(r[1] for r in rows) and len(rows) == len(docs)
    long = {r[0]: r[1:5] for r in rows}[900_010]  # 60,000 words of period 3 and another one
    assert long == (1, 0, 60_000, 3)


def test_op11_words_of_small_alphabets(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        x = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, 25))]
        w = [rng.choice("ab") for _ in range(rng.randint(0, 6))] + x * rng.randint(1, 5) + x[: rng.randint(0, len(x))]
        rows.append((i, "  ".join(w)))
    rows += [(None, "a b " * 20), (None, None), (7, "")]
    got = periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string"), min_length=2).collect()
    same([(r["doc_id"], tuple(map(tuple, r["runs"]))) for r in got], [(d, tuple(plain_runs(brute.words(t), 2))) for d, t in rows])


def test_find_runs_of_all_short_binary_words():
    letter = K.stream(4, 2)
    every = [w for n in range(2, 14) for w in itertools.product((0, 1), repeat=n)]
    bounds = np.cumsum([0] + [len(w) for w in every])
    got = periodic_runs.find_runs(letter[np.array([c for w in every for c in w])], np.repeat(np.arange(len(every)), np.diff(bounds)), bounds, 2)
    assert got.tolist() == [[k, *r] for k, w in enumerate(every) for r in plain_runs(w, 2)]


def test_op12_equals_its_sql_and_keeps_the_targets(spark, corpus, docs):
    import duckdb

    cols, rows = run(spark, "op12", corpus)
    assert cols == ["doc_id", "size", "source_size", "target", "taken"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{corpus}/documents.parquet')")
    got = con.execute(mixture.OP12_SQL)
    order = [[d[0] for d in got.description].index(c) for c in cols]
    same(rows, [tuple(r[i] for i in order) for r in got.fetchall()])
    same(run(spark, "op12", corpus)[1], rows)

    size = defaultdict(int)
    for d, t, s in docs:
        size[s] += len(brute.words(t))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s)))}
    full, goal = set(), {}
    while True:  # the excess of targets that stop is shared by weight, until none is above
        left = 1.5 * sum(size.values()) - sum(2 * size[s] for s in full)
        goal = {s: 2 * size[s] if s in full else left * weight[s] / sum(w for x, w in weight.items() if x not in full) for s in size}
        if not (over := {s for s in size if goal[s] > 2 * size[s]}):
            break
        full |= over
    taken, target, largest, n_docs = defaultdict(int), {}, defaultdict(int), Counter(s for _, _, s in docs)
    sources = {n: s for s, n in size.items()}
    assert len(sources) == len(size)
    for d, n, source_size, t, k in rows:
        s = sources[source_size]
        assert k % max(n, 1) == 0 and 0 <= k <= 2 * n
        assert n == 0 or k // n - int(t / source_size) in (0, 1)
        taken[s] += k
        target[s] = t
        largest[s] = max(largest[s], n)
    for s in size:
        assert abs(target[s] - goal[s]) < 1e-6 * max(1, goal[s])
        # whole documents: a handful of them may not add up to less than half of one
        assert abs(taken[s] - target[s]) <= max(0.05 * target[s], largest[s] / 2 if n_docs[s] < 30 else 0)


def test_mixture_samples_each_class_fairly_and_writes_its_rows(spark):
    rows = [(i, " ".join(["w"] * (100 + i % 3)), "a" if i < 3000 else "b", "x") for i in range(6000)] + [(None, "one two", None, "x"), (None, "one two", None, "x"), (None, None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies string")
    for seed in (1, 2):
        got = mixture.copies(docs, weights=(1, 1), total=1.25, seed=seed).where("doc_id is not null").collect()
        n = Counter(r["copies"] for r in got)
        assert set(n) == {1, 2} and abs(n[2] - 1500) <= 3
        low = sum(r["copies"] == 2 for r in got if r["doc_id"] % 3 == 0)
        assert 430 < low < 570
    mix = mixture.mixture(docs, weights=(1, 1), total=1.25)
    assert mix.columns == docs.columns
    plan = {r["doc_id"]: r["copies"] for r in mixture.copies(docs, weights=(1, 1), total=1.25).collect() if r["doc_id"] is not None}
    found = Counter(r["doc_id"] for r in mix.where("doc_id is not null").collect())
    assert found == Counter(plan)
    assert mix.where("doc_id is null").count() == 4  # both copies of the row, twice each


def test_mixture_of_one_hot_class(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'a b c' AS text", "if(id % 3 = 0, 'hot', concat('s', id % 7)) AS source")
    got = mixture.copies(docs, total=1.0).join(docs, "doc_id").groupBy("source").agg({"copies": "sum", "target": "max"}).collect()
    assert len(got) == 8
    for r in got:
        assert abs(3 * r["sum(copies)"] - r["max(target)"]) <= 3


def plain_audit(docs, labels):
    said = defaultdict(set)
    for d, q, t in labels:
        if d is not None:
            said[d] |= {k for k, on in (("good", q == 1), ("toxic", t == 1)) if on}
    first: dict = {}
    for d, t, _ in docs:
        first[t or ""] = min(first.get(t or "", brute.LAST), brute.key(d))
    rows = []
    for d, t, s in docs:
        t = t or ""
        w = brute.words(t)
        rows.append((s or "", {x for x, bad in (
            ("A", len(w) < 50), ("B", 100 * len(set(w)) < 65 * len(w)), ("C", 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t)),
            ("D", any(c in "#$%&*|" for c in t)), ("E", brute.key(d) > first[t])) if bad}, said[d] if d is not None else set()))
    out = []
    for part in {r[0] for r in rows}:
        mine = Counter((frozenset(f), frozenset(y)) for p, f, y in rows if p == part)
        shapley, steps = Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for at, x in enumerate(order):
                gone = {k: n for k, n in left.items() if x in k[0]}
                left = {k: n for k, n in left.items() if x not in k[0]}
                removed = sum(gone.values())
                shapley[x] += removed
                steps.append((
                    "".join(order), at + 1, sum(left.values()), removed, sum(n for k, n in mine.items() if x in k[0]) - removed,
                    sum(n for k, n in mine.items() if k[0] == {x}), sum(n for k, n in gone.items() if "good" in k[1]), sum(n for k, n in gone.items() if "toxic" in k[1])))
        out += [(part, *s, shapley[s[0][s[1] - 1]]) for s in steps]
    return out


def test_op13(spark, corpus, docs):
    cols, rows = run(spark, "op13", corpus)
    assert cols == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    t = pq.read_table(f"{corpus}/labels.parquet")
    same(rows, plain_audit(docs, list(zip(*[t[c].to_pylist() for c in ("doc_id", "quality", "toxic")]))))


def test_op13_sql_on_edge_rows(spark, corpus):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{corpus}/{t}.parquet')")
    got = con.execute(filter_audit.OP13_SQL)
    names = [d[0] for d in got.description]
    cols, rows = run(spark, "op13", corpus)
    same(rows, [tuple(r[names.index(c)] for c in cols) for r in got.fetchall()])


def test_packed_fields_do_not_touch():
    counts = {m: (1 << 57) + m for m in range(32)}  # 32 of them stay below the field's 2^63
    total = sum(filter_audit.packed(m) * n for m, n in counts.items())
    expected = [sum(on * n for on, n in zip(c, counts.values())) for c in zip(*[filter_audit.unpacked(filter_audit.packed(m)) for m in counts])]
    assert filter_audit.unpacked(total) == expected and max(expected) > 1 << 61
    table = pa.table({"part": ["p"] * 32, "mask": list(range(32)), "good": [True] * 32, "toxic": [False] * 32, "n": [counts[m] >> 7 for m in range(32)]})
    rows = filter_audit.part_rows(table).to_pylist()
    assert all(r["good_lost"] == r["removed"] and r["toxic_lost"] == 0 for r in rows)
    assert rows[4]["kept"] == counts[0] >> 7
