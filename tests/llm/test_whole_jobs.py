"""Large groups, rows without an id and parts of a method that a smaller job would leave out."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline as P
from pitchside.llm import kernels as K
from pitchside.llm import tokens


def _text(rng, n=30):
    return " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(3, 9))) for _ in range(n))


def _docs(spark, rows):
    return spark.createDataFrame([(d, t, s, len(t)) for d, t, s in rows], "doc_id long, text string, source string, n_chars long")


def test_copies_in_one_source_are_left_to_near_dedup(spark):
    rng = random.Random(11)
    copy = f"{_text(rng)}\n{_text(rng)}"
    docs = _docs(spark, [(i, copy, "hot") for i in range(150)] + [(1000 + i, _text(rng), "hot") for i in range(5)])
    kept = P.quality_rules(spark, docs, "")
    assert kept.count() == 155
    assert sorted(r["doc_id"] for r in P.near_dedup(spark, kept, "").collect()) == [0, *range(1000, 1005)]
    # a line of many different texts is still boilerplate
    pages = _docs(spark, [(i, f"{copy}\npage {i}", "hot") for i in range(101)])
    assert P.quality_rules(spark, pages, "").count() == 0


def test_rows_without_a_doc_id_are_judged_one_by_one(spark):
    rng = random.Random(12)
    texts = [_text(rng) for _ in range(8)]
    near = texts[0] + " more"
    item = _text(rng, 12)
    rows = [(1, texts[0], "a"), (None, near, "a"), (None, None, "a"), (None, "short", "a"), (None, f"{texts[6]} {item}", "a"), (7, "short", "a"), (7, texts[7], "a")]
    rows += [(None, t, "a") for t in texts[1:6]] + [(None, texts[1], "a")]
    docs = _docs(spark, [(d, t or "", s) for d, t, s in rows]).withColumn("text", F.when(F.col("n_chars") > 0, F.col("text")))
    left = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    clean = [(1, texts[0]), (7, texts[7]), *[(None, t) for t in texts[1:6]]]
    good = P.quality_rules(spark, docs, "")
    assert left(good) == sorted([*clean, (None, near), (None, texts[1]), (None, f"{texts[6]} {item}")], key=str)
    own = P.near_dedup(spark, good, "")
    assert left(own) == sorted([*clean, (None, texts[1]), (None, f"{texts[6]} {item}")], key=str)  # equal rows share an identity


def test_lines_and_hits_of_rows_without_a_doc_id(spark, tmp_path):
    rng = random.Random(13)
    line, item = _text(rng, 12), _text(rng, 12)
    docs = _docs(spark, [(None, f"{line}\n{_text(rng)}", "a") for _ in range(6)] + [(None, f"{_text(rng)} {item}", "a"), (3, _text(rng), "a")])
    assert sum(line in r["text"] for r in P.line_dedup(spark, docs, "").collect()) == 1
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = [r["text"] for r in P.decontamination(spark, docs, str(tmp_path)).collect()]
    assert len(kept) == 7 and not any(item in t for t in kept)


def test_the_limit_of_a_line_follows_its_host(spark):
    """The verdict on a text does not change when the corpus grows alike."""
    from pitchside.llm import quality

    rng = random.Random(15)
    own = [_text(rng) for _ in range(200)]
    for n in (100, 200):
        docs = _docs(spark, [(i, f"{own[i]}\nevery tenth page or more" if i % 9 == 0 else f"{own[i]}\nevery twentieth page" if i % 19 == 0 else own[i], "h") for i in range(n)])
        got = {r["doc_id"]: r["text"] for r in quality.kept_documents(docs).collect()}
        assert all("tenth" not in t for t in got.values()) and sum("twentieth" in t for t in got.values()) == sum(i % 19 == 0 and i % 9 > 0 for i in range(n))


def test_kept_documents_lose_their_frequent_lines(spark):
    rng = random.Random(14)
    own = [_text(rng) for _ in range(101)]
    docs = _docs(spark, [(i, f"Home  About\n\n{t}\nhome about", "hot") for i, t in enumerate(own)] + [(500, f"home about\n{own[0]} x", "other")])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in P.quality_rules(spark, docs, "").collect()}
    expected = {i: f"\n{t}" for i, t in enumerate(own)} | {500: f"home about\n{own[0]} x"}
    assert got == {i: (t, len(t)) for i, t in expected.items()}


def test_own_numbers_where_none_are_left_above_the_largest_doc_id(spark):
    from pitchside.llm import common

    last = (1 << 63) - 1
    rows = [(last, "the last", "a"), (3, "three", "a"), (None, "no id", "a"), (None, "no id", "a"), (3, "another three", "a"), (None, None, "a"), (last - 1, "before", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    seen = {}

    def work(inside):
        seen["rows"] = sorted((r["doc_id"], r["text"]) for r in inside.where("text is not null").collect())
        return inside.select("doc_id", "text", F.col("doc_id").alias("group_id"))

    out = common.by_text(docs, work, "group_id")
    as_given = sorted(((d, t) for d, t, _ in rows), key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == as_given
    assert sorted(((r["group_id"], r["text"]) for r in out.collect()), key=str) == as_given
    ids = [d for d, _ in seen["rows"]]
    assert max(ids) < common.NULL_ID and len(set(ids)) == len({(d, t) for d, t, _ in rows if t})
    order = [t for _, t in seen["rows"]]
    assert order.index("three") < order.index("before") < order.index("the last") < order.index("no id")
    numbered, own = common.with_own_ids(docs)
    assert sorted(((r["doc_id"], r["text"]) for r in common.with_given_ids(numbered, own, docs.columns).collect()), key=str) == as_given


def test_documents_of_their_own_are_left_as_they_are(spark):
    from pitchside.llm import common

    docs = _docs(spark, [(i, f"text {i % 3}", "a") for i in range(20)])
    assert common.by_text(docs, lambda d: d) is docs


def test_workers_drop_the_tokenizer_before_stages_that_do_not_use_it(spark, corpus, monkeypatch):
    """Workers are used again: what packing keeps must not stay beside the next run's stages (F1)."""
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(40)
    given, plain, stages = [], type(docs).mapInArrow, set()
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, work, *args, **more: given.append((name, work)) or plain(df, work, *args, **more))
    for name, stage in P.STAGES:
        stage(spark, docs, corpus)
    for name, work in given:
        stages.add(name)
        monkeypatch.setitem(K.KEPT[tokens.ENCODERS], "of a stage before", object())
        list(work(iter([])))
        assert ("of a stage before" in K.KEPT[tokens.ENCODERS]) == (name == "best_fit_packing"), name
    assert stages == {name for name, _ in P.STAGES}
