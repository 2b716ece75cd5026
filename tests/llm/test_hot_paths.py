"""The ways that only large groups take give the same results."""

from __future__ import annotations

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from . import brute


@pytest.fixture(scope="module")
def shared(spark):
    """Documents that share passages, with different text around them, and edited copies."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    text = lambda n: [word() for _ in range(n)]
    passage, copy = text(60), text(40)
    rows = []
    for i in range(40):
        if i % 2:
            rows.append((i, " ".join(text(rng.randint(0, 30)) + passage[: rng.randint(30, 60)] + text(rng.randint(0, 30)))))
        else:
            edited = list(copy)
            for _ in range(rng.randint(0, 6)):
                edited[rng.randrange(40)] = word()
            rows.append((i, " ".join(edited)))
    rows += [(100 + i, " ".join(["tick", "tock", "tick"][: 1 + i] * 30)) for i in range(3)]  # periodic
    return spark.createDataFrame(rows, "doc_id long, text string"), [(*r, None) for r in rows]


def _kept(df):
    return sorted((r["_id"], r["n_items"], r["n_removed"], r["h"]) for r in df.select("_id", "n_items", "n_removed", F.sha2("kept", 256).alias("h")).collect())


@pytest.mark.parametrize("share", [1, 8, 1024])
def test_rows_meet_their_group_on_both_ways(spark, monkeypatch, share):
    from pitchside.llm import common

    monkeypatch.setattr(common, "SHARE", share)
    rows = [(0, i) for i in range(40)] + [(i % 12, i) for i in range(1, 30)] + [(99, 0)]
    count = {k: sum(r[0] == k for r in rows) for k, _ in rows}
    groups = [(k, n, -k) for k, n in count.items() if k != 99]
    out = common.with_group(spark.createDataFrame(rows, "k long, v long"), spark.createDataFrame(groups, "k long, n long, w long"), ["k"], "n", len(rows))
    assert sorted((r["k"], r["v"], r["w"]) for r in out.collect()) == sorted((k, v, -k) for k, v in rows if k != 99)


@pytest.mark.parametrize("share", [1, 40])
def test_large_contexts_in_substring_and_suffix_array_dedup(shared, monkeypatch, share):
    from pitchside.llm import common
    from pitchside.llm import substrings as S
    from pitchside.llm import suffix_array as X

    monkeypatch.setattr(common, "SHARE", share)
    docs, rows = shared
    assert _kept(S.dedup_substrings(docs, dataclasses.replace(S.SCHEME, hot=2))) == sorted(brute.substrings(rows))
    assert _kept(X.dedup_bytes(docs, dataclasses.replace(X.SCHEME, hot=2))) == sorted((d, n, k, h) for d, n, k, _, h in brute.byte_repeats(rows))


def test_split_anchors_in_substring_dedup(shared):
    from pitchside.llm import substrings as S

    docs, rows = shared
    expected = sorted(brute.substrings(rows))
    for hot in (2, 8_000):
        assert _kept(S.dedup_substrings(docs, dataclasses.replace(S.SCHEME, hot=hot))) == expected


def test_split_anchors_in_suffix_array_dedup(shared):
    from pitchside.llm import suffix_array as X

    docs, rows = shared
    expected = sorted((d, n, k, h) for d, n, k, _, h in brute.byte_repeats(rows))
    for hot in (2, 50_000):
        assert _kept(X.dedup_bytes(docs, dataclasses.replace(X.SCHEME, hot=hot))) == expected


def test_repeat_groups_list_all_occurrences(shared):
    from pitchside.llm import suffix_array as X

    docs, rows = shared
    texts = {d: t.encode() for d, t, _ in rows}
    groups: dict = {}
    for r in X.repeat_groups(docs).collect():
        groups.setdefault((r["anchor"], r["group"], r["length"]), []).append((r["_id"], r["start"]))
    assert groups
    for (_, _, length), places in groups.items():
        assert length >= 200 and len({texts[d][s : s + length] for d, s in places}) == 1 and len(set(places)) == len(places) > 1


def _maximal_repeats(texts, least):
    """string -> places, of the repeats that differ, or end, on both sides."""
    places: dict = {}
    for d, t in texts.items():
        for n in range(least, len(t) + 1):
            for i in range(len(t) - n + 1):
                places.setdefault(t[i : i + n], []).append((d, i))
    end = iter(range(10**9))
    side = lambda d, i: texts[d][i] if 0 <= i < len(texts[d]) else -1 - next(end)
    return {
        x: p for x, p in places.items()
        if len(p) > 1 and len({side(d, i - 1) for d, i in p}) > 1 and len({side(d, i + len(x)) for d, i in p}) > 1
    }


@pytest.mark.parametrize("hot", [50_000, 3])
def test_repeat_groups_are_the_maximal_repeats_with_their_copies(spark, hot):
    """Against all maximal repeats of a small window: every one that fits around an anchor of its own is a
    group with all its places, exact copies included."""
    from pitchside.llm import suffix_array as X

    scheme = dataclasses.replace(X.SCHEME, window=12, gram=4, hot=hot)
    rng = random.Random(6)
    rows, common = [], "".join(rng.choice("abcdef") for _ in range(16))
    for i in range(14):
        own = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 16)))
        rows.append((i, own + common[rng.randint(0, 2) : rng.randint(14, 16)] + own[:3] if i % 3 else rows[0][1] if i == 9 else own + common))
    texts = {d: t.encode() for d, t in rows}
    groups: dict = {}
    for r in X.repeat_groups(spark.createDataFrame(rows, "doc_id long, text string"), scheme).collect():
        groups.setdefault((r["anchor"], r["group"]), []).append((r["_id"], r["start"], r["length"]))
    found = {}
    for members in groups.values():
        strings = {texts[d][s : s + n] for d, s, n in members}
        assert len(strings) == 1 and len(set(members)) == len(members) > 1
        found.setdefault(strings.pop(), set()).update((d, s) for d, s, _ in members)
    expected = _maximal_repeats(texts, scheme.window)
    assert any(len({texts[d] for d, _ in p}) < len(p) for p in expected.values())  # copies of a document
    if hot == 3:
        assert {x for x in found if len(x) == scheme.window}
        covered = lambda places: {(d, k) for x, p in places.items() for d, s in p for k in range(s, s + len(x))}
        assert covered(found) == covered(expected)
        return
    for x, places in expected.items():
        if len(x) == scheme.window:  # never cut by a context
            assert found[x] == set(places), x
    assert all(found[x] <= {(d, i) for d, t in texts.items() for i in range(len(t)) if t.startswith(x, i)} for x in found)


@pytest.mark.parametrize(("block", "active", "small"), [(4096, 1024, 32), (4096, 1024, 2), (3, 2, 1)])
def test_near_duplicates_in_blocks(shared, monkeypatch, block, active, small):
    from pitchside.llm import near_dup as N

    docs, rows = shared
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "ACTIVE", active)
    monkeypatch.setattr(N, "SMALL", small)
    got = {r["_id"]: (r["n_shingles"], r["comp"]) for r in N.near_duplicates(docs, 2, 80).collect()}
    assert got == brute.near_components(rows, 2)


def test_components_of_paths_stars_and_rings(spark):
    from pitchside.llm import near_dup as N

    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(2000 + i, 2000 + (i + 1) % 9) for i in range(9)]
    edges += [(rng.randrange(3000, 3100), rng.randrange(3000, 3100)) for _ in range(80)]
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["comp"] for r in N.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_all_pairs_within_the_guaranteed_distance_share_a_bucket():
    import numpy as np

    from pitchside.llm import near_dup as N

    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 16, (300, N.HASHES)).astype(np.uint16)
    b = a.copy()
    for i in range(300):
        at = rng.choice(N.HASHES, 31, replace=False)
        b[i, at] ^= 1
    shared = N.chunk_keys(a) == N.chunk_keys(b)
    assert shared.any(1).all()


def test_filter_too_large_to_send_changes_nothing(spark, monkeypatch):
    from pitchside.llm import lines as L

    rows = [(i, "\n".join(f"a line that is certainly longer than forty characters {j}" for j in range(i % 4 + 1))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    read = lambda: sorted(map(tuple, L.dedup_lines(docs).collect()))
    usual = read()
    monkeypatch.setattr(L, "FILTER_BYTES", 0)
    assert read() == usual and any(r[3] for r in usual)


def test_full_bit_map_changes_nothing(spark, monkeypatch):
    from pitchside.llm import decontaminate as D

    rng = random.Random(1)
    text = lambda n: " ".join(rng.choice(["an", "be", "co", "du"]) for _ in range(n))
    docs = [(i, text(60)) for i in range(30)]
    items = [(i, text(14)) for i in range(20)] + [(50, docs[3][1][30:90]), (51, "an be")]
    frames = [spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")]
    expected = sorted((d, n, hit, k) for d, n, hit, k, _, _ in brute.decontaminated([(*d, None) for d in docs], items))
    for bits in (1 << 27, 1 << 6):
        monkeypatch.setattr(D, "MAP_BITS", bits)
        assert sorted((r["_id"], r["n_words"], r["n_hit"], len(r["items"])) for r in D.decontaminate(*frames).collect()) == expected
