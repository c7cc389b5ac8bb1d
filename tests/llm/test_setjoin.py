import random

import brute
import numpy as np
import pytest

from freshet.llm import setjoin


def check(df, texts):
    want = brute.jaccard_components(texts)
    rows = setjoin.jaccard_components(df).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want


def family(draw, base, edits):
    words = list(base)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
    return words


def test_whole_table(docs, texts):
    check(docs, texts)


@pytest.mark.parametrize("block", [4, 256])
def test_groups_at_the_limit(spark, monkeypatch, block):
    """Near copies whose similarities lie around 0.8, so that clusters and open questions both occur."""
    monkeypatch.setattr(setjoin, "BLOCK", block)
    draw = random.Random(5)
    texts = {}
    for group in range(4):
        base = [f"g{group}w{i}" for i in range(120)]
        for _ in range(25):
            texts[len(texts)] = " ".join(family(draw, base, draw.randrange(5)))
    texts |= {1000: None, 1001: "", 1002: "one two", 1003: "ONE  two", 1004: " \n"}
    check(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7), texts)


def test_nulls_repeats_and_clashes(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a, "x"), (1, a, "x"), (None, a, "y"), (3, a + " end", "z"), (None, b, "n"), (5, None, "e"), (6, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, set string")
    found = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in setjoin.jaccard_components(df).collect())
    assert found == sorted([(1, 56, 1), (1, 56, 1), (-1, 56, 1), (3, 57, 1), (-1, 56, -1), (5, 0, 5), (6, 0, 6)])
    kept = setjoin.representatives(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, r.set) for r in kept.collect()) == [(-1, "n"), (1, "x"), (5, "e"), (6, "e")]
    assert setjoin.jaccard_components(df.limit(0)).collect() == [] == setjoin.representatives(df.limit(0)).collect()


def test_one_id_with_several_texts(spark):
    texts = [" ".join(f"{c}{i}" for i in range(50)) for c in "abc"]
    df = spark.createDataFrame([(5, texts[0]), (5, texts[1]), (4, texts[1] + " y"), (9, texts[2])], "doc_id long, text string")
    assert sorted((r.doc_id, r.text[:2]) for r in setjoin.representatives(df).collect()) == [(4, "b0"), (5, "a0"), (9, "c0")]


def test_prefix_rules_never_exclude_similar_sets():
    draw = random.Random(1)
    for _ in range(3000):
        n = draw.randrange(1, 40)
        order = list(range(60))
        a = sorted(draw.sample(order, n))
        b = sorted(set(draw.sample(a, draw.randrange(max(1, n - 6), n + 1))) | set(draw.sample(order, draw.randrange(4))))
        common = len(set(a) & set(b))
        if 100 * common < 80 * (len(a) + len(b) - common):
            continue
        shared = sorted(set(a) & set(b))[0]
        i, j = a.index(shared), b.index(shared)
        assert i < setjoin.prefix(len(a)) and j < setjoin.prefix(len(b))
        fit = setjoin._possible(*(np.array([x]) for x in (len(a), len(b), i, j)), 80)
        assert fit.all()
