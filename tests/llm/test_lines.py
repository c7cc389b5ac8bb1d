import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freshet.llm import catalog, lines


def check(spark, df, texts):
    goes = brute.repeated_lines(texts)
    rows = lines.deduplicated(df, counts=True).collect()
    assert len(rows) == df.count()
    for r in rows:
        gone = goes.get(r.doc_id, set())
        split = (texts[r.doc_id] or "").split("\n")
        assert r.n_removed == len(gone) and r.n_lines == len(split)
        assert r.text == ("\n".join(x for n, x in enumerate(split) if n not in gone) if gone else texts[r.doc_id])


def test_whole_table(spark, docs, texts):
    check(spark, docs, texts)


def test_edited_lines(spark):
    draw = random.Random(3)
    vocabulary = ["alpha", "beta", "Gamma", "delta", "é"]
    made, texts = [], {}
    for i in range(120):
        body = []
        for _ in range(4):
            if made and draw.random() < 0.7:
                line = list(draw.choice(made))
                at = draw.randrange(len(line))
                line[at : at + draw.randrange(2)] = [draw.choice(vocabulary)] * draw.randrange(2)
            else:
                line = [draw.choice(vocabulary) for _ in range(draw.choice([3, 4, 5, 6, 8, 23, 24, 25, 40]))]
            if line:
                made.append(line)
            body.append("  ".join(line))
        texts[i] = "\n".join(body)
    check(spark, spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5), texts)


def test_nulls_repeats_ties_and_clashes(spark):
    rows = [(1, "a b c d e\nx", "q"), (2, "a b c d e f", "w"), (2, "a b c d e f", "w"), (None, "a b z d e\n\n", None), (3, None, "e"), (4, "", ""), (5, "A  b c d e", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, number string")
    out = sorted(((r.doc_id or -1, r.text, r.number) for r in lines.deduplicated(df).collect()), key=str)
    assert out == sorted([(1, "x", "q"), (2, "", "w"), (2, "", "w"), (-1, "a b z d e\n\n", None), (3, None, "e"), (4, "", ""), (5, "", "")], key=str)
    assert lines.deduplicated(df.limit(0)).collect() == []
    assert sorted(r.doc_id or -1 for r in lines.deduplicated(df, drop_emptied=True).collect()) == [-1, 1, 3, 4]


def test_very_long_line(spark):
    base = [f"w{i}" for i in range(30_000)]
    texts = {1: " ".join(base), 2: " ".join(base[:777] + ["new"] + base[777:]), 3: " ".join(base[:5] + base[7:])}
    check(spark, spark.createDataFrame(list(texts.items()), "doc_id long, text string"), texts)


def test_length_column_follows_the_text(spark):
    df = spark.createDataFrame([(1, "a b c d e", 9), (2, "a b c d e\nzz", 12)], "doc_id long, text string, n_chars long")
    assert sorted((r.doc_id, r.text, r.n_chars) for r in lines.deduplicated(df).collect()) == [(1, "a b c d e", 9), (2, "zz", 2)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=6), st.lists(st.integers(0, 2), max_size=6))
def test_edit_distance(a, b):
    assert lines.within_one_edit(a, b) == (distance(a, b) <= 1)


@pytest.mark.parametrize("rows", [[(1, None)], [(1, "\n\n\n")], [(1, "a b")]])
def test_nothing_to_do(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [tuple(r) for r in lines.deduplicated(df).collect()] == rows


def test_buckets_share_hashes_out_once():
    hashes = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 32_000, np.uint64, endpoint=False))
    for buckets in (1, 12, 32, 844):
        cuts = lines._bucket_cuts(hashes, buckets)
        assert cuts[0] == 0 and cuts[-1] == len(hashes) and (np.diff(cuts) > 0).all()
        assert np.diff(cuts).max() < 2 * len(hashes) / buckets + 10


def test_equal_short_lines_go_from_op10(spark, tmp_path):
    rows = [(1, "All rights reserved.\nhome\na b c d"), (2, "all  rights reserved.\nown\nHome\n\n"), (3, "a b c x\nhome now"), (None, "home")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = catalog.QUERIES["op10_line_dedup"](spark, str(tmp_path)).collect()
    want = [(1, "All rights reserved.\na b c d", 3, 1), (2, "own\n\n", 5, 2), (3, "a b c x\nhome now", 2, 0), (None, "home", 1, 0)]
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out), key=str) == sorted(want, key=str)


def test_texts_that_lose_nothing_are_not_shuffled(spark, tmp_path):
    rows = [(1, "a b c d e", "kept"), (2, "a b c d e", "kept"), (2, "a b c d e", "kept"), (3, "x", "kept"), (None, None, "kept"), (4, "v w\nx y", "kept")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "docs"))
    df = spark.read.parquet(str(tmp_path / "docs"))
    for counts in (False, True):
        out = lines.deduplicated(df, counts=counts)
        assert sorted(((r.doc_id or 0, r.text, r.source) for r in out.collect()), key=str) == sorted([(0, None, "kept"), (1, "a b c d e", "kept"), (2, "", "kept"), (2, "", "kept"), (3, "x", "kept"), (4, "v w\nx y", "kept")], key=str)
        # All rows met the numbers by a join on the id before; now only those that the gate lets through.
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Union" in plan and "bit_or" in plan
    assert [r.n_removed for r in out.where("doc_id = 3").collect()] == [0]
