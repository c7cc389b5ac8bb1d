import hashlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freshet.llm import fingerprints as fp
from freshet.llm import words


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_report_against_brute_force(docs, texts):
    order = sorted(texts)
    rows = {r.doc_id: r for r in fp.report(docs).collect()}
    assert sorted(rows) == order
    errors, contained = [], []
    for k, i in enumerate(order):
        text, after = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = map(brute.shingles, (text, edited, after))
        errors += [abs(r.near_edited - jaccard(a, b)), abs(r.near_next - jaccard(a, c))]
        if len(a | b) <= fp.SIZE:
            assert r.near_edited == pytest.approx(jaccard(a, b))
        assert r.distinct_shingles == pytest.approx(len(a), rel=0.4)
        contained += [abs(x - (len(a & o) / len(a) if a else 1.0)) for x, o in ((r.in_edited, b), (r.in_next, c))]
    assert max(contained) < 0.3 and sum(contained) / len(contained) < 0.05
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.03
    prints = {}
    for i in order:
        assert prints.setdefault(texts[i], rows[i].fingerprint) == rows[i].fingerprint


def test_nulls_short_repeated_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c d e f g", 0), (1, "a b c d e f g", 0), (2, None, 1), (3, "", 2), (None, "x y", 3)], "doc_id long, text string, range int")
    rows = sorted(fp.report(df).collect(), key=str)
    assert len(rows) == 5
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].fingerprint == "" and by_id[2].near_next == 1.0 and by_id[2].near_edited == 1.0
    assert by_id[None].near_next == 0.0
    assert fp.report(df.limit(0)).collect() == []


def test_an_id_of_many_rows_is_several_ranges(spark):
    texts = [f"t{i} " * (1 + i % 7) for i in range(2000)]
    rows = [(None if i % 2 else i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    own = fp.with_next(df, 16).where("not tail").groupBy("range").count().collect()
    assert sum(r["count"] for r in own) == 2000 and max(r["count"] for r in own) <= 300
    assert fp.with_next(df, 16).where("tail").select("range").distinct().count() == len(own)
    # The edited texts are those of one circle through all rows: NULL ids first.
    order = [(r.doc_id, r.text) for r in df.selectExpr("*", "xxhash64(text) as h").orderBy("doc_id", "h", "text").collect()]
    expected = []
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        expected.append((i or -1, hashlib.sha256((text[: len(text) - len(text) // 2] + after[: len(text) // 2]).encode()).hexdigest()))
    assert sorted((r.doc_id or -1, r.edited_sha256) for r in fp.report(df).collect()) == sorted(expected)


def test_parts_merge_to_the_sketch_of_the_whole(spark):
    parts = [[f"w{i}" for i in range(a, a + 400)] for a in (0, 200, 900)]
    df = spark.createDataFrame([(1, " ".join(p)) for p in parts] + [(2, None)], "doc_id long, text string")
    merged = {r.doc_id: r.sketch for r in fp.merge(fp.sketches(df)).collect()}
    whole = set()
    for p in parts:
        raw, offsets = words.joined([" ".join(p).encode()])
        whole |= set((words.shingles(*words.word_hashes(raw, offsets))[0] >> np.uint64(16)).tolist())
    assert merged == {1: sorted(whole)[: fp.SIZE], 2: []}
    a = np.array(merged[1], np.uint64)
    assert fp.distinct(a) == pytest.approx(len(whole), rel=0.3)
    assert fp.containment(a, a) == 1.0


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, 60), max_size=40), st.sets(st.integers(0, 60), max_size=40))
def test_small_sets_are_exact(a, b):
    x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
    assert fp.resemblance(x, y) == pytest.approx(jaccard(a, b))
    assert fp.from_text(fp.to_text(x)).tolist() == sorted(a)
