import hashlib

import brute
import pytest
from conftest import SF

from freshet.llm import decontamination as op

TEN = "two three four five six seven eight nine ten eleven"


def report(docs, items):
    return sorted(((r.doc_id or -1, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in op.report(docs, items).collect()), key=str)


def expected(docs, items):
    rows = brute.contaminated([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect() if r.item_id is not None])
    return sorted(((-1 if i is None else i, n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0) for i, n, hit, found in rows), key=str)


def test_whole_table(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = [(i if i else i, *rest) for i, *rest in report(docs.where("doc_id > 0"), items)]
    assert got == expected(docs.where("doc_id > 0"), items) and any(r[-1] for r in got)


@pytest.mark.parametrize("limit", [0, 10**6])
def test_nulls_ties_repeats_and_clashes(spark, monkeypatch, limit):
    monkeypatch.setattr(op, "BROADCAST_ROWS", limit)
    rows = [(1, "A b C d", 1), (None, "x", 2), (2, None, 3), (2, "", 4), (3, f"one {TEN}", 5), (3, f"one {TEN}", 5), (4, "b c " * 50, 1), (5, "É é x", 0), (6, f"{TEN} " * 3, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item long")
    items = spark.createDataFrame([(7, "b, c"), (8, None), (None, "d"), (9, f"{TEN} twelve"), (9, "x"), (10, "b c"), (11, "!!"), (12, "é É")], "item_id long, text string")
    assert report(docs, items) == expected(docs, items)
    kept = op.uncontaminated(docs, items)
    assert kept.columns == docs.columns and sorted((r.doc_id, r.item) for r in kept.collect()) == [(2, 3), (2, 4)]
    assert report(docs.limit(0), items) == []
    assert all(not r[-1] for r in report(docs, items.limit(0)))


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "zeta alpha and then beta"), (2, "alpha beta"), (3, "alpha " + "so " * 30 + "beta"), (4, "beta alpha")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "alpha beta")], "item_id long, text string")
    near = {(r.doc_id, r.item_id) for r in op.proximity(docs, items, slop=3).collect()}
    assert near == {(1, 7), (2, 7), (4, 7)}
    assert op.proximity(docs.limit(0), items).collect() == []


def test_stays_with_sparks_own_functions(spark, docs):
    plan = op.report(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
