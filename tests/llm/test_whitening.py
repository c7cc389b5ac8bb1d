import math

import numpy as np
import pytest

from freshet.llm import whitening
from freshet.llm.catalog import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, components=8, weights="counts"):
    """{vec_id: (n, deviation, whitened by component)}, explained, in plain numpy."""
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in usable])
    fit = x if weights == "counts" else np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    v = centred.T @ centred / n
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:components], axes[:, ::-1][:, :components]
    deviation = [sum(int(d) ** 2 for d in n * row - total) for row in x]
    return [i for i, _ in usable], n, deviation, (x - total / n) @ axes / np.sqrt(e), e / np.trace(v)


def check(got, want):
    ids, n, deviation, whitened, explained = want
    many = whitened.shape[1]
    assert len(got) == len(ids) * many
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    signs = {}
    for i, d, w in zip(ids, deviation, whitened, strict=True):
        for k in range(many):
            r = by_id[i][k + 1][0]
            assert (r.n, r.deviation) == (n, d)
            assert r.explained == pytest.approx(explained[k], rel=1e-9)
            assert abs(r.whitened) == pytest.approx(abs(w[k]), rel=1e-6, abs=1e-8)
            if abs(w[k]) > 1e-3:
                assert signs.setdefault(k, np.sign(r.whitened * w[k])) == np.sign(r.whitened * w[k])
            assert r.identity_error <= 1e-9


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(QUERIES["op11_whitening"](spark, sf).collect(), brute(rows))


def vectors(n, d, seed=3):
    draw = np.random.default_rng(seed)
    return [[float(c) for c in row] for row in draw.normal(size=(n, d)) * (1 + np.arange(d))]


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_a_vector_that_a_third_of_the_rows_share(spark, weights):
    some = vectors(60, 5)
    rows = [(i, v) for i, v in enumerate(some + some[:1] * 30)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(7)
    got = whitening.whiten(df, weights=weights).collect()
    check(got, brute(rows, weights=weights))
    assert len({(r.component, r.whitened) for r in got if r.vec_id == 0 or r.vec_id >= 60}) == 5


def test_unusable_vectors_go_and_others_keep_null_and_repeated_keys(spark):
    good = vectors(20, 3)
    bad = [None, [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 0.0, 0.0], [1e30, 0.0, 0.0], [1.0, 2.0], []]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(good)] + [(100 + i, v, 0) for i, v in enumerate(bad)], SCHEMA)
    named = df.withColumnRenamed("label", "x").selectExpr("*", "1 as component", "2 as k1", "3 as weight")
    check(whitening.whiten(named).collect(), brute(list(enumerate(good))))
    keys = spark.createDataFrame([(None, good[0], 0), (None, good[1], 0), (7, good[2], 0), (7, good[2], 0), (8, good[3], 0), (9, good[4], 0)], SCHEMA)
    got = whitening.whiten(keys).collect()
    assert sorted((r.vec_id or -1) for r in got) == sorted([-1, -1, 7, 7, 8, 9] * 3)


def test_no_rows_and_no_variance(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 0), (2, [], 0)], SCHEMA)).collect() == []
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same if r.vec_id == 1] == [(1, 2, 0, None, None, None), (2, 2, 0, None, None, None)]
    flat = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [3.0, 2.0], 0)], SCHEMA)).collect()
    assert sorted((r.component, r.whitened is None) for r in flat) == [(1, False), (1, False), (2, True), (2, True)]
    assert flat[0].identity_error < 1e-9


def test_sums_beyond_64_bits_stay_exact(spark):
    """Grid numbers near 2^51: deviations that no long holds are NULL, others exact."""
    big = float(1 << 41)
    rows = [(1, [big, 0.0], 0), (2, [big, 1.0], 0), (3, [-big, 2.0], 0)]
    got = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got[1].deviation is None
    n, total = whitening.sums(spark.createDataFrame([([1 << 51, 1], (1 << 20)), ([5, 2], 3)], "x array<long>, weight long"))
    assert (n, total) == ((1 << 20) + 3, [(1 << 71) + 15, (1 << 20) + 6])
