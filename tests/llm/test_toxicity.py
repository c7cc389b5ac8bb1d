import numpy as np
import pytest
from conftest import SF

from freshet.llm import toxicity


def auc(bad, good):
    return np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])


def test_held_out_documents(spark):
    folder = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    known = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.classify(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in known]
    bad, good = ([r.score for r in held if known[r.doc_id] == k] for k in (1, 0))
    assert auc(bad, good) > 0.85
    assert sum(r.predicted for r in held if known[r.doc_id] == 0) <= 1


def test_held_out_labels_teach_nothing(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    import zlib

    assert {r.doc_id for r in toxicity.training_labels(labels).collect()} == {i for i in range(50) if zlib.crc32(str(i).encode()) % 3 != 1}


def test_label_model_finds_accuracies_and_dependence():
    draw = np.random.default_rng(0)
    y = draw.random(60_000) < 0.2
    accuracy = np.array([[0.05, 0.1, 0.02, 0.05], [0.7, 0.6, 0.8, 0.5]])
    votes = (draw.random((len(y), 4)) < accuracy[y.astype(int)]).astype(int)
    votes[:, 3] = np.where(draw.random(len(y)) < 0.9, votes[:, 0], votes[:, 3])  # the last copies the first
    patterns, place = np.unique(votes, axis=0, return_inverse=True)
    label = np.where(np.arange(len(y)) < 2000, y, -1)
    keys = place.ravel() * 3 + label + 1
    rows, counts = np.unique(keys, return_counts=True)
    model = toxicity.fit_label_model(patterns[rows // 3], counts.astype(float), rows % 3 - 1)
    assert model.prior == pytest.approx(0.2, abs=0.03)
    assert np.abs(model.accuracy[:, :3] - accuracy[:, :3]).max() < 0.06
    assert model.correlation[1, 0, 3] > 0.7 and abs(model.correlation[1, 1, 2]) < 0.1
    assert {model.parent[3], model.parent[0]} & {0, 3}


def test_edges(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} loser" if i % 3 == 0 else f"word{i % 7} friend", 0.5) for i in range(300)] + [(None, None, 0.1), (301, "", 0.1), (301, "", 0.1)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] * 2, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    rows = toxicity.scores(docs, model).collect()
    assert len(rows) == 303 and all(r.predicted == (r.doc_id % 3 == 0) for r in rows if r.doc_id is not None and r.doc_id < 300)
    assert len({r.score for r in rows if r.doc_id in (None, 301)}) == 1
    kept = toxicity.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == 203
    assert toxicity.scores(docs.limit(0), model).collect() == [] == toxicity.accepted(docs.limit(0), model).collect()
    assert {r.score < 0.01 for r in toxicity.classify(docs, labels.limit(0)).collect()} == {True}
    assert toxicity.classify(docs.limit(0), labels).collect() == []
    assert all(r.predicted == 1 for r in toxicity.classify(docs, labels.where("toxic = 1")).collect())


def test_very_long_text(spark):
    model = toxicity.Model(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0), 0.0)
    df = spark.createDataFrame([(1, "a" * 3_000_000), (2, "b c " * 600_000), (3, "x")], "doc_id long, text string")
    assert [r.score for r in toxicity.scores(df, model).collect()] == [0.5] * 3


def test_entries_are_counted_over_all_labels(spark):
    made = [(i, f"friend{i % 7} {'loser' if i % 20 == 0 else 'word'} rest") for i in range(1500)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 20 == 0)) for i in range(1500)], "doc_id long, toxic int")
    whole, sampled = toxicity.fit(docs, labels), toxicity.fit(docs, labels, sample_size=40)
    assert len(whole.entries) and sampled.entries.tolist() == whole.entries.tolist()
