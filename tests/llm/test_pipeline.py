import sys
from pathlib import Path

import brute
import pytest
import tokenizers
from conftest import SF

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import __spark_entry__ as entry_points  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import duck, rows_of  # noqa: E402

from freshet.llm import toxicity  # noqa: E402
from freshet.llm.catalog import QUERIES, SQL, tokenizer_path  # noqa: E402


def test_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_twins(spark, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    relation = duck(SF).execute(SQL[name])
    columns = [d[0] for d in relation.description]
    assert sorted(columns) == sorted(df.columns) and got == rows_of(columns, relation.fetchall())


def test_stages_against_brute_force(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rejected = {r.doc_id for r in toxicity.classify(docs, labels).collect() if r.predicted}
    kept = stages["toxicity"](spark, docs, SF)
    assert kept.dtypes == docs.dtypes and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - rejected

    kept = spark.createDataFrame(kept.collect(), kept.schema)
    texts = {r.doc_id: r.text for r in kept.collect()}
    goes = brute.repeated_lines(texts)
    want = {}
    for i, t in texts.items():
        left = "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in goes[i]) if goes.get(i) else t
        if not goes.get(i) or left.split():
            want[i] = left
    out = stages["line_dedup"](spark, kept, SF)
    assert out.dtypes == docs.dtypes and {r.doc_id: r.text for r in out.collect()} == want
    assert all(r.n_chars == len(r.text) for r in out.collect() if goes.get(r.doc_id))

    kept = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in want.items()], docs.schema)
    least = brute.jaccard_components(want)
    out = stages["jaccard_join"](spark, kept, SF)
    assert out.dtypes == docs.dtypes and {r.doc_id for r in out.collect()} == {i for i, (n, c) in least.items() if not n or i == c}

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i, _, hit, _ in brute.contaminated(want.items(), items) if not hit}
    out = stages["decontamination"](spark, kept, SF)
    assert out.dtypes == docs.dtypes and {r.doc_id for r in out.collect()} == clean and clean != set(want)

    reference = tokenizers.Tokenizer.from_file(tokenizer_path())
    for r in stages["bpe"](spark, kept, SF).collect():
        assert r.ids == reference.encode(r.text or "", add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_run(spark, docs):
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert out.columns == [*docs.columns, "ids", "n_tokens"] and 0 < len(rows) < docs.count() and len({r.doc_id for r in rows}) == len(rows)


def test_stages_take_nulls_repeats_empty_tables_and_more_columns(spark, docs):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 2), (1, "", "en", "s", 0, 2), (2, "a b c d e f g h", "en", "s", 15, 3), (2, "a b c d e f g h", "en", "s", 15, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids int")
    for given in (df, df.limit(0)):
        kept = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, SF)
            assert kept.columns == df.columns
        out = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
        assert len(out) == (4 if given is df else 0)
