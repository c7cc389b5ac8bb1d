from pathlib import Path

import brute
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from freshet.llm import components as module
from freshet.llm.components import components
from freshet.session import frozen


@settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=30))
def test_any_graph(spark, links):
    found = {r.node: r.component for r in components(spark.createDataFrame(links or [(1, 1)], "u long, v long")).collect()}
    linked = [x for x in links if x[0] != x[1]]
    assert found == brute.components({n for x in linked for n in x}, linked)


def test_long_chain_star_and_nulls(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(None, 3), (5, None), (9, 9)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260)]}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_few_links_make_few_files(spark, monkeypatch):
    links = [(i, i + 1) for i in range(0, 4000, 2)] + [(1, i) for i in range(5000, 7000)]
    written: list[int] = []

    def counted(df, label):
        out = frozen(df, label)
        if label != "links":
            written.append(len(list(Path(out.inputFiles()[0].removeprefix("file:")).parent.glob("part-*"))))
        return out

    monkeypatch.setattr(module, "frozen", counted)
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}

    def run() -> dict:
        written.clear()
        return {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}

    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        want = brute.components({n for x in links for n in x}, links)
        assert run() == want
        assert max(written) == 1
        monkeypatch.setattr(module, "LINKS", 500)
        assert run() == want
        assert 1 < max(written) <= 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
