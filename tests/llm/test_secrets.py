import hashlib
import re

import pytest
from pyspark.sql import functions as F

from freshet.llm import secrets
from freshet.session import working_dir

BASE = (
    ("assign", re.compile(r"""((?:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def spans(text):
    found = sorted((m.start(), i, kind, m.end()) for i, (kind, p, ok) in enumerate(BASE) for m in p.finditer(text or "") if ok(m))
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in found)


HARD = [
    "secret: token : abcdef1",
    "é𝒳 PassWord=\"abc\" api_key = 'abcdef' apikey:abcdefg",
    "AKIA" + "A" * 15 + " AKIAAKIA" + "B" * 12 + " x" + "0a" * 12 + "g" + "f" * 23,
    "token=" + "deadbeef" * 3 + "\ntoken:\nabcdef passwd  ==abcdef",
    "ſecret=abcdef toKen=abcdef",
    "password=token=abcdef" * 40,
    "",
    None,
]


def test_against_brute_force(spark, docs, texts):
    hard = spark.createDataFrame([(10_000 + i, t, "x") for i, t in enumerate(HARD)], "doc_id long, text string, findings string")
    both = docs.select("doc_id", "text", F.lit("clash").alias("findings")).union(hard)
    want = texts | {10_000 + i: t for i, t in enumerate(HARD)}
    rows = secrets.secret_report(both).collect()
    assert len(rows) == len(want)
    for r in rows:
        text = spans(want[r.doc_id])
        assert r.spans == text and r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(text.count(k + ":") for k in ("assign", "access", "hex"))


def test_ledger_scans_only_what_is_new(spark):
    ledger = working_dir(spark, "ledger-test")
    first = spark.createDataFrame([("a", 1, "token=abcdef"), ("b", 1, "token=abcdef"), ("c", 1, None)], "path string, version long, text string")
    found = {r.path: len(r.findings) for r in secrets.scan_history(first, ledger).collect()}
    assert found == {"a": 1, "b": 1, "c": 0}
    assert secrets.read_ledger(spark, ledger).count() == 2
    more = first.union(spark.createDataFrame([("a", 2, "new " + "0f" * 12)], first.schema))
    todo = secrets.unseen(secrets.addressed(more, "path", "version", "text"), secrets.read_ledger(spark, ledger)).collect()
    assert [r.text for r in todo] == ["new " + "0f" * 12]
    assert sorted((r.path, r.version, len(r.findings)) for r in secrets.scan_history(more, ledger).collect()) == [("a", 1, 1), ("a", 2, 1), ("b", 1, 1), ("c", 1, 0)]
    rules = (*secrets.RULES, secrets.Rule("word", "new"))
    todo = secrets.unseen(secrets.addressed(more, "path", "version", "text"), secrets.read_ledger(spark, ledger), rules).collect()
    assert len(todo) == 3 and all(r.missing == ["word@1"] for r in todo)
    again = {(r.path, r.version): [f.kind for f in r.findings] for r in secrets.scan_history(more, ledger, rules=rules).collect()}
    assert again[("a", 2)] == ["word", "hex"]


def test_a_changed_rule_leaves_nothing_of_its_earlier_version(spark):
    ledger = working_dir(spark, "ledger-test")
    history = spark.createDataFrame([("a", 1, "word1 word22 word3"), ("b", 1, "none")], "path string, version long, text string")
    spans = lambda *rules: {r.path: [(f.start, f.end) for f in r.findings] for r in secrets.scan_history(history, ledger, rules=rules).collect()}
    first, second = secrets.Rule("w", "word[0-9]"), secrets.Rule("w", "word[0-9][0-9]", version=2)
    assert spans(first) == {"a": [(0, 5), (6, 11), (13, 18)], "b": []}
    assert spans(second) == {"a": [(6, 12)], "b": []}
    # Findings of both are kept, and none is looked for again.
    assert spans(first) == {"a": [(0, 5), (6, 11), (13, 18)], "b": []}
    assert secrets.read_ledger(spark, ledger).count() == 4


@pytest.mark.parametrize("rows", [[], [("a", 1, "x"), ("a", 1, "x"), (None, None, "x")]])
def test_empty_and_repeated(spark, rows):
    df = spark.createDataFrame(rows, "path string, version long, text string")
    assert secrets.scan_history(df, working_dir(spark, "ledger-test")).count() == len(rows)
