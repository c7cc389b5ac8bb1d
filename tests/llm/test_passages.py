import random
from collections import defaultdict

import brute
import numpy as np

from freshet.llm import passages


def test_tuning():
    bands, rows = passages.tuned(80, 0.998)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.998 and bands * rows <= passages.MOST_HASHES


def test_whole_table(docs, texts):
    found = passages.repeated(docs).collect()
    long, paragraphs, spans = defaultdict(set), defaultdict(set), defaultdict(set)
    for i, t in texts.items():
        w = brute.words(t)
        for a in range(len(w) - 46):
            long[tuple(w[a : a + 47])].add(i)
        for a in range(len(w) - 31):
            spans[tuple(w[a : a + 32])].add(i)
        for line in (t or "").split("\n"):
            if len(brute.words(line)) >= passages.LEAST_PARAGRAPH:
                paragraphs[brute.shingles(line)].add(i)
    must = {i for o in long.values() if len(o) > 1 for i in o}
    near = {i for o in paragraphs.values() if len(o) > 1 for i in o}
    sets = list(paragraphs)
    for x, a in enumerate(sets):
        for b in sets[:x]:
            common = len(a & b)
            if common and 100 * common >= 80 * (len(a) + len(b) - common) and len(paragraphs[a] | paragraphs[b]) > 1:
                near |= paragraphs[a] | paragraphs[b]
    flagged = {r.doc_id for r in found}
    assert must <= flagged <= near | {i for o in spans.values() if len(o) > 1 for i in o}
    assert near <= {r.doc_id for r in found if r.kind == "paragraph"}
    firsts = defaultdict(set)
    for r in found:
        assert r.first_doc_id <= r.doc_id and r.stays == (r.doc_id == r.first_doc_id)
        firsts[(r.kind, r.component)].add(r.doc_id)
    assert all(len(ids) > 1 for (kind, _), ids in firsts.items() if kind == "paragraph")


def test_passage_inside_other_text(spark):
    draw = random.Random(2)
    word = lambda: f"w{draw.randrange(10**9)}"
    passage = [word() for _ in range(47)]
    texts = {i: " ".join([word() for _ in range(draw.randrange(90))] + passage + [word() for _ in range(draw.randrange(90))]) for i in range(40)}
    texts |= {100 + i: " ".join(word() for _ in range(150)) for i in range(20)} | {200: None, 201: ""}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = passages.repeated(df)
    rows = found.collect()
    assert {r.doc_id for r in rows} == set(range(40))
    for r in rows:
        assert texts[r.doc_id].split()[r.begin_word : r.end_word] and set(texts[r.doc_id].split()[r.begin_word : r.end_word]) <= set(passage)
    cleaned = {r.doc_id: r.text for r in passages.without_repeats(df, found).collect()}
    assert len(cleaned) == len(texts) and all(cleaned[i] == texts[i] for i in (0, *range(100, 120), 200, 201))
    assert all(len(cleaned[i].split()) <= len(texts[i].split()) - 32 for i in range(1, 40))


def test_nulls_repeats_and_empty(spark):
    line = " ".join(f"a{i}" for i in range(30))
    df = spark.createDataFrame([(None, line, 1), (1, line, 2), (1, line, 2), (2, "b " + line[:-3] + "é", 3)], "doc_id long, text string, set int")
    rows = [r for r in passages.repeated(df).collect() if r.kind == "paragraph"]
    assert sorted((r.doc_id or -1, r.first_doc_id or -1, r.stays) for r in rows) == [(-1, -1, True), (1, -1, False), (1, -1, False), (2, -1, False)]
    assert passages.repeated(df.limit(0)).collect() == []


def test_neighbouring_windows_always_choose_one():
    hashes = np.array([random.Random(4).randrange(2**63) for _ in range(500)], np.uint64)
    chosen = set(passages.chosen_windows(hashes, 16).tolist())
    assert all(chosen & set(range(a, a + 16)) for a in range(485))
    assert passages.chosen_windows(hashes[:3], 16).tolist() == [int(np.argmin(hashes[:3]))]


def test_short_paragraphs(spark):
    equal, near = "all rights reserved by us", [f"n{i}" for i in range(19)]
    rows = [(1, f"{equal}\n{' '.join(near)}\nx y z w"), (2, f"own text here\n{equal.title()}"), (3, f"x y z w\n{' '.join(near[:-1])}")]
    found = passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.begin_word, r.end_word, r.first_doc_id, r.stays) for r in found) == [(1, 0, 5, 1, True), (1, 5, 24, 1, True), (2, 3, 8, 1, False), (3, 4, 22, 1, False)]


def test_equal_paragraphs_from_any_length_on(docs, texts, spark):
    """Every line that two documents have, with its place, against brute force."""
    places = defaultdict(set)
    for i, t in texts.items():
        at = 0
        for line in (t or "").split("\n"):
            w = tuple(brute.words(line))
            if w:
                places[w].add((i, at, at + len(w)))
            at += len(w)
    shared = {w: p for w, p in places.items() if len({i for i, _, _ in p}) > 1}
    assert {len(w) for w in shared} >= {1, 2, 3, 4}
    found = [r for r in passages.repeated(docs, exact=1).collect() if r.kind == "paragraph"]
    rows = {(r.doc_id, r.begin_word, r.end_word): r for r in found}
    assert {p for places in shared.values() for p in places} <= set(rows)
    for w, p in shared.items():
        assert len({rows[x].component for x in p}) == 1 and (len(w) >= 5 or {rows[x].first_doc_id for x in p} == {min(i for i, _, _ in p)})
    short = {k for k in rows if k[2] - k[1] < 5}
    assert short == {x for w, p in shared.items() if len(w) < 5 for x in p}
    df = spark.createDataFrame([(1, "all rights reserved."), (2, "x\nAll  rights reserved."), (3, "all rights\nreserved.")], "doc_id long, text string")
    assert passages.repeated(df).collect() == []
    assert sorted((r.doc_id, r.begin_word, r.end_word, r.stays) for r in passages.repeated(df, exact=3).collect()) == [(1, 0, 3, True), (2, 1, 4, False)]


def test_rows_without_id_and_repeated_ids(spark):
    line = [f"a{i}" for i in range(60)]
    p, near, other = " ".join(line), " ".join(line[:-1]), " ".join(f"b{i}" for i in range(60))
    rows = [(None, f"x\n{p}"), (None, ""), (None, None), (None, f"{p} z"), (1, near), (2, f"u\nv\n{other}"), (2, f"w {other}"), (2, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = passages.repeated(df)
    kept = found.collect()
    for kind in ("paragraph", "passage"):
        assert sorted((r.doc_id or -1, r.first_doc_id or -1) for r in kept if r.kind == kind) == [(-1, -1), (-1, -1), (1, -1), (2, 2), (2, 2)]
        assert sorted(r.doc_id or -1 for r in kept if r.kind == kind and r.stays) == [-1, 2]
    cleaned = passages.without_repeats(df, found).collect()
    assert len(cleaned) == len(rows) and {r.text for r in cleaned if r.doc_id == 1} == {""}
    whole = [r.text or "" for r in cleaned]
    assert sum("a30" in t for t in whole) == 1 == sum("b30" in t for t in whole) and {"short"} < set(whole)
