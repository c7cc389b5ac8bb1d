import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from brute import LOWER, UPPER

from freshet.llm import variants
from freshet.llm.catalog import QUERIES

_LOW = str.maketrans(UPPER, LOWER)


def one_edit(word, alphabet):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in alphabet}
        if i < len(word):
            out.add(word[:i] + word[i + 1 :])
            out |= {word[:i] + c + word[i + 1 :] for c in alphabet}
    return out - {word}


def brute(rows):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(_LOW)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2}
    alphabet = set("".join(words))
    near = {w: [v for v in one_edit(w, alphabet) if v in words] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def shown(df):
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_whole_table(spark, texts):
    want = brute(texts.items())
    assert len(want) > 500 and any(w[1] for w in want)
    assert shown(QUERIES["op13_spelling_variants"](spark, "/root/testdata/sf0.001")) == want


@pytest.mark.parametrize("seed", range(4))
def test_index_against_all_pairs(seed):
    draw = random.Random(seed)
    words = sorted({"".join(draw.choice("abc") for _ in range(draw.randrange(3, 8))) for _ in range(300)})
    asked = words + ["zzz", "abz", "azc", "abcabcabcabc"]
    heads = np.array([len(w) // 2 for w in asked])
    q, w = variants.Index(words).near(asked, heads)
    got = {(asked[a], words[b]) for a, b in zip(q, w, strict=True)}
    want = {(a, b) for a in asked for b in one_edit(a, "abcz") & set(words) if b.startswith(a[: len(a) // 2])}
    assert got == want and len(q) == len(got)


def chains():
    """Chains of forms, letters beyond ASCII, and a group of words that share a half."""
    draw = random.Random(1)
    rows = []
    for word, n in (("abcdefgh", 2), ("abcdefgi", 25), ("abcdefgii", 300), ("abcdefgij", 300), ("élèvesxy", 3), ("élévesxy", 40), ("Élévesxy", 2)):
        rows += [word] * n
    rows += ["prefixes" + "".join(draw.choice("abcd") for _ in range(4)) for _ in range(300)] * 2
    rows += ["".join(draw.choice("abcd") for _ in range(4)) + "suffixes" for _ in range(300)] * 2
    rows += ["x" * 3000, "x" * 3001, "x" * 3000, "x" * 3001]
    draw.shuffle(rows)
    return [(i, " ".join(rows[i::40])) for i in range(40)] + [(None, "Prefixesaaaa"), (None, None), (50, ""), (51, "1 2 -"), (3, "abcdefgii×abcdefgii")] * 2


@pytest.mark.parametrize(("block", "questions"), [(16, 8), (4096, 65_536)])
def test_blocks_and_hot_halves(spark, monkeypatch, block, questions):
    monkeypatch.setattr(variants, "BLOCK_WORDS", block)
    monkeypatch.setattr(variants, "QUESTIONS", questions)
    rows = chains()
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(5)
    assert shown(variants.spelling_variants(df)) == brute(rows)


def test_nothing_to_group(spark):
    for rows in ([], [(1, None), (2, "short")], [(1, "lonesomeword")]):
        assert variants.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect() == []
