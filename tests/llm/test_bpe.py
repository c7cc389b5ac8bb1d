import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import tokenizers

from freshet.llm import bpe
from freshet.llm.catalog import tokenizer_path

ALPHABET = "abc  \t\n\r\x0b\x1c\x85\xa0 ​ 'stredlmv0123٣½éñßçあ漢🙂́!?.-_\x00"


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    with open(tokenizer_path(), encoding="utf-8") as file:
        return bpe.Encoder(bpe.Vocabulary(file.read()), remembered=2000)


@pytest.fixture(scope="module")
def source(spark):
    return bpe.tokenizer(spark, tokenizer_path())


def test_hard_texts(reference, encoder):
    draw = random.Random(7)
    texts = ["".join(draw.choice(ALPHABET) for _ in range(draw.randrange(50))) for _ in range(4000)]
    texts += ["".join(draw.choice(["<|endoftext|>", " ", "a", "'s", "\n"]) for _ in range(9)) for _ in range(500)]
    texts += ["a" * 9000, "ab" * 3000, " " * 3000, "<|endoftext|", "", "\0special<|endoftext|>"]
    for at in range(0, len(texts), 1000):
        part = texts[at : at + 1000]
        for text, ids, want in zip(part, encoder.encode(part), reference.encode_batch(part, add_special_tokens=False), strict=True):
            assert ids.tolist() == want.ids, text
            assert encoder.decode(ids) == reference.decode(want.ids, skip_special_tokens=False)


def test_bytes_that_are_no_text(reference, encoder):
    ids = np.array([94, 95, 96, 447, 64], np.int64)
    assert encoder.decode(ids) == reference.decode(ids.tolist(), skip_special_tokens=False)
    with pytest.raises(ValueError):
        encoder.decode(np.array([60_000]))


def test_whole_table(docs, texts, reference, source):
    rows = bpe.round_trip(docs, source).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_frames_nulls_repeats_and_clashes(spark, source):
    df = spark.createDataFrame([(1, "ab c", 5, "x"), (1, "ab c", 5, "x"), (None, None, 6, "y")], "doc_id long, text string, ids int, output string")
    encoded = bpe.encode(df, source)
    assert sorted(len(r.ids) for r in encoded.collect()) == [0, 2, 2]
    assert sorted((r.text, r.output) for r in bpe.decode(encoded, source).collect()) == [("", "y"), ("ab c", "x"), ("ab c", "x")]
    assert bpe.round_trip(df.limit(0), source).collect() == [] == bpe.encode(df.limit(0), source).collect()


def test_a_merge_of_later_tokens_is_refused():
    with open(tokenizer_path(), encoding="utf-8") as file:
        text = file.read()
    import json

    model = json.loads(text)
    model["model"]["merges"] = model["model"]["merges"][::-1]
    with pytest.raises(ValueError):
        bpe.Vocabulary(json.dumps(model))


def test_small_groups(reference, monkeypatch):
    """Groups of a few bytes, a text larger than a group, words merged in several runs, and slices of a batch."""
    for name, value in (("TOGETHER", 60), ("MERGED", 9), ("PLACES", 4), ("STRINGS", 3), ("ROWS", 4), ("ENTRIES", 50)):
        monkeypatch.setattr(bpe, name, value, raising=False)
    with open(tokenizer_path(), encoding="utf-8") as file:
        small = bpe.Encoder(bpe.Vocabulary(file.read()), remembered=40)
    draw = random.Random(5)
    texts = ["".join(draw.choice(ALPHABET) for _ in range(draw.randrange(40))) for _ in range(300)]
    texts += ["foo  bar\n baz", None, "", " ", "  ", " a", "a ", "a  ", "\n", "漢字 かな" * 40, "<|endoftext|> a<|endoftext|>", " <|endoftext|>  b", "many words " * 50, None]
    want = [e.ids for e in reference.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    column = pa.array(["left out", *texts], pa.string()).slice(1)
    for given in (texts, column, column.cast(pa.large_string())):
        assert [i.tolist() for i in small.encode(given)] == want
    assert [i.tolist() for i in small.encode(pa.nulls(3))] == [[], [], []]
    parts = list(bpe.handed(small.encode(column)))
    assert [i.tolist() for part in parts for i in part] == want
    assert all(len(part) <= 4 and sum(map(len, part[:-1])) < 50 for part in parts)


def test_memory_does_not_follow_the_rows_of_a_batch(reference, monkeypatch):
    """Only new words: two megabytes of them in one batch, and what a worker holds for it."""
    monkeypatch.setattr(bpe, "TOGETHER", 1 << 16, raising=False)
    with open(tokenizer_path(), encoding="utf-8") as file:
        fresh = bpe.Encoder(bpe.Vocabulary(file.read()), remembered=10_000)
    draw = random.Random(3)
    texts = [" ".join("".join(draw.choices("abcdefghij", k=7)) for _ in range(200)) for _ in range(1200)]
    tracemalloc.start()
    try:
        lengths = [len(ids) for ids in fresh.encode(texts)]
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert lengths[::100] == [len(reference.encode(t, add_special_tokens=False).ids) for t in texts[::100]]
    assert peak < 24 << 20, peak
