import math
import zlib
from collections import Counter, defaultdict

import xxhash

from freshet.llm import sharding


def owner(key, weights):
    def cost(shard):
        h = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
        h = xxhash.xxh64_intdigest(shard.to_bytes(4, "little"), h)
        return -math.log(((h >> 11) + 0.5) / 2**53) / weights[shard]

    return min((i for i, w in enumerate(weights) if w > 0), key=cost)


def test_whole_table_against_brute_force(docs, texts):
    rows = sharding.shard_documents(docs, [1.0] * 8).collect()
    slots = defaultdict(list)
    for r in rows:
        text = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(text) + 1, zlib.crc32(text), "key")
        assert r.shard == owner(r.doc_id, [1.0] * 8)
        assert r.grown_shard == owner(r.doc_id, [1.0] * 9) and r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert len(rows) == len(texts) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights_decide_the_shares(spark):
    shard = sharding.rendezvous(["id"], [1.0, 3.0, 0.0])
    counts = Counter(r[0] for r in spark.range(4000).select(shard).collect())
    assert set(counts) == {0, 1} and 2.5 < counts[1] / counts[0] < 3.6


def test_nulls_repeats_empty_and_clashing_columns(spark):
    rows = [(None, None, 1, "a"), (None, "é", 2, "b"), (4, "x", 3, "c"), (4, "x", 3, "c"), (5, "", 9, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int, __block string")
    out = sharding.shard_documents(df, [1.0, 1.0]).collect()
    assert sorted(r.size for r in out) == [1, 1, 2, 2, 3]
    assert len({(r.shard, r.slot) for r in out}) == 5
    assert sharding.shard_documents(df.limit(0), [1.0]).collect() == []
