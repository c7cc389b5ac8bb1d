"""Bottom-k sketches of word shingles.

A sketch is the sorted list of the ``k`` smallest distinct 48-bit hashes of a text's shingles. The
sketch of a union is the ``k`` smallest of the sketches' values, so that parts can be sketched apart
and merged in any order. With fewer than ``k`` values it is the whole set and all estimates are exact.

Defined results: a NULL text is an empty one; a text without words has the empty sketch, which is like
itself (1) and like nothing else (0); texts of fewer words than a shingle are one shingle; equal texts
have equal sketches; texts are read whole, whatever their length; empty tables give empty results. Extra
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm import words

SIZE = 128
SHINGLE = 5
BITS = 48
_FIRST = -(1 << 63)


def of_set(shingles: np.ndarray, k: int = SIZE) -> np.ndarray:
    """The sketch of a sorted set of 64-bit hashes."""
    short = shingles[: 2 * k] >> np.uint64(64 - BITS)
    kept = np.unique(short)[:k]
    return kept if len(kept) == k or len(shingles) <= 2 * k else np.unique(shingles >> np.uint64(64 - BITS))[:k]


def merged(a: np.ndarray, b: np.ndarray, k: int = SIZE) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = SIZE) -> float:
    """Estimated Jaccard similarity: the share of the union's sketch that both have."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merged(a, b, k)
    both = np.intersect1d(a, b, assume_unique=True)
    return len(np.intersect1d(union, both, assume_unique=True)) / len(union)


def distinct(a: np.ndarray, k: int = SIZE) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * float(1 << BITS) / float(a[-1] + np.uint64(1))


def containment(a: np.ndarray, b: np.ndarray, k: int = SIZE) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    j = resemblance(a, b, k)
    return min(1.0, j / (1 + j) * (1 + distinct(b, k) / distinct(a, k)))


def to_text(sketch: np.ndarray) -> str:
    """Six bytes a value, in base 64."""
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    packed = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    return np.pad(packed, ((0, 0), (2, 0))).view(">u8").ravel().astype(np.uint64)


def sketches(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = SIZE, shingle: int = SHINGLE) -> DataFrame:
    """``key, sketch array<long>`` per row; rows of one key are parts to be merged with ``merge``."""
    narrow = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets in words.shingle_sets(batch.column(1), shingle):
                values = [of_set(s, k).astype(np.int64) for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sets)), pa.array(values, pa.list_(pa.int64()))], ["key", "sketch"])

    schema = T.StructType([T.StructField("key", narrow.schema["key"].dataType), T.StructField("sketch", T.ArrayType(T.LongType()))])
    return narrow.mapInArrow(run, schema).withColumnRenamed("key", key)


def merge(parts: DataFrame, key: str = "doc_id", k: int = SIZE) -> DataFrame:
    """One sketch per key. Repeated values go, and each task keeps k a key, before anything is shuffled."""
    values = parts.select(key, F.explode("sketch").alias("value")).distinct()
    least = Window.partitionBy(key).orderBy("value")
    kept = values.withColumn("__n", F.row_number().over(least)).where(F.col("__n") <= k)
    full = kept.groupBy(key).agg(F.array_sort(F.collect_list("value")).alias("sketch"))
    empty = F.array().cast("array<bigint>")
    return parts.select(key).distinct().alias("a").join(full.alias("b"), F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")), "left").select(f"a.{key}", F.coalesce("sketch", empty).alias("sketch"))


def likeness(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated resemblance of two sketch columns, in Spark's own functions."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(shared / F.size(union))


REPORT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, distinct_shingles double, in_edited double, in_next double"


def _key(key: Column, tie: Column) -> Column:
    """Two whole numbers as 16 bytes that sort like them."""
    return F.unhex(F.concat(*[F.lpad(F.hex(c.bitwiseXOR(F.lit(_FIRST))), 16, "0") for c in (key, tie)]))


def _ranges(rows: DataFrame, n: int) -> tuple[np.ndarray, dict[bytes, int], list[int]]:
    """Bounds of about ``n`` ranges of equally many rows by ``id, tie``; for the first key of each range
    the range before it; and the ids that hold several ranges.

    Only those are cut by ``tie`` as well, and only their ties are read.
    """
    marks = [i / n for i in range(1, n)]
    points = Counter(rows.agg(F.percentile_approx("id", marks, 10 * n)).first()[0] or [])
    hot = [i for i, many in points.items() if many > 1]
    bounds = {(i, _FIRST) for i in points}
    if hot:
        ties = rows.where(F.col("id").isin(hot)).groupBy("id").agg(F.percentile_approx("tie", marks, 10 * n)).collect()
        bounds |= {(i, at[j * n // points[i] - 1]) for i, at in ties for j in range(1, points[i])}
    cuts = np.array(sorted(struct.pack(">QQ", i - _FIRST, tie - _FIRST) for i, tie in bounds), "S16")
    firsts = rows.select(_first_key(hot).alias("key")).groupBy(_range_of(cuts)("key").alias("range")).agg(F.min("key").alias("first"))
    starts = sorted((r["range"], bytes(r["first"])) for r in firsts.collect())
    return cuts, {first: starts[i - 1][0] for i, (_, first) in enumerate(starts)}, hot


def _first_key(hot: list[int]) -> Column:
    """The key by which a row may be its range's first: with its tie only if its id holds several ranges."""
    return _key(F.col("id"), F.when(F.col("id").isin(hot), F.col("tie")).otherwise(F.lit(_FIRST)) if hot else F.lit(_FIRST))


def _range_of(bounds: np.ndarray):
    @F.pandas_udf("int")
    def number(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy().astype("S16"), "right").astype(np.int32))

    return number


def with_next(documents: DataFrame, ranges: int) -> DataFrame:
    """Documents dealt out by range of id and sorted within; the first of each range is also the last
    row, with ``tail`` set, of the range before it, so that every document meets the next in one task.

    Rows of one id (or none) are in order of a hash of their text, so that an id that many rows share is
    several ranges. The driver holds one bound and one key per range, whatever the number of documents.
    """
    rows = documents.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_FIRST)).alias("id"), F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    bounds, before, hot = _ranges(rows.select("id", "tie"), ranges)

    @F.pandas_udf("array<struct<range:int,tail:boolean>>")
    def places(keys: pd.Series, firsts: pd.Series) -> pd.Series:
        own = np.searchsorted(bounds, keys.to_numpy().astype("S16"), "right")
        return pd.Series([[{"range": int(r), "tail": False}] + ([{"range": before[i], "tail": True}] if i in before else []) for i, r in zip(firsts, own, strict=True)])

    dealt = rows.select("*", F.explode(places(_key(F.col("id"), F.col("tie")), _first_key(hot))).alias("place")).select("place.range", "place.tail", "id", "tie", "doc_id", "text")
    return dealt.repartition(ranges, "range").sortWithinPartitions("range", "tail", "id", "tie", "text")


def report(documents: DataFrame, k: int = SIZE, shingle: int = SHINGLE) -> DataFrame:
    """Each document's sketch beside those of its edited text and of the next document.

    The next document is the next row by doc_id (NULL first), then by a hash of the text; the first follows the last.
    Edited: the last half of the code points gives way to the first as many of the next document.
    ``distinct_shingles`` estimates how many different shingles the text has, ``in_edited`` and
    ``in_next`` what share of them the other text contains.
    """
    spark = documents.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def finished(rows: list[tuple[int | None, str, str | None]], follower: str | None) -> pa.RecordBatch:
        """``rows``: documents in order; ``follower``: what comes after the last, sketched for likeness only."""
        texts = [t for _, t in rows]
        after = [*texts[1:], follower]
        edited = [(t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode() for t, n in zip(texts, after, strict=True)]
        own = [of_set(s, k) for s in words.shingles(*words.word_hashes(*words.joined([t.encode() for t in [*texts, follower]])), shingle)]
        changed = [of_set(s, k) for s in words.shingles(*words.word_hashes(*words.joined(edited)), shingle)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in rows], pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
                pa.array([to_text(s) for s in own[:-1]]),
                pa.array([to_text(s) for s in changed]),
                pa.array([resemblance(a, b, k) for a, b in zip(own, changed, strict=False)], pa.float64()),
                pa.array([resemblance(a, b, k) for a, b in zip(own, own[1:], strict=False)], pa.float64()),
                pa.array([float(distinct(a, k)) for a in own[:-1]], pa.float64()),
                pa.array([containment(a, b, k) for a, b in zip(own, changed, strict=False)], pa.float64()),
                pa.array([containment(a, b, k) for a, b in zip(own, own[1:], strict=False)], pa.float64()),
            ],
            [f.split(" ")[0] for f in REPORT.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str]] = []
        size, at = 0, None
        closed = True  # the range's follower has come; repeated rows of its id are not needed
        for batch in batches:
            for r, tail, i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if r != at:
                    at, closed = r, False
                if closed:
                    continue
                body = text.as_py()
                if tail:
                    yield finished(held, body)
                    held, size, closed = [], 0, True
                    continue
                if size > words.BLOCK_BYTES // 2:
                    yield finished(held, body)
                    held, size = [], 0
                held.append((i.as_py(), body))
                size += len(body)

    return with_next(documents, ranges).drop("id", "tie").mapInArrow(run, REPORT)
