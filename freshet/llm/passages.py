"""Substring deduplication: paragraphs that are nearly the same, and passages within them that are equal.

Paragraphs are lines of at least ``LEAST_PARAGRAPH`` words, one shingle. Their shingles' MinHash signature
is cut into bands, tuned so that paragraphs at the similarity limit collide almost surely; paragraphs that
collide are joined, their exact Jaccard similarity is computed from the texts, and links make
components. Equal paragraphs are one class before that; with ``exact`` words given, also those too short
for a shingle, from so many words on (by default none: headings and sign-offs of a few words are shared by
documents that have nothing else in common).

A passage that repeats inside longer paragraphs is found by windows of ``PASSAGE`` words whose places
the text itself chooses: of every ``GAP`` neighbouring places the one whose window has the least hash.
Two texts that share ``PASSAGE + GAP - 1`` words in a row therefore share a window. A window is a
signature of a single band, and equal windows are equal texts.

Of each component the occurrences in its first document stay; the others are marked for removal.

Defined results: words are cut at ASCII white space, A-Z lower-cased; a NULL or empty text has neither
paragraphs nor passages; a NULL id sorts first and is returned as NULL; rows that repeat both
id and text are one document, rows of one id with different texts (or of no id) are several; repeats
within one document are not reported; an empty table gives an empty result. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm import setjoin, words
from freshet.llm.components import components
from freshet.llm.lines import Lines, _identified
from freshet.session import frozen

SHINGLE = 5
PERCENT = 80
RECALL = 0.998
#: Every paragraph that has a shingle.
LEAST_PARAGRAPH = SHINGLE
PASSAGE = 32
GAP = 16
MOST_HASHES = 32

_U = np.uint64
_FIRST = -(1 << 63)
#: What tells documents apart, and their order.
DOCUMENT = ("id", "sum")


def tuned(percent: int = PERCENT, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows per band: the longest rows with which paragraphs at the limit collide with at
    least this probability, using at most so many hashes; then the fewest bands that do."""
    s = percent / 100
    for rows in range(most, 0, -1):
        for bands in range(1, most // rows + 1):
            if 1 - (1 - s**rows) ** bands >= recall:
                return bands, rows
    raise ValueError("so high a recall takes more hashes")


def band_keys(lines: Lines, chosen: np.ndarray, bands: int, rows: int, shingle: int = SHINGLE) -> np.ndarray:
    """The band keys of the chosen lines, each of at least ``shingle`` words."""
    runs = np.append(words.run_hashes(lines.words, shingle), _U(0))
    edges = np.stack([lines.start[chosen], lines.end[chosen] - shingle + 1], axis=1).ravel()
    keys = np.zeros((len(chosen), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(chosen), band + 1, np.uint64)
        for row in range(rows):
            # Multiplying by odd numbers permutes the hashes; the number of the hash decides on it.
            factor = words.mix(np.array([band * rows + row + 1], np.uint64))[0] | _U(1)
            least = np.minimum.reduceat(runs * factor ^ (factor >> _U(7)), edges)[::2]
            key = words.mix(key * _U(0x9E3779B97F4A7C15) + least)
        keys[:, band] = key
    return keys


def _paragraphs(docs: DataFrame, bands: int, rows: int, least: int, exact: int) -> DataFrame:
    """A row per paragraph: document, line, first word and the one after the last, class, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, raw, offsets in words.blocks(batch.column(2)):
                lines = Lines(raw, offsets)
                chosen = np.flatnonzero(lines.size >= min(least, exact))
                if not len(chosen):
                    continue
                near = lines.size[chosen] >= max(least, SHINGLE)
                # Lines without a shingle have no band keys.
                ends = np.append(0, np.cumsum(near * bands)).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(band_keys(lines, chosen[near], bands, rows).view(np.int64).ravel()))
                first = np.searchsorted(lines.text, lines.text[chosen])
                base = lines.start[first]
                row = pa.array(at + lines.text[chosen])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(row),
                        batch.column(1).take(row),
                        pa.array(lines.number[chosen]),
                        pa.array(lines.start[chosen] - base),
                        pa.array(lines.end[chosen] - base),
                        pa.array((lines.ids()[0][chosen] >> _U(1)).astype(np.int64)),
                        keys,
                    ],
                    ["id", "sum", "number", "begin", "end", "set", "bands"],
                )

    return docs.mapInArrow(run, "id bigint, sum bigint, number bigint, begin bigint, end bigint, set bigint, bands array<bigint>")


def chosen_windows(hashes: np.ndarray, gap: int = GAP) -> np.ndarray:
    """Of every ``gap`` neighbouring windows the first with the least hash; of fewer windows one."""
    if len(hashes) <= gap:
        return np.argmin(hashes)[None] if len(hashes) else np.zeros(0, np.int64)
    least = np.argmin(np.lib.stride_tricks.sliding_window_view(hashes, gap), axis=1)
    places = least + np.arange(len(least))
    return places[np.append(True, places[1:] != places[:-1])]


def _windows(docs: DataFrame, length: int, gap: int) -> DataFrame:
    """``key, id, sum, begin`` of the windows that the texts choose."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, until, raw, offsets in words.blocks(batch.column(2)):
                hashes, first = words.word_hashes(raw, offsets)
                sums = np.append(_U(0), np.cumsum(hashes * words._power_tables(len(hashes) + 1)[0][: len(hashes)], dtype=np.uint64))
                n = max(0, len(hashes) - length + 1)
                spans = words.mix((sums[length : length + n] - sums[:n]) * words._power_tables(n + 1)[1][:n])
                places = [a + chosen_windows(spans[a : max(a, b - length + 1)], gap) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                many = np.array([len(p) for p in places])
                place = np.concatenate(places) if until > at else np.zeros(0, np.int64)
                row = np.repeat(np.arange(until - at), many)
                owner = pa.array(at + row)
                yield pa.RecordBatch.from_arrays([pa.array(spans[place].view(np.int64)), batch.column(0).take(owner), batch.column(1).take(owner), pa.array(place - first[row])], ["key", "id", "sum", "begin"])

    return docs.mapInArrow(run, "key bigint, id bigint, sum bigint, begin bigint")


def _passages(docs: DataFrame, length: int, gap: int) -> DataFrame:
    """``id, sum, begin, end, cluster, first_id, first_sum``: windows that several documents share, joined where they
    overlap and come from the same first document."""
    table = frozen(_windows(docs, length, gap), "windows")
    # Written, so that the join reads both sides by plain exchanges and can split a hot key.
    shared = frozen(table.groupBy("key").agg(F.min(F.struct(*DOCUMENT)).alias("first"), F.max(F.struct(*DOCUMENT)).alias("last")).where("first < last").select("key", F.col("first.id").alias("first_id"), F.col("first.sum").alias("first_sum")), "shared-windows")
    found = table.join(shared, "key").select("id", "sum", "begin", "first_id", "first_sum", "key")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = found.repartition(partitions, "id", "sum").sortWithinPartitions("id", "sum", "first_id", "first_sum", "begin")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "sum", "begin", "end", "cluster", "first_id", "first_sum"]
        kinds = [pa.int64()] * 7
        open_: list[int] | None = None
        for batch in batches:
            rows = []
            for i, body, begin, origin, origin_sum, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if open_ and (*open_[:2], *open_[5:]) == (i, body, origin, origin_sum) and begin <= open_[3]:
                    open_[3] = begin + length
                    open_[4] = min(open_[4], key)
                    continue
                if open_:
                    rows.append(open_)
                open_ = [i, body, begin, begin + length, key, origin, origin_sum]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        if open_:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(open_, kinds, strict=True)], names)

    return ordered.mapInArrow(run, "id bigint, sum bigint, begin bigint, end bigint, cluster bigint, first_id bigint, first_sum bigint")


def _line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``set, text`` of the lines ``id, sum, number, set``; a document's lines bound the lists."""
    numbers = wanted.groupBy("id", "sum").agg(F.collect_list(F.struct("number", "set")).alias("lines"))
    split = docs.join(numbers, ["id", "sum"]).select(F.split("text", "\n", -1).alias("all"), F.explode("lines").alias("line"))
    # Rows that repeat both id and text give a line more than once.
    return split.select(F.col("line.set").alias("set"), F.col("all")[F.col("line.number").cast("int")].alias("text")).dropDuplicates(["set"])


def _near_paragraphs(docs: DataFrame, percent: int, recall: float, least: int, exact: int) -> DataFrame:
    bands, rows = tuned(percent, recall)
    found = frozen(_paragraphs(docs, bands, rows, least, exact), "paragraphs")
    classes = frozen(found.groupBy("set").agg(F.min(F.struct("id", "sum", "number")).alias("at"), F.first("bands").alias("bands")), "paragraph-classes")
    keys = classes.select("set", F.explode("bands").alias("shingle"))
    shared = frozen(keys.groupBy("shingle").agg(F.min("set").alias("a"), F.max("set").alias("b")).where("a < b").select("shingle"), "shared-bands")
    lists = frozen(keys.join(shared, "shingle").select("shingle", "set", F.lit(1).alias("size"), F.lit(0).alias("place")), "bands")
    wanted = classes.join(lists.select("set").distinct(), "set").select("at.id", "at.sum", "at.number", "set")
    texts = frozen(_line_texts(docs, wanted), "paragraph-texts")
    linked = frozen(components(setjoin.links_between(lists, texts, SHINGLE, percent)), "paragraph-components")
    # Per class first: only those that several documents have, alone or with linked ones, matter.
    spread = frozen(found.groupBy("set").agg(F.min(F.struct(*DOCUMENT)).alias("first"), F.max(F.struct(*DOCUMENT)).alias("last")), "paragraph-spread")
    joint = linked.select(F.col("node").alias("set"), F.col("component").alias("cluster"))
    in_clusters = spread.join(joint, "set")
    firsts = in_clusters.groupBy("cluster").agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first < last").select("cluster", "first")
    together = joint.join(firsts, "cluster").select("set", "cluster", "first")
    alone = spread.where("first < last").join(joint, "set", "left_anti").select("set", F.col("set").alias("cluster"), "first")
    places = frozen(together.union(alone), "paragraph-clusters")
    return found.join(places, "set").select("id", "sum", "begin", "end", "cluster", F.col("first.id").alias("first_id"), F.col("first.sum").alias("first_sum"))


def repeated(documents: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, recall: float = RECALL, least: int = LEAST_PARAGRAPH, passage: int = PASSAGE, gap: int = GAP, exact: int = LEAST_PARAGRAPH) -> DataFrame:
    """Every occurrence of a paragraph or passage that several documents have: where it is, in words,
    its component, the component's first document, and whether it stays. ``text_hash`` tells apart the
    documents of one id, or of none. Near paragraphs have at least ``least`` words, equal ones at least
    ``exact``."""
    docs = _identified(documents, key, text)
    near = _near_paragraphs(docs, percent, recall, least, exact).withColumn("kind", F.lit("paragraph"))
    exact = _passages(docs, passage, gap).withColumn("kind", F.lit("passage"))
    shown = lambda c: F.when(F.col(c) != _FIRST, F.col(c))
    return near.unionByName(exact).select(
        shown("id").alias(key), "kind", F.col("begin").alias("begin_word"), F.col("end").alias("end_word"), F.col("cluster").alias("component"), shown("first_id").alias("first_doc_id"),
        ((F.col("id") == F.col("first_id")) & (F.col("sum") == F.col("first_sum"))).alias("stays"), F.col("sum").alias("text_hash")
    )


def without_repeats(documents: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, text`` with the words of all occurrences that do not stay taken out; other texts as they are."""
    spans = found.where("not stays").groupBy(F.coalesce(F.col(key), F.lit(_FIRST)).alias("id"), F.col("text_hash").alias("sum")).agg(F.collect_list(F.struct("begin_word", "end_word")).alias("spans"))
    body = F.col(text).cast("string")
    docs = documents.select(F.coalesce(F.col(key).cast("bigint"), F.lit(_FIRST)).alias("id"), F.xxhash64(F.coalesce(body, F.lit(""))).alias("sum"), body.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, cut in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if not cut or not body:
                    out.append(body)
                    continue
                data = body.encode()
                raw = np.frombuffer(data, np.uint8)
                begin, end, _ = words.word_spans(raw, np.array([0, len(raw)]))
                parts, at = [], 0
                for span in sorted((s["begin_word"], s["end_word"]) for s in cut):
                    a, b = int(begin[span[0]]), int(end[span[1] - 1])
                    if b > at:
                        parts.append(data[at : max(a, at)])
                        at = b
                out.append(b"".join([*parts, data[at:]]).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["id", "text"])

    cleaned = docs.join(spans, ["id", "sum"], "left").select("id", "text", "spans").mapInArrow(run, "id bigint, text string")
    return cleaned.select(F.when(F.col("id") != _FIRST, F.col("id")).alias(key), F.col("text").alias(text))
