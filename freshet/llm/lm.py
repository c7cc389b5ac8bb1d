"""Scores of whole documents by a gated recurrent language model, beside a smoothed word-count model.

Words are counted over all training documents. The most frequent ones are the model's list; a softmax
over classes of about equal count and then over the words of the class names them. A word outside the
list is the class of such words times its smoothed share among them, so that all words together,
unknown ones as one, have probability one. The network learns in rounds: each training document belongs
to one round; every task goes through its part by truncated backpropagation, starting from the weights
that all share, and what the tasks have learnt is averaged by words seen. All documents are then scored
whole, the state carried from window to window.

Texts become lists of symbols once. Frequent words, of bounded number, are looked up in a broadcast
table; the rest of a document's words meet their counts by shuffle. The driver holds the weights and
the frequent words. Words are told apart by 64-bit hashes.

Defined results: a NULL or empty text is one end; a NULL key counts as the empty text where documents
are held out, and stays NULL; repeated rows are counted, and scored, once each. Without training
documents the model is its start, and every word is unknown. An empty table gives an empty result. A
text of any length is one list. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm import gru, words
from freshet.session import frozen

#: Documents whose crc32 leaves HELD when divided by FOLDS are not learnt from.
FOLDS, HELD = 5, 1
#: Words whose counts every task holds, at most; they decide on speed alone.
FREQUENT = 1 << 19
#: Words that are counted together before they are handed on; symbols that a task trains on or scores together.
COUNTED, TOGETHER = 4_000_000, 4_000_000
#: Documents side by side, and symbols in a window, while scoring; the results do not depend on them.
SCORING = (256, 64)
#: Pieces in which weights are averaged.
PIECES = 16

_U = np.uint64
_FIRST = -(1 << 63)


@dataclass(frozen=True)
class Settings:
    """Symbols in the list with the end, their classes, units of the state, documents side by side and
    symbols in a window while training, rounds, and the rate of learning."""

    listed: int = 1024
    classes: int = 16
    hidden: int = 16
    lanes: int = 96
    window: int = 24
    rounds: int = 2
    rate: float = 0.15

    def __post_init__(self):
        if not 1 <= self.listed < 1 << 16:
            raise ValueError("symbols are kept as 16 bits")


def prepared(documents: DataFrame, key: str, text: str, rounds: int) -> DataFrame:
    """``id, sum, held, turn, text``"""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    crc = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return documents.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(_FIRST)).alias("id"),
        F.xxhash64(body).alias("sum"),
        (crc % FOLDS == HELD).alias("held"),
        (F.floor(crc / FOLDS) % rounds).cast("int").alias("turn"),
        body.alias("text"),
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, train, n``: how often each word occurs in training documents, and in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def handed() -> Iterator[pa.RecordBatch]:
            every = np.concatenate([s[0] for s in seen])
            train = np.concatenate([s[1] for s in seen])
            word, which, n = np.unique(every, return_inverse=True, return_counts=True)
            learnt = np.bincount(which, train, len(word)).astype(np.int64)
            for at in range(0, len(word), 200_000):
                part = slice(at, at + 200_000)
                yield pa.RecordBatch.from_arrays([pa.array(word[part].view(np.int64)), pa.array(learnt[part]), pa.array(n[part].astype(np.int64))], ["word", "train", "n"])

        for batch in batches:
            held = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            for at, last, raw, offsets in words.blocks(batch.column(1)):
                hashes, first = words.word_hashes(raw, offsets)
                seen.append((hashes, np.repeat(~held[at:last], np.diff(first))))
                size += len(hashes)
            if size >= COUNTED:
                yield from handed()
                seen, size = [], 0
        if seen:
            yield from handed()

    parts = docs.select("held", "text").mapInArrow(run, "word bigint, train bigint, n bigint")
    return parts.groupBy("word").agg(F.sum("train").alias("train"), F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted hashes and training counts of the most frequent words, and the count that they all reach."""
    level = F.floor(8 * F.log2("n")).cast("int")
    chosen, total = None, 0
    # One row per eighth of a power of two: a few hundred whatever the data.
    for r in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("many"), F.min("n").alias("least")).collect(), reverse=True):
        total += r["many"]
        if total > most:
            break
        chosen = r["least"]
    if chosen is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), 1 << 62
    rows = counts.where(F.col("n") >= chosen).select("word", "train").toArrow()
    word = rows["word"].to_numpy().view(np.uint64)
    order = np.argsort(word)
    return word[order], rows["train"].to_numpy()[order], chosen


@dataclass(frozen=True)
class Lexicon:
    """Frequent words by hash with their training counts and symbols, and what the other words amount to."""

    word: np.ndarray
    train: np.ndarray
    symbol: np.ndarray
    counts: np.ndarray
    tokens: int
    distinct: int

    @property
    def unlisted(self) -> float:
        """Smoothed weight of all words outside the list, the unknown one included."""
        return self.tokens - int(self.counts.sum()) + 0.5 * (self.distinct - int((self.counts > 0).sum())) + 0.5

    @property
    def base(self) -> float:
        return math.log10(self.tokens + 0.5 * (self.distinct + 1))


def lexicon(word: np.ndarray, train: np.ndarray, tokens: int, distinct: int, ends: int, listed: int) -> Lexicon:
    top = np.lexsort((word, -train))[: listed - 1]
    top = top[train[top] > 0]
    symbol = np.full(len(word), len(top) + 1, np.uint16)
    symbol[top] = np.arange(1, len(top) + 1)
    return Lexicon(word, train, symbol, np.append(ends, train[top]).astype(np.int64), tokens, distinct)


def encoded(docs: DataFrame, lex: Lexicon) -> DataFrame:
    """Every text as symbols, with the sums of its frequent words; rare ones as hashes and counts."""
    shared = docs.sparkSession.sparkContext.broadcast(lex)
    schema = "id bigint, sum bigint, held boolean, turn int, n_tokens bigint, n_known bigint, listed_log double, other_log double, n_other bigint, n_rare bigint, rare array<bigint>, times array<bigint>, symbols binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = shared.value
        outside = len(lex.counts)
        log, ended = np.log10(lex.train + 0.5), math.log10(lex.counts[0] + 0.5)
        names = [f.split()[0] for f in schema.split(", ")]
        for batch in batches:
            for at, last, raw, offsets in words.blocks(batch.column("text")):
                hashes, first = words.word_hashes(raw, offsets)
                many = last - at
                word, which = np.unique(hashes, return_inverse=True)
                place = np.minimum(np.searchsorted(lex.word, word), max(len(lex.word) - 1, 0))
                found = lex.word[place] == word if len(lex.word) else np.zeros(len(word), bool)
                one = np.full(len(word), outside, np.uint16)
                one[found] = lex.symbol[place[found]]
                weight, known = np.zeros(len(word)), np.zeros(len(word), bool)
                weight[found], known[found] = log[place[found]], lex.train[place[found]] > 0
                symbol, rare = one[which], ~found[which]
                owner = np.repeat(np.arange(many), np.diff(first))
                inside = symbol < outside

                def total(values: np.ndarray) -> np.ndarray:
                    return np.bincount(owner, values, many)

                # Each text's rare words, one entry each.
                pair, times = np.unique(owner[rare] * len(word) + which[rare], return_counts=True)
                cut = np.searchsorted(pair, np.arange(many + 1) * max(len(word), 1))
                rows = pa.array(cut, pa.int32())
                lists = [pa.ListArray.from_arrays(rows, pa.array(v)) for v in (word[pair % max(len(word), 1)].view(np.int64), times.astype(np.int64))]
                # An end follows each text's words.
                ends = first[1:] + np.arange(many)
                every = np.zeros(len(symbol) + many, np.uint16)
                body = np.ones(len(every), bool)
                body[ends] = False
                every[body] = symbol
                bounds = np.append(0, ends + 1)
                data = every.astype("<u2").tobytes()
                packed = pa.array([data[2 * a : 2 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.binary())
                columns = [
                    *(batch.column(c).slice(at, many) for c in ("id", "sum", "held", "turn")),
                    pa.array(np.diff(bounds)),
                    pa.array((total(known[which]) + (lex.counts[0] > 0)).astype(np.int64)),
                    pa.array(total(weight[which] * inside) + ended),
                    pa.array(total(weight[which] * ~inside)),
                    pa.array(total(~inside).astype(np.int64)),
                    pa.array(total(rare).astype(np.int64)),
                    *lists,
                    packed,
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)


def _lists(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(d.as_buffer(), "<u2") for d in column]


def _together(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches that hold about ``most`` symbols together."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(column).nbytes // 2
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _averaged(learnt: DataFrame, partitions: int) -> DataFrame:
    """``piece, weights``: the mean of the tasks' pieces by symbols seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, total, seen = None, None, 0.0

        def mean() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([(total / seen).astype("<f4").tobytes()], pa.binary())], ["piece", "weights"])

        for batch in batches:
            for p, n, data in zip(*(batch.column(c) for c in ("piece", "seen", "weights")), strict=True):
                if p.as_py() != piece:
                    if piece is not None:
                        yield mean()
                    piece, total, seen = p.as_py(), 0.0, 0.0
                total = total + n.as_py() * np.frombuffer(data.as_buffer(), "<f4").astype(np.float64)
                seen += n.as_py()
        if piece is not None:
            yield mean()

    # By task, so that the sums do not depend on which task ended first.
    return learnt.repartition(partitions, "piece").sortWithinPartitions("piece", "task").mapInArrow(run, "piece int, weights binary")


def fit(texts: DataFrame, lex: Lexicon, settings: Settings) -> tuple[gru.Shape, np.ndarray]:
    """The weights after all rounds over the training documents of an ``encoded`` table."""
    counts = lex.counts.astype(np.float64)
    shape = gru.Shape(len(counts), gru.class_cuts(counts, settings.classes), settings.hidden)
    flat = gru.start(shape, counts, lex.unlisted - 0.5)
    squares = np.full_like(flat, 1e-6)
    context = texts.sparkSession.sparkContext
    for turn in range(settings.rounds):
        shared = context.broadcast((flat, squares))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            flat, squares = (a.copy() for a in shared.value)
            seen = 0
            for some in _together(batches, "symbols", TOGETHER):
                docs = [d for b in some for d in _lists(b.column("symbols"))]
                gru.train(shape, flat, squares, docs, settings.lanes, settings.window, settings.rate)
                seen += sum(map(len, docs))
            if seen:
                pieces = np.array_split(np.stack([flat, squares]), PIECES, axis=1)
                task = TaskContext.get().partitionId()
                columns = [pa.array(range(PIECES), pa.int32()), pa.array([task] * PIECES, pa.int32()), pa.array([seen] * PIECES, pa.int64()), pa.array([p.astype("<f4").tobytes() for p in pieces], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["piece", "task", "seen", "weights"])

        mine = texts.where(~F.col("held") & (F.col("turn") == turn)).select("symbols")
        learnt = mine.mapInArrow(run, "piece int, task int, seen bigint, weights binary")
        rows = sorted(_averaged(learnt, PIECES).collect())
        if rows:
            both = [np.frombuffer(r["weights"], "<f4").reshape(2, -1) for r in rows]
            flat, squares = np.ascontiguousarray(np.concatenate(both, axis=1))
        shared.unpersist()
    return shape, flat


def likelihoods(texts: DataFrame, shape: gru.Shape, flat: np.ndarray) -> DataFrame:
    """The columns of an ``encoded`` table without its lists, with ``model_log``: the natural logarithm of the list's symbols."""
    shared = texts.sparkSession.sparkContext.broadcast(flat)
    kept = [c for c in texts.columns if c not in ("symbols", "rare", "times")]
    schema = texts.select(*kept).schema.add("model_log", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _together(batches, "symbols", TOGETHER):
            docs = [d for b in some for d in _lists(b.column("symbols"))]
            logs, at = gru.log_likelihoods(shape, shared.value, docs, *SCORING), 0
            for b in some:
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(logs[at : at + b.num_rows])], [*kept, "model_log"])
                at += b.num_rows

    return texts.select(*kept, "symbols").mapInArrow(run, schema)


def score(documents: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    docs = prepared(documents, key, text, settings.rounds)
    counts = frozen(word_counts(docs), "word-counts")
    sums = counts.agg(F.sum("train").alias("n"), F.count_if(F.col("train") > 0).alias("distinct")).first()
    ends = docs.where(~F.col("held")).count()
    word, train, bound = frequent(counts, FREQUENT)
    lex = lexicon(word, train, (sums["n"] or 0) + ends, sums["distinct"] + (ends > 0), ends, settings.listed)
    texts = frozen(encoded(docs, lex), "symbols")

    entry = F.explode(F.arrays_zip("rare", "times")).alias("entry")
    entries = texts.select("id", "sum", entry).select("id", "sum", F.col("entry.rare").alias("word"), F.col("entry.times").alias("times"))
    met = entries.join(counts.where(F.col("n") < bound).select("word", "train"), "word")
    rare = met.groupBy("id", "sum").agg(
        F.sum(F.col("times") * F.log10(F.col("train") + 0.5)).alias("rare_log"),
        F.sum(F.when(F.col("train") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum("times").alias("rare_tokens"),
    )

    shape, flat = fit(texts, lex, settings)
    scored = frozen(likelihoods(texts, shape, flat), "likelihoods")
    # Repeated rows have their rare words counted together; each gets its share.
    share = F.col("n_rare") / F.col("rare_tokens")
    others = F.col("other_log") + F.coalesce(F.col("rare_log") * share, F.lit(0.0))
    shown = scored.join(rare, ["id", "sum"], "left")
    return shown.select(
        F.when(F.col("id") != _FIRST, F.col("id")).alias(key),
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce(F.round(F.col("rare_known") * share), F.lit(0)).cast("bigint")).alias("n_known"),
        F.lit(lex.tokens).cast("bigint").alias("train_tokens"),
        (F.col("listed_log") + others - F.col("n_tokens") * F.lit(lex.base)).alias("base_score"),
        (F.col("model_log") / math.log(10) + others - F.col("n_other") * F.lit(math.log10(lex.unlisted))).alias("score"),
    )
