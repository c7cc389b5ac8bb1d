"""Toxicity by weak supervision.

1. Words and word beginnings that mark toxic texts are mined from all labelled rows.
   They make up the voters: some are lexicons of whole words, some are patterns of beginnings. A voter
   votes for toxic where any of its entries occurs.
2. Every document's votes are counted by pattern (at most 2^voters rows). A generative model of the
   patterns, fitted by expectation maximisation with the labelled rows held to their labels, estimates
   each voter's accuracy and which voters depend on each other: given the class, a voter depends on its
   parent in a maximum spanning tree of conditional mutual information.
3. A logistic regression on the mined entries learns the model's posterior labels of a bounded sample of
   labelled rows.

Only rows whose crc32(doc_id as text) mod 3 is not 1 lend their labels.

Defined results: a NULL or empty text has no features and gets the score of the intercept; a NULL
doc_id is never labelled and not held out; a document labelled more than once is toxic if any label
says so, NULL labels do not count; repeated rows are scored alike; without both kinds of labels every
score is the share of toxic labels (0 without any); an empty table gives an empty result. Extra
columns of the documents are not read by ``scores`` and kept by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm import words
from freshet.session import frozen

#: Labelled rows that the classifier is fitted on, at most.
SAMPLE = 20_000
#: Entries that are mined, at most, and what each must reach.
ENTRIES = 4096
LEAST_POSITIVES = 3
#: Features that a task counts together before it hands them on, about.
COUNTED = 1_000_000
#: Bits by which the texts of unlabelled documents are kept from a shuffle, 64 a row.
GATE_BITS = 1 << 24
LEAST_LIFT = 4.0
#: Log-likelihood ratio of an entry's counts against chance: of a million features that say nothing,
#: a few dozen get here.
LEAST_RATIO = 16.0
LEXICONS, PATTERNS = 10, 6
VOTERS = LEXICONS + PATTERNS
BEGINNINGS = (4, 5, 6)
THRESHOLD = 0.7

_U = np.uint64
SEPARATOR = np.ones(256, bool)
SEPARATOR[128:] = False
for _lo, _hi in (("0", "9"), ("A", "Z"), ("a", "z")):
    SEPARATOR[ord(_lo) : ord(_hi) + 1] = False


def features(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For whole words and then for each length of beginnings: the rows and the features in them.

    The lowest three bits of a feature tell its kind, 0 for words.
    """
    begin, end, first = words.word_spans(raw, offsets, SEPARATOR)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    sums = words.running(words.LOWER[raw])
    clear = ~_U(7)
    yield row, words.span_hashes(sums, begin, end) & clear
    for kind, length in enumerate(BEGINNINGS, 1):
        long = end - begin > length
        at = begin[long]
        yield row[long], (words.span_hashes(sums, at, at + length) & clear) | _U(kind)


@dataclass
class LabelModel:
    """P(toxic), and per voter P(vote | parent's vote, class) along the tree."""

    prior: float
    parent: list[int]
    #: table[class, voter, parent's vote, vote]
    table: np.ndarray
    #: P(vote = 1 | class) of each voter, and the class-conditional correlations of votes.
    accuracy: np.ndarray = field(default_factory=lambda: np.zeros((2, 0)))
    correlation: np.ndarray = field(default_factory=lambda: np.zeros((2, 0, 0)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic | votes) for rows of votes."""
        log = np.log(np.array([1 - self.prior, self.prior]))[:, None] + np.zeros((2, len(votes)))
        for j, p in enumerate(self.parent):
            given = votes[:, p] if p >= 0 else np.zeros(len(votes), int)
            log += np.log(self.table[:, j, given, votes[:, j]])
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -60, 60)))


def _tree(weight: np.ndarray) -> list[int]:
    """Parents in a maximum spanning tree, the first voter being the root."""
    n = len(weight)
    parent, best, inside = [-1] * n, np.zeros(n, int), np.zeros(n, bool)
    inside[0] = True
    gain = weight[0].copy()
    for _ in range(n - 1):
        gain[inside] = -np.inf
        j = int(np.argmax(gain))
        parent[j], inside[j] = int(best[j]), True
        closer = weight[j] > gain
        best[closer], gain[closer] = j, weight[j][closer]
    return parent


def fit_label_model(votes: np.ndarray, counts: np.ndarray, label: np.ndarray, rounds: int = 25) -> LabelModel:
    """``votes`` rows of 0/1 with how many documents have them, and their label: 0, 1, or -1 if unknown."""
    n, m = votes.shape
    known = label >= 0
    share = float((counts * (label == 1)).sum() / counts[known].sum())
    belief = np.where(known, label == 1, share).astype(float)
    weight = counts * known  # the labelled rows alone give the first model
    for step in range(rounds):
        cells = np.zeros((2, 2, 2, m, m))  # class, vote of j, vote of k
        for c in (0, 1):
            w = weight * (belief if c else 1 - belief)
            for a in (0, 1):
                for b in (0, 1):
                    cells[c, a, b] = ((votes == a) * w[:, None]).T @ (votes == b)
        total = cells[:, 0, 0, 0, 0] + cells[:, 1, 1, 0, 0] + 2e-9
        smooth = cells + 0.1
        joint = smooth / smooth.sum((1, 2), keepdims=True)
        first, second = joint.sum(2, keepdims=True), joint.sum(1, keepdims=True)
        information = (total[:, None, None] / total.sum() * (joint * np.log(joint / (first * second))).sum((1, 2))).sum(0)
        parent = _tree(information)
        table = np.zeros((2, m, 2, 2))
        for j, p in enumerate(parent):
            if p < 0:
                table[:, j, 0] = table[:, j, 1] = first[:, :, 0, j, j]
            else:
                pair = smooth[:, :, :, p, j]
                table[:, j] = pair / pair.sum(2, keepdims=True)
        model = LabelModel(float(np.clip(total[1] / total.sum(), 1e-6, 1 - 1e-6)), parent, table)
        updated = np.where(known, belief, model.posterior(votes))
        if step and np.abs(updated - belief).max() < 1e-6:
            break
        belief, weight = updated, counts.astype(float)
    model.accuracy = first[:, 1, 0].diagonal(axis1=1, axis2=2)
    spread = model.accuracy * (1 - model.accuracy)
    model.correlation = (joint[:, 1, 1] - model.accuracy[:, :, None] * model.accuracy[:, None, :]) / np.sqrt(spread[:, :, None] * spread[:, None, :])
    return model


def fit_linear(rows: list[np.ndarray], target: np.ndarray, size: int, steps: int = 400, ridge: float = 0.05) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on sets of entries, by full gradients."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    entry = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    n = len(rows)
    share = np.clip(target.mean(), 1e-4, 1 - 1e-4)
    x = np.zeros(size + 1)
    x[-1] = np.log(share / (1 - share))
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        z = x[-1] + np.bincount(owner, x[entry], minlength=n)
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) / n
        gradient = np.append(np.bincount(entry, error[owner], minlength=size), error.sum())
        gradient[:-1] += ridge * x[:-1] / n
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        x -= 0.1 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-9)
    return x[:-1], float(x[-1])


@dataclass
class Model:
    entries: np.ndarray
    voter: np.ndarray
    weights: np.ndarray
    intercept: float
    labels: LabelModel | None = None

    def __post_init__(self):
        #: By the 16 bits above a feature's kind: whether any entry has them.
        self.gate = np.zeros(1 << 16, bool)
        self.gate[(self.entries >> _U(3)) & _U(0xFFFF)] = True

    def matches(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, entry) pairs, by row."""
        found = []
        for row, feature in features(raw, offsets):
            if len(self.entries):
                maybe = np.flatnonzero(self.gate[(feature >> _U(3)) & _U(0xFFFF)])
                row, feature = row[maybe], feature[maybe]
                at = np.minimum(np.searchsorted(self.entries, feature), len(self.entries) - 1)
                hit = self.entries[at] == feature
                found.append(row[hit] * len(self.entries) + at[hit])
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return np.divmod(pairs, max(1, len(self.entries)))

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, entry = self.matches(raw, offsets)
        z = self.intercept + np.bincount(row, self.weights[entry], minlength=len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """One row per labelled document that may be learnt from."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    return usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def _labelled(docs: DataFrame, usable: DataFrame) -> DataFrame:
    """``text, toxic`` of the labelled documents. A bitmap of a fixed size, at most ``GATE_BITS / 64``
    rows, is broadcast, so that few other texts are shuffled."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(GATE_BITS))
    cell, mask = F.shiftright(bit, 6), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {GATE_BITS}) & 63 as int))")
    cells = usable.select(cell.alias("cell"), mask.alias("mask")).groupBy("cell").agg(F.bit_or("mask").alias("bits"))
    likely = docs.withColumn("cell", cell).join(F.broadcast(cells), "cell").where(F.col("bits").bitwiseAND(mask) != 0)
    return likely.select("doc_id", "text").join(usable, "doc_id").select("text", "toxic")


def _mine(labelled: DataFrame, positives: int, negatives: int) -> np.ndarray:
    """Entries by how much likelier they are in toxic texts of ``text, toxic``."""

    def summed(held: list[tuple]) -> list[np.ndarray]:
        names, bad, good = (np.concatenate(c) for c in zip(*held, strict=True))
        names, place = np.unique(names, return_inverse=True)
        return [names, *(np.bincount(place, c, minlength=len(names)).astype(np.int64) for c in (bad, good))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            names, bad, good = summed(held)
            return pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(bad), pa.array(good)], ["feature", "bad", "good"])

        for batch in batches:
            toxic = np.minimum(batch.column(1).to_numpy(zero_copy_only=False), 1)
            for at, _, raw, offsets in words.blocks(batch.column(0)):
                for row, feature in features(raw, offsets):
                    order = np.lexsort((row, feature))
                    feature, row = feature[order], row[order]
                    new = np.append(True, (feature[1:] != feature[:-1]) | (row[1:] != row[:-1])) if len(row) else np.zeros(0, bool)
                    names, place = np.unique(feature[new], return_inverse=True)
                    bad = np.bincount(place, toxic[at + row[new]], minlength=len(names)).astype(np.int64)
                    held.append((names, bad, np.bincount(place, minlength=len(names)) - bad))
                    size += len(names)
                if size >= COUNTED:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    counts = labelled.select("text", "toxic").mapInArrow(words.frugal(count), "feature bigint, bad bigint, good bigint").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    lift = ((F.col("bad") + 0.5) / (positives + 1)) / ((F.col("good") + 0.5) / (negatives + 1))
    seen, share = F.col("bad") + F.col("good"), positives / (positives + negatives)
    part = lambda n, p: F.when(n > 0, n * F.log(n / (seen * p))).otherwise(0.0)
    ratio = 2 * (part(F.col("bad"), share) + part(F.col("good"), 1 - share))
    telling = (F.col("bad") >= LEAST_POSITIVES) & (lift >= LEAST_LIFT) & (ratio >= LEAST_RATIO)
    best = counts.where(telling).orderBy(ratio.desc(), "feature").limit(ENTRIES)
    return np.array([r["feature"] for r in best.select("feature").collect()], np.int64).view(np.uint64)


def fit(documents: DataFrame, labels: DataFrame, sample_size: int = SAMPLE) -> Model:
    """Mine entries, count the votes of all documents, fit the label model, then the classifier."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    usable = frozen(training_labels(labels), "training-labels")
    n = usable.count()
    part = min(1.0, 0.95 * sample_size / max(1, n))
    # Only the classifier's rows are sampled. The limit makes the bound certain, so that they may be broadcast.
    sample = frozen(usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(part * (1 << 20)) + (n <= sample_size)).limit(sample_size), "sampled-labels")
    tally = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    positives, negatives = sum(v for k, v in tally.items() if k > 0), tally.get(0, 0)
    if not positives or not negatives:
        share = min(max(positives / max(1, positives + negatives), 1e-9), 1 - 1e-9)
        return Model(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    ranked = _mine(_labelled(docs, usable), positives, negatives)
    # Entries go round the voters of their kind in order of strength.
    voter = np.zeros(len(ranked), np.int64)
    for kind, start, many in ((False, 0, LEXICONS), (True, LEXICONS, PATTERNS)):
        own = ((ranked & _U(7)) > 0) == kind
        voter[own] = start + np.arange(own.sum()) % many
    order = np.argsort(ranked)
    model = Model(ranked[order], voter[order], np.zeros(len(ranked)), 0.0)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, until, raw, offsets in words.blocks(batch.column(1)):
                row, entry = model.matches(raw, offsets)
                mask = np.zeros(until - at, np.int64)
                np.bitwise_or.at(mask, row, 1 << model.voter[entry])
                cuts = np.searchsorted(row, np.arange(1, until - at))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, until - at), pa.array(mask), pa.array(np.split(entry, cuts), pa.list_(pa.int64()))], ["doc_id", "votes", "entries"])

    votes = frozen(docs.mapInArrow(words.frugal(vote), "doc_id bigint, votes bigint, entries array<bigint>"), "votes")
    by_pattern = votes.join(usable, "doc_id", "left").groupBy("votes", F.coalesce("toxic", F.lit(-1)).alias("label")).agg(F.count("*").alias("n")).collect()
    patterns = np.array([r["votes"] for r in by_pattern], np.int64)
    bits = (patterns[:, None] >> np.arange(VOTERS)) & 1
    label = np.minimum(np.array([r["label"] for r in by_pattern]), 1)
    if not (label >= 0).any():
        return model
    model.labels = fit_label_model(bits, np.array([r["n"] for r in by_pattern], float), label)
    drawn = votes.join(F.broadcast(sample.select("doc_id")), "doc_id").select("votes", "entries").limit(2 * sample_size).collect()
    target = model.labels.posterior((np.array([r["votes"] for r in drawn], np.int64)[:, None] >> np.arange(VOTERS)) & 1)
    model.weights, model.intercept = fit_linear([np.array(r["entries"], np.int64) for r in drawn], target, len(model.entries))
    return model


def scores(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, until, raw, offsets in words.blocks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, until - at), pa.array(model.scores(raw, offsets))], ["doc_id", "score"])

    scored = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(words.frugal(run), "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(documents: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose score is below the threshold."""
    place = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [pa.array(model.scores(raw, offsets) < threshold) for _, _, raw, offsets in words.blocks(batch.column(place))]
            if kept:
                yield batch.filter(pa.concat_arrays(kept))

    return documents.mapInArrow(words.frugal(run), documents.schema)


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return scores(documents, fit(documents, labels))
