"""Grouping of spelling variants: words of the corpus that are one edit apart, found with a bidirectional
FM-index and a search scheme for one error.

The vocabulary is kept in blocks of consecutive words, once in its own order and once in that of the
reversed words. A block is a delimited text with the rank structure of a Burrows-Wheeler transform over
the words' beginnings: the beginnings that equal what was read so far are an interval of ranks, and a
further letter takes one interval to the next. The two orders are the index's two directions. A word
within one edit shares with another its first or its second half, so two searches find all of it:

* the first half exactly, then across the second half to the right, allowing one error;
* the second half exactly, then across the first half to the left, allowing one error, and only what the
  first search cannot have found.

Each begins at the delimiter on its half's outer side and so keeps its direction. The half that is
matched exactly also names the blocks that can hold an answer: a range of the order, nearly always one
block. Where many words share a half, more blocks are asked, and a block's questions are dealt out over
several tasks; only a count and the best answer leave a block for each word.

Defined results: a NULL or empty text has no words; a NULL key takes part as an empty one in the rule
that spoils runs; repeated rows count again; ties between forms go to the smallest in code-point order;
no word, or an empty table, gives an empty result. A text of any length is split whole. Extra columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.session import frozen

LEAST_LETTERS = 7
LEAST_COUNT = 2
#: So many times as frequent as a word must its form be.
RATIO = 10
#: One run in so many loses a letter before it is counted.
SPOILED = 31

#: Words in a block, at least; and blocks of an order, about, at most.
BLOCK_WORDS, MOST_BLOCKS = 4096, 4096
#: Questions that a task asks a block.
QUESTIONS = 65_536
#: Words that are counted together before they are handed on, and questions asked at once.
COUNTED, AT_ONCE = 400_000, 8192

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _runs(documents: DataFrame, least: int, spoiled: int) -> DataFrame:
    """``word, n``: the words of some documents at a time, with their counts among these."""
    # Shorter runs cannot give a word: a letter may go, none is added.
    pattern = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def handed(counts: Counter) -> Iterator[pa.RecordBatch]:
        words = list(counts)
        for at in range(0, len(words), 20_000):
            some = words[at : at + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([counts[w] for w in some], pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                named = crc32(b"%s:" % (key.as_py() or "").encode())
                for word, n in Counter(pattern.findall(text.as_py().encode().translate(_LOWER).decode())).items():
                    h = crc32(word.encode(), named)
                    if h % spoiled == 0:
                        cut = h % len(word)
                        word = word[:cut] + word[cut + 1 :]
                        if len(word) < least:
                            continue
                    counts[word] += n
            if len(counts) >= COUNTED:
                yield from handed(counts)
                counts = Counter()
        yield from handed(counts)

    return documents.mapInArrow(run, "word string, n bigint")


def vocabulary(documents: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS, count: int = LEAST_COUNT, spoiled: int = SPOILED) -> DataFrame:
    """``word, n`` of the distinct words that occur often enough."""
    texts = documents.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    return _runs(texts, least, spoiled).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def _symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters of all words end to end, each word's length, and its place when one more symbol follows each."""
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    return letters, lengths, starts


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range that each is from."""
    many = hi - lo
    owner = np.repeat(np.arange(len(lo)), many)
    return np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + lo[owner], owner


class Index:
    """Ranks of the beginnings of distinct words, read backwards to the delimiter before each word."""

    def __init__(self, words: list[str]):
        letters, lengths, starts = _symbols(words)
        self.words, self.many = words, len(words)
        self.alphabet, symbol = np.unique(letters, return_inverse=True)
        n = len(letters) + self.many
        text, within = np.zeros(n, np.int64), np.ones(n, bool)
        within[starts] = False
        text[within] = symbol + 1
        back = np.arange(n) - np.repeat(starts, lengths + 1)
        rank, step = text, 1
        while step <= lengths.max(initial=0):
            earlier = np.zeros(n, np.int64)
            earlier[back >= step] = rank[np.flatnonzero(back >= step) - step]
            rank = np.unique(rank * (n + 1) + earlier, return_inverse=True)[1]
            step *= 2
        # Equal beginnings of several words stand in the words' order.
        order = np.argsort(rank, kind="stable")
        following = np.append(text[1:], 0)[order]
        owner = np.repeat(np.arange(self.many), lengths + 1)[order]
        self.following, self.width = following, n + 1
        self.ends = np.flatnonzero(following == 0)
        self.ended = owner[self.ends]
        rows = np.flatnonzero(following)
        self.places = np.sort(following[rows] * self.width + rows)

    def step(self, symbol: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Where a bound of an interval goes when a letter follows."""
        return self.many + np.searchsorted(self.places, symbol * self.width + bound)

    def _children(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """The letters that follow each interval, and the intervals they lead to."""
        rows, owner = _ranges(lo, hi)
        letter = self.following[rows]
        found = np.unique(owner[letter > 0] * self.width + letter[letter > 0])
        owner, letter = found // self.width, found % self.width
        return owner, letter, self.step(letter, lo[owner]), self.step(letter, hi[owner])

    def near(self, asked: list[str], heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs ``question, word`` one edit apart whose first ``heads`` letters are the question's."""
        letters, lengths, starts = _symbols(asked)
        pattern = np.zeros(len(letters) + len(asked), np.int64)
        within = np.ones(len(pattern), bool)
        within[starts + lengths] = False
        at = np.minimum(np.searchsorted(self.alphabet, letters), len(self.alphabet) - 1)
        pattern[within] = np.where(self.alphabet[at] == letters, at + 1, len(self.alphabet) + 1)

        q, lo, hi = np.arange(len(asked)), np.zeros(len(asked), np.int64), np.full(len(asked), self.many)
        wrong = [np.zeros(0, np.int64)] * 4  # question, place in it, interval: one error made
        hits, s = [], 0
        while len(q) or len(wrong[0]):
            born = []
            ready = np.flatnonzero(heads[q] <= s)
            if len(ready):
                # Questions with the same beginning share an interval; its letters are listed once.
                node, one, which = np.unique(lo[ready], return_index=True, return_inverse=True)
                owner, letter, child_lo, child_hi = self._children(node, hi[ready][one])
                first = np.searchsorted(owner, np.arange(len(node) + 1))
                child, asker = _ranges(first[which], first[which + 1])
                asker = ready[asker]
                own = pattern[starts[q] + s]
                other = letter[child] != own[asker]
                child, asker = child[other], asker[other]
                inserted = [q[asker], np.full(len(asker), s), child_lo[child], child_hi[child]]
                inner = own[asker] > 0
                replaced = [c[inner] for c in inserted]
                replaced[1] = replaced[1] + 1
                dropped = ready[own[ready] > 0]
                born = [inserted, replaced, [q[dropped], np.full(len(dropped), s + 1), lo[dropped], hi[dropped]]]
            if len(wrong[0]):
                asker, place, low, high = wrong
                c = pattern[starts[asker] + place]
                whole = np.flatnonzero(c == 0)
                end = np.searchsorted(self.ends, low[whole])
                met = end < np.searchsorted(self.ends, high[whole])
                hits.append(asker[whole[met]] * self.many + self.ended[end[met]])
                on = np.flatnonzero(c > 0)
                low, high = self.step(c[on], low[on]), self.step(c[on], high[on])
                alive = low < high
                wrong = [asker[on][alive], place[on][alive] + 1, low[alive], high[alive]]
            wrong = [np.concatenate(c) for c in zip(wrong, *born, strict=True)]
            c = pattern[starts[q] + s]
            q, lo, hi, c = q[c > 0], lo[c > 0], hi[c > 0], c[c > 0]
            lo, hi = self.step(c, lo), self.step(c, hi)
            alive = lo < hi
            q, lo, hi = q[alive], lo[alive], hi[alive]
            s += 1
        pairs = np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.int64)
        return pairs // self.many, pairs % self.many


def _blocks(words: DataFrame, size: int, partitions: int) -> DataFrame:
    """``first, last, words, counts``: runs of consecutive words in the order of ``name``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts = [], []

        def block(many: int) -> pa.RecordBatch:
            row = [[names[0]], [names[many - 1]], [names[:many]], [counts[:many]]]
            kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["first", "last", "words", "counts"])

        for batch in batches:
            names += batch.column(0).to_pylist()
            counts += batch.column(1).to_pylist()
            while len(names) >= 2 * size:
                yield block(size)
                del names[:size], counts[:size]
        if names:
            yield block(len(names))

    ordered = words.repartitionByRange(partitions, "name").sortWithinPartitions("name")
    return ordered.mapInArrow(run, "first string, last string, words array<string>, counts array<bigint>")


def _asked(words: DataFrame, bounds: list[tuple[str, str]], forward: bool, salts: dict[str, int] | None) -> DataFrame:
    """``first, salt, name, head``: the blocks that can hold a word with the same half."""
    firsts, lasts = [b[0] for b in bounds], [b[1] for b in bounds]
    shared = words.sparkSession.sparkContext.broadcast((firsts, lasts, salts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, lasts, salts = shared.value
        for batch in batches:
            out = []
            for name in batch.column(0).to_pylist():
                head = len(name) // 2 if forward else len(name) - len(name) // 2
                half = name[:head]
                for b in range(bisect_left(lasts, half), bisect_right(firsts, half + "\U0010ffff")):
                    out.append((firsts[b], crc32(name.encode()) % salts.get(firsts[b], 1) if salts else 0, name, head))
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            kinds = [pa.string(), pa.int32(), pa.string(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["first", "salt", "name", "head"])

    return words.select("name").mapInArrow(run, "first string, salt int, name string, head int")


def _shared_ends(index: Index, asked: list[str], q: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Whether the question's letters behind its head are also the last of the found word: the other search has this pair."""
    tails = [name[len(name) - len(name) // 2 :] for name in asked]
    return np.fromiter((index.words[b].endswith(tails[a]) for a, b in zip(q.tolist(), w.tolist(), strict=True)), bool, len(q))


def _answers(blocks: DataFrame, asked: DataFrame, salts: dict[str, int], forward: bool, partitions: int) -> DataFrame:
    """``word, n_near, minus, form``: for each word the near ones that a block holds, and the best of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, counts, named, waiting = None, None, None, []

        def answered() -> Iterator[pa.RecordBatch]:
            names, heads = [w[0] for w in waiting], np.array([w[1] for w in waiting], np.int64)
            q, w = index.near(names, heads)
            if not forward:
                other = ~_shared_ends(index, names, q, w)
                q, w = q[other], w[other]
            order = np.lexsort((named[w], -counts[w], q))
            q, w = q[order], w[order]
            at = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
            many = np.diff(np.append(at, len(q)))
            turn = (lambda x: x) if forward else (lambda x: x[::-1])
            words = pa.array([turn(names[i]) for i in q[at].tolist()], pa.string())
            forms = pa.array([turn(index.words[i]) for i in w[at].tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([words, pa.array(many), pa.array(-counts[w[at]]), forms], ["word", "n_near", "minus", "form"])

        for batch in batches:
            held, names, heads = batch.column("words"), batch.column("name"), batch.column("head")
            for i in range(batch.num_rows):
                if held[i].is_valid:
                    if waiting:
                        yield from answered()
                        waiting = []
                    words = held[i].as_py()
                    index, counts = Index(words), np.array(batch.column("counts")[i].as_py(), np.int64)
                    named = np.arange(len(words))
                    if not forward:
                        named[sorted(range(len(words)), key=lambda j: words[j][::-1])] = np.arange(len(words))
                else:
                    waiting.append((names[i].as_py(), heads[i].as_py()))
                    if len(waiting) >= AT_ONCE:
                        yield from answered()
                        waiting = []
        if waiting:
            yield from answered()

    spread = F.create_map(*[F.lit(x) for pair in salts.items() for x in pair])[F.col("first")] if salts else F.lit(None)
    copies = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce(spread, F.lit(1)) - 1)))
    held = copies.select("first", "salt", F.lit(0).alias("kind"), "words", "counts", F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("head"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("words", "array<string>"), ("counts", "array<bigint>"))]
    questions = asked.select("first", "salt", F.lit(1).alias("kind"), *none, "name", "head")
    met = held.union(questions).repartition(partitions, "first", "salt").sortWithinPartitions("first", "salt", "kind")
    return met.mapInArrow(run, "word string, n_near bigint, minus bigint, form string")


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n_near, minus, form`` of a written table ``word, n``: how many words are one edit away, and
    the most frequent of them with its negative count. Words without any have no row."""
    spark = words.sparkSession
    total = words.count()
    size = max(BLOCK_WORDS, -(-total // MOST_BLOCKS))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = []
    for forward in (True, False):
        name = F.col("word") if forward else F.reverse("word")
        named = words.select(name.alias("name"), "n")
        blocks = frozen(_blocks(named, size, max(1, min(partitions, total // size))), "word-blocks")
        # A row for each block: some thousands, however many words there are.
        bounds = sorted((r["first"], r["last"]) for r in blocks.select("first", "last").collect())
        asked = _asked(named, bounds, forward, None).groupBy("first").agg(F.count("*").alias("n"))
        salts = {r["first"]: -(-r["n"] // QUESTIONS) for r in asked.where(F.col("n") > QUESTIONS).collect()}
        parts.append(_answers(blocks, _asked(named, bounds, forward, salts), salts, forward, max(partitions, len(bounds))))
    best = F.min(F.struct("minus", "form")).alias("best")
    found = parts[0].union(parts[1]).groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", "best.minus", "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the forms of a written table ``word, form`` lead. A form is far more frequent
    than its word, so that chains are short and have no circles; each round doubles the way."""
    current = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        farther = frozen(current.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        current = farther.select("word", "root")
        if farther.where("moved").isEmpty():
            return current


def spelling_variants(documents: DataFrame, key: str = "doc_id", text: str = "text", ratio: int = RATIO, **options) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the vocabulary."""
    words = frozen(vocabulary(documents, key, text, **options), "vocabulary")
    found = words.join(neighbours(words), "word", "left")
    held = F.coalesce(-F.col("minus") >= ratio * F.col("n"), F.lit(False))
    judged = frozen(
        found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(held, F.col("form")).alias("form"), F.when(held, -F.col("minus")).alias("form_n")),
        "forms",
    )
    led = roots(judged.where("form is not null"))
    return judged.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
