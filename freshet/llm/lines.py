"""Line deduplication across a corpus, exact and within one word's edit.

A line is what stands between newlines, as its words (cut at ASCII white space, A-Z lower-cased). It
goes if an earlier line of the corpus equals it, or can be made equal by inserting, deleting or
replacing one word. Earlier is by document, then place in it; whether the earlier line goes itself
makes no difference. Near lines have at least ``LEAST_WORDS`` words: one edit in fewer would be less than
0.8 alike. Equal lines have a minimum of their own, ``exact``, which is that of the near ones unless
given; with ``LEAST_EXACT`` every line that has a word takes part.

The near ones come from a deletion-neighbourhood join: every variant of a line with one word deleted is
a hashed key. Two lines are within one edit exactly if they share a variant with the word deleted at
the same place, or a variant of one is the other. Groups of a key are folded to their earliest lines by
aggregation, so a key that millions of lines share costs one row a line. Variants are emitted only for
lines that share with another what an edit in one of their parts (halves, or quarters of short lines)
would leave: lines within one edit always do. The edit distance is then verified on the words.

Defined results: a NULL or empty text has one line without words and stays as it is; a NULL id sorts
first; rows that repeat both id and text are one document, and each gets that document's result; a
text without lines that go is handed on as it is; an empty table gives an empty result. Other columns
keep their values in ``deduplicated`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm import words
from freshet.llm.decontamination import gated
from freshet.session import frozen

LEAST_WORDS = 5
#: Words of equal lines, at least, where all copies are to go.
LEAST_EXACT = 1
#: Lines of fewer words are cut into quarters, longer ones into halves.
SHORT = 24
#: The Bloom filter's bits (8 MB), and where in a hash the bits' numbers are read.
GATE_BITS = 1 << 26
GATE_SHIFTS = (0, 32)
_U = np.uint64
_FIRST = -(1 << 63)


class Lines:
    """The lines with words of one block of texts."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        low = words.LOWER[raw]
        begin, end, first = words.word_spans(raw, offsets)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        newline = np.flatnonzero(raw == 10)
        line = np.searchsorted(newline, begin)
        starts = np.flatnonzero(np.append(True, np.diff(line + text) > 0)) if len(begin) else np.zeros(0, np.int64)
        self.start, self.end = starts, np.append(starts[1:], len(begin)) if len(starts) else starts
        self.text = text[starts]
        self.number = line[starts] - np.searchsorted(newline, offsets[self.text])
        self.size = self.end - self.start
        self.words = words.span_hashes(words.running(low), begin, end)
        self.up, self.down = words._power_tables(len(begin) + 2)
        self.sums = [self._sums(self.words), self._sums(words.mix(self.words + _U(0x5851F42D4C957F2D)))]

    def _sums(self, hashes: np.ndarray) -> np.ndarray:
        return np.append(_U(0), np.cumsum(hashes * self.up[: len(hashes)], dtype=np.uint64))

    def part(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        """An order-sensitive hash of the words from ``start`` to ``end``."""
        return (self.sums[which][end] - self.sums[which][start]) * self.down[start]

    def ids(self) -> list[np.ndarray]:
        return [words.mix(self.part(self.start, self.end, k) + self.size.astype(np.uint64)) for k in (0, 1)]

    def remains(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``line, key`` of what an edit in each part of the chosen lines would leave the same.

        Of two lines within one edit, the shorter of n words, some k gives the same first k and last
        n - 1 - k words. With places cut every t words, the first j t and the last n - (j + 1) t words
        are the same for the part j that k is in. A line is the shorter of a pair or one word longer.
        """
        lines, keys = [], []
        for shorter in (self.size[chosen], self.size[chosen] - 1):
            step = -(-shorter // np.where(shorter < SHORT, 4, 2))
            for j in range(4):
                some = np.flatnonzero(j * step < shorter)
                line, n, t = chosen[some], shorter[some], step[some]
                start, end = self.start[line], self.end[line]
                front = self.part(start, start + j * t)
                back = self.part(end - np.maximum(n - (j + 1) * t, 0), end)
                lines.append(line)
                keys.append(words.mix(words.mix(front + n.astype(np.uint64)) + back * _U(3) + _U(j)))
        return np.concatenate(lines), np.concatenate(keys)

    def variants(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``line, deleted place, key`` of every variant of the chosen lines; place -1 is the line itself."""
        size = self.size[chosen]
        line = np.repeat(chosen, size)
        start, end = self.start[line], self.end[line]
        at = start + np.arange(len(line)) - np.repeat(np.cumsum(size) - size, size)
        rest = (self.sums[0][at] - self.sums[0][start]) * self.down[start] + (self.sums[0][end] - self.sums[0][at + 1]) * self.down[start + 1]
        own = self.part(self.start[chosen], self.end[chosen])
        hashed = lambda h, n: words.mix(h + n.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        return np.append(line, chosen), np.append(at - start, np.full(len(chosen), -1)), np.append(hashed(rest, self.size[line] - 1), hashed(own, size))


def _identified(documents: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return documents.select(F.coalesce(F.col(key).cast("bigint"), F.lit(_FIRST)).alias("id"), F.xxhash64(body).alias("sum"), body.alias("text"))


def _occurrences(docs: DataFrame, least: int) -> DataFrame:
    """A row per line of enough words: where it stands, and its identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, raw, offsets in words.blocks(batch.column(2)):
                lines = Lines(raw, offsets)
                long = np.flatnonzero(lines.size >= least)
                row = pa.array(at + lines.text[long])
                a, b = (i[long].view(np.int64) for i in lines.ids())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(lines.number[long]), pa.array(a), pa.array(b)], ["id", "sum", "number", "a", "b"])

    return docs.mapInArrow(words.frugal(run), "id bigint, sum bigint, number bigint, a bigint, b bigint")


def _bucket_cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of sorted hashes begins, and the end of the last."""
    return np.searchsorted(((hashes >> _U(32)) * _U(buckets)) >> _U(32), np.arange(buckets + 1).astype(np.uint64))


def _chosen(docs: DataFrame, least: int) -> DataFrame:
    """``a`` of the lines that share what an edit would leave with another line.

    Each Arrow batch settles the keys that several of its lines have, and hands on one line per key,
    packed by range of key, so that a key costs at most a posting per batch however many lines have it.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 4 * partitions

    def several(key: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs by key, and which of them have a key that another line has."""
        order = np.lexsort((a, key))
        key, a = key[order], a[order]
        new = np.append(True, (key[1:] != key[:-1]) | (a[1:] != a[:-1])) if len(key) else np.zeros(0, bool)
        key, a = key[new], a[new]
        same = key[1:] == key[:-1]
        return key, a, np.append(same, False) | np.append(False, same) if len(key) else np.zeros(0, bool)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owners = [], []
            for _, _, raw, offsets in words.blocks(batch.column(0)):
                lines = Lines(raw, offsets)
                line, key = lines.remains(np.flatnonzero(lines.size >= least))
                keys.append(key)
                owners.append(lines.ids()[0][line])
            if not keys:
                continue
            key, a, shared = several(np.concatenate(keys), np.concatenate(owners))
            settled = np.unique(a[shared])
            first = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
            key, a = key[first], a[first]
            cuts, parts = _bucket_cuts(key, buckets), _bucket_cuts(settled, buckets)
            rows = [(i, key[cuts[i] : cuts[i + 1]].tobytes(), a[cuts[i] : cuts[i + 1]].tobytes(), settled[parts[i] : parts[i + 1]].tobytes()) for i in range(buckets)]
            rows = [x for x in rows if x[1] or x[3]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["bucket", "keys", "lines", "settled"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts: list[tuple]) -> pa.RecordBatch:
            key, a, settled = (np.frombuffer(b"".join(c), np.uint64) for c in zip(*parts, strict=True))
            _, a, shared = several(key, a)
            return pa.RecordBatch.from_arrays([pa.array(np.unique(np.append(a[shared], settled)).view(np.int64))], ["a"])

        at, held = None, []
        for batch in batches:
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != at and held:
                    yield out(held)
                    held = []
                at = bucket
                held.append(tuple(row))
        if held:
            yield out(held)

    packed = docs.select("text").mapInArrow(words.frugal(pack), "bucket int, keys binary, lines binary, settled binary")
    return packed.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(words.frugal(meet), "a bigint")


def _gate(chosen: DataFrame) -> np.ndarray:
    """A Bloom filter of occurrences ``id, sum, a``, of a fixed size whatever their number.

    A line that it lets through by mistake costs its variants and changes no result.
    """
    here = F.col("a").bitwiseXOR(F.col("sum"))
    bits = chosen.select(F.explode(F.array(*(F.shiftrightunsigned(here, k).bitwiseXOR(F.col("id")).bitwiseAND(GATE_BITS - 1) for k in GATE_SHIFTS))).alias("bit"))
    cells = bits.groupBy(F.shiftright("bit", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
    gate = np.zeros(GATE_BITS // 64, np.int64)
    gate[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return gate


def _neighbourhoods(docs: DataFrame, chosen: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The keys of all variants of the lines first seen at ``id, sum, a``, and the lines themselves.

    The texts are read once more rather than shuffled to meet the chosen lines: the gate is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_gate(chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "sum", "number", "size", "place", "key", "a", "line"]
        gate = shared.value
        for batch in batches:
            ids, sums = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, _, raw, offsets in words.blocks(batch.column(2)):
                lines = Lines(raw, offsets)
                a = lines.ids()[0]
                owner, text_sum = ids[at + lines.text].view(np.uint64), sums[at + lines.text].view(np.uint64)
                passed = lines.size >= least
                for k in GATE_SHIFTS:
                    bit = ((((a ^ text_sum) >> _U(k)) ^ owner) & _U(GATE_BITS - 1)).astype(np.int64)
                    passed &= (gate[bit >> 6] >> (bit & 63)) & 1 > 0
                picked = np.flatnonzero(passed)
                # Of equal lines in a block the earliest stands for all.
                order = np.lexsort((lines.number[picked], sums[at + lines.text[picked]], ids[at + lines.text[picked]], a[picked]))
                picked = picked[order]
                picked = np.sort(picked[np.append(True, a[picked][1:] != a[picked][:-1])] if len(picked) else picked)
                line, place, key = lines.variants(picked)
                row = pa.array(at + lines.text[line])
                content, texts = [], {}
                for i in picked.tolist():
                    t = int(lines.text[i])
                    if t not in texts:
                        texts[t] = bytes(raw[offsets[t] : offsets[t + 1]]).decode().split("\n")
                    content.append(texts[t][int(lines.number[i])])
                shown = pa.array([None] * (len(line) - len(picked)) + content, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), pa.array(lines.number[line]), pa.array(lines.size[line]), pa.array(place), pa.array(key.view(np.int64)), pa.array(a[line].view(np.int64)), shown], names
                )

    schema = "id bigint, sum bigint, number bigint, size bigint, place bigint, key bigint, a bigint, line string"
    table = frozen(docs.mapInArrow(words.frugal(run), schema), "variants")
    return table.select("key", "size", "place", "a", F.struct("id", "sum", "number").alias("at")), table.where("place = -1").select(F.struct("id", "sum", "number").alias("at"), "line")


def within_one_edit(a: list, b: list) -> bool:
    """Whether one insertion, deletion or replacement of an element, or none, turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[p:] == b[p + 1 :] or (len(a) == len(b) and a[p + 1 :] == b[p + 1 :])


def _split(line: str) -> list[bytes]:
    """The line's words as they are compared."""
    return line.encode().translate(words.LOWER.tobytes()).split()


def _candidates(variants: DataFrame) -> DataFrame:
    """``at, earlier``: lines with the earliest line that shares each kind of key, if that is earlier."""
    # Most keys have one line; only the others' rows go on.
    meeting = frozen(variants.groupBy("key").agg(F.min("a").alias("least"), F.max("a").alias("most")).where("least < most").select("key"), "meeting-keys")
    variants = frozen(variants.join(meeting, "key", "left_semi").select("key", "size", "place", "at"), "meeting-variants")
    # Lines that lack the word at one place, and among all: the lines that are the variant, and the rest.
    same = variants.groupBy("key", "size", "place").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    same = frozen(same, "same-place")
    keys = same.groupBy("key").agg(
        F.min(F.when(F.col("place") == -1, F.col("first"))).alias("whole"),
        F.min(F.when(F.col("place") >= 0, F.col("first"))).alias("shortened"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    shared = frozen(keys.where("first < last").select("key", "whole", "shortened"), "shared-keys")
    rows = variants.join(shared, "key").join(same.where("place >= 0 and first < last").select("key", "size", "place", "first"), ["key", "size", "place"], "left")
    other = F.when(F.col("place") == -1, F.col("shortened")).otherwise(F.col("whole"))
    pairs = rows.select("at", F.explode(F.array("first", other)).alias("earlier"))
    return pairs.where("earlier is not null and earlier < at").distinct()


def _verified(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """The lines of pairs that are within one edit."""
    beside = pairs.join(contents, "at").join(contents.select(F.col("at").alias("earlier"), F.col("line").alias("other")), "earlier").select("at.id", "at.sum", "at.number", "line", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [within_one_edit(_split(x), _split(y)) for x, y in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            yield batch.select([0, 1, 2]).filter(pa.array(near, pa.bool_()))

    return beside.mapInArrow(words.frugal(run), "id bigint, sum bigint, number bigint").distinct()


def repeated_lines(docs: DataFrame, least: int = LEAST_WORDS, exact: int | None = None) -> DataFrame:
    """``id, sum, number`` of every line that an earlier one makes superfluous: an equal one from ``exact``
    words on, a near one from ``least`` words on."""
    return _superfluous(docs, least, exact).distinct()


def _superfluous(docs: DataFrame, least: int, exact: int | None) -> DataFrame:
    """The repeated lines; one for several reasons comes several times."""
    found = frozen(_occurrences(docs, least if exact is None else min(exact, least)), "lines")
    at = F.struct("id", "sum", "number")
    firsts = frozen(found.groupBy("a", "b").agg(F.min(at).alias("first")), "distinct-lines")
    copies = found.join(firsts, ["a", "b"]).where(at > F.col("first")).select("id", "sum", "number")
    chosen = _chosen(docs, least).distinct().join(firsts, "a").select("first.id", "first.sum", "a")
    variants, contents = _neighbourhoods(docs, chosen, least)
    near = frozen(_verified(_candidates(variants), contents), "near-lines")
    # Every copy of a near line's text has the same fate as its first occurrence.
    goes = near.join(firsts.select("a", "b", "first.*"), ["id", "sum", "number"]).select("a", "b")
    return copies.union(found.join(goes, ["a", "b"]).select("id", "sum", "number"))


def deduplicated(documents: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, counts: bool = False, drop_emptied: bool = False, exact: int | None = None) -> DataFrame:
    """The documents without their repeated lines; with ``counts`` also ``n_lines`` and ``n_removed``
    (columns of these names give way); with ``drop_emptied`` without those that keep no word. A column
    ``n_chars`` follows a text that changes. Only texts that lose lines, and a few that share their bit
    in the gate, meet the lines' numbers by shuffle."""
    names = [c for c in documents.columns if not (counts and c in ("n_lines", "n_removed"))]
    # Inside, columns go by their place, so that no name can clash.
    renamed = documents.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))
    inner, place = renamed.columns, names.index(text)
    numeric = {n for n, kind in documents.dtypes if kind in ("int", "bigint")}
    length = names.index("n_chars") if "n_chars" in names and "n_chars" in numeric else None
    docs = _identified(documents, key, text)
    goes = frozen(_superfluous(docs, least, exact).groupBy("id", "sum").agg(F.collect_set("number").alias("numbers")), "superfluous")
    body = F.coalesce(F.col(f"c{place}").cast("string"), F.lit(""))
    tagged = renamed.withColumn("id", F.coalesce(F.col(f"c{names.index(key)}").cast("bigint"), F.lit(_FIRST))).withColumn("sum", F.xxhash64(body))
    marked = gated(tagged, goes)
    clean = marked.where("not open").select(*inner)
    joined = marked.where("open").join(goes, ["id", "sum"], "left").select(*inner, "numbers")
    if counts:
        joined = clean.withColumn("numbers", F.lit(None).cast("array<bigint>")).union(joined)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, gone, stays = [], [], [], []
            for value, numbers in zip(batch.column(place), batch.column(len(names)), strict=True):
                value, drop = value.as_py(), set(numbers.as_py() or ())
                split = (value or "").split("\n") if counts or drop else []
                left = "\n".join(x for i, x in enumerate(split) if i not in drop) if drop else value
                stays.append(not (drop_emptied and drop and not left.split()))
                texts.append(left)
                total.append(len(split))
                gone.append(len(drop))
            columns = batch.columns[: len(names)]
            columns[place] = pa.array(texts, pa.string())
            if length is not None:
                sizes = zip(columns[length].to_pylist(), texts, gone, strict=True)
                columns[length] = pa.array([len(t) if g else n for n, t, g in sizes], columns[length].type)
            extra = [pa.array(total, pa.int64()), pa.array(gone, pa.int64())] if counts else []
            out = pa.RecordBatch.from_arrays([*columns, *extra], [*inner, *(["n_lines", "n_removed"] if counts else [])])
            yield out.filter(pa.array(stays, pa.bool_())) if drop_emptied else out

    fields = [T.StructField(f.name, T.StringType() if i == place else f.dataType) for i, f in enumerate(renamed.schema.fields)]
    if counts:
        fields += [T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())]
    out = joined.mapInArrow(words.frugal(run), T.StructType(fields))
    if not counts:
        # These are handed on as they are.
        out = clean.withColumn(f"c{place}", F.col(f"c{place}").cast("string")).union(out)
    return out.toDF(*names, *(["n_lines", "n_removed"] if counts else []))
