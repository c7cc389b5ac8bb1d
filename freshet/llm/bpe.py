"""Byte-level byte-pair encoding of whole texts with the files of a public tokenizer, and decoding.

Texts are cut into words by the tokenizer's pattern. The distinct words of some megabytes of text that
the worker has not met yet are laid end to end and encoded together: an index maps each mergeable pair
to all its places in them; pairs are merged in ascending rank, each at all its places at once, and only
the neighbours' entries are updated. A merge never makes a pair of a lower rank than its own (checked
when the vocabulary is read), so this equals merging word by word.

Words stay slices of Arrow buffers and are told apart by Arrow's dictionaries. What a worker holds is
bounded by bytes of text, or by the longest text if that is more, and not by the rows of a batch.

Defined results: a NULL text is empty and has no ids; special tokens' strings in a text become their
ids; unknown ids are refused when decoding; bytes that are no UTF-8 decode to U+FFFD. Rows are
independent of each other. Extra columns are passed through by ``encode`` and ``decode``.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm import words

# Fixed value: how the byte-level vocabularies cut texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

DOUBLE = re.compile(r" \s").search

#: Distinct words, and their bytes with their ids', that a worker remembers; beyond, it forgets all and starts anew.
REMEMBERED = 300_000
REMEMBERED_BYTES = 32 << 20
#: Bytes of text that are cut together, and of distinct new words that are merged together.
TOGETHER = 8 << 20
MERGED = 2 << 20
#: Places whose pairs are ranked at once, and texts cut by the pattern as Python strings at once.
PLACES = 1 << 17
STRINGS = 10_000
#: Rows, and ids or characters, handed back together.
ROWS = 500
ENTRIES = 1 << 20


def byte_names() -> dict[str, int]:
    """The printable character by which vocabulary files name each byte."""
    plain = [b for lo, hi in (("!", "~"), ("¡", "¬"), ("®", "ÿ")) for b in range(ord(lo), ord(hi) + 1)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary:
    """Tokens' bytes, the merges as sorted pair codes with rank and result, and the special tokens."""

    def __init__(self, text: str):
        file = json.loads(text)
        names = byte_names()
        model, added = file["model"], file.get("added_tokens", [])
        if file.get("normalizer") or model["type"] != "BPE" or file["pre_tokenizer"]["type"] != "ByteLevel" or file["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("not a plain byte-level vocabulary")
        self.special = {a["content"]: a["id"] for a in added}
        ids = model["vocab"]
        self.size = max([*ids.values(), *self.special.values()]) + 1
        pieces: list[bytes] = [b""] * self.size
        for name, i in ids.items():
            pieces[i] = bytes(names[c] for c in name)
        for content, i in self.special.items():
            pieces[i] = content.encode()
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.byte_ids = np.zeros(256, np.int32)
        for name, b in names.items():
            self.byte_ids[b] = ids[name]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made_at = {a + b: rank for rank, (a, b) in reversed(list(enumerate(pairs)))}
        if any(made_at.get(part, -1) >= rank for rank, pair in enumerate(pairs) for part in pair):
            raise ValueError("a merge uses a token that a later one makes")
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.left, self.right = left, right
        codes = left * self.size + right
        order = np.argsort(codes, kind="stable")
        self.codes, self.ranks = codes[order], order

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, or -1."""
        codes = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.ranks[at], -1)


class PairIndex:
    """All places of each mergeable pair in a run of words, by rank."""

    def __init__(self, vocabulary: Vocabulary, data: np.ndarray, lengths: np.ndarray):
        """``data``: the words' bytes end to end."""
        self.v = vocabulary
        self.lengths = lengths
        n = len(data)
        if n >= 2**31 - 2:
            raise ValueError("a word of two gigabytes")
        self.symbols = np.append(vocabulary.byte_ids[data], np.int32(-1))
        #: The next and the previous place that still holds a token of the same word; n if none.
        self.next = np.arange(1, n + 2, dtype=np.int32)
        self.previous = np.arange(-1, n, dtype=np.int32)
        ends = np.cumsum(self.lengths)
        self.next[ends[ends > 0] - 1] = n
        begins = ends - self.lengths
        self.previous[begins[self.lengths > 0]] = n
        self.alive = np.ones(n + 1, bool)
        self.alive[n] = False
        self.places: dict[int, list[np.ndarray]] = defaultdict(list)
        self.active: list[int] = []
        for at in range(0, n, PLACES):
            self._add((at + np.flatnonzero(self.next[at : min(at + PLACES, n)] < n)).astype(np.int32))

    def _add(self, at: np.ndarray) -> None:
        """Enter the pairs that begin at these places."""
        if not len(at):
            return
        ranks = self.v.rank_of(self.symbols[at], self.symbols[self.next[at]])
        known = ranks >= 0
        at, ranks = at[known], ranks[known]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, group in zip(ranks[np.append(0, cuts)].tolist(), np.split(at, cuts), strict=True):
            if rank not in self.places:
                heapq.heappush(self.active, rank)
            self.places[rank].append(group)

    def _merge(self, rank: int) -> None:
        lists = self.places.pop(rank)
        at = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.sort(lists[0])
        left, right = int(self.v.left[rank]), int(self.v.right[rank])
        follower = self.next[at]
        at = at[self.alive[at] & (self.symbols[at] == left) & (self.symbols[follower] == right)]
        if left == right and len(at) > 1:
            # Of a run of one token, the first two merge, then the next two.
            kept, taken = [], -1
            for i in at.tolist():
                if i != taken:
                    kept.append(i)
                    taken = int(self.next[i])
                else:
                    taken = -1
            at = np.array(kept, np.int32)
        if not len(at):
            return
        gone = self.next[at]
        self.symbols[at] = self.v.made[rank]
        self.symbols[gone] = -1
        self.alive[gone] = False
        self.next[at] = self.next[gone]
        self.previous[self.next[at]] = at
        before = self.previous[at]
        self._add(np.unique(np.concatenate([before[self.alive[before]], at[self.alive[self.next[at]]]])))

    def encode(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words end to end, and how many each has."""
        while self.active:
            self._merge(heapq.heappop(self.active))
        kept = np.flatnonzero(self.alive)
        word = np.repeat(np.arange(len(self.lengths)), self.lengths)[kept]
        return self.symbols[kept], np.bincount(word, minlength=len(self.lengths))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of runs given by start and length, end to end."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def flat(strings: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings end to end, and how many each has. No string may be NULL."""
    _, offsets, data = strings.buffers()
    if not len(strings):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    offsets = np.frombuffer(offsets, np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]], np.diff(offsets)


def sliced(data: np.ndarray, cuts: np.ndarray) -> pa.StringArray:
    """The strings between the cuts, the last of which is the end of ``data``."""
    return pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data))


def grouped(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """First and last (exclusive) of groups in a row that have ``most`` bytes together, or one member."""
    ends, at = np.cumsum(lengths), 0
    while at < len(lengths):
        before = int(ends[at - 1]) if at else 0
        until = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, until
        at = until


class Lookup:
    """Distinct strings, numbered, and the ids of each."""

    def __init__(self, strings: list[str], ids: list[int]):
        """Each of the first strings has one id."""
        self.strings = pa.array(strings, pa.string())
        self.ids = np.array(ids, np.uint32)
        self.starts = np.arange(len(ids), dtype=np.int64)
        self.counts = np.ones(len(ids), np.int64)

    @property
    def nbytes(self) -> int:
        return self.strings.nbytes + self.ids.nbytes + self.starts.nbytes + self.counts.nbytes

    def numbers(self, strings: pa.StringArray, encode: Callable[[pa.StringArray], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The numbers of these strings, which may repeat; ``encode`` gives the new ones' ids end to end, and how many each has."""
        coded = strings.dictionary_encode()
        numbers = np.array(pc.fill_null(pc.index_in(coded.dictionary, value_set=self.strings), -1), np.int64)
        unmet = numbers < 0
        if unmet.any():
            new = coded.dictionary.filter(pa.array(unmet))
            ids, counts = encode(new)
            numbers[unmet] = len(self.starts) + np.arange(len(new))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
            self.strings = pa.concat_arrays([self.strings, new])
        return numbers[coded.indices.to_numpy()]

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of these numbers' strings end to end."""
        return self.ids[ragged(self.starts[numbers], self.counts[numbers])]


class Encoder:
    """Encodes and decodes texts; words met before are looked up.

    What stands between two single spaces is looked up as a whole, with the space before it: no word
    of the pattern reaches across such a space. Texts with more white space after a space are cut by the
    pattern alone, and so are those with special tokens, which are cut out first.
    """

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.v = vocabulary
        self.remembered = remembered
        self.find = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(vocabulary.special, key=len, reverse=True)) + ")").split if vocabulary.special else None
        self._forget()

    def _forget(self) -> None:
        # No text in which special tokens were cut out has a word that equals one.
        self.words = Lookup([*self.v.special], [*self.v.special.values()])
        #: What stands between cuts of the texts; each consists of words.
        self.chunks = Lookup([], [])

    def _words(self, text: str) -> list[str]:
        pieces = self.cut(text) if self.cut and any(s in text for s in self.v.special) else [text]
        return [w for i, piece in enumerate(pieces) for w in ([piece] if i % 2 else self.find(piece))]

    def _merged(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words."""
        data, lengths = flat(words)
        ends = np.cumsum(lengths)
        parts = [PairIndex(self.v, data[ends[a] - lengths[a] : ends[b - 1]], lengths[a:b]).encode() for a, b in grouped(lengths, MERGED)]
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([counts for _, counts in parts])

    def _joined(self, chunks: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct chunks, put together from their words'."""
        sizes, owned = [], []
        for at in range(0, len(chunks), STRINGS):
            parts = [self._words(c) for c in chunks.slice(at, STRINGS).to_pylist()]
            sizes.append(np.array([len(w.encode()) for words in parts for w in words], np.int64))
            owned.append(np.array([len(words) for words in parts], np.int64))
        data, _ = flat(chunks)
        numbers = self.words.numbers(sliced(data, np.append(0, np.cumsum(np.concatenate(sizes)))), self._merged)
        until = np.append(0, np.cumsum(self.words.counts[numbers]))[np.append(0, np.cumsum(np.concatenate(owned)))]
        return self.words.of(numbers), np.diff(until)

    def _encode(self, texts: pa.StringArray) -> Iterator[np.ndarray]:
        if len(self.words.strings) + len(self.chunks.strings) > self.remembered or self.words.nbytes + self.chunks.nbytes > REMEMBERED_BYTES:
            self._forget()
        data, lengths = flat(texts)
        ends = np.cumsum(lengths)
        begins = ends - lengths
        cut = data == ord(" ")
        cut[begins[lengths > 0]] = True
        for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
            text = data[begin:end].tobytes().decode()
            if DOUBLE(text) or any(s in text for s in self.v.special):
                cut[begin:end] = False
                cut[begin + np.cumsum([0, *(len(w.encode()) for w in self._words(text)[:-1])])] = True
        cuts = np.append(np.flatnonzero(cut), len(data))
        numbers = self.chunks.numbers(sliced(data, cuts), self._joined)
        for a, b in itertools.pairwise(np.searchsorted(cuts, np.append(begins, len(data))).tolist()):
            yield self.chunks.of(numbers[a:b])

    def encode(self, texts: pa.Array | list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text; the new words of ``TOGETHER`` bytes of text are encoded together."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        elif pa.types.is_null(texts.type):
            texts = texts.cast(pa.string())
        texts = pc.fill_null(texts, "")
        for a, b in grouped(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64), TOGETHER):
            yield from self._encode(texts.slice(a, b - a).cast(pa.string()))

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        if len(ids) and int(ids.max()) >= self.v.size:
            raise ValueError(f"no token has the id {int(ids.max())}")
        lengths = self.v.lengths[ids]
        return self.v.bytes[ragged(self.v.starts[ids], lengths)].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}


def _encoder(source) -> Encoder:
    """The worker's encoder for a broadcast ``(digest, file text)``, with the words it remembers."""
    digest, text = source.value
    if digest not in _encoders:
        _encoders.clear()
        _encoders[digest] = Encoder(Vocabulary(text))
    return _encoders[digest]


def tokenizer(spark: SparkSession, path: str):
    """The tokenizer's file, read by the driver and broadcast: its size does not depend on the data."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    Vocabulary(text)
    return spark.sparkContext.broadcast((hashlib.sha256(text.encode()).hexdigest(), text))


def handed(results: Iterator) -> Iterator[list]:
    """The results in lists of ``ROWS``, or fewer that have ``ENTRIES`` entries together."""
    part, size = [], 0
    for result in results:
        part.append(result)
        size += len(result)
        if len(part) == ROWS or size >= ENTRIES:
            yield part
            part, size = [], 0
    if part:
        yield part


def _mapped(df: DataFrame, source, column: str, out: str, kind: T.DataType, arrow: pa.DataType, each) -> DataFrame:
    """``df`` with ``out`` computed from ``column`` by ``each(encoder, array)``, row by row; an older ``out`` gives way."""
    # Inside, columns go by their place, so that no name can clash.
    kept = [c for c in df.columns if c != out]
    renamed = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), F.col(f"`{column}`").alias("input"))
    schema = T.StructType([*renamed.schema.fields[:-1], T.StructField("output", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(source)
        for batch in batches:
            at = 0
            for results in handed(each(encoder, batch.columns[-1])):
                part = batch.slice(at, len(results))
                at += len(results)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(results, arrow)], [*(f"c{i}" for i in range(len(kept))), "output"])

    return renamed.mapInArrow(words.frugal(run), schema).toDF(*kept, out)


def encode(df: DataFrame, source, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text`` as ``array<int>``."""

    def each(encoder: Encoder, texts: pa.Array) -> Iterator[np.ndarray]:
        return (i.astype(np.int32) for i in encoder.encode(texts))

    return _mapped(df, source, text, ids, T.ArrayType(T.IntegerType()), pa.list_(pa.int32()), each)


def decode(df: DataFrame, source, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with the text that ``ids`` stand for; NULL stands for nothing."""

    def each(encoder: Encoder, rows: pa.Array) -> Iterator[str]:
        return (encoder.decode(np.array(r.as_py() or [], np.int64)) for r in rows)

    return _mapped(df, source, ids, text, T.StringType(), pa.string(), each)


DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def round_trip(documents: DataFrame, source) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them, without moving either."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    narrow = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(source)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                decoded = encoder.decode(ids).encode()
                rows.append((key, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return narrow.mapInArrow(words.frugal(run), DIGESTS)
