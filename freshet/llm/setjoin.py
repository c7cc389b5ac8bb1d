"""Exact Jaccard self join of texts' word shingles, up to connected components.

Every text's set is put in one global order (rare shingles first) and enters the inverted index with
its prefix only: two sets that are similar enough share a shingle there. Lists are sorted by set size,
which makes them runs of blocks; pairs whose sizes, or whose places in the list, rule the overlap out
are skipped by block. Relations between sets save the rest:

* equal sets are one class, found before the index is built;
* of each list's block only links to the block's leader and to the next set are tried first. These
  exact answers make clusters of highly similar sets;
* what the clusters answer is not asked again: only sets of different clusters are still compared, and
  of those only the ones that the triangle inequality of the Jaccard distance to a shared leader leaves
  open. They are compared in blocks, so that no row is made per pair.

So every pair of similar texts ends up in one component, without all pairs of a group being made.
Lists are bounded work for most shingles because the frequent ones, counted over all texts, come last
in the order and enter the index only where a set has little else.

Defined results: words are cut at ASCII white space after lower-casing A-Z; a text with fewer words
than a shingle is one shingle; a NULL or empty text, or one without words, has the empty set and links
with nothing; a NULL key takes part like any other but never names a component that has other keys;
repeated rows are one class; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm import words
from freshet.llm.components import components
from freshet.session import frozen

SHINGLE = 5
PERCENT = 80
#: Shingles that go to the end of the order by their count, at most; only speed depends on it.
FREQUENT = 1_000_000
#: Shingles that are counted together, and the count from which one of them is reported.
COUNTED = 4_000_000
REPORTED = 2
#: Sets in a block when open questions are settled.
BLOCK = 256
#: Postings in one bucket of the index, about.
BUCKET_POSTINGS = 150_000

#: Bits by which texts are kept from a shuffle when a round does not ask for them, 64 a row.
GATE_BITS = 1 << 24

_U = np.uint64
_FIRST = -(1 << 63)
_POSTING = (("shingle", np.uint64), ("set", np.uint64), ("size", np.uint32), ("place", np.uint32))


def set_id(shingles: np.ndarray) -> int:
    """A 63-bit identity of a set; 0 is the empty one."""
    if not len(shingles):
        return 0
    return int(words.mix(np.array([words.mix(shingles).sum() + _U(len(shingles))], np.uint64))[0] >> _U(1)) or 1


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The smallest intersection with which sets of these sizes are similar: 100 i >= percent (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def prefix(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _pack(columns: list[np.ndarray]) -> bytes:
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns]
    return len(columns[0]).to_bytes(8, "little") + b"".join(planes)


def _unpack(data: bytes) -> list[np.ndarray]:
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for _, kind in _POSTING:
        width = np.dtype(kind).itemsize
        plane = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(plane.T).view(kind).ravel())
        at += n * width
    return out


def _sets(documents: DataFrame, shingle: int) -> DataFrame:
    """Rows of kind 0: ``key, sum, set, n`` of every text; of kind 1: a shingle in ``set`` and its count among some millions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "key", "sum", "set", "n"]
        seen: dict[int, np.ndarray] = {}
        size = 0

        def reported() -> pa.RecordBatch:
            every = np.concatenate(list(seen.values()))
            seen.clear()
            every.sort()
            starts, counts = runs(every)
            often = counts >= REPORTED
            shared, counts = every[starts[often]].view(np.int64), counts[often].astype(np.int64)
            del every, starts, often
            return pa.RecordBatch.from_arrays([pa.array(np.ones(len(shared), np.int8)), *[pa.nulls(len(shared), pa.int64())] * 2, pa.array(shared), pa.array(counts)], names)

        for batch in batches:
            for at, sets in words.shingle_sets(batch.column(1), shingle):
                ids = [set_id(s) for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(sets), np.int8)), batch.column(0).slice(at, len(sets)), batch.column(2).slice(at, len(sets)), pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64())], names)
                for i, one in zip(ids, sets, strict=True):
                    if i not in seen:
                        seen[i] = one
                        size += len(one)
            if size >= COUNTED:
                yield reported()
                size = 0
        if seen:
            yield reported()

    return documents.mapInArrow(words.frugal(run), "kind tinyint, key bigint, sum bigint, set bigint, n bigint")


def _frequent(reports: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, with their counts: at most ``most``, by a count they all reach."""
    counts = frozen(reports.groupBy(F.col("set").alias("shingle")).agg(F.sum("n").alias("n")), "shingle-counts")
    level = F.floor(8 * F.log2("n")).cast("int")
    chosen, total = None, 0
    # One row per eighth of a power of two: a few hundred whatever the data.
    for r in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True):
        total += r["n"]
        if total > most:
            break
        chosen = r["level"]
    if chosen is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # As Arrow columns, 16 bytes a row; row objects would take some hundreds.
    rows = counts.where(level >= chosen).select("shingle", "n").toArrow()
    shingles = rows["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], rows["n"].to_numpy()[order]


def _index(documents: DataFrame, frequent: tuple[np.ndarray, np.ndarray], buckets: int, shingle: int, percent: int) -> DataFrame:
    """``bucket, postings``: the prefixes of each batch's distinct sets, packed by range of shingle."""
    shared = documents.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, counts = shared.value
        gate = np.zeros(1 << 20, bool)
        gate[often & _U(0xFFFFF)] = True
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            done: set[int] = set()
            out: list[list[np.ndarray]] = []
            for _, sets in words.shingle_sets(batch.column(1), shingle):
                for s in sets:
                    i = set_id(s)
                    if not i or i in done:
                        continue
                    done.add(i)
                    n, p = len(s), prefix(len(s), percent)
                    maybe = np.flatnonzero(gate[s & _U(0xFFFFF)])
                    if len(maybe):
                        at = np.minimum(np.searchsorted(often, s[maybe]), len(often) - 1)
                        weight = np.zeros(n, np.int64)
                        weight[maybe] = np.where(often[at] == s[maybe], counts[at], 0)
                        s = s[np.argsort(weight, kind="stable")]
                    out.append([s[:p], np.full(p, i, np.uint64), np.full(p, n, np.uint32), np.arange(p, dtype=np.uint32)])
            if not out:
                continue
            columns = [np.concatenate(c) for c in zip(*out, strict=True)]
            bucket = ((columns[0] >> _U(32)) * _U(buckets)) >> _U(32)
            order = np.argsort(columns[0])
            columns, bucket = [c[order] for c in columns], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            for first in range(0, buckets, 64):
                some = [b for b in range(first, min(first + 64, buckets)) if cuts[b] < cuts[b + 1]]
                packed = [squeeze(_pack([c[cuts[b] : cuts[b + 1]] for c in columns])) for b in some]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(packed, pa.binary())], ["bucket", "postings"])

    return documents.mapInArrow(words.frugal(run), "bucket int, postings binary")


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every run of equal values."""
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(values)))


def _possible(size_a, size_b, place_a, place_b, percent: int):
    """Whether two sets can be similar whose first common shingle stands at these places of their orders.

    The rest of each set must be long enough for the overlap. And of two prefixes, one holds all common
    shingles up to its end, so that those common in the prefixes are at least the overlap less the
    longer rest behind a prefix: so many must still fit in from these places on.
    """
    a, b = size_a.astype(np.int64), size_b.astype(np.int64)
    need = least_overlap(a, b, percent)
    most = 1 + np.minimum(a - place_a - 1, b - place_b - 1)
    behind_a, behind_b = -(-percent * a // 100) - 1, -(-percent * b // 100) - 1
    inside = np.maximum(need - np.maximum(behind_a, behind_b), 1)
    fits = (place_a + inside <= a - behind_a) & (place_b + inside <= b - behind_b)
    return (100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & (most >= need) & fits


def _with_partner(shingle: np.ndarray, size: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Which postings may have a partner in their list. Long lists are only looked at for sizes."""
    near = (shingle[1:] == shingle[:-1]) & (100 * size[:-1].astype(np.int64) >= percent * size[1:].astype(np.int64))
    kept = np.append(near, False) | np.append(False, near) if len(shingle) else np.zeros(0, bool)
    starts, lengths = runs(shingle)
    for many in range(2, 17):
        at = starts[lengths == many]
        for part in np.array_split(at, 1 + len(at) * many * many // 2_000_000):
            rows = part[:, None] + np.arange(many)
            n, i = size[rows], place[rows]
            fit = _possible(n[:, :, None], n[:, None, :], i[:, :, None], i[:, None, :], percent)
            fit[:, np.arange(many), np.arange(many)] = False
            kept[rows] = fit.any(axis=2)
    return kept


def _lists(index: DataFrame, partitions: int, percent: int) -> DataFrame:
    """Postings of the lists in which some set can have a partner."""
    unpack = lambda data: _unpack(zstandard.ZstdDecompressor().decompress(data))

    def finished(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        shingle, owner, size, place = (np.concatenate(c) for c in zip(*map(unpack, parts), strict=True))
        order = np.lexsort((owner, size, shingle))
        shingle, owner, size, place = shingle[order], owner[order], size[order], place[order]
        # A set that several batches hold has entered once for each.
        same = np.append(False, (shingle[1:] == shingle[:-1]) & (owner[1:] == owner[:-1]))
        shingle, owner, size, place = (c[~same] for c in (shingle, owner, size, place))
        kept = _with_partner(shingle, size, place, percent)
        columns = [shingle[kept].view(np.int64), owner[kept].view(np.int64), size[kept].astype(np.int32), place[kept].astype(np.int32)]
        for at in range(0, len(columns[0]), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 200_000]) for c in columns], ["shingle", "set", "size", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, []
        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if b != bucket and parts:
                    yield from finished(parts)
                    parts = []
                bucket = b
                parts.append(data.as_py())
        if parts:
            yield from finished(parts)

    return index.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(words.frugal(run), "shingle bigint, set bigint, size int, place int")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of whole lists, a batch or more at a time, from rows sorted by their first column."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        if key[0] == key[-1] and (not held or held[-1].column(0)[-1].as_py() == key[0]):
            held.append(batch)
            continue
        cut = int(np.searchsorted(key, key[-1]))
        yield _columns([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield _columns(held)


def _columns(batches: list[pa.RecordBatch]) -> list[np.ndarray]:
    table = pa.Table.from_batches(batches)
    return [c.to_numpy() for c in table.columns]


def _first_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """In every list, each set with the leader of its block of sizes and with the next set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shingle, owner, size, place in _columns_by_list(batches):
            n = len(shingle)
            starts, lengths = runs(shingle)
            list_no = np.repeat(np.arange(len(starts)), lengths)
            # Blocks: sizes between powers of 1 / similarity.
            block = np.floor(np.log(size) / -np.log(percent / 100)).astype(np.int64)
            first, many = runs(list_no * 4096 + block)
            leaders = np.minimum.reduceat(owner, first) if n else owner
            by_block = np.repeat(np.arange(len(first)), many)
            leader_at = np.flatnonzero(owner == leaders[by_block])
            a = np.concatenate([np.arange(n), np.arange(n - 1)])
            b = np.concatenate([leader_at[by_block], np.arange(1, n)])
            fit = (a != b) & (shingle[a] == shingle[b]) & _possible(size[a], size[b], place[a], place[b], percent)
            a, b = owner[a[fit]], owner[b[fit]]
            pairs, counts = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.array(counts.astype(np.int64))], ["u", "v", "shared"])

    return lists.mapInArrow(words.frugal(run), "u bigint, v bigint, shared bigint").groupBy("u", "v").agg(F.sum("shared").alias("shared"))


def _columns_by_list(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    for columns in _streamed(batches):
        if len(columns[0]):
            yield columns


def _open(group: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each posting of a list with the later ones that sizes, places and known distances leave open.

    ``group``: size, set, place, cluster, leader and distance of each posting, by size.
    """
    size, owner, place, cluster, leader, distance = group
    sizes, far = size.astype(np.int64), 1 - percent / 100 + 1e-9
    # For each set the block of larger ones that may be its partners.
    until = np.searchsorted(sizes, 100 * sizes // percent, "right")
    for i in range(len(sizes) - 1):
        j = np.arange(i + 1, until[i])
        j = j[cluster[j] != cluster[i]]
        j = j[_possible(sizes[i], sizes[j], place[i], place[j], percent)]
        answered = (leader[j] == owner[i]) | (leader[i] == owner[j])
        ruled_out = (leader[j] == leader[i]) & (np.abs(distance[j] - distance[i]) > far)
        j = j[~(answered | ruled_out)]
        if len(j):
            yield i, j


def _open_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The lists that several clusters share, one at a time."""
    for shingle, *columns in _columns_by_list(batches):
        starts, lengths = runs(shingle)
        for s, many in zip(starts.tolist(), lengths.tolist(), strict=True):
            cluster = columns[3][s : s + many]
            if (cluster != cluster[0]).any():
                yield [c[s : s + many] for c in columns]


def _gathered(rows: Iterator[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Distinct columns of the given blocks of rows, a million at a time."""
    held, size = [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in np.unique(np.concatenate(held, axis=1), axis=1)], names)

    for block in rows:
        held.append(block)
        size += block.shape[1]
        if size > 1_000_000:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _participants(lists: DataFrame, percent: int) -> DataFrame:
    """``job, set, cluster``: the sets with an open pair in some list, under the list's largest cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[np.ndarray]:
            for group in _open_lists(batches):
                owner, cluster = group[1], group[3]
                taken = np.zeros(len(owner), bool)
                for i, j in _open(group, percent):
                    taken[i] = taken[j] = True
                if taken.any():
                    names, counts = np.unique(cluster, return_counts=True)
                    yield np.stack([np.full(taken.sum(), names[np.argmax(counts)]), owner[taken], cluster[taken]])

        yield from _gathered(rows(), ["job", "set", "cluster"])

    return lists.mapInArrow(words.frugal(run), "job bigint, set bigint, cluster bigint").distinct()


def _settled(parts: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between different clusters among the participants of each job.

    A job's sets are cut into blocks, those of its own cluster apart from the others, and every two
    blocks that may hold a pair of different clusters meet in one task. So a set is copied once per
    block and never once per partner. A task yields the links that join two of its clusters, one for each
    join, which is enough.
    """
    parts = frozen(parts, "participants")
    inside = (F.col("cluster") == F.col("job")).cast("int")
    jobs = parts.groupBy("job").agg(F.ceil(F.sum(inside) / BLOCK).alias("own"), F.ceil(F.sum(1 - inside) / BLOCK).alias("other"))
    placed = parts.join(jobs, "job").withColumn("inside", inside == 1)
    block = F.pmod(F.xxhash64("set"), F.when(F.col("inside"), F.col("own")).otherwise(F.col("other")))
    # Blocks of the job's cluster are numbered from 0, the others from -1 downwards.
    mine = placed.withColumn("block", F.when(F.col("inside"), block).otherwise(-1 - block))
    meets = F.expr(
        "if(inside, transform(sequence(1, greatest(other, 1)), o -> named_struct('x', block, 'y', -o)),"
        " concat(if(own > 0, transform(sequence(0, own - 1), i -> named_struct('x', i, 'y', block)), array()),"
        " transform(sequence(1, other), o -> named_struct('x', greatest(block, -o), 'y', least(block, -o)))))"
    )
    spread = mine.join(_gated(texts, parts), "set").select("job", "set", "cluster", "block", "text", F.explode(meets).alias("meet")).select("job", "meet.x", "meet.y", "block", "set", "cluster", "text")
    partitions = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = spread.repartition(partitions, "job", "x", "y").sortWithinPartitions("job", "x", "y")

    def settle(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        """All pairs of different clusters of one task's sets; within one block only if it meets itself."""
        _, x, y = rows[0][:3]
        block, owner, cluster = (np.array([r[k] for r in rows], np.int64) for k in (3, 4, 5))
        if (cluster == cluster[0]).all():
            return
        sets = words.shingles(*words.word_hashes(*words.joined([r[6].encode() for r in rows])), shingle)
        sizes = np.array([len(s) for s in sets])
        queries = np.flatnonzero(block == y)
        against = np.flatnonzero(block == x)
        everything = np.concatenate([sets[k] for k in against])
        whose = np.repeat(np.arange(len(against)), sizes[against])
        joined = {c: c for c in cluster.tolist()}

        def root(c: int) -> int:
            while joined[c] != c:
                joined[c] = c = joined[joined[c]]
            return c

        for q in queries.tolist():
            at = np.minimum(np.searchsorted(sets[q], everything), max(sizes[q] - 1, 0))
            common = np.bincount(whose[sets[q][at] == everything], minlength=len(against))
            union = sizes[q] + sizes[against] - common
            hit = against[(100 * common >= percent * union) & (cluster[against] != cluster[q])]
            for h in hit.tolist():
                a, b = root(int(cluster[q])), root(int(cluster[h]))
                if a != b:
                    joined[a] = b
                    yield int(owner[q]), int(owner[h])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if pairs := list(settle(rows)):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], ["u", "v"])

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:3] != row[:3]:
                    yield from found(held)
                    held = []
                held.append(row)
        if held:
            yield from found(held)

    return ordered.mapInArrow(words.frugal(run), "u bigint, v bigint")


def _gated(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """The texts of the sets asked for, and few others, without a shuffle of the texts: a bitmap of a
    fixed size, at most ``GATE_BITS / 64`` rows, is broadcast."""
    bit = F.pmod(F.xxhash64("set"), F.lit(GATE_BITS))
    cell, mask = F.shiftright(bit, 6).alias("cell"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(set), {GATE_BITS}) & 63 as int))")
    cells = asked.select(cell, mask.alias("mask")).groupBy("cell").agg(F.bit_or("mask").alias("bits"))
    return texts.withColumn("cell", cell).join(F.broadcast(cells), "cell").where(F.col("bits").bitwiseAND(mask) != 0).select("set", "text")


def _measured(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``u, v, distance, linked`` of every pair, from the whole texts."""
    pairs = frozen(pairs.select("u", "v"), "pairs")
    texts = _gated(texts, pairs.select(F.explode(F.array("u", "v")).alias("set")))
    left = texts.select(F.col("set").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("set").alias("v"), F.col("text").alias("text_v"))
    beside = pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "text_u", "text_v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple = (None, None)
        for batch in batches:
            v = batch.column(1).to_numpy()
            for at, sets in words.shingle_sets(batch.column(2), shingle):
                out = []
                for row, one in enumerate(sets, at):
                    if kept[0] != v[row]:
                        kept = (v[row], next(words.shingle_sets(batch.column(3).slice(row, 1), shingle))[1][0])
                    common = len(np.intersect1d(one, kept[1], assume_unique=True))
                    union = len(one) + len(kept[1]) - common
                    out.append((1 - common / union, 100 * common >= percent * union))
                distance, linked = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sets)), batch.column(1).slice(at, len(sets)), pa.array(distance), pa.array(linked)], ["u", "v", "distance", "linked"])

    return beside.mapInArrow(words.frugal(run), "u bigint, v bigint, distance double, linked boolean")


def _best(pairs: DataFrame) -> DataFrame:
    """For each set the partner that most lists suggest; ties go to the smaller."""
    both = pairs.select("u", "v", "shared").union(pairs.select("v", "u", "shared").toDF("u", "v", "shared"))
    best = both.groupBy("u").agg(F.max_by("v", F.struct("shared", -F.col("v"))).alias("v"))
    return best.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def links_between(lists: DataFrame, texts: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Verified links ``u, v`` that connect all similar sets which meet in some list.

    ``lists`` has ``shingle, set, size, place``, where size and place only serve to rule pairs out;
    ``texts`` has the text of every ``set`` in them. One question a set comes first and makes the
    clusters; then all that is left open between clusters is settled in blocks.
    """
    partitions = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_list = lambda df: df.repartition(partitions, "shingle").sortWithinPartitions("shingle", "size", "set")
    answers = frozen(_measured(_best(frozen(_first_pairs(by_list(lists), percent), "first-pairs")), texts, shingle, percent), "answers")
    linked = answers.where("linked").select("u", "v")
    clusters = components(linked).withColumnRenamed("node", "set")
    # What is known of each set: its cluster, and its distance from one leader (itself at 0 if none).
    leaders = answers.select(F.col("u").alias("set"), F.col("v").alias("leader"), "distance").union(answers.select("v", "u", "distance"))
    known = leaders.groupBy("set").agg(F.min(F.struct("distance", "leader")).alias("by"))
    states = clusters.join(known, "set", "full").select("set", F.coalesce("component", "set").alias("cluster"), F.coalesce("by.leader", "set").alias("leader"), F.coalesce("by.distance", F.lit(0.0)).alias("distance"))
    # Written, so that the join reads both sides by plain exchanges and can split a hot list.
    placed = frozen(
        lists.join(states, "set", "left").select("shingle", "size", "set", "place", F.coalesce("cluster", "set").alias("cluster"), F.coalesce("leader", "set").alias("leader"), F.coalesce("distance", F.lit(0.0)).alias("distance")),
        "placed",
    )
    split = frozen(placed.groupBy("shingle").agg(F.min("cluster").alias("a"), F.max("cluster").alias("b")).where("a != b").select("shingle"), "split")
    left_open = by_list(placed.join(split, "shingle", "left_semi"))
    return linked.union(frozen(_settled(_participants(left_open, percent), texts, shingle, percent), "settled"))


def _keyed(documents: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return documents.select(F.col(key).cast("bigint").alias("key"), body.alias("text"), F.xxhash64(body).alias("sum"))


def _components(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``key, sum, n, least`` of every row: the size of its set and the smallest key of its component."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = frozen(_sets(docs, shingle), "sets")
    sets = table.where("kind = 0").select("key", "sum", "set", "n")
    classes = sets.where("n > 0").groupBy("set", "n").agg(F.min(F.struct("key", "sum")).alias("one"))
    postings = classes.agg(F.sum(F.col("n") * (100 - percent) / 100 + 1)).first()[0] or 0
    buckets = max(4 * partitions, int(postings / BUCKET_POSTINGS))
    index = _index(docs, _frequent(table.where("kind = 1"), FREQUENT), buckets, shingle, percent)
    lists = frozen(_lists(index, partitions, percent), "lists")

    # One text of each class that is in some list is carried on.
    wanted = lists.select("set").distinct().join(classes.select("set", "one.key", "one.sum"), "set")
    known = F.coalesce("key", F.lit(_FIRST)).alias("id")
    met = docs.select(known, "sum", "text").join(wanted.select(known, "sum", "set"), ["id", "sum"])
    texts = frozen(met.groupBy("id", "sum", "set").agg(F.first("text").alias("text")).select("set", "text"), "texts")

    found = components(links_between(lists, texts, shingle, percent))
    member = sets.join(found.withColumnRenamed("node", "set"), "set", "left").select("key", "sum", "n", F.coalesce("component", "set").alias("group"))
    names = frozen(member.where("n > 0").groupBy("group").agg(F.min("key").alias("least")), "components")
    full = member.where("n > 0").join(names, "group").select("key", "sum", "n", "least")
    return full.union(member.where("n = 0").select("key", "sum", "n", F.col("key").alias("least")))


def jaccard_components(documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``key, n_shingles, component_id`` for every row."""
    found = _components(_keyed(documents, key, text), shingle, percent)
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))


def representatives(documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component, with all its columns, and all rows whose set is empty.

    That is the row whose key names the component; of several with that key, and of rows without any
    key, the one whose text hashes least; of rows that repeat both, any one.
    """
    names = documents.columns
    found = frozen(_components(_keyed(documents, key, text), shingle, percent), "document-components")
    inner = documents.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))
    body = F.coalesce(F.col(f"c{names.index(text)}").cast("string"), F.lit(""))
    tagged = inner.withColumn("key", F.col(f"c{names.index(key)}").cast("bigint")).withColumn("sum", F.xxhash64(body))
    # Rows that do not name their component go; ties are rare and settled among themselves.
    named = found.where("n > 0 and key <=> least").groupBy(F.col("least").alias("its_key")).agg(F.min("sum").alias("its_sum"))
    goes = found.where("n > 0").join(named, F.col("key").eqNullSafe(F.col("its_key")) & (F.col("sum") == F.col("its_sum")), "left_anti")
    goes = frozen(goes.select("key", "sum").distinct(), "copies")
    match = F.col("key").eqNullSafe(F.col("its_key")) & (F.col("sum") == F.col("its_sum"))
    kept = tagged.join(goes.toDF("its_key", "its_sum"), match, "left_anti")
    again = frozen(found.where("n > 0 and key <=> least").groupBy("key", "sum").agg(F.count("*").alias("rows")).where("rows > 1").select("key", "sum").toDF("its_key", "its_sum"), "repeated-rows")
    if again.isEmpty():
        return kept.select(*inner.columns).toDF(*names)
    once = kept.join(again, match, "left_semi").dropDuplicates(["key", "sum"])
    return kept.join(again, match, "left_anti").union(once).select(*inner.columns).toDF(*names)
