"""Benchmark decontamination by a distributed positional inverted index.

The test items are cut into windows of ``WINDOW`` words; an item of fewer words is one window. For each
window the two test terms that are rarest in the training texts, counted over all of them, are its
anchors. The index stores the postings ``term, document, position`` of anchor terms. A posting less the
anchor's place in its item is an alignment of the item with the document; lists are intersected on it,
and alignments that hold both anchors of some window are verified word for word. Proximity matches
intersect the same lists with a tolerance.

Words are runs of digits, letters and characters from U+0080 on, with A-Z lower-cased.

Defined results: a NULL or empty text has no words, matches nothing and is matched by nothing; a NULL
doc_id stays NULL; rows that repeat id and text get the same result each; items that repeat an item_id
are one item with several texts; items with a NULL item_id are not looked for; empty tables give
empty results or no hits. Extra columns are not read by ``report`` and kept by ``uncontaminated``.
Everything is made of Spark's own functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.session import frozen

WINDOW = 10
#: Rarest places of a window whose postings are intersected.
ANCHORS = 2
#: Rows of test terms or anchors that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 500_000

# Fixed value: what separates words once A-Z are letters like a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FIRST = -(1 << 63)

#: Bits of the gate that keeps texts which no alignment asks for out of shuffles, 64 a row: 2^18 rows
#: of 16 bytes are broadcast at most, whatever the number of documents. A text that it lets through by
#: mistake is shuffled and changes no result.
GATE_BITS = 1 << 24


def lowered(text: Column) -> Column:
    """A-Z lower-cased and nothing else; texts of ASCII alone take the fast way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def words_of(text: Column) -> Column:
    return raw_words(lowered(text))


def small(df: DataFrame) -> DataFrame:
    """``df``, a written table, with a broadcast hint if it is small enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def item_words(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """``item, entry, words``: one entry per distinct text of an item that has words."""
    split = items.select(F.col(key).alias("item"), words_of(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("words"))
    return split.where(F.col("item").isNotNull() & (F.size("words") > 0)).distinct().withColumn("entry", F.xxhash64("item", "words"))


def tokens(docs: DataFrame) -> DataFrame:
    """``id, sum, position, term`` of every word."""
    split = docs.select("id", "sum", F.posexplode(raw_words(F.col("text"))).alias("position", "word"))
    return split.select("id", "sum", "position", lowered(F.col("word")).alias("term"))


def identified(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return documents.select(F.coalesce(F.col(key).cast("bigint"), F.lit(_FIRST)).alias("id"), F.xxhash64(body).alias("sum"), body.alias("text"))


def anchors(entries: DataFrame, docs: DataFrame, window: int = WINDOW, many: int = ANCHORS) -> DataFrame:
    """``entry, start, places``: the places of the rarest terms of each window that can occur at all."""
    placed = entries.select("entry", F.size("words").alias("n"), F.posexplode("words").alias("place", "term"))
    terms = small(frozen(placed.select("term").distinct(), "test-terms"))
    counts = tokens(docs).join(terms, "term").groupBy("term").agg(F.count("*").alias("count"))
    counted = placed.join(counts, "term", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    # A place is in the windows that start up to window - 1 words before it.
    starts = F.sequence(F.greatest(F.col("place") - window + 1, F.lit(0)), F.least("place", F.greatest(F.col("n") - window, F.lit(0))))
    rarest = Window.partitionBy("entry", "start").orderBy("count", "place")
    ranked = counted.select("entry", "place", "term", "count", F.explode(starts).alias("start")).withColumn("rank", F.row_number().over(rarest))
    kept = ranked.where(F.col("rank") <= many).groupBy("entry", "start").agg(F.min("count").alias("least"), F.array_sort(F.collect_list(F.struct("place", "term"))).alias("places"))
    return frozen(kept.where("least > 0").select("entry", "start", "places"), "anchors")


def index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored postings of the terms."""
    return frozen(tokens(docs).join(small(terms), "term").select("term", "id", "sum", "position"), "postings")


def _aligned(postings: DataFrame, picked: DataFrame) -> DataFrame:
    """``id, sum, entry, shift, place``: where an entry would begin if this posting were its place."""
    places = frozen(picked.select("entry", F.explode("places").alias("at")).select("entry", "at.place", "at.term").distinct(), "anchor-places")
    return postings.join(small(places), "term").select("id", "sum", "entry", (F.col("position") - F.col("place")).alias("shift"), "place")


def _complete(groups: DataFrame, picked: DataFrame) -> DataFrame:
    """Groups whose ``found`` places hold all anchors of some window of the entry."""
    sets = picked.groupBy("entry").agg(F.collect_set(F.transform("places", lambda x: x["place"])).alias("sets"))
    sets = small(frozen(sets, "anchor-sets"))
    return groups.join(sets, "entry").where(F.exists("sets", lambda s: F.size(F.array_except(s, F.col("found"))) == 0)).drop("sets")


def exact_alignments(postings: DataFrame, picked: DataFrame) -> DataFrame:
    """``id, sum, entry, shift`` that hold all anchors of some window."""
    groups = _aligned(postings, picked).groupBy("id", "sum", "entry", "shift").agg(F.collect_set("place").alias("found"))
    return _complete(groups, picked).select("id", "sum", "entry", "shift")


def proximity(documents: DataFrame, items: DataFrame, slop: int = 5, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, item_id, near``: items one of whose windows has all its anchors in the document within
    ``slop`` words of where they would have to be; ``near`` is the first word of the stretch.

    Alignments go to two rows of bins of twice the slop, half a bin apart, so that any two within the
    slop share one.
    """
    docs, entries = identified(documents, key, text), frozen(item_words(items), "items")
    picked = anchors(entries, docs, window)
    found = _aligned(index(docs, picked.select(F.explode("places.term").alias("term")).distinct()), picked)
    width = 2 * max(slop, 1)
    bins = F.array(F.floor(F.col("shift") / width) * 2, F.floor((F.col("shift") + max(slop, 1)) / width) * 2 + 1)
    groups = found.withColumn("bin", F.explode(bins)).groupBy("id", "sum", "entry", "bin").agg(F.collect_set("place").alias("found"), F.min("shift").alias("near"), F.collect_set(F.struct("place", "shift")).alias("all"))
    close = lambda s: F.exists("all", lambda a: F.forall(s, lambda p: F.exists("all", lambda b: (b["place"] == p) & (F.abs(b["shift"] - a["shift"]) <= slop))))
    sets = small(frozen(picked.groupBy("entry").agg(F.collect_set(F.transform("places", lambda x: x["place"])).alias("sets")), "anchor-sets"))
    kept = groups.join(sets, "entry").where(F.exists("sets", close)).join(small(entries.select("entry", "item")), "entry")
    shown = F.when(F.col("id") != _FIRST, F.col("id")).alias(key)
    return kept.groupBy("id", "item").agg(F.min("near").alias("near")).select(shown, F.col("item").alias("item_id"), F.greatest("near", F.lit(0)).alias("near"))


def gate(asked: DataFrame, bits: int = GATE_BITS) -> DataFrame:
    """``cell, bits``: a bitmap of the asked ``id, sum``."""
    spots = asked.select(F.xxhash64("id", "sum").bitwiseAND(bits - 1).alias("spot"))
    return spots.select(F.shiftright("spot", 6).alias("cell"), F.expr("shiftleft(1L, cast(spot & 63 as int))").alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bits"))


def gated(rows: DataFrame, asked: DataFrame, bits: int = GATE_BITS) -> DataFrame:
    """``rows`` with ``open``: whether their ``id, sum`` may be among the asked. No row is shuffled."""
    spotted = rows.withColumn("spot", F.xxhash64("id", "sum").bitwiseAND(bits - 1)).withColumn("cell", F.shiftright("spot", 6))
    met = spotted.join(F.broadcast(gate(asked, bits)), "cell", "left")
    held = F.coalesce(F.expr("(bits & shiftleft(1L, cast(spot & 63 as int))) != 0"), F.lit(False))
    return met.withColumn("open", held).drop("spot", "cell", "bits")


def _hits(window: int) -> Column:
    """For each alignment its item and the document words inside occurring windows.

    ``words``: the document's; ``aligned``: array of item, shift, words.
    """
    return F.expr(
        f"""transform(aligned, a -> named_struct('item', a.item, 'hit', aggregate(
            filter(
                transform(sequence(0, greatest(size(a.words) - {window}, 0)), s -> if(
                    forall(sequence(s, s + least({window}, size(a.words)) - 1), p -> get(words, a.shift + p) <=> get(a.words, p)), s, -1)),
                s -> s >= 0),
            cast(array() as array<int>),
            (all, s) -> array_union(all, sequence(a.shift + s, a.shift + s + least({window}, size(a.words)) - 1)))))"""
    )


def alignments(docs: DataFrame, entries: DataFrame, window: int = WINDOW) -> DataFrame:
    """``id, sum, aligned`` of the documents in which some entry may occur: where, and the entry's words.

    A document's alignments are bounded by its length and the number of items.
    """
    picked = anchors(entries, docs, window)
    postings = index(docs, picked.select(F.explode("places.term").alias("term")).distinct())
    candidates = exact_alignments(postings, picked).join(small(entries), "entry")
    return candidates.groupBy("id", "sum").agg(F.collect_list(F.struct("item", F.col("shift").cast("int").alias("shift"), "words")).alias("aligned"))


def searched(met: DataFrame, window: int = WINDOW) -> DataFrame:
    """``id, sum, n_words, found`` of rows ``id, sum, text, aligned``."""
    # The generator keeps the split from being copied into the search, where it would run once a word.
    split = met.select("id", "sum", "aligned", F.explode(F.array(words_of(F.col("text")))).alias("words"))
    hits = F.filter(_hits(window), lambda h: F.size(h["hit"]) > 0)
    none = F.array().cast("array<struct<item:bigint,hit:array<int>>>")
    return split.select("id", "sum", F.size("words").cast("bigint").alias("n_words"), F.when(F.col("aligned").isNotNull(), hits).otherwise(none).alias("found"))


def contaminated_words(documents: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, sum, n_words, found`` of every row, found being the items that occur with the words they hit."""
    docs, entries = identified(documents, key, text), frozen(item_words(items), "items")
    return searched(docs.join(alignments(docs, entries, window), ["id", "sum"], "left"), window)


def report(documents: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, words hit, items that occur and their digest."""
    found = contaminated_words(documents, items, window)
    names = F.array_sort(F.array_distinct(F.transform("found", lambda h: h["item"].cast("string"))))
    hit = F.size(F.array_distinct(F.flatten(F.transform("found", lambda h: h["hit"])))).cast("bigint")
    sums = found.select("id", "n_words", hit.alias("n_hit"), names.alias("items"))
    return sums.select(
        F.when(F.col("id") != _FIRST, F.col("id")).alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def uncontaminated(documents: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all their columns, that hold no window of any item.

    Only texts that hold an alignment, and a few that share their bit in the gate, meet the alignments
    by shuffle; and only rows that the gate of the contaminated ones lets through meet these.
    """
    docs, entries = identified(documents, key, text), frozen(item_words(items), "items")
    aligned = frozen(alignments(docs, entries, window), "alignments")
    asked = gated(docs, aligned.select("id", "sum")).where("open").drop("open")
    hit = searched(asked.join(aligned, ["id", "sum"]), window).where(F.size("found") > 0)
    found = frozen(hit.select("id", "sum").distinct(), "contaminated")
    names = documents.columns
    inner = documents.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))
    body = F.coalesce(F.col(f"c{names.index(text)}").cast("string"), F.lit(""))
    tagged = inner.withColumn("id", F.coalesce(F.col(f"c{names.index(key)}").cast("bigint"), F.lit(_FIRST))).withColumn("sum", F.xxhash64(body))
    marked = gated(tagged, found)
    clean = marked.where("not open").select(*inner.columns)
    doubtful = marked.where("open").join(found, ["id", "sum"], "left_anti").select(*inner.columns)
    return clean.union(doubtful).toDF(*names)
