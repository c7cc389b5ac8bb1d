"""Queries over the given tables that apply the operators, and their SQL twins where SQL has them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from freshet.llm import bpe, decontamination, fingerprints, lines, lm, passages, secrets, setjoin, sharding, toxicity, variants, warc, whitening
from freshet.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)

        QUERIES[build.__name__] = run
        if sql:
            SQL[build.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SECRETS_SQL = f"""
with rules(rank, kind, pattern, grp, least) as (values
    {", ".join(f"({i}, '{r.kind}', '{r.pattern.replace(chr(39), chr(39) * 2)}', {r.group}, {r.least})" for i, r in enumerate(secrets.RULES))}
), bodies as (select doc_id, coalesce(text, '') as body from documents),
found as (
    {" union all ".join(f'''select doc_id, rank, kind, least, regexp_extract_all(body, '{r.pattern.replace(chr(39), chr(39) * 2)}', 0) as ms,
        regexp_extract_all(body, '{r.pattern.replace(chr(39), chr(39) * 2)}', {r.group}) as gs,
        regexp_split_to_array(body, '{r.pattern.replace(chr(39), chr(39) * 2)}') as parts
    from bodies, rules where rank = {i}''' for i, r in enumerate(secrets.RULES))}
), each as (
    select doc_id, rank, kind, least, unnest(generate_series(1, len(ms))) as i, ms, gs, parts from found where len(ms) > 0
), placed as (
    select doc_id, rank, kind, length(gs[i]) >= least as ok, length(ms[i]) as n,
        sum(length(parts[i]) + length(ms[i])) over (partition by doc_id, rank order by i)::bigint as until from each
), spans as (
    select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
        string_agg(kind || ':' || (until - n) || ':' || until, ',' order by until - n, rank) as spans
    from placed where ok group by doc_id
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
    sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans, sha256(body) as blob_sha256
from bodies left join spans using (doc_id)
"""


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(SECRETS_SQL)
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATION_SQL = f"""
with docs as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{decontamination.UPPER}', '{decontamination.LOWER}'), '{_SEPARATORS}'), lambda x: x <> '') as w
    from documents
), items as (
    select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{decontamination.UPPER}', '{decontamination.LOWER}'), '{_SEPARATORS}'), lambda x: x <> '') as w
    from benchmark where item_id is not null
), starts as (
    select item_id, w, least({decontamination.WINDOW}, len(w)) as k, unnest(generate_series(1, greatest(len(w) - {decontamination.WINDOW}, 0) + 1)) as s
    from items where len(w) > 0
), windows as (select distinct item_id, k, array_to_string(w[s:s + k - 1], ' ') as gram from starts),
places as (
    select doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) as s from docs, (select distinct k from windows) where len(w) >= k
), found as (
    select doc_id, item_id, s, windows.k from places join windows on places.k = windows.k and array_to_string(w[s:s + places.k - 1], ' ') = gram
), hits as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(generate_series(s, s + k - 1)) as p from found) group by doc_id),
names as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct doc_id, item_id::varchar as item from found) group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hits using (doc_id) left join names using (doc_id)
"""


@query(DECONTAMINATION_SQL)
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The place of an installed vocabulary file; any other path may be passed to the operator."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), bpe.tokenizer(spark, tokenizer_path()))


@query()
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DuckDB has no SHA-1; held against brute force in the tests."""
    return warc.archive_report(table(spark, sf_dir, "pages"))


@query()
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of equal weight. DuckDB has no CRC-32; held against brute force in the tests."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), [1.0] * 8)


@query()
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.jaccard_components(table(spark, sf_dir, "documents"))


@query()
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated lines, and how many it lost."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.deduplicated(docs, counts=True, exact=lines.LEAST_EXACT)


@query()
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a paragraph or passage that several documents have."""
    return passages.repeated(table(spark, sf_dir, "documents"))


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL has no eigenvectors; held against plain numpy in the tests."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query()
def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL cannot train; counts are held against brute force in the tests, scores against held-out texts."""
    return lm.score(table(spark, sf_dir, "documents"))


@query()
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DuckDB has no CRC-32; held against brute force in the tests."""
    return variants.spelling_variants(table(spark, sf_dir, "documents"))
