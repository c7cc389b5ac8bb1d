"""The stages that turn raw documents into training tokens.

1. toxicity: documents with a score of at least 0.7 go.
2. line dedup: lines that an earlier document has, exactly or within one word's edit, are taken out of
   the later text. A document that is left without any word by this goes, whether its lines repeat
   those of one document or of several.
3. n-gram Jaccard join: of each component of near copies the document with the smallest id stays.
4. decontamination: documents with any window of a benchmark item go.
5. encoding: each document's tokens, ready for training.

Stages 1 to 4 keep all columns and return those of the documents, whatever else the table has;
``n_chars``, where it exists, follows the text. A NULL text or id passes every stage as its operator
defines. The last stage adds ``n_tokens`` and ``ids``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import bpe, decontamination, lines, setjoin, toxicity
from freshet.llm.catalog import table, tokenizer_path
from freshet.session import frozen, tune


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return lines.deduplicated(docs, drop_emptied=True)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return setjoin.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return decontamination.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    encoded = bpe.encode(docs, bpe.tokenizer(spark, tokenizer_path()))
    return encoded.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

# SQL cannot express the classifier; the stages are held against brute force in the tests.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = frozen(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
