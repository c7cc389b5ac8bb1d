"""Secret scanning over every historical version of every path, through a ledger of blobs.

A version's content is addressed by its SHA-256. The ledger holds one row per scanned blob and the
rule versions it was scanned with; a scan touches only pairs of blob and rule version that the ledger
lacks, however many paths and versions carry the blob, and findings are joined back to all of them.

Defined results: a NULL text is the empty blob and has no findings; a NULL path or version is kept as
it is; repeated rows are reported as often as they occur; an empty history gives an empty result and
leaves the ledger as it was. Other columns of the history are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.session import frozen, working_dir


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost, non-overlapping matches on one line; those whose ``group`` has fewer
    than ``least`` characters are dropped. A changed rule needs a new ``version``."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The kinds of secrets, in the order in which equal starts are listed. A run of 24 hex
# digits, and of 16 after AKIA, is matched as such: a run is taken whole or not at all.
KEYWORDS = ("password", "passwd", "secret", "token")
ASSIGN = rf"({'|'.join(map(_either_case, KEYWORDS))}|{_either_case('api')}_?{_either_case('key')})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
RULES = (
    Rule("assign", ASSIGN, group=2, least=6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)

LEDGER = "blob string, rules array<string>, findings array<struct<start:int,rank:int,kind:string,end:int,rule:string>>"


def _found(rule: Rule, rank: int) -> Column:
    """Spans of one rule in code points, from the matches and the text between them."""
    m, parts, groups = f"__m{rank}", f"__p{rank}", f"__g{rank}"
    return F.expr(
        f"""aggregate(
            transform({m}, (x, i) -> named_struct('gap', length({parts}[i]), 'len', length(x), 'ok', length({groups}[i]) >= {rule.least})),
            named_struct('at', 0, 'out', cast(array() as array<struct<start:int,rank:int,kind:string,end:int,rule:string>>)),
            (a, x) -> named_struct('at', a.at + x.gap + x.len, 'out', if(x.ok,
                concat(a.out, array(named_struct('start', a.at + x.gap, 'rank', {rank}, 'kind', '{rule.kind}', 'end', a.at + x.gap + x.len, 'rule', '{rule.key}'))), a.out)),
            a -> a.out)"""
    )


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``findings`` of each blob for the rules its ``missing`` names, in order of start, then kind.

    The text between matches is looked at only where there is a match.
    """
    wanted = lambda r: F.array_contains("missing", r.key)
    out = blobs.select(
        "*",
        *(
            F.when(wanted(r), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))).otherwise(F.array().cast("array<string>")).alias(f"__m{i}")
            for i, r in enumerate(rules)
        ),
    )
    out = out.select(
        "*",
        *(F.when(F.size(f"__m{i}") > 0, F.split("text", r.pattern, -1)).alias(f"__p{i}") for i, r in enumerate(rules)),
        *(
            F.when(F.size(f"__m{i}") > 0, F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group)) if r.group else F.col(f"__m{i}")).alias(f"__g{i}")
            for i, r in enumerate(rules)
        ),
    )
    found = F.concat(*(_found(r, i) for i, r in enumerate(rules)))
    return out.select("blob", F.col("missing").alias("rules"), F.array_sort(found).alias("findings"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def unseen(history: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per blob that lacks a rule version: its text and the rules it lacks.

    Copies are reduced to one text on the map side before the shuffle.
    """
    every = F.array(*(F.lit(r.key) for r in rules))
    blobs = history.groupBy("blob").agg(F.first("text").alias("text"))
    # A blob has a ledger row per scan with new rules: at most as many as there were rule versions.
    seen = ledger.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
    pairs = blobs.join(seen, "blob", "left").withColumn("missing", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))))
    return pairs.where(F.size("missing") > 0).select("blob", "text", "missing")


def addressed(history: DataFrame, path: str, version: str | None, text: str) -> DataFrame:
    at = F.col(version) if version else F.lit(None).cast("long")
    body = F.coalesce(F.col(text), F.lit(""))
    return history.select(F.col(path).alias("path"), at.alias("version"), body.alias("text"), F.sha2(body, 256).alias("blob"))


def scan_history(history: DataFrame, ledger_path: str, path: str = "path", version: str | None = "version", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger at ``ledger_path`` lacks, add it there, and return ``path, version, blob,
    findings`` for every row of the history. Findings are those of the given rules.

    The ledger only ever gets whole appended jobs. Two writers at once may scan a blob twice; readers
    take the distinct findings.
    """
    spark = history.sparkSession
    versions = addressed(history, path, version, text)
    before = read_ledger(spark, ledger_path)
    scan(unseen(versions, before, rules), rules).write.mode("append").parquet(ledger_path)
    # Of a rule that has changed the ledger holds findings of each version.
    keys = F.array(*(F.lit(r.key) for r in rules))
    own = lambda s: F.array_contains(keys, s["rule"])
    span = lambda s: F.struct(*(s[name].alias(name) for name in ("start", "rank", "kind", "end")))
    after = read_ledger(spark, ledger_path).where(F.size("findings") > 0)
    findings = (
        after.groupBy("blob")
        .agg(F.flatten(F.collect_list("findings")).alias("__all"))
        .select("blob", F.array_sort(F.array_distinct(F.transform(F.filter("__all", own), span))).alias("findings"))
    )
    # Written, so that the join reads both sides by plain exchanges and can split a hot blob.
    findings = frozen(findings, "findings")
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    return versions.select("path", "version", "blob").join(findings, "blob", "left").select("path", "version", "blob", F.coalesce("findings", none).alias("findings"))


def secret_report(documents: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """Per document: counts by kind, the spans as text and their digest, with a ledger of its own if none is given."""
    ledger_path = ledger_path or working_dir(documents.sparkSession, "blob-ledger")
    found = scan_history(documents, ledger_path, "doc_id", None, "text")
    spans = F.array_join(F.transform("findings", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("path").alias("doc_id"),
        *(count(r.kind).alias(f"n_{r.kind}") for r in RULES),
        F.sha2(spans, 256).alias("base_sha256"),
        spans.alias("spans"),
        F.col("blob").alias("blob_sha256"),
    )
