"""Schema validation, rule checks and run monitoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.schemas import CORRUPT, extended


def violations(rows: DataFrame, required: list[str]) -> DataFrame:
    """Rows read with ``_corrupt_record`` that are unreadable or lack a required column."""
    missing = F.lit(None).cast("string")
    for name in reversed(required):
        missing = F.when(F.col(name).isNull(), F.lit(f"missing {name}")).otherwise(missing)
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("corrupt")).otherwise(missing)
    return rows.withColumn("violation", reason).where(F.col("violation").isNotNull())


def with_corrupt(schema: T.StructType) -> T.StructType:
    return extended(schema, (CORRUPT, T.StringType()))


def rule_report(df: DataFrame, rules: dict[str, Column], unique: str | None = None) -> DataFrame:
    """Violations per rule in one pass: a NULL outcome counts as a violation.

    Key uniqueness counts surplus rows. It comes from the same pass through one distinct count,
    which Spark plans as a partial aggregation per key first.
    """
    broken = {name: F.count_if(~F.coalesce(rule, F.lit(False))) for name, rule in rules.items()}
    if unique:
        broken["unique key"] = F.count(unique) - F.count_distinct(F.col(unique))
    names = list(broken)
    totals = df.agg(*[broken[n].alias(f"r{i}") for i, n in enumerate(names)])
    lines = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations")) for i, n in enumerate(names)])
    return totals.select(F.inline(lines))


def unstable_names(df: DataFrame, key: str, name: str) -> DataFrame:
    """Keys seen under more than one name."""
    spread = df.groupBy(key).agg(F.min(name).alias("low"), F.max(name).alias("high"))
    return spread.where("low != high").select(key)
