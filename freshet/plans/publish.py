"""Tables for readers, carried forward from publish to publish.

Every publish takes the runs committed since the last one and nothing older:

* silver videos lie in buckets of their id. Ids that silver lacks are appended; a bucket is rewritten only
  when rows of its own are replaced;
* gold tables and the quality report are sums: the new rows are added and the replaced ones taken off;
* channel growth and name history need each channel's last snapshot and its open spell, which are carried
  along; finished rows are appended and never read again.

A publish first writes down what it will do (``published/version=<n>``: the rows that come and go, and the
carried state after them), then does it, then logs it. One that died is finished from what it wrote down
before the next begins, so that nothing is added or taken off twice. Only the last run can be repeated;
if it had been published, its publish is undone from what it wrote down and done again. So no publish ever
reads a run older than the last publish again, and those may be swept.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.operators.selection import one_per_key
from freshet.operators.skew import fits_broadcast
from freshet.plans.layers import GOLD_SUMS, gold_of, gold_sums, growth, name_history, silver_videos
from freshet.plans.quality import rule_report
from freshet.plans.store import RunStore
from freshet.schemas import CHANNEL_STATS, PUBLISHED, SILVER_VIDEOS, extended
from freshet.session import frozen, together, tune
from freshet.sinks.writers import overwrite_partitions, write_table
from freshet.sources.files import delete, empty, folders, read_or_empty

GOLD_KEYS = {
    "gold_by_channel": "channel_id",
    "gold_by_category": "category_id",
    "gold_by_language": "language",
    "gold_by_day": "published_day",
}
MEASURES = ["subscribers", "total_views", "video_count"]
#: Buckets of the silver table; fixed by its first publish.
BUCKETS = 64
_RUN = ("run", T.StringType())
_SPELL = T.StructType([T.StructField(n, k) for n, k in (("channel_id", T.StringType()), ("version", T.LongType()), ("channel_name", T.StringType()), ("valid_from", T.StringType()), ("valid_to", T.StringType()))])
_UNDONE = T.StructType([T.StructField("video_id", T.StringType()), T.StructField("bucket", T.IntegerType())])
_GROWTH = extended(CHANNEL_STATS, _RUN, *[(f"{m}_delta", T.LongType()) for m in MEASURES])


def video_rules() -> dict[str, Column]:
    """Row rules of the video table; the report adds the uniqueness of its key."""
    counts = ("view_count", "like_count", "comment_count", "duration")
    rules = {"key present": F.col("video_id").isNotNull(), "publish time parses": F.col("published_ts").isNotNull()}
    return rules | {f"{name} not negative": F.col(name) >= 0 for name in counts}


def _sum_schema(key: str) -> T.StructType:
    kind = T.DateType() if key == "published_day" else T.StringType()
    return T.StructType([T.StructField(key, kind), *[T.StructField(name, T.LongType()) for name in GOLD_SUMS]])


_DQ = T.StructType([T.StructField("rule", T.StringType()), T.StructField("violations", T.LongType())])
_STATE = {**{name: _sum_schema(key) for name, key in GOLD_KEYS.items()}, "rules": _DQ, "last_stats": extended(CHANNEL_STATS, _RUN), "open_spells": _SPELL}


@dataclass(frozen=True)
class Step:
    """One publish: the runs after ``after`` up to ``until``, on top of the state of version ``base``, in
    place of version ``undo`` if that is not 0."""

    version: int
    base: int
    after: str
    until: str
    commit: int
    buckets: int
    undo: int = 0


class Published:
    """What readers find below ``target``, and the steps that brought it there."""

    def __init__(self, spark: SparkSession, store: RunStore, target: str, buckets: int = BUCKETS):
        self.spark, self.store, self.target, self.buckets = spark, store, target, buckets

    def _path(self, step: Step | int, name: str) -> str:
        return f"{self.target}/published/version={step.version if isinstance(step, Step) else step}/{name}"

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        return read_or_empty(self.spark, path, schema, self.store.fmt)

    def _write(self, df: DataFrame, path: str) -> None:
        write_table(df, path, "overwrite", self.store.fmt)

    def silver(self) -> DataFrame:
        return self._read(f"{self.target}/silver_videos", extended(SILVER_VIDEOS, ("bucket", T.IntegerType())))

    def state(self, version: int, name: str) -> DataFrame:
        """What version ``version`` carries; version 0 is empty."""
        return self._read(self._path(version, name), _STATE[name]) if version else empty(self.spark, _STATE[name])

    def _last(self, table: str) -> Step | None:
        rows = self._read(f"{self.target}/published/{table}", PUBLISHED)
        found = rows.agg(F.max(F.struct(*PUBLISHED.names)).alias("last")).first()["last"]
        return Step(**found.asDict()) if found else None

    def last(self) -> Step | None:
        """The last publish that readers have."""
        return self._last("log")

    def next_step(self) -> Step | None:
        """The step to do now, or None if readers have all committed runs."""
        done, begun = self._last("log"), self._last("begun")
        if begun and (not done or begun.version > done.version):
            return begun
        commits = self.store.commits(self.spark)
        found = commits.agg(F.max(F.struct("run", "written")).alias("last"), F.max(F.when(F.col("run") == (done.until if done else ""), F.col("written"))).alias("same")).first()
        if found["last"] is None:
            return None
        version = done.version + 1 if done else 1
        last = {"until": found["last"]["run"], "commit": found["last"]["written"]}
        if done and found["same"] == done.commit:
            return Step(version, done.version, done.until, buckets=done.buckets, **last) if done.until < last["until"] else None
        if done:
            # Its last run is another one by now.
            return Step(version, done.base, done.after, buckets=done.buckets, undo=done.version, **last)
        return Step(version, 0, "", buckets=self.buckets, **last)

    def fresh(self, step: Step) -> DataFrame:
        """The silver rows that the step's runs bring, one per id, with their buckets."""
        videos = silver_videos(self.store.table(self.spark, "video_details", step.after, step.until))
        return videos.withColumn("bucket", F.pmod(F.xxhash64("video_id"), F.lit(step.buckets)).cast("int"))

    def replaced(self, step: Step, fresh: DataFrame) -> DataFrame:
        """The rows of silver whose ids come again. Only the buckets of these ids are read."""
        if not step.base:
            return self.silver().where(F.lit(False))
        before = self.silver().where(F.col("bucket").isin(_buckets(fresh)))
        if step.undo:
            before = before.join(_ids(self._staged(step.undo, "fresh")), "video_id", "left_anti").unionByName(self._staged(step.undo, "replaced"))
        return before.join(_ids(fresh), "video_id", "left_semi")

    def begin(self, step: Step) -> None:
        """Write down the rows that come and go and the state after them, and then that this is so."""
        spark, base = self.spark, step.base
        self._write(self.fresh(step), self._path(step, "fresh"))
        fresh = self._staged(step, "fresh")
        self._write(self.replaced(step, fresh), self._path(step, "replaced"))
        replaced = self._staged(step, "replaced")
        if step.undo:
            # Rows that the undone publish had replaced and this one does not.
            back = self._staged(step.undo, "replaced").join(_ids(fresh), "video_id", "left_anti")
            self._write(back, self._path(step, "restored"))
            self._write(self._staged(step.undo, "fresh").select("video_id", "bucket"), self._path(step, "undone"))

        out: dict[str, DataFrame] = {}
        for name, key in GOLD_KEYS.items():
            parts = [self.state(base, name), gold_sums(_dated(fresh), key), _negative(gold_sums(_dated(replaced), key), key)]
            out[name] = _added(parts, [key]).where("videos > 0")
        rules = [self.state(base, "rules"), rule_report(fresh, video_rules()), _negative(rule_report(replaced, video_rules()), "rule")]
        out["rules"] = _added(rules, ["rule"])

        snapshots = self.store.table(spark, "channel_stats", step.after, step.until)
        last = self.state(base, "last_stats")
        both = last.withColumn("new", F.lit(False)).unionByName(snapshots.withColumn("new", F.lit(True)))
        out["growth"] = growth(both, "channel_id", [F.col("run").asc()], MEASURES).where("new").select(*_GROWTH.names)
        out["last_stats"] = one_per_key(both.drop("new"), ["channel_id"], [F.col("run").desc()])

        spells = self.state(base, "open_spells")
        seen = spells.select("channel_id", "channel_name", F.col("valid_from").alias("run"))
        found = name_history(seen.unionByName(snapshots.select(*seen.columns)), "channel_id", "channel_name", "run")
        before = spells.select("channel_id", (F.col("version") - 1).alias("before"))
        numbered = found.join(before, "channel_id", "left").withColumn("version", F.col("version") + F.coalesce("before", F.lit(0)))
        out["spells"] = numbered.select(*_SPELL.names)
        together(spark, *[partial(self._write, df.select(*_STATE[name].names) if name in _STATE else df, self._path(step, name)) for name, df in out.items()])
        named = self._read(self._path(step, "spells"), _SPELL)
        self._write(named.where("valid_to is null"), self._path(step, "open_spells"))
        self._note("begun", step)

    def _staged(self, step: Step | int, name: str) -> DataFrame:
        return self._read(self._path(step, name), extended(SILVER_VIDEOS, ("bucket", T.IntegerType())))

    def _note(self, table: str, step: Step) -> None:
        row = self.spark.createDataFrame([tuple(getattr(step, name) for name in PUBLISHED.names)], PUBLISHED)
        self._write(row, f"{self.target}/published/{table}/version={step.version}")

    def finish(self, step: Step, resumed: bool) -> None:
        """Show readers what was written down; doing it again changes nothing."""
        if step.undo and step.base:
            self._undo_appended(step)
        jobs: list[Callable[[], None]] = [partial(self._apply_silver, step, resumed), partial(self._apply_names, step)]
        grown = self._read(self._path(step, "growth"), _GROWTH)
        jobs.append(partial(self._replace if not step.base else overwrite_partitions, grown, f"{self.target}/channel_growth", ["run"], self.store.fmt))
        for name, key in GOLD_KEYS.items():
            jobs.append(partial(self._write, gold_of(self.state(step.version, name), [key]), f"{self.target}/{name}"))
        together(self.spark, *jobs)
        self._apply_report(step)
        self._note("log", step)
        self._forget(step)

    def _replace(self, df: DataFrame, path: str, by: list[str], fmt: str) -> None:
        """A whole table anew, in folders."""
        write_table(df.hint("rebalance", *[F.col(c) for c in by]), path, "overwrite", fmt, tuple(by))

    def _apply_silver(self, step: Step, resumed: bool) -> None:
        fresh, path = self._staged(step, "fresh"), f"{self.target}/silver_videos"
        if not step.base:
            self._replace(fresh, path, ["bucket"], self.store.fmt)
            return
        # After a lost driver some buckets may hold their new rows already.
        touched, gone, back = set(_buckets(fresh if resumed else self._staged(step, "replaced"))), _ids(fresh), fresh
        if step.undo:
            undone = self._read(self._path(step, "undone"), _UNDONE)
            touched |= set(_buckets(undone))
            gone = _ids(fresh.select("video_id").unionByName(undone.select("video_id")))
            back = fresh.unionByName(self._staged(step, "restored"))
        if touched:
            kept = self.silver().where(F.col("bucket").isin(sorted(touched))).join(gone, "video_id", "left_anti")
            self._rewrite(kept.unionByName(back.where(F.col("bucket").isin(sorted(touched)))), path, sorted(touched))
        rest = fresh.where(~F.col("bucket").isin(sorted(touched))) if touched else fresh
        write_table(rest.hint("rebalance", F.col("bucket")), path, "append", self.store.fmt, ("bucket",))

    def _rewrite(self, rows: DataFrame, path: str, buckets: list[int]) -> None:
        """Replace these buckets; one that is left without rows goes."""
        rows = frozen(rows, "buckets")
        overwrite_partitions(rows, path, ["bucket"], self.store.fmt)
        empty = set(buckets) - set(_buckets(rows))
        self._delete(*[f"{path}/bucket={b}" for b in empty])

    def _undo_appended(self, step: Step) -> None:
        """Take back what the undone publish had appended: its runs' growth and the spells it finished."""
        path = f"{self.target}/channel_growth"
        runs = [name for name in folders(self.spark, path, "run=") if name > step.after]
        self._delete(*[f"{path}/run={name}" for name in runs], f"{self.target}/channel_names/current=false/publish={step.undo}")

    def _delete(self, *paths: str) -> None:
        for path in paths:
            delete(self.spark, path)

    def _apply_names(self, step: Step) -> None:
        """Finished spells stay below ``current=false``; the open ones are all below ``current=true``."""
        spells = self._read(self._path(step, "spells"), _SPELL)
        path = f"{self.target}/channel_names"
        if not step.base:
            self._replace(spells.withColumns({"current": F.col("valid_to").isNull(), "publish": F.when(F.col("valid_to").isNotNull(), step.version).otherwise(0)}), path, ["current", "publish"], self.store.fmt)
            return
        self._write(spells.where("valid_to is not null"), f"{path}/current=false/publish={step.version}")
        # Channels without a snapshot in these runs keep their spell.
        self._write(self.state(step.version, "open_spells"), f"{path}/current=true/publish=0")

    def _apply_report(self, step: Step) -> None:
        """Rules by their sums. Keys can only have become ambiguous in buckets that got rows."""
        ids = self.silver().where(F.col("bucket").isin(_buckets(self._staged(step, "fresh")))).select("video_id")
        unique = rule_report(ids, {}, unique="video_id")
        self._write(self.state(step.version, "rules").unionByName(unique), f"{self.target}/dq_report")

    def _forget(self, step: Step) -> None:
        """Only this step and the state it builds on are needed, in case it must be undone."""
        top = f"{self.target}/published"
        kept = {str(step.version), str(step.base)}
        self._delete(*[f"{top}/version={v}" for v in folders(self.spark, top, "version=") if v not in kept], self._path(step, "growth"))


def _ids(df: DataFrame) -> DataFrame:
    ids = df.select("video_id").distinct()
    return F.broadcast(ids) if fits_broadcast(ids) else ids


def _buckets(df: DataFrame) -> list[int]:
    """At most as many as silver has."""
    return sorted(r["bucket"] for r in df.select("bucket").distinct().collect())


def _dated(silver: DataFrame) -> DataFrame:
    return silver.withColumn("published_day", F.to_date("published_ts"))


def _negative(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, *[(-F.col(name)).alias(name) for name in df.columns if name != key])


def _added(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    whole = reduce(DataFrame.unionByName, parts)
    sums = [F.sum(name).alias(name) for name in whole.columns if name not in keys]
    return whole.groupBy(*keys).agg(*sums)


def publish(spark: SparkSession, store: RunStore, target: str, buckets: int = BUCKETS) -> list[Step]:
    """Bring silver videos, the four gold tables, channel growth, name history and the quality report up
    to the last committed run; the steps that this took."""
    tune(spark)
    published, steps = Published(spark, store, target, buckets), []
    while step := published.next_step():
        begun = published._last("begun")
        resumed = begun is not None and begun.version == step.version
        if not resumed:
            published.begin(step)
        published.finish(step, resumed)
        steps.append(step)
    return steps
