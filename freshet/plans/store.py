"""Durable run state on plain files.

Every run writes its own ``run=<stamp>`` folders and, last of all, a commit row. Readers only look at
runs with a commit row, so a run that died half-way is invisible and re-running a stamp replaces
exactly what it wrote before.

* ``done``: ids that need no further work. Append-only, never rewritten; every reader treats it as a set.
* ``open``: changes of the backlog. A run writes the ids it adds, tries or closes, and nothing for those
  that merely wait, so the backlog costs its size only when it is read.
* ``watermark``: the channels a run has moved.
* ``open_base``, ``watermark_base``: snapshots that ``BASE_RUNS`` runs write once, so that readers merge
  the changes of a bounded number of runs.
* ``cleared``: channels whose state ends with a run; a NULL channel stands for all. What earlier runs wrote
  about them is left out when state is read, and dropped for good when the store is compacted into a new
  ``epoch`` of ``done``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.operators.skew import fits_broadcast
from freshet.schemas import (
    CHANNEL_STATS,
    CLEARED,
    COMMIT,
    LEDGER,
    OPEN_CHANGE,
    QUARANTINE,
    RUN_AUDIT,
    RUN_SUMMARY,
    VIDEO_DETAILS,
    WATERMARK,
    extended,
)
from freshet.sinks.writers import write_table
from freshet.sources.files import delete, empty, read_or_empty


def utc(run_ts: datetime) -> datetime:
    """The instant as a plain UTC time: a time without a zone is UTC, wherever the driver runs."""
    return run_ts.astimezone(UTC).replace(tzinfo=None) if run_ts.tzinfo else run_ts


def stamp_of(run_ts: datetime) -> str:
    return utc(run_ts).strftime("%Y%m%d_%H%M%S")


def instant(run_ts: datetime) -> Column:
    """The same instant as a timestamp column, whatever the driver's and the session's zones."""
    since = utc(run_ts) - datetime(1970, 1, 1)
    return F.timestamp_micros(F.lit((since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds))


def plain(micros: int | None) -> datetime | None:
    """Microseconds as a plain UTC time."""
    return None if micros is None else datetime(1970, 1, 1) + timedelta(microseconds=micros)


BASE_RUNS = 24


@dataclass(frozen=True)
class State:
    """What the runs before this one left behind."""

    epoch: int
    repeated: bool
    watermark: DataFrame
    done: DataFrame
    open: DataFrame
    # The run whose snapshots this builds on ('' for none), and the runs committed since.
    base: str = ""
    since: int = 0
    # The last run that cleared channels.
    cleared: str = ""
    # The last committed run of all, which may be this one.
    newest: datetime | None = None

    @property
    def ledger(self) -> DataFrame:
        return self.done.unionByName(self.open)


@dataclass(frozen=True)
class RunStore:
    root: str
    fmt: str = "parquet"
    # Runs whose changes a reader of the state merges, at most.
    base_runs: int = BASE_RUNS

    TABLES = {
        "channel_stats": CHANNEL_STATS,
        "video_details": VIDEO_DETAILS,
        "quarantine": QUARANTINE,
        "late": LEDGER,
        "given_up": LEDGER,
        "audit": RUN_AUDIT,
        "open": OPEN_CHANGE,
        "open_base": LEDGER,
        "watermark": WATERMARK,
        "watermark_base": WATERMARK,
        "cleared": CLEARED,
        "commits": COMMIT,
    }

    def _done_path(self, epoch: int) -> str:
        return f"{self.root}/done/epoch={epoch}"

    def _read(self, spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
        return read_or_empty(spark, path, extended(schema, ("run", T.StringType())), self.fmt)

    def write(self, df: DataFrame, table: str, run_ts: datetime) -> None:
        ordered = df.select(*self.TABLES[table].names)
        write_table(ordered, f"{self.root}/{table}/run={stamp_of(run_ts)}", "overwrite", self.fmt)

    def write_done(self, df: DataFrame, epoch: int, run_ts: datetime) -> None:
        ordered = df.select(*LEDGER.names)
        write_table(ordered, f"{self._done_path(epoch)}/run={stamp_of(run_ts)}", "overwrite", self.fmt)

    def stage(self, df: DataFrame, name: str, run_ts: datetime) -> DataFrame:
        """Write an intermediate result of the current run and read it back: later steps scan only
        the columns they need, and a lost executor costs no recomputation. Every run has staging
        tables of its own, which go when it is committed."""
        path = f"{self.root}/staging/run={stamp_of(run_ts)}/{name}"
        write_table(df, path, "overwrite", self.fmt)
        return df.sparkSession.read.schema(df.schema).format(self.fmt).load(path)

    def commit(self, spark: SparkSession, epoch: int, run_ts: datetime, base: str = "", since: int = 0, cleared: str = "", summary: dict | None = None) -> None:
        totals = F.struct(*[F.lit(summary[name]).cast("bigint").alias(name) for name in RUN_SUMMARY.names]) if summary else F.lit(None).cast(RUN_SUMMARY)
        columns = {"epoch": F.lit(epoch).cast("bigint"), "base": F.lit(base), "since": F.lit(since).cast("bigint"), "cleared": F.lit(cleared), "summary": totals}
        self.write(spark.range(1).select(instant(run_ts).alias("run_ts"), *[c.alias(name) for name, c in columns.items()]), "commits", run_ts)

    def snapshot(self, state: State, run_ts: datetime) -> str:
        """Write the whole backlog and all watermarks, for the commit of this run to name."""
        self.write(state.open, "open_base", run_ts)
        self.write(state.watermark, "watermark_base", run_ts)
        return stamp_of(run_ts)

    def committed_runs(self, spark: SparkSession) -> DataFrame:
        """What every commit names: its run, epoch, snapshots and last clearing."""
        return self._read(spark, f"{self.root}/commits", COMMIT).select("run", "epoch", "base", "cleared")

    def summaries(self, spark: SparkSession) -> DataFrame:
        """The totals of every committed run."""
        rows = self._read(spark, f"{self.root}/commits", COMMIT).where("summary is not null")
        return rows.select("run", "run_ts", "summary.*")

    def finish(self, spark: SparkSession, state: State, run_ts: datetime, summary: dict | None = None) -> None:
        """Commit a run that found ``state``; its changes are written. Once in ``base_runs`` runs it also
        writes the snapshots that later runs build on."""
        base, since = state.base, state.since + 1
        if since >= self.base_runs:
            own = {"run": stamp_of(run_ts), "epoch": state.epoch, "base": state.base, "since": since, "cleared": state.cleared}
            base, since = self.snapshot(self._state(spark, own, state.repeated, committed=False), run_ts), 0
        self.commit(spark, state.epoch, run_ts, base, since, state.cleared, summary)

    def unstage(self, spark: SparkSession, run_ts: datetime) -> None:
        """Drop the staging tables of a committed run."""
        delete(spark, f"{self.root}/staging/run={stamp_of(run_ts)}")

    def drop(self, spark: SparkSession, table: str, run_ts: datetime) -> None:
        """Remove what one run wrote to a table."""
        delete(spark, f"{self.root}/{table}/run={stamp_of(run_ts)}")

    def withdraw(self, spark: SparkSession, run_ts: datetime) -> None:
        """Before a committed run is repeated: hide it until it is whole again."""
        self.write(empty(spark, COMMIT), "commits", run_ts)

    def run(self, spark: SparkSession, table: str, run_ts: datetime) -> DataFrame:
        """Rows one run wrote, committed or not."""
        return self._read(spark, f"{self.root}/{table}", self.TABLES[table]).where(
            F.col("run") == stamp_of(run_ts)
        ).drop("run")

    def table(self, spark: SparkSession, table: str, after: str = "", until: str | None = None) -> DataFrame:
        """All committed rows of a table with their ``run`` stamp; only the folders of runs later than
        ``after`` and up to ``until``, where given, are listed."""
        asked = F.col("run") > after
        asked = asked if until is None else asked & (F.col("run") <= until)
        commits = self._read(spark, f"{self.root}/commits", COMMIT).where(asked).select("run")
        return self._read(spark, f"{self.root}/{table}", self.TABLES[table]).where(asked).join(commits, "run", "left_semi")

    def commits(self, spark: SparkSession) -> DataFrame:
        """``run, written`` of the committed runs: the stamp, and when its commit row was written in
        microseconds, which tells a repeated run from its first form."""
        rows = self._read(spark, f"{self.root}/commits", COMMIT)
        # An empty table has no files that could be asked for their time.
        written = F.unix_micros("_metadata.file_modification_time") if rows.inputFiles() else F.lit(0).cast("bigint")
        return rows.select("run", written.alias("written"))

    def load(self, spark: SparkSession, before: datetime) -> State:
        """State as of the last commit before ``before``."""
        every = self._read(spark, f"{self.root}/commits", COMMIT)
        is_before, is_this = F.col("run") < stamp_of(before), F.col("run") == stamp_of(before)
        names = ("run", "epoch", "base", "since", "cleared")
        found = every.agg(
            F.max(F.when(is_before, F.struct(*names))).alias("last"),
            F.bool_or(is_this).alias("repeated"),
            F.max(F.unix_micros("run_ts")).alias("newest"),
        ).first()
        last, repeated, newest = found["last"], bool(found["repeated"]), plain(found["newest"])
        if last is None:
            return State(0, repeated, *[empty(spark, schema) for schema in (WATERMARK, LEDGER, LEDGER)], newest=newest)
        return replace(self._state(spark, last.asDict(), repeated), newest=newest)

    def _state(self, spark: SparkSession, last: dict, repeated: bool, committed: bool = True) -> State:
        """The state after the run ``last``, whether it is committed already or about to be."""
        run, base = F.col("run"), last["base"]
        # The plain filter prunes folders before the plan runs: a repeated run may replace its own.
        commits = self._read(spark, f"{self.root}/commits", COMMIT).where(run <= last["run"] if committed else run < last["run"])
        known = commits.select("run", "epoch")
        if not committed:
            own = spark.range(1).select(F.lit(last["run"]).alias("run"), F.lit(last["epoch"]).cast("bigint").alias("epoch"))
            known = known.unionByName(own)
        ended = self._ended(spark, known, last["cleared"]) if last["cleared"] else (None, None)

        def alive(rows: DataFrame) -> DataFrame:
            for_all, channels = ended
            if for_all:
                rows = rows.where(run >= for_all)
            if channels is not None:
                cut = rows.join(channels, "channel_id", "left")
                rows = cut.where(F.col("ended").isNull() | (run >= F.col("ended"))).drop("ended")
            return rows

        def changes(table: str) -> DataFrame:
            since = self._read(spark, f"{self.root}/{table}", self.TABLES[table]).where((run > base) & (run <= last["run"]))
            return since.join(known.select("run"), "run", "left_semi")

        def kept(table: str) -> DataFrame:
            return self._read(spark, f"{self.root}/{table}_base", self.TABLES[f"{table}_base"]).where(run == base)

        def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
            rest = [name for name in rows.columns if name not in (*keys, "run")]
            newest = rows.groupBy(*keys).agg(F.max(F.struct("run", *rest)).alias("newest"))
            return newest.select(*keys, *[F.col(f"newest.{name}").alias(name) for name in rest])

        backlog = kept("open").withColumn("closed", F.lit(False)).unionByName(changes("open"))
        opened = latest(alive(backlog), ["channel_id", "video_id"]).where(~F.col("closed")).select(*LEDGER.names)
        marks = latest(alive(kept("watermark").unionByName(changes("watermark"))), ["channel_id"]).select(*WATERMARK.names)
        of_epoch = known.where(F.col("epoch") == last["epoch"]).select("run")
        earlier = self._read(spark, self._done_path(last["epoch"]), LEDGER).where(run <= last["run"])
        done = alive(earlier.join(of_epoch, "run", "left_semi")).drop("run")
        return State(last["epoch"], repeated, marks, done, opened, base, last["since"], last["cleared"])

    def _ended(self, spark: SparkSession, known: DataFrame, until: str) -> tuple[str | None, DataFrame | None]:
        """The run with which all state ended, if any, and the runs with which that of single channels did."""
        cleared = self._read(spark, f"{self.root}/cleared", CLEARED).where(F.col("run") <= until).join(known.select("run"), "run", "left_semi")
        found = cleared.agg(F.max(F.when(F.col("channel_id").isNull(), F.col("run"))).alias("all"), F.count("channel_id").alias("n")).first()
        if not found["n"]:
            return found["all"], None
        single = cleared.where("channel_id is not null").groupBy("channel_id").agg(F.max("run").alias("ended"))
        return found["all"], F.broadcast(single) if fits_broadcast(cleared) else single

    def admit(self, spark: SparkSession, run_ts: datetime) -> State:
        """The state for a run at ``run_ts``, which must not come before the last commit.

        Only the last committed run may be repeated: an older one would build on a backlog that later
        runs have worked off, and their rows would be lost. Two runs within a second have one stamp.
        """
        state = self.load(spark, run_ts)
        newest = state.newest
        if newest and stamp_of(newest) > stamp_of(run_ts):
            raise ValueError(f"run {stamp_of(newest)} is committed; {stamp_of(run_ts)} comes before it")
        if newest and stamp_of(newest) == stamp_of(run_ts) and newest != utc(run_ts):
            raise ValueError(f"another run within the second {stamp_of(run_ts)} is committed")
        return state

    def committed(self, spark: SparkSession, run_ts: datetime) -> bool:
        return not self._read(spark, f"{self.root}/commits", COMMIT).where(F.col("run") == stamp_of(run_ts)).isEmpty()

    def newest(self, spark: SparkSession) -> datetime | None:
        """The time of the last committed run, plain UTC."""
        return plain(self._read(spark, f"{self.root}/commits", COMMIT).agg(F.max(F.unix_micros("run_ts"))).first()[0])

    def clear(self, spark: SparkSession, run_ts: datetime, channels: DataFrame | None = None) -> bool:
        """Forget the listed channels, or everything; False when there is no state to clear. A row for
        each channel is written and nothing else."""
        state = self._load_unused(spark, run_ts)
        if state.watermark.isEmpty() and state.ledger.isEmpty():
            return False
        named = spark.range(1).select(F.lit(None).cast("string").alias("channel_id")) if channels is None else channels.where("channel_id is not null")
        self.write(named.select("channel_id").distinct(), "cleared", run_ts)
        self.commit(spark, state.epoch, run_ts, state.base, state.since + 1, stamp_of(run_ts))
        return True

    def compact(self, spark: SparkSession, run_ts: datetime) -> bool:
        """Rewrite the state as one folder a table, without what was cleared, once many runs have added to
        it; False when there is none. Earlier epochs and snapshots may go."""
        state = self._load_unused(spark, run_ts)
        if state.watermark.isEmpty() and state.ledger.isEmpty():
            return False
        self.write_done(state.done, state.epoch + 1, run_ts)
        self.commit(spark, state.epoch + 1, run_ts, self.snapshot(state, run_ts))
        return True

    def _load_unused(self, spark: SparkSession, run_ts: datetime) -> State:
        state = self.admit(spark, run_ts)
        if state.repeated:
            raise ValueError(f"a committed run already has the stamp {stamp_of(run_ts)}")
        return state

    def seed(self, spark: SparkSession, run_ts: datetime, ids: DataFrame, watermark: DataFrame) -> None:
        """Start an empty store from imported state documents: every id counts as fetched."""
        ledger = ids.select(
            "channel_id",
            "video_id",
            F.lit(None).cast("timestamp").alias("published_ts"),
            instant(run_ts).alias("first_seen_run"),
            F.lit("fetched").alias("status"),
            F.lit(1).cast("bigint").alias("attempts"),
        )
        state = self._load_unused(spark, run_ts)
        if not (state.watermark.isEmpty() and state.ledger.isEmpty()):
            raise ValueError("the store has state of its own; clear it before seeding")
        self.write_done(ledger, state.epoch + 1, run_ts)
        self.write(watermark, "watermark", run_ts)
        self.commit(spark, state.epoch + 1, run_ts, state.base, state.since + 1, state.cleared)
