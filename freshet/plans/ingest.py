"""One run: landed responses in, flat tables, state and audit out, as Spark plans over all channels."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial, reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from freshet.functions.scalars import LOOKBACK_MINUTES
from freshet.operators.counters import flagged, summary_metrics, upload_status
from freshet.operators.selection import (
    after_bound,
    anti_seen,
    beyond_cap,
    cap_per_key,
    driven_by,
    enrich,
    one_per_key,
    seen_among,
    with_bound,
)
from freshet.operators.skew import fits_broadcast
from freshet.operators.state import FETCHED, MISSING, PENDING
from freshet.plans.store import BASE_RUNS, RunStore, State, instant, stamp_of, utc
from freshet.schemas import CHANNEL_STATS, LEDGER, QUARANTINE, RUN_AUDIT, VIDEO_DETAILS
from freshet.session import together, tune
from freshet.sinks.writers import MODES, SAVE_FORMATS, save_run, save_table, write_snapshot
from freshet.sources.files import empty, read_channel_list, read_csv
from freshet.sources.isolation import isolated
from freshet.sources.landing import (
    ITEMS,
    blocking,
    channel_rows,
    channel_stats,
    complete_answers,
    read_envelopes,
    rejected,
    search_items,
    search_rows,
    video_details,
    video_rows,
)

# Fixed value: ids one channel may contribute to one run.
CAP = 200
ID = ["channel_id", "video_id"]
# A search result's place as one number: the page, and the position in it.
PAGE_ITEMS, PLACE = 1 << 31, "decimal(38,0)"
# The turn of candidates that earlier runs left open.
BACKLOG = 0
FLATTEN = {"channels": channel_rows, "search": search_rows, "videos": video_rows}


@dataclass(frozen=True)
class RunConf:
    landing: str
    root: str
    channel_list: str
    run_ts: datetime
    incremental: bool = True
    cap: int = CAP
    lookback_minutes: int = LOOKBACK_MINUTES
    # Runs after which an id without details is given up and reported; None asks for it for ever.
    max_attempts: int | None = None
    # Take the newest page of the search as the whole answer.
    first_page_only: bool = False
    # "table" keeps the run's tables in the store, "csv" writes them below ``export`` instead, "both" does both.
    save: str = "table"
    upload: bool = True
    export: str | None = None
    # Beginning of the names of two catalog tables that get the run's rows too, for instance "media.daily_".
    # "append" adds the run as a partition, once however often it is repeated; the other modes are plain.
    catalog: str | None = None
    catalog_mode: str = "append"
    fmt: str = "parquet"
    multi_line: bool = False
    # Channels with fewer videos in a run count as alerts.
    min_videos: int = 1
    # Runs from one snapshot of the state to the next.
    base_runs: int = BASE_RUNS

    def __post_init__(self):
        if self.save not in SAVE_FORMATS:
            raise ValueError(f"save must be one of {SAVE_FORMATS}")
        if self.catalog_mode not in MODES:
            raise ValueError(f"catalog_mode must be one of {MODES}")


@dataclass(frozen=True)
class RunResult:
    channels: DataFrame
    videos: DataFrame
    audit: DataFrame
    quarantine: DataFrame
    late: DataFrame
    given_up: DataFrame
    ran: bool
    export: str
    # Totals of the run, see RUN_SUMMARY.
    summary: dict[str, int] = field(default_factory=dict)


def _no_run(spark: SparkSession) -> RunResult:
    schemas = (CHANNEL_STATS, VIDEO_DETAILS, RUN_AUDIT, QUARANTINE, LEDGER, LEDGER)
    return RunResult(*[empty(spark, s) for s in schemas], ran=False, export="skipped")


def _turn(df: DataFrame, turn: int, **known) -> DataFrame:
    """Candidate rows of one source; columns the source does not know are NULL or defaults."""
    columns = {
        "published_ts": F.lit(None).cast("timestamp"),
        "place": F.lit(None).cast("struct<page_no:bigint,pos:bigint>"),
        "first_seen_run": F.lit(None).cast("timestamp"),
        "status": F.lit(PENDING),
        "attempts": F.lit(0).cast("bigint"),
        **known,
    }
    return df.select(*ID, F.lit(turn).alias("turn"), *[c.alias(name) for name, c in columns.items()])


def _candidates(found: DataFrame, backlog: DataFrame, refresh: DataFrame | None, incremental: bool) -> DataFrame:
    """Ids this run may take, one row each: backlog first, then asked-for refreshes, then new ids."""
    fresh = found.where("not waiting and not cached" if incremental else "not waiting")
    carried = {name: F.col(name) for name in ("published_ts", "first_seen_run", "status", "attempts")}
    parts = [
        _turn(backlog, BACKLOG, **carried),
        _turn(fresh, 2, published_ts=F.col("published_ts"), place=F.col("place")),
    ]
    if refresh is None:
        return reduce(DataFrame.unionByName, parts)
    parts.append(_turn(refresh, 1))
    return one_per_key(reduce(DataFrame.unionByName, parts), ID, [F.col("turn")])


def _order() -> list:
    return [F.col("turn"), F.col("published_ts").desc_nulls_last(), F.col("place").asc_nulls_last(), F.col("video_id")]


def _offered(store: RunStore, items: DataFrame, small: bool, state: State, backlog: DataFrame, conf: RunConf) -> DataFrame:
    """Distinct search results: ``inside`` the bound, already ``cached`` (taken) or ``waiting`` (open).

    One pass and one look at the ledger serve the new ids, the counters and the late report. Results and
    ledger rows meet in one hash aggregation: all its values are fixed width, so nothing is sorted.
    """
    bounded = with_bound(items, state.watermark, "channel_id", "last_fetch_ts", conf.lookback_minutes)
    inside = after_bound("published_ts") if conf.incremental else F.lit(True)
    # A page holds fewer than PAGE_ITEMS items, so page and position make one number.
    place = F.col("page_no").cast(PLACE) * PAGE_ITEMS + F.col("pos")
    offers = bounded.select(*ID, "published_ts", place.cast(PLACE).alias("at"), inside.alias("inside"), F.lit(None).cast("boolean").alias("taken"))
    taken = state.done.select(*ID, F.lit(True).alias("taken"))
    known = seen_among(items, taken.unionByName(backlog.select(*ID, F.lit(False).alias("taken"))), ID, small, keep=["taken"])
    met = offers.unionByName(known, allowMissingColumns=True).groupBy(*ID).agg(
        F.min("published_ts").alias("published_ts"),
        F.min("at").alias("at"),
        F.max("inside").alias("inside"),
        F.coalesce(F.bool_or("taken"), F.lit(False)).alias("cached"),
        F.coalesce(F.bool_or(~F.col("taken")), F.lit(False)).alias("waiting"),
    )
    # What only the ledger has was not offered.
    ids = met.where("inside is not null")
    page = F.floor(F.col("at") / PAGE_ITEMS).cast("bigint")
    spot = F.pmod("at", F.lit(PAGE_ITEMS).cast(PLACE)).cast("bigint")
    placed = ids.select(*ID, "published_ts", F.struct(page.alias("page_no"), spot.alias("pos")).alias("place"), "inside", "cached", "waiting")
    return store.stage(placed, "offered", conf.run_ts)


def _changes(store, conf, active, selected, retrieved, pending) -> dict[str, DataFrame]:
    """What this run does to the state: ids finished, ids that open, stay open or close, channels moved."""
    run = instant(conf.run_ts)
    taken = flagged(selected, retrieved, ID, "retrieved").withColumn("attempts", F.col("attempts") + 1)
    # Three tables are filters over what became of the selected ids.
    outcome = store.stage(taken.withColumn("status", F.when(F.col("retrieved"), FETCHED).otherwise(MISSING)), "outcome", conf.run_ts)
    tried = F.lit(False) if conf.max_attempts is None else F.col("attempts") >= conf.max_attempts
    closed = F.col("retrieved") | tried
    seen_first = F.coalesce("first_seen_run", run).alias("first_seen_run")
    columns = [*ID, "published_ts", seen_first, "status", "attempts"]
    # Of the selected ids those of the backlog may close; what was in it and still waits has not changed.
    tried_ids = outcome.where(~closed | (F.col("turn") == BACKLOG)).select(*columns, closed.alias("closed"))
    waiting = pending.where(F.col("turn") != BACKLOG).select(*columns, F.lit(False).alias("closed"))
    return {
        "done": outcome.where(closed).select(*columns),
        "given_up": outcome.where(closed & ~F.col("retrieved")).select(*columns),
        "open": tried_ids.unionByName(waiting),
        "watermark": active.select("channel_id", run.alias("last_fetch_ts"), run.alias("updated_at")),
    }


def _audit(listed, active, blocked, found, selected, retrieved, conf) -> DataFrame:
    counts = found.groupBy("channel_id").agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(F.col("cached") | F.col("waiting")).alias("cached"),
    )
    taken = selected.groupBy("channel_id").agg(F.count(F.lit(1)).alias("selected"))
    answered = retrieved.groupBy("channel_id").agg(F.count(F.lit(1)).alias("retrieved"))
    rows = listed
    for side in (counts, taken, answered, active.withColumn("ok", F.lit(True)), blocked):
        rows = rows.join(side, "channel_id", "left")

    def number(name: str):
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    return rows.select(
        instant(conf.run_ts).alias("run_ts"),
        "channel_id",
        number("found"),
        number("cached"),
        (F.coalesce("found", F.lit(0)) - F.coalesce("cached", F.lit(0))).alias("new"),
        number("selected"),
        number("retrieved"),
        F.when(F.col("ok"), "ok").otherwise("failed").alias("status"),
        F.when(F.col("ok").isNull(), F.coalesce("error", F.lit("no channel response"))).alias("error"),
    )


SNAPSHOTS = {"channel_stats": CHANNEL_STATS, "video_details": VIDEO_DETAILS}


def _export(store: RunStore, spark: SparkSession, conf: RunConf) -> tuple[str, dict[str, list[str]]]:
    """CSV snapshot of both tables in the hour of the run, whatever becomes of it afterwards; ``upload``
    only decides whether it counts as handed on. The outcome, and the files of each table."""
    if conf.save == "table":
        return upload_status(False, None), {}
    if not conf.export:
        return upload_status(conf.upload, conf.export), {}
    hour, files = utc(conf.run_ts).strftime("year=%Y/month=%m/day=%d/hour=%H"), {}
    try:
        for table in SNAPSHOTS:
            rows = store.run(spark, table, conf.run_ts)
            files[table] = write_snapshot(rows, f"{conf.export}/{table}/{hour}", table, stamp_of(conf.run_ts))
    except (PySparkException, Py4JError, OSError) as error:
        # The rows are in the store: a failed copy must not cost the run its state.
        warnings.warn(f"export to {conf.export} failed: {error}", stacklevel=2)
        return upload_status(True, conf.export, succeeded=False), {}
    return upload_status(conf.upload, conf.export), files


def _save(store: RunStore, spark: SparkSession, conf: RunConf) -> None:
    """Both tables of the run in the session's catalog, if asked for."""
    for table in SNAPSHOTS if conf.catalog is not None else ():
        rows, name = store.run(spark, table, conf.run_ts), f"{conf.catalog}{table}"
        if conf.catalog_mode == "append":
            save_run(rows, name, stamp_of(conf.run_ts), conf.fmt)
        else:
            save_table(rows, name, conf.catalog_mode, conf.fmt)


def _staged(spark: SparkSession, store: RunStore, conf: RunConf, kind: str) -> DataFrame:
    """The flattened responses of one kind; files that cannot be read are rejected and cost no other."""
    folder = f"{conf.landing}/{kind}"

    def stage(unreadable: list[str]) -> DataFrame:
        pages = read_envelopes(spark, folder, ITEMS[kind], conf.multi_line, unreadable)
        return store.stage(FLATTEN[kind](pages), f"{kind}_rows", conf.run_ts)

    return isolated(spark, folder, stage)


def run_job(spark: SparkSession, conf: RunConf, refresh: DataFrame | None = None) -> RunResult:
    """Videos first, state and reports next, the commit row last: until then the run is invisible."""
    tune(spark)
    listing = read_channel_list(spark, conf.channel_list)
    if listing is None:
        return _no_run(spark)
    store = RunStore(conf.root, conf.fmt, conf.base_runs)
    state = store.admit(spark, conf.run_ts)
    if state.repeated:
        store.withdraw(spark, conf.run_ts)

    # The list is parsed once, next to the responses.
    known = listing.where(F.col("channel_id").isNotNull()).select("channel_id").distinct()
    listed, *frames = together(
        spark,
        partial(store.stage, known, "listed", conf.run_ts),
        *[partial(_staged, spark, store, conf, kind) for kind in FLATTEN],
    )
    rows = dict(zip(FLATTEN, frames))
    rejects = reduce(DataFrame.unionByName, [rejected(frame, name) for name, frame in rows.items()])
    incomplete = listed.join(complete_answers(rows["search"], conf.first_page_only), "channel_id", "left_anti")
    whole = incomplete.withColumn("incomplete", F.lit("incomplete answer"))
    blocked = blocking(rejects).join(whole, "channel_id", "full").select("channel_id", F.coalesce("error", "incomplete").alias("error"))
    blocked = store.stage(blocked, "blocked", conf.run_ts)
    stats = channel_stats(rows["channels"]).join(blocked, "channel_id", "left_anti")
    store.write(driven_by(stats, listed, "channel_id"), "channel_stats", conf.run_ts)
    channels = store.run(spark, "channel_stats", conf.run_ts)
    active = channels.select("channel_id")

    items = driven_by(search_items(rows["search"]), active, "channel_id")
    backlog = store.stage(driven_by(state.open, active, "channel_id"), "backlog", conf.run_ts)
    offered = _offered(store, items, fits_broadcast(rows["search"].select(*ID)), state, backlog, conf)
    found = offered.where("inside")
    late = offered.where("not inside and not cached and not waiting")
    asked = None if refresh is None else driven_by(refresh.select(*ID).distinct(), active, "channel_id")
    # Filters over written tables, unless refreshes had to be merged in.
    candidates = _candidates(found, backlog, asked, conf.incremental)
    candidates = candidates if asked is None else store.stage(candidates, "candidates", conf.run_ts)
    selected = store.stage(cap_per_key(candidates, "channel_id", "video_id", _order(), conf.cap).drop("rn"), "selected", conf.run_ts)
    pending = beyond_cap(candidates, selected, ID)

    # Names go to the ids, so that the wide rows are shuffled once, by their id. Only the wanted details
    # are put in order and reduced to one row each.
    owners = enrich(selected.select(*ID), channels, "channel_id", ["channel_name"])
    videos = one_per_key(video_details(rows["videos"]).join(owners, "video_id"), ID, [])
    store.write(videos, "video_details", conf.run_ts)
    retrieved = store.run(spark, "video_details", conf.run_ts).select(*ID)

    exported, files = _export(store, spark, conf)
    _save(store, spark, conf)

    tables = _changes(store, conf, active, selected, retrieved, pending)
    # A refresh, a full run, or the backlog such a run has left may hold ids that are done already.
    finished = anti_seen(tables.pop("done"), state.done, ID, fits_broadcast(selected.select(*ID)))
    tables["quarantine"] = rejects
    tables["late"] = _late_rows(late)
    # The totals are counted on the way, while the audit is written.
    totals = Observation()
    audit = _audit(listed, active, blocked, found, selected, retrieved, conf)
    tables["audit"] = audit.observe(totals, *[c.alias(name) for name, c in summary_metrics(conf.min_videos).items()])
    together(
        spark,
        partial(store.write_done, finished, state.epoch, conf.run_ts),
        *[partial(store.write, df, table, conf.run_ts) for table, df in tables.items()],
    )
    summary = dict(totals.get)
    store.finish(spark, state, conf.run_ts, summary)
    store.unstage(spark, conf.run_ts)

    if conf.save == "csv" and files:
        # The files are the only copy; nothing that comes later reads the tables of a run.
        for table in SNAPSHOTS:
            store.drop(spark, table, conf.run_ts)
        channels = read_csv(spark, files["channel_stats"], CHANNEL_STATS)
    written = {t: store.run(spark, t, conf.run_ts) for t in ("video_details", "audit", "quarantine", "late", "given_up")}
    if conf.save == "csv" and files:
        written["video_details"] = read_csv(spark, files["video_details"], VIDEO_DETAILS)
    return RunResult(
        channels, written["video_details"], written["audit"], written["quarantine"], written["late"], written["given_up"], True, exported, summary
    )


def _late_rows(late: DataFrame) -> DataFrame:
    return late.select(
        *ID,
        "published_ts",
        F.lit(None).cast("timestamp").alias("first_seen_run"),
        F.lit("late").alias("status"),
        F.lit(0).cast("bigint").alias("attempts"),
    )
