"""Whole runs over landed responses: a first run, the incremental run after it, and its audit."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import Window
from pyspark.sql import functions as F

from freshet.catalog.base import CUTOFF_SQL, DURATION_SQL, K_SQL, earlier, events, query, table
from freshet.catalog.landed import channel_envelopes, empty_answers, land, search_envelopes, video_envelopes
from freshet.plans.ingest import RunConf, run_job
from freshet.plans.publish import publish
from freshet.plans.store import RunStore
from freshet.session import together, working_dir
from freshet.sinks.writers import write_csv
from freshet.streaming.arrivals import READY, arrivals, run_arrivals

CAP = 20
FIRST, SECOND = datetime(2024, 1, 15), datetime(2024, 2, 1)

# Errors are found by the search but their details never come back.
_FIRST = f"""first as (select *, row_number() over (partition by user_id order by ts desc, cast(event_id as varchar)) as rn
             from events where ts < {CUTOFF_SQL}),
    taken1 as (select * from first where rn <= {CAP} and event_type != 'error')"""

_SECOND = f"""{_FIRST},
    backlog as (select event_id, 0 as turn from first where rn > {CAP} or event_type = 'error'),
    offered as (select event_id, turn from backlog union all select event_id, 2 from events where ts >= {CUTOFF_SQL}),
    second as (select e.*, turn, row_number() over (partition by user_id order by turn, ts desc, cast(event_id as varchar)) as rn
               from offered join events e using (event_id)),
    taken2 as (select * from second where rn <= {CAP} and event_type != 'error')"""


def _videos_sql(source: str) -> str:
    return f"""select cast(event_id as varchar) as video_id, cast(user_id as varchar) as channel_id, c_name as channel_name,
        {K_SQL} as view_count, cast({DURATION_SQL} as bigint) as duration, event_type || ',y' as tags, 'en' as language
        from {source} join customer on c_custkey = user_id"""


def _land(spark, sf, base, df, spoil=None):
    customers = table(spark, sf, "customer")
    pages = search_envelopes(df).unionByName(empty_answers(customers, df))
    together(
        spark,
        partial(land, channel_envelopes(customers), f"{base}/channels"),
        partial(land, spoil(pages) if spoil else pages, f"{base}/search/whole"),
        partial(land, video_envelopes(df.where("event_type != 'error'")), f"{base}/videos"),
    )


def _runs(spark, sf, runs, spoil=None, **options):
    base = working_dir(spark, "ingest")
    listed = table(spark, sf, "customer").select(F.col("c_name").alias("channel_name"), F.col("c_custkey").alias("channel_id"))
    write_csv(listed, f"{base}/list")
    result = None
    for step, (name, (run_ts, df)) in enumerate(runs.items()):
        _land(spark, sf, f"{base}/{name}", df, None if step else spoil)
        conf = RunConf(f"{base}/{name}", f"{base}/store", f"{base}/list", run_ts, **{"cap": CAP, **options})
        result = run_job(spark, conf)
    return result


def _first(spark, sf):
    return _runs(spark, sf, {"first": (FIRST, earlier(events(spark, sf)))})


def _second(spark, sf):
    df = events(spark, sf)
    return _runs(spark, sf, {"first": (FIRST, earlier(df)), "second": (SECOND, df)})


def _shown(result):
    return result.videos.select("video_id", "channel_id", "channel_name", "view_count", "duration", "tags", "language")


@query("ingest_first_run", f"with {_FIRST} {_videos_sql('taken1')}")
def ingest_first_run(spark, sf):
    return _shown(_first(spark, sf))


@query("ingest_second_run", f"with {_SECOND} {_videos_sql('taken2')}")
def ingest_second_run(spark, sf):
    return _shown(_second(spark, sf))


@query(
    "ingest_audit",
    f"""with {_SECOND},
        f as (select user_id, count(*) as found from events where ts > {CUTOFF_SQL} - interval 10 minute group by 1),
        c as (select user_id, count(*) as cached from events where ts > {CUTOFF_SQL} - interval 10 minute and ts < {CUTOFF_SQL} group by 1),
        s as (select user_id, count(*) as selected, count(*) filter (where event_type != 'error') as retrieved from second where rn <= {CAP} group by 1)
        select cast(c_custkey as varchar) as channel_id, coalesce(found, 0) as found, coalesce(cached, 0) as cached,
               coalesce(found, 0) - coalesce(cached, 0) as new, coalesce(selected, 0) as selected,
               coalesce(retrieved, 0) as retrieved, 'ok' as status
        from customer left join f on f.user_id = c_custkey left join c on c.user_id = c_custkey left join s on s.user_id = c_custkey""",
)
def ingest_audit(spark, sf):
    return _second(spark, sf).audit.drop("run_ts", "error")


def _spoiled(pages):
    """Search answers that are not whole: of every fourth user no page at all; of the next the last page
    announces another; of the next the first page is lost."""
    user = F.col("channel_id").cast("bigint")
    last = F.max("page_no").over(Window.partitionBy("channel_id"))
    promised = F.when((user % 4 == 1) & (F.col("page_no") == last), F.lit("next")).alias("nextPageToken")
    marked = pages.select("channel_id", "page_no", "items", promised)
    lost = (user % 4 == 0) | ((user % 4 == 2) & (F.col("page_no") == 0))
    return marked.where(~lost)


@query(
    "ingest_incomplete_pages",
    f"""with offered as (select * from events where ts < {CUTOFF_SQL} and event_type != 'error' and user_id % 4 != 3)
        {_videos_sql('offered')}""",
)
def ingest_incomplete_pages(spark, sf):
    """What the run after spoiled answers takes: everything of the users whose answers were not whole."""
    df = earlier(events(spark, sf))
    runs = {"first": (FIRST, df), "second": (SECOND, df)}
    return _shown(_runs(spark, sf, runs, _spoiled, cap=1_000_000))


_NAMED = (5, 25, 45)


def _unreadable(spark, pages, folder):
    """Search answers in files that are no archives although their names say so: those of three users in
    files named after them, those of every tenth user together."""
    user = F.col("channel_id").cast("bigint")
    land(pages.where(user % 10 == 0).coalesce(2), f"{folder}/mixed")
    for named in _NAMED:
        land(pages.where(user == named).coalesce(1), f"{folder}/user-{named}")
    path = spark._jvm.org.apache.hadoop.fs.Path
    top = path(folder)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    for part in (p.getPath() for p in fs.globStatus(path(f"{folder}/*/part-*"))):
        owner = part.getParent().getName().removeprefix("user-")
        name = part.getName() if owner == "mixed" else f"answer__{owner}__p0.json"
        fs.rename(part, path(part.getParent(), f"{name}.gz"))


_LOST = f"user_id % 10 = 0 or user_id in {_NAMED}"


@query(
    "ingest_unreadable_files",
    f"""with offered as (select * from events where ts < {CUTOFF_SQL} and event_type != 'error'),
        first as (select user_id, count(*) as n from offered where not ({_LOST}) group by 1),
        second as (select user_id, count(*) as n from offered where {_LOST} group by 1)
        select cast(c_custkey as varchar) as channel_id, coalesce(first.n, 0) as first_run, coalesce(second.n, 0) as second_run,
               case when c_custkey in {_NAMED} then 'unreadable file' when c_custkey % 10 = 0 then 'incomplete answer' end as error
        from customer left join first on first.user_id = c_custkey left join second on second.user_id = c_custkey
        union all select '', 2, 0, 'unreadable file' """,
)
def ingest_unreadable_files(spark, sf):
    """Per channel what the run finds that cannot read some files, and the run after the files came whole;
    and the files whose names say nothing of a channel."""
    df, base = earlier(events(spark, sf)), working_dir(spark, "ingest")
    customers = table(spark, sf, "customer")
    write_csv(customers.select(F.col("c_name").alias("channel_name"), F.col("c_custkey").alias("channel_id")), f"{base}/list")
    user = F.col("channel_id").cast("bigint")

    def spoil(pages):
        lost = (user % 10 == 0) | user.isin(*_NAMED)
        _unreadable(spark, pages.where(lost), f"{base}/first/search")
        return pages.where(~lost)

    _land(spark, sf, f"{base}/first", df, spoil)
    _land(spark, sf, f"{base}/second", df)
    first, second = (run_job(spark, RunConf(f"{base}/{name}", f"{base}/store", f"{base}/list", run_ts, cap=1_000_000)) for name, run_ts in (("first", FIRST), ("second", SECOND)))
    later = second.audit.select("channel_id", F.col("retrieved").alias("second_run"))
    audit = first.audit.join(later, "channel_id").select("channel_id", F.col("retrieved").alias("first_run"), "second_run", "error")
    unnamed = first.quarantine.where("channel_id is null").groupBy(F.lit("").alias("channel_id"), F.col("reason").alias("error")).agg(F.count("*").alias("first_run"))
    return audit.unionByName(unnamed.withColumn("second_run", F.lit(0).cast("bigint")))


@query(
    "ingest_three_runs",
    f"""with {_SECOND}, every as (select * from taken1 union all select event_id, ts, user_id, event_type, value, props, rn from taken2)
        {_videos_sql('every')}""",
)
def ingest_three_runs(spark, sf):
    """All videos the store holds after two runs, the second of them twice."""
    df, base = events(spark, sf), working_dir(spark, "ingest")
    customers = table(spark, sf, "customer")
    write_csv(customers.select(F.col("c_name").alias("channel_name"), F.col("c_custkey").alias("channel_id")), f"{base}/list")
    for name, run_ts, rows, times in (("first", FIRST, earlier(df), 1), ("second", SECOND, df, 2)):
        _land(spark, sf, f"{base}/{name}", rows)
        for _ in range(times):
            run_job(spark, RunConf(f"{base}/{name}", f"{base}/store", f"{base}/list", run_ts, cap=CAP))
    videos = RunStore(f"{base}/store").table(spark, "video_details")
    return videos.select("video_id", "channel_id", "channel_name", "view_count", "duration", "tags", "language")


@query(
    "ingest_given_up",
    f"""select cast(event_id as varchar) as video_id, cast(user_id as varchar) as channel_id, 2 as attempts
        from events join customer on c_custkey = user_id where ts < {CUTOFF_SQL} and event_type = 'error'""",
)
def ingest_given_up(spark, sf):
    """Ids whose details never came back are reported when they are given up."""
    df = earlier(events(spark, sf))
    result = _runs(spark, sf, {"first": (FIRST, df), "second": (SECOND, df)}, cap=1_000_000, max_attempts=2)
    return result.given_up.select("video_id", "channel_id", "attempts")


@query(
    "ingest_on_arrival",
    f"""with {_SECOND}, every as (select 1 as batch, * from taken1 union all select 2, event_id, ts, user_id, event_type, value, props, rn from taken2)
        select batch, cast(event_id as varchar) as video_id, cast(user_id as varchar) as channel_id, c_name as channel_name
        from every join customer on c_custkey = user_id""",
)
def ingest_on_arrival(spark, sf):
    """Two deliveries arrive, one while nothing listens; each is run once, also when the stream's own
    checkpoint is lost in between. Each video with the number of its run."""
    df, base = events(spark, sf), working_dir(spark, "ingest")
    customers = table(spark, sf, "customer")
    write_csv(customers.select(F.col("c_name").alias("channel_name"), F.col("c_custkey").alias("channel_id")), f"{base}/list")
    conf = RunConf("", f"{base}/store", f"{base}/list", FIRST, cap=CAP)
    for checkpoint, (name, run_ts, rows) in enumerate((("first", FIRST, earlier(df)), ("second", SECOND, df))):
        _land(spark, sf, f"{base}/in/{name}", rows)
        spark.range(1).select(F.lit(run_ts.isoformat()).alias("fetched_at")).coalesce(1).write.json(f"{base}/in/{name}/mark")
        _renamed(spark, f"{base}/in/{name}/mark/part-*", f"{base}/in/{name}/{READY}")
        run_arrivals(spark, f"{base}/in", f"{base}/checkpoint-{checkpoint}", conf)
    store = RunStore(conf.root)
    numbers = arrivals(spark, store).select("run", F.row_number().over(Window.orderBy("run")).alias("batch"))
    videos = store.table(spark, "video_details").join(F.broadcast(numbers), "run")
    return videos.select("batch", "video_id", "channel_id", "channel_name")


_ONCE = f"""videos as (select e.*, c_name, {K_SQL} as views, cast({DURATION_SQL} as bigint) as seconds,
        case when ts >= {CUTOFF_SQL} or event_id % 7 = 0 then '20240201_000000' else '20240115_000000' end as run
        from events e join customer on c_custkey = user_id where event_type != 'error')"""


def _published(spark, sf):
    """Both runs, each followed by a publish; the second run refreshes every seventh id of the first."""
    df, base = events(spark, sf), working_dir(spark, "ingest")
    customers = table(spark, sf, "customer")
    write_csv(customers.select(F.col("c_name").alias("channel_name"), F.col("c_custkey").alias("channel_id")), f"{base}/list")
    again = earlier(df).where("event_id % 7 = 0 and event_type != 'error'")
    asked = again.select(F.col("user_id").cast("string").alias("channel_id"), F.col("event_id").cast("string").alias("video_id"))
    for name, run_ts, rows, refresh in (("first", FIRST, earlier(df), None), ("second", SECOND, df, asked)):
        _land(spark, sf, f"{base}/{name}", rows)
        run_job(spark, RunConf(f"{base}/{name}", f"{base}/store", f"{base}/list", run_ts, cap=1_000_000), refresh)
        publish(spark, RunStore(f"{base}/store"), f"{base}/out")
    return lambda name: spark.read.parquet(f"{base}/out/{name}")


@query("publish_silver", f"with {_ONCE} select cast(event_id as varchar) as video_id, c_name as channel_name, views as view_count, seconds as duration, run from videos")
def publish_silver(spark, sf):
    """Silver after two publishes: refreshed rows have replaced their first form."""
    return _published(spark, sf)("silver_videos").select("video_id", "channel_name", "view_count", "duration", "run")


@query(
    "publish_gold",
    f"""with {_ONCE} select cast(user_id as varchar) as channel_id, count(*) as videos, cast(sum(views) as bigint) as views,
        avg(seconds) as avg_duration, 0.0 as engagement from videos group by user_id""",
)
def publish_gold(spark, sf):
    """Gold by channel after two publishes, by sums added and taken off."""
    return _published(spark, sf)("gold_by_channel").select("channel_id", "videos", "views", "avg_duration", "engagement")


@query("ingest_full_mode", f"{_videos_sql('events')} where event_type != 'error'")
def ingest_full_mode(spark, sf):
    """A run that takes everything again, whatever the ledger holds from the run before it."""
    df, base = events(spark, sf), working_dir(spark, "ingest")
    customers = table(spark, sf, "customer")
    write_csv(customers.select(F.col("c_name").alias("channel_name"), F.col("c_custkey").alias("channel_id")), f"{base}/list")
    _land(spark, sf, f"{base}/all", df)
    for run_ts, incremental in ((FIRST, True), (SECOND, False)):
        result = run_job(spark, RunConf(f"{base}/all", f"{base}/store", f"{base}/list", run_ts, cap=1_000_000, incremental=incremental))
    return _shown(result)


@query(
    "store_clear",
    f"""select cast(event_id as varchar) as video_id, cast(user_id as varchar) as channel_id from events where ts < {CUTOFF_SQL}
        and user_id not in (select c_custkey from customer where c_mktsegment = 'MACHINERY')""",
)
def store_clear(spark, sf):
    """The ledger of a store that was filled, partly cleared and compacted."""
    store = RunStore(f"{working_dir(spark, 'ingest')}/store")
    ids = earlier(events(spark, sf)).select(F.col("user_id").cast("string").alias("channel_id"), F.col("event_id").cast("string").alias("video_id"))
    marks = ids.select("channel_id").distinct().select("channel_id", *[F.lit(FIRST).alias(name) for name in ("last_fetch_ts", "updated_at")])
    store.seed(spark, FIRST, ids, marks)
    cleared = table(spark, sf, "customer").where("c_mktsegment = 'MACHINERY'")
    store.clear(spark, FIRST + timedelta(days=1), cleared.select(F.col("c_custkey").cast("string").alias("channel_id")))
    before = store.load(spark, SECOND).done
    store.compact(spark, FIRST + timedelta(days=2))
    return before.select("video_id", "channel_id").intersectAll(store.load(spark, SECOND).done.select("video_id", "channel_id"))


def _renamed(spark, pattern, name):
    """Give the one file that matches a name of its own."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(name).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.rename(fs.globStatus(path(pattern))[0].getPath(), path(name))
