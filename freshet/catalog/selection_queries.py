"""Filters, joins, caps, batches and counters over whole tables.

Channel is played by ``user_id`` or, where groups should be large, by ``event_type``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.catalog.base import CUTOFF_SQL, cutoff, earlier, events, newest, prop, query, table, watermark
from freshet.operators import counters as C
from freshet.operators import selection as Sel
from freshet.operators.skew import fits_broadcast, hot_keys
from freshet.session import frozen

CAP = 20

_WM = f"select user_id, max(ts) as lf from events where ts < {CUTOFF_SQL} group by 1"
_SEEN = f"select 1 from events s where s.event_id = e.event_id and s.user_id = e.user_id and s.ts < {CUTOFF_SQL}"


@query("filter_kind", "select event_id, 'feed#' || event_type as kind from events where event_type = 'view'")
def filter_kind(spark, sf):
    kinds = events(spark, sf).select("event_id", F.concat(F.lit("feed#"), "event_type").alias("kind"))
    return Sel.of_kind(kinds, "kind", "view")


@query(
    "driving_join",
    """select event_id, user_id from events
       where user_id in (select c_custkey from customer where c_mktsegment = 'BUILDING')""",
)
def driving_join(spark, sf):
    listed = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    return Sel.driven_by(events(spark, sf), listed.withColumnRenamed("c_custkey", "user_id"), "user_id").select(
        "event_id", "user_id"
    )


@query(
    "incremental_filter",
    f"""with wm as ({_WM})
        select e.event_id, e.user_id, e.ts from events e left join wm using (user_id)
        where wm.lf is null or e.ts > wm.lf - interval 10 minute""",
)
def incremental_filter(spark, sf):
    df = events(spark, sf).select("event_id", "user_id", "ts")
    return Sel.incremental_filter(df, watermark(df), "user_id", "ts", "last_fetch_ts").select("event_id", "user_id", "ts")


@query(
    "mode_first_run",
    """with wm as (select user_id, max(ts) as lf from events where ts < timestamp '2024-01-01 12:00:00' group by 1)
       select e.event_id, e.user_id, wm.lf is null as first_run from events e left join wm using (user_id)
       where wm.lf is null or e.ts > wm.lf - interval 10 minute""",
)
def mode_first_run(spark, sf):
    df = events(spark, sf).select("event_id", "user_id", "ts")
    first_half_day = df.where(F.col("ts") < F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"))
    state = first_half_day.groupBy("user_id").agg(F.max("ts").alias("last_fetch_ts"))
    kept = Sel.incremental_filter(df, state, "user_id", "ts", "last_fetch_ts")
    return Sel.state_of(kept, state, "user_id", "last_fetch_ts").select(
        "event_id", "user_id", (~F.col("has_state")).alias("first_run")
    )


@query(
    "mode_full",
    f"""select event_id, user_id from (
        select event_id, user_id, row_number() over (partition by user_id order by ts desc, event_id) as rn from events)
        where rn <= {CAP}""",
)
def mode_full(spark, sf):
    df = events(spark, sf).select("event_id", "user_id", "ts")
    return Sel.cap_per_key(df, "user_id", "event_id", newest(), CAP).select("event_id", "user_id")


@query("anti_seen", f"select e.event_id, e.user_id from events e where not exists ({_SEEN})")
def anti_seen(spark, sf):
    df = events(spark, sf).select("event_id", "user_id", "ts")
    small = fits_broadcast(df.select("user_id", "event_id"))
    return Sel.anti_seen(df, earlier(df), ["user_id", "event_id"], small).select("event_id", "user_id")


@query(
    "late_report",
    f"""with wm as ({_WM})
        select e.event_id, e.user_id, e.ts from events e join wm using (user_id)
        where e.ts <= wm.lf - interval 10 minute and e.event_type = 'error'""",
)
def late_report(spark, sf):
    df = events(spark, sf).select("event_id", "user_id", "ts", "event_type")
    ledger = earlier(df).where("event_type != 'error'")
    late = Sel.late_items(df, watermark(df), ledger, "user_id", "event_id", "ts", "last_fetch_ts")
    return late.select("event_id", "user_id", "ts")


@query(
    "state_left_join",
    f"""with wm as ({_WM})
        select c.c_custkey, wm.lf as last_fetch_ts, wm.lf is not null as has_state
        from customer c left join wm on wm.user_id = c.c_custkey""",
)
def state_left_join(spark, sf):
    channels = table(spark, sf, "customer").select("c_custkey")
    state = watermark(events(spark, sf)).withColumnRenamed("user_id", "c_custkey")
    return Sel.state_of(channels, state, "c_custkey", "last_fetch_ts")


@query(
    "semi_lookup",
    f"""select event_id, event_type != 'error' as answered from events where ts >= {CUTOFF_SQL}""",
)
def semi_lookup(spark, sf):
    df = events(spark, sf).select("event_id", "ts", "event_type")
    wanted = df.where(F.col("ts") >= cutoff()).select("event_id")
    found, missing = Sel.lookup(df.where("event_type != 'error'"), wanted, "event_id")
    answered = found.select("event_id", F.lit(True).alias("answered"))
    return answered.unionByName(missing.select("event_id", F.lit(False).alias("answered")))


@query(
    "enrich_channel",
    "select e.event_id, e.user_id, c.c_name, c.c_mktsegment from events e join customer c on c.c_custkey = e.user_id",
)
def enrich_channel(spark, sf):
    channels = table(spark, sf, "customer").withColumnRenamed("c_custkey", "user_id")
    return Sel.enrich(events(spark, sf).select("event_id", "user_id"), channels, "user_id", ["c_name", "c_mktsegment"])


@query("distinct_ids", "select distinct l_orderkey, l_linenumber from lineitem")
def distinct_ids(spark, sf):
    return Sel.distinct_ids(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "last_item_wins",
    """select user_id, arg_max(event_id, ts) as event_id, arg_max(event_type, ts) as event_type from events group by 1""",
)
def last_item_wins(spark, sf):
    df = events(spark, sf).select("user_id", "event_id", "event_type", "ts")
    return Sel.one_per_key(df, ["user_id"], [F.col("ts").desc()]).drop("ts")


@query(
    "cap_per_channel",
    """select event_id, event_type, rn from (
       select event_id, event_type, row_number() over (partition by event_type order by ts desc, event_id) as rn from events)
       where rn <= 200""",
)
def cap_per_channel(spark, sf):
    df = events(spark, sf).select("event_id", "event_type", "ts")
    capped = Sel.cap_per_key(df, "event_type", "event_id", newest(), 200)
    return capped.select("event_id", "event_type", "rn")


@query(
    "cap_pending",
    """select event_id, event_type from (
       select event_id, event_type, row_number() over (partition by event_type order by ts desc, event_id) as rn from events)
       where rn > 200""",
)
def cap_pending(spark, sf):
    df = events(spark, sf).select("event_id", "event_type", "ts")
    selected = Sel.cap_per_key(df, "event_type", "event_id", newest(), 200)
    return Sel.beyond_cap(df, selected, ["event_type", "event_id"]).select("event_id", "event_type")


@query(
    "search_first_page",
    """select event_id, user_id from (
       select event_id, user_id, row_number() over (partition by user_id order by ts desc, event_id) as rn
       from events where event_type != 'error') where rn <= 50""",
)
def search_first_page(spark, sf):
    df = events(spark, sf).where("event_type != 'error'").select("event_id", "user_id", "ts")
    return Sel.cap_per_key(df, "user_id", "event_id", newest(), 50).select("event_id", "user_id")


@query(
    "request_batches",
    """with ranked as (select event_type, event_id, row_number() over (partition by event_type order by ts desc, event_id) as rn from events)
       select event_type, (rn - 1) // 50 as batch_no, string_agg(cast(event_id as varchar), ',' order by rn) as ids, count(*) as n
       from ranked group by 1, 2""",
)
def request_batches(spark, sf):
    df = events(spark, sf).select("event_id", "event_type", "ts")
    return Sel.request_batches(df, "event_type", "event_id", newest())


@query("newest_first", "select event_id, user_id, ts from events order by ts desc, event_id")
def newest_first(spark, sf):
    return events(spark, sf).select("event_id", "user_id", "ts").orderBy(*newest())


@query("preview", "select event_id, user_id, ts from events order by ts desc, event_id limit 5")
def preview(spark, sf):
    return events(spark, sf).select("event_id", "user_id", "ts").orderBy(*newest()).limit(5)


_COUNTERS = f"""select user_id, count(*) as found, count(*) filter (where ts < {CUTOFF_SQL}) as cached,
    count(*) filter (where ts >= {CUTOFF_SQL}) as new,
    least(count(*) filter (where ts >= {CUTOFF_SQL}), {CAP}) as selected from events group by 1"""


def _marked(spark, sf):
    df = events(spark, sf).select("event_id", "user_id", "ts", "event_type")
    return C.flagged(df, earlier(df), ["user_id", "event_id"], "cached")


@query("run_counters", _COUNTERS)
def run_counters(spark, sf):
    return C.run_counters(_marked(spark, sf), "user_id", CAP)


@query(
    "run_totals",
    f"""with c as ({_COUNTERS})
        select count(*) as channels_processed, cast(sum(selected) as bigint) as videos_collected from c""",
)
def run_totals(spark, sf):
    return C.run_totals(C.run_counters(_marked(spark, sf), "user_id", CAP), "selected")


@query(
    "quota_estimate",
    f"with c as ({_COUNTERS}) select cast(count(*) * 103 + sum(selected) as bigint) as units from c",
)
def quota_estimate(spark, sf):
    return C.quota_estimate(C.run_counters(_marked(spark, sf), "user_id", CAP), "selected")


_AUDIT = f"""with c as ({_COUNTERS}),
    r as (select user_id, count(*) filter (where event_type = 'purchase') as retrieved from (
          select user_id, event_type, row_number() over (partition by user_id order by ts desc, event_id) as rn
          from events where ts >= {CUTOFF_SQL}) where rn <= {CAP} group by 1),
    a as (select c.user_id, c.found, c.cached, c.new, c.selected, coalesce(r.retrieved, 0) as retrieved,
          case when c.selected > 0 and coalesce(r.retrieved, 0) = 0 then 'failed' else 'ok' end as status
          from c left join r using (user_id))"""


def _audit(spark, sf):
    """Only purchases are answered; a channel with nothing answered has failed."""
    # Counters and picks both need it: written once rather than joined to the ledger twice.
    marked = frozen(_marked(spark, sf))
    hot = hot_keys(events(spark, sf), ["user_id"])
    picked = Sel.cap_per_key(marked.where(~F.col("cached")), "user_id", "event_id", newest(), CAP, hot)
    answered = picked.groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("retrieved"))
    rows = C.run_counters(marked, "user_id", CAP).join(answered, "user_id", "left")
    rows = rows.withColumn("retrieved", F.coalesce("retrieved", F.lit(0)))
    failed = (F.col("selected") > 0) & (F.col("retrieved") == 0)
    return rows.withColumn("status", F.when(failed, "failed").otherwise("ok"))


@query("run_audit", f"{_AUDIT} select * from a")
def run_audit(spark, sf):
    return _audit(spark, sf)


@query("all_success", f"{_AUDIT} select bool_and(status = 'ok') as all_success from a")
def all_success(spark, sf):
    return C.all_success(_audit(spark, sf), F.col("status") == "ok")


@query(
    "audit_alerts",
    f"""{_AUDIT} select user_id, status, retrieved,
        case when status = 'failed' then 'failed channel' else 'too few videos' end as alert
        from a where status = 'failed' or retrieved < 3""",
)
def audit_alerts(spark, sf):
    return C.audit_alerts(_audit(spark, sf), "user_id", min_videos=3)


@query(
    "incremental_enrich",
    f"""with wm as ({_WM}),
        fresh as (select e.* from events e left join wm using (user_id)
                  where (wm.lf is null or e.ts > wm.lf - interval 10 minute) and not exists ({_SEEN})),
        ranked as (select *, row_number() over (partition by user_id order by ts desc, event_id) as rn from fresh)
        select r.event_id, r.user_id, c.c_name, r.ts, coalesce(try_cast(json_extract_string(r.props, '$.k') as bigint), 0) as k
        from ranked r join customer c on c.c_custkey = r.user_id where r.rn <= {CAP}""",
)
def incremental_enrich(spark, sf):
    """Bound, dedup against the ledger, cap, enrichment and JSON defaults in one plan."""
    df = events(spark, sf)
    slim = df.select("event_id", "user_id", "ts", "props")
    within = Sel.incremental_filter(slim, watermark(df), "user_id", "ts", "last_fetch_ts")
    fresh = Sel.anti_seen(within, earlier(df), ["user_id", "event_id"])
    selected = Sel.cap_per_key(fresh, "user_id", "event_id", newest(), CAP, hot_keys(df, ["user_id"]))
    channels = table(spark, sf, "customer").withColumnRenamed("c_custkey", "user_id")
    named = Sel.enrich(selected, channels, "user_id", ["c_name"])
    return named.select("event_id", "user_id", "c_name", "ts", F.coalesce(prop("k"), F.lit(0)).alias("k"))
