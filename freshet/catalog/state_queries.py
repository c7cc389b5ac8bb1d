"""Set operations and state writes over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.catalog.base import CUTOFF_SQL, cutoff, earlier, events, query, table, watermark
from freshet.operators import state as St
from freshet.session import working_dir
from freshet.sources.files import read_state_documents

_STATUS = "case event_type when 'error' then 'pending' when 'signup' then 'missing' else 'fetched' end"


def _ledger(df, status):
    return df.select(
        "user_id",
        "event_id",
        F.col("ts").alias("published_ts"),
        F.col("ts").alias("first_seen_run"),
        status.alias("status"),
        F.when(status == "pending", 0).otherwise(1).cast("bigint").alias("attempts"),
    )


def _status():
    return F.when(F.col("event_type") == "error", "pending").when(F.col("event_type") == "signup", "missing").otherwise("fetched")


@query(
    "union_channels",
    """select event_id, user_id, event_type, case when event_type = 'view' then null else value end as value from events""",
)
def union_channels(spark, sf):
    df = events(spark, sf).select("event_id", "user_id", "event_type", "value")
    views = df.where("event_type = 'view'").drop("value")
    others = df.where("event_type != 'view'")
    return views.unionByName(others, allowMissingColumns=True)


@query("ledger_union", "select distinct user_id, event_id from events")
def ledger_union(spark, sf):
    df = events(spark, sf).select("user_id", "event_id", "ts")
    overlapping = df.where(F.col("ts") >= F.lit("2024-01-13").cast("timestamp_ntz"))
    return St.ledger_union(earlier(df), overlapping, ["user_id", "event_id"])


@query(
    "state_upsert",
    f"""with old as (select user_id, event_id, ts, {_STATUS} as status, case when event_type = 'error' then 0 else 1 end as attempts
                     from events where ts < {CUTOFF_SQL}),
        new as (select user_id, event_id, timestamp '2024-02-01' as run, 'fetched' as status
                from events where ts >= timestamp '2024-01-10' and event_type != 'view')
        select coalesce(o.user_id, n.user_id) as user_id, coalesce(o.event_id, n.event_id) as event_id,
               coalesce(n.status, o.status) as status, coalesce(o.ts, n.run) as first_seen_run,
               cast(case when n.status is not null then 1 else o.attempts end as bigint) as attempts
        from old o full join new n on o.event_id = n.event_id and o.user_id = n.user_id""",
)
def state_upsert(spark, sf):
    df = events(spark, sf)
    later = df.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")).where("event_type != 'view'")
    changes = _ledger(later, F.lit("fetched")).withColumn("first_seen_run", F.lit("2024-02-01").cast("timestamp_ntz"))
    merged = St.upsert_ledger(_ledger(earlier(df), _status()), changes, ["user_id", "event_id"])
    return merged.select("user_id", "event_id", "status", "first_seen_run", "attempts")


@query(
    "state_clear",
    f"""select event_id, user_id from events where ts < {CUTOFF_SQL}
        and user_id not in (select c_custkey from customer where c_mktsegment = 'MACHINERY')""",
)
def state_clear(spark, sf):
    cleared = table(spark, sf, "customer").where("c_mktsegment = 'MACHINERY'").withColumnRenamed("c_custkey", "user_id")
    return St.without_channels(earlier(events(spark, sf)), cleared, "user_id").select("event_id", "user_id")


@query(
    "collect_ids",
    """with ranked as (select event_type, event_id, row_number() over (partition by event_type order by event_id) as rn from events)
       select event_type, (rn - 1) // 1000 as chunk_no, string_agg(cast(event_id as varchar), ',' order by event_id) as ids
       from ranked group by 1, 2""",
)
def collect_ids(spark, sf):
    documents = St.collect_ids(events(spark, sf), "event_type", "event_id")
    return documents.select("event_type", "chunk_no", F.array_join(F.col("video_ids").cast("array<string>"), ",").alias("ids"))


@query(
    "state_import",
    f"""with wm as (select user_id, max(ts) as lf from events where ts < {CUTOFF_SQL} group by 1)
        select cast(e.user_id as varchar) as channel_id, cast(e.event_id as varchar) as video_id, wm.lf as last_fetch_ts
        from events e left join wm using (user_id)""",
)
def state_import(spark, sf):
    """Export every id as state documents, read them back as ledger and watermark."""
    df = events(spark, sf)
    state = watermark(df).withColumn("updated_at", cutoff())
    path = working_dir(spark, "state")
    documents = St.state_documents(df.select("user_id", "event_id"), state, "user_id", "event_id", size=20)
    documents.select("value").write.text(path)
    imported = read_state_documents(spark, path, multi_line=False)
    ids = St.ids_of_documents(imported)
    bounds = St.watermark_of_documents(imported)
    return ids.join(bounds, "channel_id", "left").select(
        "channel_id", "video_id", F.col("last_fetch_ts").cast("timestamp_ntz").alias("last_fetch_ts")
    )
