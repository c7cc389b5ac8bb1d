"""File streams drained on an availableNow trigger."""

from __future__ import annotations

from pyspark.sql import functions as F

from freshet.catalog.base import EVENTS, events, query
from freshet.session import working_dir
from freshet.sinks.writers import write_table
from freshet.sources.files import read_or_empty
from freshet.streaming.feed import drain, drain_new, file_stream, known_keys


@query("stream_dedup", "select event_id, user_id, event_type, 1 as times from events")
def stream_dedup(spark, sf):
    """Two feeds with the same events, the second after the first has been drained: it adds nothing. The
    keys that the stream knows are those of the events, each once."""
    base, keys = working_dir(spark, "stream"), ["user_id", "event_id"]
    for feed in ("first", "second"):
        write_table(events(spark, sf), f"{base}/in/{feed}")
        stream = file_stream(spark, f"{base}/in/*", EVENTS).select("event_id", "user_id", "event_type")
        drain_new(stream, f"{base}/taken", f"{base}/checkpoint", keys)
    taken = spark.read.schema(stream.schema).parquet(f"{base}/taken").select("event_id", "user_id", "event_type")
    times = known_keys(spark, f"{base}/checkpoint").groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("times"))
    return taken.join(times, keys, "left").select("event_id", "user_id", "event_type", "times")


@query("stream_available_now", "select event_id, event_type, date_trunc('hour', ts) as hour from events")
def stream_available_now(spark, sf):
    """Files arrive in two rounds; each round processes what is new and stops."""
    base = working_dir(spark, "stream")
    df = events(spark, sf)
    for arrived in (df.where("event_type = 'click'"), df.where("event_type != 'click'")):
        write_table(arrived, f"{base}/in", "append")
        stream = file_stream(spark, f"{base}/in", EVENTS, files_per_batch=4)
        hourly = stream.select("event_id", "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
        drain(hourly, f"{base}/out", f"{base}/checkpoint")
    return read_or_empty(spark, f"{base}/out", hourly.schema)
