"""One run for every delivery that arrives, driven by the offset log of a file stream.

A delivery is a folder of landed responses. Its last file is ``ready.json``: ``{}``, or the time at which
the responses were fetched as ``{"fetched_at": "..."}`` (else the file's own time counts). The stream
watches these files; its checkpoint remembers which ones were handed out, and hands out again what a lost
driver left unfinished.

Before a run starts, its delivery and time are written down below the store. So a delivery that comes
again, because the driver died before, within or after its run, or because the checkpoint was lost, keeps
its run: a committed one is left alone, any other is repeated under the same stamp and replaces exactly
what it had written. Runs stay in order, whatever the deliveries' times.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.scalars import parse_iso_lenient
from freshet.plans.ingest import RunConf, run_job
from freshet.plans.store import RunStore, instant, plain, stamp_of
from freshet.schemas import ARRIVAL, extended
from freshet.session import tune
from freshet.sinks.writers import write_table
from freshet.sources.files import read_or_empty

READY = "ready.json"
_MARK = T.StructType([T.StructField("fetched_at", T.StringType())])
_NO_AGE = "36500d"  # a delivery is never too old to be taken


def arrivals(spark: SparkSession, store: RunStore) -> DataFrame:
    """``delivery, batch, run_ts, run`` of every run that a delivery has started, committed or not."""
    return read_or_empty(spark, f"{store.root}/arrivals", extended(ARRIVAL, ("run", T.StringType())), store.fmt)


def _run_time(spark: SparkSession, store: RunStore, delivery: str, batch: int, fetched: int) -> datetime | None:
    """The time of the run that the delivery still needs: what was written down, or else its own time,
    moved behind the runs before it, which is then written down."""
    micros = F.unix_micros("run_ts")
    known = arrivals(spark, store).agg(F.max(F.when(F.col("delivery") == delivery, micros)).alias("own"), F.max(micros).alias("last")).first()
    own, newest = plain(known["own"]), store.newest(spark)
    if own and store.committed(spark, own):
        return None
    # Unless another run has been committed meanwhile.
    if own and not (newest and newest > own):
        return own
    # A stamp names a second, so two runs need different ones.
    earlier = [t.replace(microsecond=0) + timedelta(seconds=1) for t in (plain(known["last"]), newest) if t]
    run_ts = max([plain(fetched), *earlier])
    row = spark.range(1).select(F.lit(delivery).alias("delivery"), F.lit(batch).cast("bigint").alias("batch"), instant(run_ts).alias("run_ts"))
    write_table(row, f"{store.root}/arrivals/run={stamp_of(run_ts)}", "overwrite", store.fmt)
    return run_ts


def run_arrivals(spark: SparkSession, deliveries: str, checkpoint: str, conf: RunConf, refresh: DataFrame | None = None) -> Sequence[datetime]:
    """Run every delivery below ``deliveries`` that has not been run, oldest first, then stop.

    ``conf`` says how; its landing folder and time are the deliveries' own. The times of the runs that
    were started are returned. Schedule it as often as deliveries are expected: without a new one it ends
    at once.
    """
    tune(spark)
    store, started = RunStore(conf.root, conf.fmt), []
    marks = (
        spark.readStream.schema(_MARK)
        .option("maxFilesPerTrigger", "1")
        .option("maxFileAge", _NO_AGE)
        .json(f"{deliveries}/*/{READY}")
        .select(
            F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("delivery"),
            F.unix_micros(F.coalesce(parse_iso_lenient("fetched_at"), "_metadata.file_modification_time")).alias("fetched"),
        )
    )

    def take(batch: DataFrame, number: int) -> None:
        # One mark a batch; a mark without a line in it is none.
        for mark in batch.dropDuplicates(["delivery"]).collect():
            run_ts = _run_time(spark, store, mark["delivery"], number, mark["fetched"])
            if run_ts is not None:
                run_job(spark, replace(conf, landing=mark["delivery"], run_ts=run_ts), refresh)
                started.append(run_ts)

    query = marks.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return started
