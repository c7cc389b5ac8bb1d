"""File streams run to completion on a schedule, with dedup that never forgets an id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from freshet.sinks.writers import write_table

# Keys live on disk, and a batch saves its changes instead of all of them.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.load(folder)


def drain(stream: DataFrame, target: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Append everything not yet processed under ``checkpoint`` to ``target``, then stop."""
    query = (
        stream.writeStream.format(fmt)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_new(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], fmt: str = "parquet") -> None:
    """Append the rows whose key has not come before, at whatever time, then stop.

    The keys are state of the stream: a batch looks its own up in the state store and reads nothing that
    was written earlier. There is no watermark, so no key is ever forgotten; RocksDB keeps them on the
    executors' disks, and each batch adds its own to the checkpoint. Feeds that must know of each other
    are folders of one stream. Each batch owns one folder ``batch=``, which a repeated batch replaces.
    Of copies within one batch any may be kept; rows with a NULL in the key are rejected.
    """
    spark = stream.sparkSession

    def take(batch: DataFrame, batch_id: int) -> None:
        write_table(batch, f"{target}/batch={batch_id}", "overwrite", fmt)

    before = {name: spark.conf.get(name, None) for name in STATE_CONF}
    for name, value in STATE_CONF.items():
        spark.conf.set(name, value)
    try:
        query = (
            stream.dropna(subset=list(keys))
            .dropDuplicates(list(keys))
            .writeStream.foreachBatch(take)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:  # the query has taken its copy
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    query.awaitTermination()


def known_keys(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keys that a ``drain_new`` stream knows, from the state of its last finished batch."""
    return spark.read.format("statestore").load(checkpoint).select("key.*")
