"""Running streams: triggers, checkpoints, and sinks that stay correct when a batch is replayed.

A micro-batch may run again after a failure. File sinks commit each batch once; the ``foreachBatch`` sinks here write
into a folder named after the batch and overwrite it, so a replay replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tapelake.operators import ingest, silver
from tapelake.sources.files import parquet_options

# Fixed values of the stream jobs.
CHECKPOINT_INTERVAL = "60 seconds"
BRONZE_INTERVAL = "5 seconds"


def with_trigger(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Every ``interval``, or with None all that is there and then stop."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def append_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = CHECKPOINT_INTERVAL,
    partition: str | None = None,
) -> StreamingQuery:
    """Append a stream to Parquet; offsets and state live in ``checkpoint``, on storage all executors share."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .options(**parquet_options(None))
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if partition:
        writer = writer.partitionBy(partition)
    return with_trigger(writer, interval).start()


def append_bronze_trades(
    messages: DataFrame, path: str, checkpoint: str, interval: str | None = BRONZE_INTERVAL
) -> StreamingQuery:
    """Trade messages to the day-partitioned Bronze table. Rows land before their offsets are committed, and Bronze
    keeps whatever arrives: duplicates are Silver's business."""
    rows = ingest.parse_trades(messages).withColumn("day", F.to_date("timestamp"))
    return append_table(rows, path, checkpoint, interval, partition="day")


def append_bronze_orderbooks(
    messages: DataFrame, path: str, checkpoint: str, interval: str | None = BRONZE_INTERVAL
) -> StreamingQuery:
    rows = ingest.parse_orderbooks(messages).withColumn("day", F.to_date("timestamp"))
    return append_table(rows, path, checkpoint, interval, partition="day")


def deduplicate(stream: DataFrame, key: str = "trade_id") -> DataFrame:
    """One row per key among those arriving within the watermark of each other; state is dropped as it passes."""
    return stream.dropDuplicatesWithinWatermark([key])


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def fan_out(
    stream: DataFrame,
    outputs: dict[str, tuple[Callable[[DataFrame], DataFrame], str]],
    checkpoint: str,
    interval: str | None = CHECKPOINT_INTERVAL,
) -> StreamingQuery:
    """Feed several outputs, name -> (transformation, path), from one read of the source.

    The batch is kept for the length of its writes; a lost block is read again from the source.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for transform, path in outputs.values():
                transform(batch).write.mode("overwrite").parquet(_batch_folder(path, batch_id))
        finally:
            batch.unpersist()

    return with_trigger(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), interval).start()


def split_late(
    stream: DataFrame,
    on_time: str,
    late: str,
    progress: str,
    checkpoint: str,
    delay: str = "5 seconds",
    interval: str | None = CHECKPOINT_INTERVAL,
) -> StreamingQuery:
    """Send rows older than the newest event of earlier batches less ``delay`` to a table of their own.

    Each batch writes the newest event time up to its end (one row) under its batch id, so the limit survives a restart,
    a replayed batch sees the limit it saw first, and a batch reads one entry however many came before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = batch.select(F.lit(None).cast("timestamp").alias("newest")).limit(0)
        if batch_id > 0:
            newest = spark.read.schema("newest timestamp").parquet(_batch_folder(progress, batch_id - 1))
        limit = newest.agg((F.max("newest") - F.expr(f"INTERVAL {delay}")).alias("_limit"))
        batch.persist()
        try:
            marked = batch.crossJoin(limit)
            is_late = F.coalesce(F.col("event_time") < F.col("_limit"), F.lit(False))
            marked.filter(~is_late).drop("_limit").write.mode("overwrite").parquet(_batch_folder(on_time, batch_id))
            marked.filter(is_late).drop("_limit").write.mode("overwrite").parquet(_batch_folder(late, batch_id))
            own = batch.agg(F.max("event_time").alias("newest")).unionByName(newest)
            own.agg(F.max("newest").alias("newest")).write.mode("overwrite").parquet(_batch_folder(progress, batch_id))
        finally:
            batch.unpersist()

    return with_trigger(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), interval).start()


@contextmanager
def stream_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Streams started inside this block keep these settings; the session gets its own back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def state_partitions(spark: SparkSession, count: int | None = None):
    """Start stateful streams inside this block to fix their number of state partitions, by default one per core.

    A stream keeps the number it first started with, and each partition is a store of its own on every batch.
    """
    return stream_settings(spark, {"spark.sql.shuffle.partitions": str(count or spark.sparkContext.defaultParallelism)})


ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def rocksdb_state(spark: SparkSession):
    """Start streams inside this block to keep their state in RocksDB: off the JVM heap, with changelog checkpoints."""
    return stream_settings(spark, ROCKSDB_STATE)


def use_rocksdb_state(spark: SparkSession) -> None:
    """The same for all streams the session starts from here on."""
    for key, value in ROCKSDB_STATE.items():
        spark.conf.set(key, value)


def silver_stream(
    messages: DataFrame, dim_symbol: DataFrame, path: str, checkpoint: str, interval: str | None = CHECKPOINT_INTERVAL
) -> StreamingQuery:
    """Trade messages to the Silver table. Each batch runs the Silver job, which skips trades the table holds, so neither
    a replayed batch nor a replay older than any watermark adds a row."""

    def write(batch: DataFrame, batch_id: int) -> None:
        silver.run_silver_job(ingest.parse_trades(batch), dim_symbol, path)

    return with_trigger(messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), interval).start()
