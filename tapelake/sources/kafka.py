"""Kafka JSON topics, and recorded topics for sessions without the connector.

Both readers give one shape: key, value, topic, partition, offset, timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

RECORDED = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


def read_topic(
    spark: SparkSession,
    servers: str,
    topics: str,
    starting: str = "latest",
    max_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A stream of Kafka messages as text. Needs the Kafka connector on the session's class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load().select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def read_recorded(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream over a topic recorded as Parquet files."""
    reader = spark.readStream.schema(RECORDED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def record(messages: DataFrame, path: str) -> None:
    """Save messages in the recorded shape, absent columns as NULL."""
    present = set(messages.columns)
    wanted = [part.split() for part in RECORDED.split(", ")]
    columns = [(F.col(n) if n in present else F.lit(None)).cast(t).alias(n) for n, t in wanted]
    messages.select(*columns).write.mode("overwrite").parquet(path)


def to_messages(df: DataFrame, key: str | None = "symbol") -> DataFrame:
    """Rows as JSON text, keyed so that one symbol stays in one partition."""
    key_column = F.col(key) if key else F.lit(None)
    return df.select(key_column.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def write_topic(messages: DataFrame, servers: str, checkpoint: str, topic: str | None = None) -> DataStreamWriter:
    """An append-only Kafka sink; without ``topic`` each row names its own."""
    writer = (
        messages.writeStream.format("kafka")
        .outputMode("append")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )
    return writer.option("topic", topic) if topic else writer
