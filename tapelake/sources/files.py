"""File sources and sinks: partitioned Parquet, CSV, JSON references, table statistics and compaction."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.functions.timing import ts_literal
from tapelake.schemas import SYMBOL_REFERENCE

# The table properties of the lakehouse.
TARGET_FILE_BYTES = 256 * 1024 * 1024
ROW_GROUP_BYTES = 128 * 1024 * 1024
BLOOM_COLUMN = "symbol"
BLOOM_FPP = "0.01"
COMPACTION_THRESHOLD = 50


def parquet_options(bloom_column: str | None = BLOOM_COLUMN) -> dict[str, str]:
    options = {
        "compression": "zstd",
        "parquet.enable.dictionary": "true",
        "parquet.block.size": str(ROW_GROUP_BYTES),
    }
    if bloom_column:
        options[f"parquet.bloom.filter.enabled#{bloom_column}"] = "true"
        options[f"parquet.bloom.filter.fpp#{bloom_column}"] = BLOOM_FPP
    return options


def scan(df: DataFrame, columns: list[str] | None = None, predicate=None) -> DataFrame:
    """Filter, then project; both reach the Parquet reader."""
    if predicate is not None:
        df = df.filter(predicate)
    return df.select(*columns) if columns else df


def scan_incremental(df: DataFrame, since: str, column: str = "_ingested_at") -> DataFrame:
    """Rows ingested strictly after ``since``."""
    return df.filter(F.col(column) > ts_literal(since))


def read_symbol_reference(spark: SparkSession, path: str) -> DataFrame:
    """The symbol reference, a JSON array in one file."""
    return spark.read.schema(SYMBOL_REFERENCE).json(path, multiLine=True)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, without rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_by_day(df: DataFrame, path: str, ts: str = "timestamp", day: str = "day", mode: str = "append") -> None:
    """Day-partitioned Parquet.

    The rebalance hint lets AQE both merge small days and split a large one at the advisory size, so neither many tiny
    files nor one task per day results.
    """
    rows = df.withColumn(day, F.to_date(ts))
    bloom = BLOOM_COLUMN if BLOOM_COLUMN in df.columns else None
    rows.hint("rebalance", F.col(day)).write.mode(mode).options(**parquet_options(bloom)).partitionBy(day).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace exactly the partitions present in ``df``; with no rows nothing changes.

    The files are staged and moved at commit, and only on success, so a lost executor or a failed job leaves the old
    partitions in place.
    """
    bloom = BLOOM_COLUMN if BLOOM_COLUMN in df.columns else None
    (
        df.hint("rebalance", F.col(partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**parquet_options(bloom))
        .partitionBy(partition)
        .parquet(path)
    )


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; one file per partition, as a single file would funnel the table through one task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def sample_capped(df: DataFrame, cap: int = 100_000) -> DataFrame:
    """At most ``cap`` rows. The quality checks do not use it: they scan everything."""
    return df.limit(cap)


def sample_hashed(df: DataFrame, key: str, share: float) -> DataFrame:
    """About ``share`` of the rows, chosen by a hash of ``key``: the same ones in every run, without a shuffle."""
    if not 0 <= share < 1:
        raise ValueError("share must be at least 0 and under 1")
    return df.filter(F.substring(F.md5(F.col(key).cast("string")), 1, 8) < f"{int(share * 2**32):08x}")


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer. Each layer counts on its own, so a Parquet layer answers from file footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out


def table_stats(spark: SparkSession, tables: dict[str, str], threshold: int = COMPACTION_THRESHOLD) -> DataFrame:
    """Files and records per table path, and whether it has more files than the threshold."""
    stats = []
    for name, path in tables.items():
        files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).count()
        stats.append(
            files.agg(F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("count"), F.lit(0)).alias("record_count"))
            .select(F.lit(name).alias("table_name"), "file_count", "record_count")
            .withColumn("needs_compaction", F.col("file_count") > threshold)
        )
    out = stats[0]
    for other in stats[1:]:
        out = out.unionByName(other)
    return out


def compaction_report(stats: DataFrame) -> DataFrame:
    """Tables over the threshold, and what to do about them."""
    return stats.filter("needs_compaction").select(
        "table_name", "file_count", "record_count", F.lit("rewrite_data_files").alias("action")
    )


def compact(spark: SparkSession, source: str, target: str, partition: str | None = None) -> None:
    """Rewrite a table into few files at a new path, leaving the old one readable until readers move."""
    df = spark.read.parquet(source)
    bloom = BLOOM_COLUMN if BLOOM_COLUMN in df.columns else None
    rows = df.hint("rebalance", F.col(partition)) if partition else df.hint("rebalance")
    writer = rows.write.mode("errorifexists").options(**parquet_options(bloom))
    (writer.partitionBy(partition) if partition else writer).parquet(target)
