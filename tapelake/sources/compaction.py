"""Compaction of a partitioned Parquet table in its place, which a crash at any point neither shortens nor doubles.

Files of a partition are packed first-fit-decreasing into bins of the target size, and a bin becomes a file (a few
may share one, as bins are dealt to tasks by ranges that Spark samples). The packed
partitions are written beside the table, then noted in a journal, then put over the old ones, and then the note is closed.
A run that ended before the note changed nothing; one that ended after it is repeated from the copy by the next run, and
putting a copy over a partition twice is the same as once. One compaction at a time, and no writer to the same partitions
meanwhile; readers that listed the old files of a partition have to list again after its swap.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.sources.files import BLOOM_COLUMN, TARGET_FILE_BYTES, parquet_options, read_or_empty

JOURNAL = "run string, copy string, state string"
PLAN = "folder string, file string, bytes bigint, bin string"
#: A folder's files are packed by so many at once; more are dealt out by a hash of their names.
PACKED_AT_ONCE = 10_000


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``(folder, file, bytes)`` of a table's files, from the listing: no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return listed.select(
        F.regexp_extract("path", r"([^/]*)/[^/]*$", 1).alias("folder"), F.regexp_extract("path", r"([^/]*)$", 1).alias("file"), F.col("length").alias("bytes")
    )


def packed(sizes: np.ndarray, target: int) -> np.ndarray:
    """The bin of each size: largest first, each into the first bin with room for it, or a new one."""
    bins, room, used = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
    for i in np.argsort(-sizes, kind="stable"):
        fits = room[:used] >= sizes[i]
        at = int(np.argmax(fits)) if fits.any() else used
        if at == used:
            room[used], used = target, used + 1
        room[at] -= sizes[i]
        bins[i] = at
    return bins


def compaction_plan(sizes: DataFrame, target: int = TARGET_FILE_BYTES, least_saved: float = 0.5) -> DataFrame:
    """``(folder, file, bytes, bin)`` for ``sizes(folder, file, bytes)``: the files of folders that lose at least the share
    ``least_saved`` of their files, and the bin each goes to. A file over the target has a bin of its own."""
    counts = sizes.groupBy("folder").agg(F.ceil(F.count("*") / F.lit(PACKED_AT_ONCE)).alias("lots"))
    dealt = sizes.join(counts, "folder").withColumn("lot", F.pmod(F.xxhash64("file"), "lots"))

    def pack(files: pd.DataFrame) -> pd.DataFrame:
        files = files.sort_values("file")
        bins = packed(files["bytes"].to_numpy(), target)
        return files.assign(bin=[f"{files['lot'].iloc[0]}-{b}" for b in bins])[["folder", "file", "bytes", "bin"]]

    plan = dealt.select("folder", "file", "bytes", "lot").groupBy("folder", "lot").applyInPandas(pack, PLAN)
    saved = plan.groupBy("folder").agg(F.count("*").alias("files"), F.countDistinct("bin").alias("bins"))
    return plan.join(saved.filter(F.col("bins") <= F.col("files") * (1 - least_saved)).select("folder"), "folder")


def write_packed(spark: SparkSession, path: str, copy: str, partition: str, plan: DataFrame) -> None:
    """The planned partitions of the table, at ``copy``, about a file for each bin."""
    df = spark.read.parquet(path)
    bloom = BLOOM_COLUMN if BLOOM_COLUMN in df.columns else None
    by_file = plan.select(F.col("folder").alias("_folder"), F.col("file").alias("_file"), "bin")
    rows = df.withColumn("_file", F.element_at(F.split("_metadata.file_path", "/"), -1))
    rows = rows.withColumn("_folder", F.element_at(F.split("_metadata.file_path", "/"), -2)).join(by_file, ["_folder", "_file"])
    bins = plan.select("folder", "bin").distinct().count()
    # By range of folder and bin: as many tasks as bins, so that a bin is one task's work and one file.
    rows = rows.repartitionByRange(max(1, bins), "_folder", "bin").drop("_folder", "_file", "bin")
    rows.write.options(**parquet_options(bloom)).partitionBy(partition).parquet(copy)


def note(spark: SparkSession, journal: str, run: str, copy: str, state: str) -> None:
    spark.createDataFrame([(run, copy, state)], JOURNAL).coalesce(1).write.mode("append").parquet(journal)


def swap(spark: SparkSession, path: str, copy: str, partition: str) -> None:
    """Put the copy's partitions over the table's, about a file for each of the copy's."""
    df = spark.read.parquet(copy)
    bloom = BLOOM_COLUMN if BLOOM_COLUMN in df.columns else None
    whole_files = df.withColumn("_from", F.col("_metadata.file_path"))
    n_files = max(1, file_sizes(spark, copy).count())
    dealt = whole_files.repartitionByRange(n_files, partition, "_from").drop("_from")
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**parquet_options(bloom))
    writer.partitionBy(partition).parquet(path)


def finish(spark: SparkSession, path: str, work: str, partition: str) -> int:
    """Repeat swaps that an earlier run noted and did not close; how many there were."""
    journal = f"{work}/journal"
    noted = read_or_empty(spark, journal, JOURNAL)
    open_runs = noted.groupBy("run", "copy").agg(F.max((F.col("state") == "closed").cast("int")).alias("c")).filter("c = 0")
    left = open_runs.select("run", "copy").collect()  # one compaction runs at a time, so one at most
    for r in left:
        swap(spark, path, r.copy, partition)
        note(spark, journal, r.run, r.copy, "closed")
    return len(left)


def compact_in_place(
    spark: SparkSession, path: str, work: str, partition: str, target: int = TARGET_FILE_BYTES, least_saved: float = 0.5
) -> int:
    """Pack the files of the table at ``path``, partitioned by ``partition`` alone; how many files were packed.

    ``work`` is a folder of this table's own for copies and the journal, outside the table, that all executors reach. What
    an earlier run left open is finished first. A table without files to pack is not touched.
    """
    finish(spark, path, work, partition)
    run = uuid.uuid4().hex
    copy, planned = f"{work}/{run}/packed", f"{work}/{run}/plan"
    compaction_plan(file_sizes(spark, path), target, least_saved).write.parquet(planned)
    plan = spark.read.schema(PLAN).parquet(planned)
    files = plan.count()
    if files:
        write_packed(spark, path, copy, partition, plan)
        note(spark, f"{work}/journal", run, copy, "packed")
        finish(spark, path, work, partition)
    return files
