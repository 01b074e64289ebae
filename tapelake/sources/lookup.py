"""A copy of a table laid out for point lookups by one key.

Rows are dealt into folders by a checksum of the key and sorted by it. A reader works the folder out from the key, so it
lists and opens that folder alone; in its file the key's range leaves one row group, and a bloom filter spares even that
for keys that are not there.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from functools import reduce
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapelake.sources.files import parquet_options, read_or_empty

#: A lookup decodes one row group, so they are small.
GROUP_BYTES = 8 * 1024 * 1024
BUCKET = "_bucket"


def buckets_for(rows: int, rows_in_file: int = 4_000_000) -> int:
    """A number of folders that leaves about so many rows in each."""
    return max(1, -(-rows // rows_in_file))


def bucket_column(key: str, buckets: int) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % F.lit(buckets), F.lit(-1)).cast("int")


def bucket_of(value: object, buckets: int) -> int:
    return crc32(str(value).encode()) % buckets


def write_lookup(df: DataFrame, path: str, key: str, buckets: int, mode: str = "append") -> None:
    """Write or extend the copy. ``key`` is text or a whole number, and ``buckets`` has to stay the same for a path.

    Appends add a file to each folder they touch. A folder that one key fills beyond the advisory size is written by
    several tasks. Rows without a key go to a folder of their own that no lookup reads.
    """
    options = parquet_options(key) | {"parquet.block.size": str(GROUP_BYTES)}
    rows = df.withColumn(BUCKET, bucket_column(key, buckets)).hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, key)
    rows.write.mode(mode).options(**options).partitionBy(BUCKET).parquet(path)


def lookup(spark: SparkSession, path: str, schema: str | StructType, key: str, values: Iterable[object], buckets: int) -> DataFrame:
    """All rows of the copy whose key is one of ``values``; ``schema`` is the table's, so no file is opened to infer it."""
    wanted = defaultdict(list)
    for value in dict.fromkeys(values):
        wanted[bucket_of(value, buckets)].append(value)
    found = [
        read_or_empty(spark, f"{path}/{BUCKET}={bucket}", schema).filter(F.col(key).isin(some)) for bucket, some in wanted.items()
    ]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)
