"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.session import scratch_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the folder all executors share and read it back, so that a lost executor costs
    no recomputation and costly steps run once."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text, null taken as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def fresh(name: str, taken: list[str]) -> str:
    """The name, with underscores before it until it is none of those taken in any case."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = "_" + name
    return name
