"""The time-of-day dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp

# Session bounds as hour * 100 + minute, end exclusive.
SESSIONS = {"pre-market": (400, 930), "regular": (930, 1600), "after-hours": (1600, 2000)}
MARKET_SESSION = "regular"


def trading_session(key: Column) -> Column:
    out = None
    for name, (start, end) in SESSIONS.items():
        inside = (key >= start) & (key < end)
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return out.otherwise("closed")


def time_key(ts: Column | str) -> Column:
    return F.hour(ts) * 100 + F.minute(ts)


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per minute of the day."""
    minute_of_day = F.col("id").cast("int")
    hour, minute = F.floor(minute_of_day / 60).cast("int"), minute_of_day % 60
    key = hour * 100 + minute
    session = trading_session(key)
    return spark.range(1440).select(
        key.alias("time_key"),
        hour.alias("hour"),
        minute.alias("minute"),
        F.concat_ws(":", F.lpad(hour.cast("string"), 2, "0"), F.lpad(minute.cast("string"), 2, "0")).alias("time_of_day"),
        session.alias("trading_session"),
        (session == MARKET_SESSION).alias("is_market_hours"),
    )


def volume_by_session(trades: DataFrame, dim: DataFrame) -> DataFrame:
    """Trades and volume per trading session.

    Trades are counted per minute key before the join, so 1440 rows meet the dimension however many trades there are.
    """
    per_minute = trades.groupBy(time_key("timestamp").alias("time_key")).agg(
        F.count(F.lit(1)).alias("n"), fp.quantity_sum().alias("volume")
    )
    return (
        per_minute.join(dim, "time_key")
        .groupBy("trading_session", "is_market_hours")
        .agg(F.sum("n").alias("trade_count"), F.sum("volume").alias("total_volume"))
    )
