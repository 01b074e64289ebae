"""Windowed trade aggregates; the same functions run on a batch and on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.functions.timing import SUBDAY_INTERVALS, event_time, interval_seconds

# Fixed values of the stream job: allowed disorder and the window sizes.
WATERMARK = "5 seconds"
WINDOW_SIZES = ("1m", "5m", "15m")


def with_event_time(trades: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Add the event time read from the ISO text and its watermark. Rows without a readable time are dropped, as no
    window could take them.

    Spark has one watermark per query: it waits while a source is idle, and nothing flushes until a later event.
    """
    timed = trades.withColumn("event_time", event_time("timestamp")).filter("event_time IS NOT NULL")
    return timed.withWatermark("event_time", watermark)


def tumbling(trades: DataFrame, size: str) -> DataFrame:
    """Count, volume, VWAP, high and low per symbol and tumbling window of ``event_time``."""
    window = F.window("event_time", SUBDAY_INTERVALS[size])
    return (
        trades.groupBy("symbol", window)
        .agg(
            F.count(F.lit(1)).alias("trade_count"),
            fp.quantity_sum().alias("total_volume"),
            fp.vwap().alias("vwap"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
        )
        .select(
            "symbol",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            F.lit(size).alias("window_size"),
            "trade_count",
            "total_volume",
            "vwap",
            "high_price",
            "low_price",
        )
    )


def tumbling_all(trades: DataFrame, sizes: tuple[str, ...] = WINDOW_SIZES) -> DataFrame:
    """All window sizes in one table, told apart by ``window_size``."""
    out = tumbling(trades, sizes[0])
    for size in sizes[1:]:
        out = out.unionByName(tumbling(trades, size))
    return out


def tumbling_rollup(trades: DataFrame, sizes: tuple[str, ...] = WINDOW_SIZES) -> DataFrame:
    """The rows of ``tumbling_all`` from one pass over a batch: trades are folded into windows of the first size,
    which must divide the others, and those are added up into every size."""
    base = trades.groupBy("symbol", F.window("event_time", SUBDAY_INTERVALS[sizes[0]])["start"].alias("at")).agg(
        F.count(F.lit(1)).alias("n"),
        fp.quantity_sum().alias("volume"),
        fp.notional_total().alias("value"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
    )

    def inside(size: str) -> Column:
        micros = F.lit(interval_seconds(size) * 1_000_000)
        start = F.unix_micros("at") - F.pmod(F.unix_micros("at"), micros)
        return F.struct(
            F.timestamp_micros(start).alias("window_start"),
            F.timestamp_micros(start + micros).alias("window_end"),
            F.lit(size).alias("window_size"),
        )

    windows = base.withColumn("w", F.explode(F.array(*[inside(size) for size in sizes])))
    return windows.groupBy("symbol", "w.window_start", "w.window_end", "w.window_size").agg(
        F.sum("n").alias("trade_count"),
        F.sum("volume").alias("total_volume"),
        fp.vwap_from(F.sum("value"), F.sum("volume")).alias("vwap"),
        F.max("high").alias("high_price"),
        F.min("low").alias("low_price"),
    )
