"""Gold: daily bars per symbol, candles of any interval, and the idempotent day job."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.functions.timing import bucket_start, on_days, ts_literal
from tapelake.sources.files import overwrite_partitions


def trade_order(ts: str = "timestamp", tie_break: str | None = "trade_id") -> Column:
    """What first and last mean: event time, then trade id.

    The tie-break makes the ordering key a struct, which costs a sort before the partial aggregate (about four times
    the plain form, measured on 20 million rows). Pass ``tie_break=None`` for feeds without equal timestamps.
    """
    return F.struct(ts, tie_break) if tie_break else F.col(ts)


def ohlcv(ts: str = "timestamp", tie_break: str | None = "trade_id") -> dict[str, Column]:
    """Bar aggregates. All of them combine before the shuffle, so one symbol holding most rows stays cheap."""
    order = trade_order(ts, tie_break)
    return {
        "open_price": F.min_by("price", order),
        "close_price": F.max_by("price", order),
        "high_price": F.max("price"),
        "low_price": F.min("price"),
        "total_volume": fp.quantity_sum(),
        "trade_count": F.count(F.lit(1)),
    }


def aggregates(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def daily_ohlcv(
    trades: DataFrame, day: date | str | None = None, aggregated_at: str | None = None, tie_break: str | None = "trade_id"
) -> DataFrame:
    """One row per symbol and day in the layout of ``GOLD_DAILY``; VWAP is 0 where no volume traded."""
    if day is not None:
        trades = trades.filter(on_days("timestamp", day, day))
    stamp = ts_literal(aggregated_at) if aggregated_at else F.current_timestamp()
    bars = trades.groupBy("symbol", F.to_date("timestamp").alias("trading_date")).agg(
        *aggregates(ohlcv(tie_break=tie_break)),
        fp.notional_total().alias("value_ticks"),
        F.max("company_name").alias("company_name"),
        F.max("sector").alias("sector"),
    )
    return bars.select(
        "symbol",
        "trading_date",
        "open_price",
        "close_price",
        "high_price",
        "low_price",
        F.coalesce(fp.within(fp.vwap_from("value_ticks", "total_volume"), "low_price", "high_price"), F.lit(0.0)).alias(
            "vwap"
        ),
        "total_volume",
        F.col("trade_count").cast("int").alias("trade_count"),
        fp.from_ticks(F.col("value_ticks")).alias("total_value"),
        "company_name",
        "sector",
        stamp.alias("_aggregated_at"),
    )


def run_gold_job(trades: DataFrame, path: str, day: date | str | None = None, aggregated_at: str | None = None) -> None:
    """Rebuild one day, or all days, of the gold table; a rerun gives the same table and empty input changes nothing."""
    overwrite_partitions(daily_ohlcv(trades, day, aggregated_at), path, "trading_date")


def candles(
    trades: DataFrame,
    interval: str,
    symbol: str | None = None,
    first: date | str | None = None,
    last: date | str | None = None,
) -> DataFrame:
    """OHLCV candles of a supported interval; the optional filters reach the scan."""
    bucket = bucket_start("timestamp", interval)
    if symbol is not None:
        trades = trades.filter(F.col("symbol") == symbol)
    if first is not None and last is not None:
        trades = trades.filter(on_days("timestamp", first, last))
    return trades.groupBy("symbol", bucket.alias("bucket_ts")).agg(*aggregates(ohlcv()))
