"""Chart datasets: series per time grain over the bid/ask view of trades, and risk panels over accounts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.functions.timing import bucket_start, ts_literal
from tapelake.operators.gold import trade_order
from tapelake.operators.running import cumulative_volume

GRAIN = "1m"
# Fixed value: the share of one sector above which the concentration panel warns.
CONCENTRATION_LIMIT = 0.5
TICKER_MINUTES = 15


def _bucket(grain: str) -> Column:
    return bucket_start("timestamp", grain).alias("bucket_ts")


def _side_quantity(side: str) -> Column:
    return F.sum(F.when(F.col("side") == side, F.col("quantity").cast("bigint")).otherwise(0))


def price_series(trades: DataFrame, grain: str = GRAIN) -> DataFrame:
    """Mean price per symbol."""
    return trades.groupBy(_bucket(grain), "symbol").agg(fp.price_mean().alias("avg_price"))


def ohlc_series(trades: DataFrame, grain: str = GRAIN) -> DataFrame:
    """Open, high, low and close of all trades."""
    order = trade_order()
    return trades.groupBy(_bucket(grain)).agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
    )


def side_price_series(bid_ask: DataFrame, grain: str = GRAIN) -> DataFrame:
    """Mean price of buy- and sell-initiated trades."""
    return bid_ask.groupBy(_bucket(grain), "side").agg(fp.price_mean().alias("avg_price"))


def volume_series(trades: DataFrame, grain: str = GRAIN) -> DataFrame:
    return trades.groupBy(_bucket(grain)).agg(fp.quantity_sum().alias("volume"))


def cumulative_volume_series(trades: DataFrame, grain: str = GRAIN) -> DataFrame:
    return cumulative_volume(volume_series(trades, grain))


def spread_series(bid_ask: DataFrame, grain: str = GRAIN) -> DataFrame:
    """Mean ask minus mean bid; a sell is a trade at the ask side, a buy at the bid side of the chart."""
    sell, buy = F.col("side") == "sell", F.col("side") == "buy"
    price = F.col("price")
    return bid_ask.groupBy(_bucket(grain)).agg(
        (fp.price_mean(F.when(sell, price)) - fp.price_mean(F.when(buy, price))).alias("spread")
    )


def vwap_series(trades: DataFrame, grain: str = GRAIN) -> DataFrame:
    return trades.groupBy(_bucket(grain)).agg(fp.price_mean().alias("avg_price"), fp.vwap().alias("vwap"))


def pressure_series(bid_ask: DataFrame, grain: str = GRAIN) -> DataFrame:
    """Buy- and sell-initiated volume."""
    return bid_ask.groupBy(_bucket(grain)).agg(
        _side_quantity("buy").alias("buy_volume"), _side_quantity("sell").alias("sell_volume")
    )


def imbalance_series(bid_ask: DataFrame, grain: str = GRAIN) -> DataFrame:
    """Net order flow."""
    return bid_ask.groupBy(_bucket(grain)).agg((_side_quantity("buy") - _side_quantity("sell")).alias("net_flow"))


def size_distribution(bid_ask: DataFrame) -> DataFrame:
    return bid_ask.groupBy("size_bucket").agg(F.count(F.lit(1)).alias("trade_count"))


def volatility_series(trades: DataFrame, grain: str = GRAIN) -> DataFrame:
    """Sample deviation of price, NULL for a single trade."""
    return trades.groupBy(_bucket(grain)).agg(fp.price_stddev().alias("price_stddev"))


def ticker_series(trades: DataFrame, now: datetime | str, minutes: int = TICKER_MINUTES) -> DataFrame:
    """Mean price per 10 seconds over the last minutes before ``now``."""
    end = ts_literal(now)
    recent = trades.filter((F.col("timestamp") > end - F.expr(f"INTERVAL {minutes} MINUTES")) & (F.col("timestamp") <= end))
    return recent.groupBy(F.window("timestamp", "10 seconds")["start"].alias("bucket_ts")).agg(
        fp.price_mean().alias("avg_price")
    )


def exposure(enriched: DataFrame) -> DataFrame:
    """Account by symbol heatmap in long form: signed quantity and traded value."""
    signed = F.when(F.col("trade_type") == "BUY", F.col("quantity")).otherwise(-F.col("quantity")).cast("bigint")
    return enriched.groupBy("account_id", "symbol").agg(
        F.sum(signed).alias("net_quantity"), fp.notional_sum().alias("gross_value")
    )


def exposure_matrix(enriched: DataFrame, symbols: list[str]) -> DataFrame:
    """The heatmap with one column per given symbol."""
    return exposure(enriched).groupBy("account_id").pivot("symbol", symbols).agg(F.first("net_quantity"))


def concentration(trades: DataFrame, limit: float = CONCENTRATION_LIMIT) -> DataFrame:
    """Share of each sector in traded value, and whether it passes the limit."""
    by_sector = trades.groupBy("sector").agg(fp.notional_total().alias("ticks"))
    total = by_sector.agg(F.sum("ticks").alias("total"))
    share = F.col("ticks").cast("double") / F.nullif(F.col("total").cast("double"), F.lit(0.0))
    return by_sector.crossJoin(total).select(
        "sector", fp.from_ticks(F.col("ticks")).alias("total_value"), share.alias("share"), (share > limit).alias("over_limit")
    )


def candlestick(gold: DataFrame) -> DataFrame:
    """Bars in the chart's shape, NULL as 0."""

    def or_zero(name: str, alias: str) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(alias)

    return gold.select(
        "symbol",
        F.col("trading_date").cast("string").alias("date"),
        or_zero("open_price", "open"),
        or_zero("close_price", "close"),
        or_zero("low_price", "low"),
        or_zero("high_price", "high"),
        or_zero("total_volume", "volume"),
        or_zero("vwap", "vwap"),
    )
