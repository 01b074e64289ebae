"""The BI layer: canonical views over trades and daily bars, and their named metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.operators.gold import aggregates, ohlcv


def trades_enriched(trades: DataFrame) -> DataFrame:
    """Trades with side, value, calendar columns and the aggressor's account."""
    buy = F.col("is_aggressive_buy")
    return trades.select(
        "trade_id",
        "symbol",
        F.when(buy, "BUY").otherwise("SELL").alias("trade_type"),
        "price",
        "quantity",
        fp.from_ticks(fp.notional_ticks()).alias("value"),
        F.col("timestamp").alias("traded_at"),
        F.to_date("timestamp").alias("trade_date"),
        F.hour("timestamp").alias("trade_hour"),
        F.when(buy, F.col("buyer_agent_id")).otherwise(F.col("seller_agent_id")).alias("account_id"),
        "sector",
    )


def daily_bars(trades: DataFrame) -> DataFrame:
    """The canonical ``daily_trade_summary``."""
    bars = trades.groupBy("symbol", F.to_date("timestamp").alias("trade_date")).agg(
        *aggregates(ohlcv()), fp.notional_total().alias("value_ticks")
    )
    change = (F.col("close_price") - F.col("open_price")) / F.nullif(F.col("open_price"), F.lit(0.0)) * F.lit(100.0)
    return bars.select(
        "symbol",
        "trade_date",
        "open_price",
        F.col("close_price").alias("close"),
        F.col("high_price").alias("high"),
        F.col("low_price").alias("low"),
        fp.within(fp.vwap_from("value_ticks", "total_volume"), "low_price", "high_price").alias("vwap"),
        "total_volume",
        "trade_count",
        fp.from_ticks(F.col("value_ticks")).alias("total_value_traded"),
        change.alias("change_pct"),
    )


def daily_trade_summary(enriched: DataFrame) -> DataFrame:
    """Counts, volume, value and price range per day, symbol and sector."""
    return enriched.groupBy("trade_date", "symbol", "sector").agg(
        F.count(F.lit(1)).alias("trade_count"),
        fp.quantity_sum().alias("total_volume"),
        fp.notional_sum().alias("total_value"),
        F.min("price").alias("low_price"),
        F.max("price").alias("high_price"),
        fp.price_mean().alias("avg_price"),
    )


def market_daily_overview(enriched: DataFrame) -> DataFrame:
    """Market totals per day, straight from trades so that value stays an exact sum."""
    return enriched.groupBy("trade_date").agg(
        fp.quantity_sum().alias("market_volume"),
        fp.notional_sum().alias("market_value"),
        F.count_distinct("symbol").alias("active_symbols"),
        F.count(F.lit(1)).alias("total_trades"),
    )


def market_daily_breadth(daily: DataFrame, books: DataFrame) -> DataFrame:
    """Advancing, declining and unchanged symbols per day, with the day's mean book spread."""
    change = F.col("close") - F.col("open_price")
    breadth = daily.groupBy("trade_date").agg(
        F.count_if(change > 0).alias("advancing"),
        F.count_if(change < 0).alias("declining"),
        F.count_if(change == 0).alias("unchanged"),
    )
    spreads = books.groupBy(F.to_date("timestamp").alias("trade_date")).agg(fp.price_mean("spread").alias("avg_spread"))
    return breadth.join(spreads, "trade_date", "left")


def sector_daily_summary(enriched: DataFrame) -> DataFrame:
    """Per day and sector: symbols, volume, value, and the mean of the symbols' mean prices."""
    per_symbol = enriched.groupBy("trade_date", "sector", "symbol").agg(
        fp.quantity_sum().alias("volume"),
        fp.notional_total().alias("value_ticks"),
        F.rint(fp.price_mean() * F.lit(1e6)).cast("bigint").alias("mean_micros"),
    )
    return per_symbol.groupBy("trade_date", "sector").agg(
        F.count(F.lit(1)).alias("symbol_count"),
        F.sum("volume").alias("total_volume"),
        fp.from_ticks(F.sum("value_ticks")).alias("total_value"),
        (F.sum("mean_micros").cast("double") / (F.count(F.lit(1)).cast("double") * F.lit(1e6))).alias("avg_price"),
    )


def trader_performance(enriched: DataFrame) -> DataFrame:
    """Per account: counts, bought and sold quantity, value, symbols, first and last day."""
    quantity = F.col("quantity").cast("bigint")
    return enriched.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.sum(F.when(F.col("trade_type") == "BUY", quantity).otherwise(0)).alias("bought_qty"),
        F.sum(F.when(F.col("trade_type") == "SELL", quantity).otherwise(0)).alias("sold_qty"),
        fp.notional_sum().alias("total_value"),
        F.count_distinct("symbol").alias("symbols_traded"),
        F.min("trade_date").alias("first_trade_date"),
        F.max("trade_date").alias("last_trade_date"),
    )


# Named metrics of the BI datasets: dataset -> metric -> aggregate.
METRICS = {
    "daily_trade_summary": {
        "total_volume": lambda: F.sum("total_volume"),
        "avg_vwap": lambda: fp.price_mean("vwap"),
        "trade_count": lambda: F.sum("trade_count"),
        "total_value": lambda: fp.money_sum(fp.ticks("total_value_traded")),
        "avg_change_pct": lambda: fp.price_mean("change_pct"),
    },
    "market_daily_overview": {
        "total_trades": lambda: F.sum("total_trades"),
        "total_volume": lambda: F.sum("market_volume"),
        "total_value": lambda: fp.money_sum(fp.ticks("market_value")),
    },
    "symbol_reference": {"symbol_count": lambda: F.count_distinct("symbol")},
    "trades_enriched": {
        "count": lambda: F.count(F.lit(1)),
        "total_volume": lambda: fp.quantity_sum(),
        "total_value": lambda: fp.notional_sum(),
        "avg_price": lambda: fp.price_mean(),
    },
}


def dataset_metrics(df: DataFrame, dataset: str, metrics: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """Evaluate named metrics of a dataset, all in one pass, optionally grouped."""
    known = METRICS[dataset]
    chosen = metrics or list(known)
    return df.groupBy(*(by or [])).agg(*[known[name]().alias(name) for name in chosen])
