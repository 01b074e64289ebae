"""Live feeds: trades, alerts and the current candle, for batch or streaming input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.operators.alerts import AlertRules


def trade_feed(trades: DataFrame, symbol: str | None = None) -> DataFrame:
    """Trades of one symbol, or all."""
    return trades if symbol is None else trades.filter(F.col("symbol") == symbol)


def alert_feed(alerts: DataFrame, symbols: list[str] | None = None, rules: AlertRules = AlertRules()) -> DataFrame:
    """Alerts of the watched symbols, with the detector's fields and those its subscribers read."""
    if symbols:
        alerts = alerts.filter(F.col("symbol").isin(*symbols))
    tier = (
        F.when(F.col("severity") == "CRITICAL", rules.critical)
        .when(F.col("severity") == "HIGH", rules.high)
        .otherwise(rules.medium)
    )
    message = F.concat_ws(" ", "severity", "symbol", "direction", F.format_string("%.2f%%", "pct_change"))
    return alerts.withColumns(
        {"triggered_at": F.col("timestamp"), "threshold": tier * F.lit(100.0), "message": message}
    )


def live_candles(trades: DataFrame) -> DataFrame:
    """The minute bar each trade falls in; in update mode the open bar is sent again as it grows."""
    order = F.struct("event_time", "trade_id")
    return trades.groupBy("symbol", F.window("event_time", "1 minute").alias("window")).agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        fp.quantity_sum().alias("volume"),
    ).select("symbol", F.col("window.start").alias("minute"), "open", "high", "low", "close", "volume")
