"""Chart, indicator and price-alert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.operators import alerts, charts, gold, indicators
from tapelake.operators.selection import bid_ask_view
from tapelake.plans.analytics import MEAN, PRICE_STD, VALUE, VOLUME, VWAP
from tapelake.plans.market_sql import rounded
from tapelake.plans.registry import query
from tapelake.plans.selection import SIDED
from tapelake.streaming.aggregates import tumbling, tumbling_rollup
from tapelake.streaming.feeds import alert_feed, live_candles, trade_feed

MINUTE = "time_bucket(INTERVAL '1 minute', timestamp) AS bucket_ts"


def side_mean(side: str) -> str:
    when = f"CASE WHEN side = '{side}' THEN"
    return f"cast(sum({when} px END) AS double) / (nullif(count({when} 1 END), 0) * 1000000)"


def side_sum(side: str) -> str:
    return f"cast(sum(CASE WHEN side = '{side}' THEN quantity ELSE 0 END) AS bigint)"


@query("ch_price", f"SELECT {MINUTE}, symbol, {MEAN} AS avg_price FROM trades GROUP BY 1, 2")
def ch_price(m):
    return charts.price_series(m.trades)


@query(
    "ch_ohlc",
    f"""SELECT {MINUTE}, first(price ORDER BY timestamp, trade_id) AS open, max(price) AS high, min(price) AS low,
       last(price ORDER BY timestamp, trade_id) AS close FROM trades GROUP BY 1""",
)
def ch_ohlc(m):
    return charts.ohlc_series(m.trades)


@query("ch_bid_ask", f"WITH {SIDED} SELECT {MINUTE}, side, {MEAN} AS avg_price FROM sided GROUP BY 1, 2")
def ch_bid_ask(m):
    return charts.side_price_series(bid_ask_view(m.trades))


@query("ch_volume", f"SELECT {MINUTE}, {VOLUME} AS volume FROM trades GROUP BY 1")
def ch_volume(m):
    return charts.volume_series(m.trades)


@query(
    "ch_cumvol",
    f"""SELECT bucket_ts, volume, cast(sum(volume) OVER (ORDER BY bucket_ts) AS bigint) AS cumulative_volume
FROM (SELECT {MINUTE}, {VOLUME} AS volume FROM trades GROUP BY 1)""",
)
def ch_cumvol(m):
    return charts.cumulative_volume_series(m.trades)


@query(
    "ch_spread",
    f"""WITH {SIDED} SELECT time_bucket(INTERVAL '1 hour', timestamp) AS bucket_ts, {side_mean("sell")} - {side_mean("buy")} AS spread
FROM sided GROUP BY 1""",
)
def ch_spread(m):
    return charts.spread_series(bid_ask_view(m.trades), "1h")


@query(
    "ch_vwap_price",
    f"""SELECT {MINUTE}, {MEAN} AS avg_price, {VWAP} AS vwap FROM trades GROUP BY 1""",
)
def ch_vwap_price(m):
    return charts.vwap_series(m.trades)


@query(
    "ch_pressure",
    f"WITH {SIDED} SELECT {MINUTE}, {side_sum('buy')} AS buy_volume, {side_sum('sell')} AS sell_volume FROM sided GROUP BY 1",
)
def ch_pressure(m):
    return charts.pressure_series(bid_ask_view(m.trades))


@query("ch_imbalance", f"WITH {SIDED} SELECT {MINUTE}, {side_sum('buy')} - {side_sum('sell')} AS net_flow FROM sided GROUP BY 1")
def ch_imbalance(m):
    return charts.imbalance_series(bid_ask_view(m.trades))


@query("ch_size_dist", f"WITH {SIDED} SELECT size_bucket, count(*) AS trade_count FROM sided GROUP BY 1")
def ch_size_dist(m):
    return charts.size_distribution(bid_ask_view(m.trades))


@query(
    "ch_volatility",
    f"SELECT time_bucket(INTERVAL '30 minutes', timestamp) AS bucket_ts, {PRICE_STD} AS price_stddev FROM trades GROUP BY 1",
)
def ch_volatility(m):
    return charts.volatility_series(m.trades, "30m")


@query(
    "st_ticker_15m",
    f"""SELECT time_bucket(INTERVAL '10 seconds', timestamp) AS bucket_ts, {MEAN} AS avg_price FROM trades
WHERE timestamp > TIMESTAMP '2024-01-15 11:45:00' AND timestamp <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1""",
)
def st_ticker_15m(m):
    return charts.ticker_series(m.trades, "2024-01-15 12:00:00")


@query(
    "ch_exposure",
    f"""SELECT account_id, symbol, cast(sum(CASE WHEN trade_type = 'BUY' THEN quantity ELSE -quantity END) AS bigint) AS net_quantity,
       {VALUE} AS gross_value FROM trades_enriched GROUP BY 1, 2""",
)
def ch_exposure(m):
    return charts.exposure(m.enriched)


@query(
    "ch_concentration",
    """SELECT sector, cast(v AS double) / 1000000 AS total_value, cast(v AS double) / cast(sum(v) OVER () AS double) AS share,
       cast(v AS double) / cast(sum(v) OVER () AS double) > 0.5::DOUBLE AS over_limit
FROM (SELECT sector, sum(px * quantity) AS v FROM trades GROUP BY 1)""",
)
def ch_concentration(m):
    return charts.concentration(m.trades)


@query(
    "ch_candlestick",
    """SELECT symbol, cast(trading_date AS varchar) AS date, coalesce(open_price, 0) AS open, coalesce(close_price, 0) AS close,
       coalesce(low_price, 0) AS low, coalesce(high_price, 0) AS high, cast(total_volume AS double) AS volume, coalesce(vwap, 0) AS vwap FROM gold""",
)
def ch_candlestick(m):
    return charts.candlestick(m.gold)


MACD_SQL = """WITH RECURSIVE bars AS (
  SELECT symbol, time_bucket(INTERVAL '4 hours', timestamp) AS bucket_ts, last(price ORDER BY timestamp, trade_id) AS p FROM trades GROUP BY 1, 2),
series AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bucket_ts) AS rn FROM bars),
walk AS (
  SELECT symbol, rn, bucket_ts, p AS total, NULL::DOUBLE AS fast, NULL::DOUBLE AS slow, NULL::DOUBLE AS line_total, NULL::DOUBLE AS smooth
  FROM series WHERE rn = 1
  UNION ALL
  SELECT symbol, rn, bucket_ts, total, fast, slow,
         CASE WHEN rn = 26 THEN fast - slow WHEN rn > 26 THEN line_total + (fast - slow) END,
         CASE WHEN rn = 34 THEN (line_total + (fast - slow)) / 9 WHEN rn > 34 THEN ((fast - slow) - smooth) * (2::DOUBLE / 10) + smooth END
  FROM (
    SELECT s.symbol, s.rn, s.bucket_ts, w.total + s.p AS total,
           CASE WHEN s.rn = 12 THEN (w.total + s.p) / 12 WHEN s.rn > 12 THEN (s.p - w.fast) * (2::DOUBLE / 13) + w.fast END AS fast,
           CASE WHEN s.rn = 26 THEN (w.total + s.p) / 26 WHEN s.rn > 26 THEN (s.p - w.slow) * (2::DOUBLE / 27) + w.slow END AS slow,
           w.line_total, w.smooth
    FROM walk w JOIN series s ON s.symbol = w.symbol AND s.rn = w.rn + 1))
SELECT symbol, cast(bucket_ts AS timestamp) AS bucket_ts, {macd} AS macd, {signal} AS signal, {histogram} AS histogram FROM walk WHERE rn >= 34"""


@query(
    "win_macd",
    MACD_SQL.replace("{macd}", rounded("fast - slow", 6)).replace("{signal}", rounded("smooth", 6))
    .replace("{histogram}", rounded("(fast - slow) - smooth", 6)),
)
def win_macd(m):
    """Over 4-hour candles, as a month of daily ones is shorter than the warm-up; to six places, as a scan adds in another
    order than a walk."""
    found = indicators.macd(gold.candles(m.trades, "4h"))
    return found.select("symbol", "bucket_ts", *[fp.round_half_up(F.col(c), 6).alias(c) for c in ("macd", "signal", "histogram")])


# Sparse data needs a longer memory than five minutes; the replay is otherwise the detector's.
SLOW_RULES = alerts.AlertRules(baseline_seconds=6 * 3600.0, cooldown_seconds=3600.0)

ALERT_SQL = """WITH RECURSIVE ticks AS (
  SELECT symbol, price AS p, epoch_us(timestamp) AS us, timestamp, row_number() OVER (PARTITION BY symbol ORDER BY timestamp, trade_id) AS rn FROM trades),
walk AS (
  SELECT symbol, rn, timestamp, p, p AS base, us AS since, NULL::BIGINT AS alerted, NULL::DOUBLE AS change, NULL::DOUBLE AS old_base FROM ticks WHERE rn = 1
  UNION ALL
  SELECT symbol, rn, timestamp, p, CASE WHEN expired OR base = 0 OR fires THEN p ELSE base END,
         CASE WHEN expired OR fires THEN us ELSE since END, CASE WHEN fires THEN us ELSE alerted END,
         CASE WHEN fires THEN change END, CASE WHEN fires THEN base END
  FROM (
    SELECT *, NOT expired AND base <> 0 AND change >= 0.02::DOUBLE AND (alerted IS NULL OR us - alerted >= {cooldown}) AS fires
    FROM (
      SELECT t.symbol, t.rn, t.timestamp, t.p, t.us, w.base, w.since, w.alerted, t.us - w.since > {window} AS expired,
             abs(t.p - w.base) / nullif(w.base, 0) AS change
      FROM walk w JOIN ticks t ON t.symbol = w.symbol AND t.rn = w.rn + 1)))
SELECT symbol, CASE WHEN change >= 0.1::DOUBLE THEN 'CRITICAL' WHEN change >= 0.05::DOUBLE THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       CASE WHEN p > old_base THEN 'UP' ELSE 'DOWN' END AS direction, p AS price, old_base AS baseline_price, {pct} AS pct_change,
       timestamp, 'price_movement' AS alert_type
FROM walk WHERE change IS NOT NULL"""


def _alert_sql(window: int, cooldown: int) -> str:
    return ALERT_SQL.format(window=window * 1_000_000, cooldown=cooldown * 1_000_000, pct=rounded("change * 100", 4))


@query("st_price_alert", _alert_sql(21600, 3600))
def st_price_alert(m):
    return alerts.price_alerts(m.trades, SLOW_RULES)


@query("st_price_alert_default", _alert_sql(300, 60))
def st_price_alert_default(m):
    """The detector's own five minutes and one minute."""
    return alerts.price_alerts(m.trades)


def _tumble_sql(minutes: int) -> str:
    return f"""SELECT symbol, time_bucket(INTERVAL '{minutes} minutes', timestamp) AS window_start,
       time_bucket(INTERVAL '{minutes} minutes', timestamp) + INTERVAL '{minutes} minutes' AS window_end, '{minutes}m' AS window_size,
       count(*) AS trade_count, {VOLUME} AS total_volume, {VWAP} AS vwap,
       max(price) AS high_price, min(price) AS low_price FROM trades GROUP BY 1, 2, 3"""


@query("st_tumble_agg", " UNION ALL ".join(_tumble_sql(n) for n in (1, 5, 15)))
def st_tumble_agg(m):
    return tumbling_rollup(m.trades.withColumnRenamed("timestamp", "event_time"))


@query("st_live_candle", f"""SELECT symbol, {MINUTE.replace("bucket_ts", "minute")}, first(price ORDER BY timestamp, trade_id) AS open,
       max(price) AS high, min(price) AS low, last(price ORDER BY timestamp, trade_id) AS close, {VOLUME} AS volume FROM trades GROUP BY 1, 2""")  # fmt: skip
def st_live_candle(m):
    return live_candles(m.trades.withColumnRenamed("timestamp", "event_time"))


@query(
    "st_alert_feed",
    _alert_sql(21600, 3600).replace("FROM walk WHERE change IS NOT NULL", """,
       timestamp AS triggered_at, CASE WHEN change >= 0.1::DOUBLE THEN 0.1::DOUBLE WHEN change >= 0.05::DOUBLE THEN 0.05::DOUBLE ELSE 0.02::DOUBLE END * 100 AS threshold
FROM walk WHERE change IS NOT NULL AND symbol IN ('NATION_3', 'NATION_8')"""),
)
def st_alert_feed(m):
    found = alerts.price_alerts(m.trades, SLOW_RULES)
    return alert_feed(found, ["NATION_3", "NATION_8"], SLOW_RULES).drop("message")


@query("st_trade_feed", "SELECT trade_id, symbol, price, quantity FROM trades WHERE symbol = 'NATION_8'")
def st_trade_feed(m):
    return trade_feed(m.trades, "NATION_8").select("trade_id", "symbol", "price", "quantity")


@query("st_tumble_1m", _tumble_sql(1))
def st_tumble_1m(m):
    return tumbling(m.trades.withColumnRenamed("timestamp", "event_time"), "1m")
