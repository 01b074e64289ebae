"""Ingestion, order-book and health queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapelake.operators import health, ingest, orderbook
from tapelake.plans.market_sql import rounded
from tapelake.plans.registry import query
from tapelake.schemas import TRADE_EVENT
from tapelake.sources.views import PROCESSED_AT


@query(
    "evt_decode",
    """SELECT n AS "offset", event_type, CASE WHEN status IN ('valid', 'invalid') THEN 'decoded' ELSE status END AS status FROM feed""",
)
def evt_decode(m):
    return m.decoded.select("offset", "event_type", "status")


@query(
    "evt_validate",
    """SELECT n AS "offset", event_type, status = 'valid' AS is_valid,
       CASE status WHEN 'bad_json' THEN 'json_decode_error' WHEN 'invalid' THEN 'validation_error' END AS error FROM feed""",
)
def evt_validate(m):
    return m.validated.select("offset", "event_type", "is_valid", "error")


TOPIC_SQL = """CASE event_type WHEN 'OrderPlaced' THEN 'raw.orders' WHEN 'OrderCancelled' THEN 'raw.orders' WHEN 'TradeExecuted' THEN 'raw.trades'
            WHEN 'QuoteUpdate' THEN 'raw.quotes' WHEN 'OrderBookSnapshot' THEN 'raw.orderbook-snapshots' WHEN 'MarketStats' THEN 'raw.market-stats'
            WHEN 'TradingHalt' THEN 'raw.trading-halts' WHEN 'TradingResume' THEN 'raw.trading-halts' WHEN 'AgentAction' THEN 'raw.agent-actions'
            ELSE 'dlq.raw.failed' END"""


@query(
    "evt_route",
    f"""SELECT n AS "offset", event_type, {TOPIC_SQL} AS topic,
       CASE WHEN event_type IS NULL OR event_type = 'Mystery' OR slot = 25 THEN NULL WHEN event_type = 'AgentAction' THEN 'A7' ELSE symbol END AS key
FROM feed WHERE status IN ('valid', 'invalid')""",
)
def evt_route(m):
    decoded = m.decoded.filter("status = 'decoded'")
    return ingest.route(decoded).select("offset", "event_type", "topic", "key")


@query(
    "evt_flatten",
    """SELECT n AS "offset", event_type, trade_id, symbol, price, quantity, CASE WHEN slot = 20 THEN true ELSE n % 2 = 0 END AS is_aggressive_buy
FROM feed WHERE status = 'valid' AND event_type = 'TradeExecuted'""",
)
def evt_flatten(m):
    """Valid trades read back from their flat text, which shows the coercion of quoted numbers and of yes."""
    valid = m.validated.filter("is_valid AND event_type = 'TradeExecuted'")
    event = F.from_json("flat", TRADE_EVENT)
    return ingest.flatten(valid).select("offset", event.alias("e")).select(
        "offset", "e.event_type", "e.trade_id", "e.symbol", "e.price", "e.quantity", "e.is_aggressive_buy"
    )


@query(
    "evt_flatten_other",
    """SELECT n AS "offset", CASE event_type
  WHEN 'QuoteUpdate' THEN '{"event_type":"QuoteUpdate","event_id":"E' || n || '","timestamp":"2024-01-01T00:00:00Z","symbol":"' || symbol || '","best_bid":null,"best_bid_size":0,"best_ask":null,"best_ask_size":0,"spread":null}'
  WHEN 'TradingHalt' THEN '{"event_type":"TradingHalt","symbol":"' || symbol || '","reason":"drop","level":2,"trigger_price":90.0,"reference_price":100.0,"decline_pct":10.0,"halt_duration_secs":600}'
  WHEN 'TradingResume' THEN '{"event_type":"TradingResume","symbol":"' || symbol || '","halted_at":"x","halt_duration_secs":600,"level":1}'
  WHEN 'MarketStats' THEN '{"event_type":"MarketStats","event_id":"E' || n || '","timestamp":"2024-01-01T00:00:00Z","symbol":"' || symbol || '","open":1.0,"high":2.5,"low":1.0,"close":2.0,"volume":10,"trade_count":1,"vwap":1.5}'
  WHEN 'AgentAction' THEN '{"event_type":"AgentAction","event_id":"E' || n || '","timestamp":"2024-01-01T00:00:00Z","agent_id":"A7","agent_type":"RetailTrader","symbol":"' || symbol || '","action":"BUY","decision_factors":["momentum","spread"]}'
  END AS flat
FROM feed WHERE status = 'valid' AND event_type IN ('QuoteUpdate', 'TradingHalt', 'TradingResume', 'MarketStats', 'AgentAction')""",
)
def evt_flatten_other(m):
    """The exact flat text of types without prices from the data: defaults filled in, integers read as doubles."""
    wanted = F.col("event_type").isin("QuoteUpdate", "TradingHalt", "TradingResume", "MarketStats", "AgentAction")
    valid = m.validated.filter(F.col("is_valid") & wanted)
    return ingest.flatten(valid).select("offset", "flat")


@query(
    "evt_flatten_orders",
    """SELECT n AS "offset", CASE event_type
  WHEN 'OrderPlaced' THEN '{"event_type":"OrderPlaced","event_id":"E' || n || '","timestamp":"2024-01-01T00:00:00Z","order_id":"O1","symbol":"' || symbol || '","side":"Buy","order_type":"Limit","price":null,"quantity":' || quantity || ',"agent_id":"A1","agent_type":"MarketMaker"}'
  WHEN 'OrderCancelled' THEN '{"event_type":"OrderCancelled","event_id":"E' || n || '","timestamp":"2024-01-01T00:00:00Z","order_id":"O1","symbol":"' || symbol || '","side":"Sell","price":' || price::DOUBLE || ',"remaining_quantity":0,"agent_id":"A1","reason":"user"}'
  WHEN 'OrderBookSnapshot' THEN '{"event_type":"OrderBookSnapshot","event_id":"E' || n || '","timestamp":"2024-01-01T00:00:00Z","symbol":"' || symbol || '","bids":[{"price":' || price::DOUBLE || ',"quantity":5,"order_count":0}],"asks":[],"sequence_number":null}'
  END AS flat
FROM feed WHERE status = 'valid' AND event_type IN ('OrderPlaced', 'OrderCancelled', 'OrderBookSnapshot')""",
)
def evt_flatten_orders(m):
    """The exact flat text of orders, cancellations and books, prices taken from the data."""
    wanted = F.col("event_type").isin("OrderPlaced", "OrderCancelled", "OrderBookSnapshot")
    valid = m.validated.filter(F.col("is_valid") & wanted)
    return ingest.flatten(valid).select("offset", "flat")


@query(
    "evt_dlq",
    """SELECT n AS "offset", CASE status WHEN 'bad_json' THEN 'json_decode_error' ELSE 'validation_error' END AS error, true AS keeps_message
FROM feed WHERE status IN ('bad_json', 'invalid')""",
)
def evt_dlq(m):
    letters = ingest.dead_letters(m.validated)
    body = F.from_json("envelope", "error string, original_message string")
    return letters.select("offset", "value", body.alias("e")).select(
        "offset", F.col("e.error").alias("error"), (F.col("e.original_message") == F.col("value")).alias("keeps_message")
    )


@query(
    "bronze_parse_trade",
    """SELECT trade_id, symbol, price, quantity, buy_order_id, sell_order_id, buyer_agent_id, seller_agent_id, is_aggressive_buy,
       'TradeExecuted' AS event_type, timestamp, 'raw.trades' AS _kafka_topic, _kafka_partition, _kafka_offset,
       TIMESTAMP '2024-01-31 00:00:00' AS _ingested_at FROM trades""",
)
def bronze_parse_trade(m):
    return ingest.parse_trades(m.trade_messages, ingested_at=PROCESSED_AT)


@query(
    "bronze_parse_orderbook",
    """SELECT symbol, coalesce('[' || string_agg(lvl, ',' ORDER BY trade_id) FILTER (WHERE side = 'BID') || ']', '[]') AS bids_json,
       coalesce('[' || string_agg(lvl, ',' ORDER BY trade_id) FILTER (WHERE side = 'ASK') || ']', '[]') AS asks_json,
       cast(CASE WHEN extract(day FROM snapshot_ts) % 2 = 0 THEN extract(day FROM snapshot_ts) ELSE 0 END AS int) AS sequence_number,
       'OrderBookSnapshot' AS event_type, cast(snapshot_ts AS timestamp) AS timestamp, 'raw.orderbook-snapshots' AS _kafka_topic,
       0 AS _kafka_partition, cast(epoch_us(cast(snapshot_ts AS timestamp)) // 1000000 AS bigint) AS _kafka_offset, TIMESTAMP '2024-01-31 00:00:00' AS _ingested_at
FROM (SELECT *, '{"price":' || cast(price AS varchar) || ',"quantity":' || quantity || ',"order_count":' || order_count || '}' AS lvl FROM book_levels)
GROUP BY symbol, snapshot_ts""",
)
def bronze_parse_orderbook(m):
    return ingest.parse_orderbooks(m.book_messages, ingested_at=PROCESSED_AT)


def odd_trade_messages(m):
    """The trade topic with numbers quoted or with a fraction, times of 0, 1, 3 and 6 fraction digits, and, by offset,
    what Bronze cannot hold."""
    kind = F.col("offset") % 13
    changes = {
        1: (r'"quantity":(\d+)', '"quantity":"$1"'),
        2: (r'"quantity":(\d+)', '"quantity":$1.0'),
        3: (r'"quantity":(\d+)', '"quantity":3000000000'),
        4: (r'"price":[^,]+', '"price":"1.5d"'),
        5: (r'"price":([^,]+)', '"price":"$1"'),
        6: (r'"trade_id":"[^"]*",', ""),
        7: (r"^(.{60}).*$", "$1"),
        8: (r"\.\d{6}Z", "Z"),
        9: (r"\.(\d)\d{5}Z", ".$1Z"),
        10: (r"\.(\d{3})\d{3}Z", ".$1Z"),
        11: (r'"timestamp":"[^"]*"', '"timestamp":"soon"'),
    }
    value = F.col("value")
    for number, (pattern, to) in changes.items():
        value = F.when(kind == number, F.regexp_replace("value", pattern, to)).otherwise(value)
    return m.trade_messages.withColumn("value", value)


ACCEPTED_SQL = """SELECT trade_id, symbol, price, quantity, is_aggressive_buy,
       CASE _kafka_offset % 13 WHEN 8 THEN date_trunc('second', timestamp) WHEN 10 THEN date_trunc('millisecond', timestamp)
            WHEN 9 THEN make_timestamp(epoch_us(timestamp) // 100000 * 100000) ELSE timestamp END AS timestamp, _kafka_offset
FROM trades WHERE _kafka_offset % 13 NOT IN (3, 4, 6, 7, 11)"""
ACCEPTED = ("trade_id", "symbol", "price", "quantity", "is_aggressive_buy", "timestamp", "_kafka_offset")


@query("bronze_parse_trade_coerced", ACCEPTED_SQL)
def bronze_parse_trade_coerced(m):
    return ingest.parse_trades(odd_trade_messages(m), ingested_at=PROCESSED_AT).select(*ACCEPTED)


@query(
    "bronze_rejects",
    """SELECT 'raw.trades' AS topic, _kafka_partition AS "partition", _kafka_offset AS "offset",
       CASE _kafka_offset % 13 WHEN 3 THEN 'bad_quantity' WHEN 4 THEN 'bad_price' WHEN 6 THEN 'missing_trade_id' WHEN 7 THEN 'bad_json'
            ELSE 'bad_timestamp' END AS reason
FROM trades WHERE _kafka_offset % 13 IN (3, 4, 6, 7, 11)""",
)
def bronze_rejects(m):
    """With ``bronze_parse_trade_coerced`` every message of the topic is accounted for."""
    return ingest.rejects(ingest.read_trades(odd_trade_messages(m))).select("topic", "partition", "offset", "reason")


METRICS_SQL = """WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, snapshot_ts, side ORDER BY CASE WHEN side = 'BID' THEN -price ELSE price END, trade_id) AS rn
  FROM book_levels),
sides AS (
  SELECT symbol, cast(snapshot_ts AS timestamp) AS timestamp, cast(extract(day FROM snapshot_ts) AS int) AS sequence_number,
         coalesce(max(CASE WHEN side = 'BID' THEN price END), 0) AS bid, coalesce(min(CASE WHEN side = 'ASK' THEN price END), 0) AS ask,
         coalesce(cast(sum(quantity) FILTER (WHERE side = 'BID' AND rn <= 5) AS bigint), 0) AS bd,
         coalesce(cast(sum(quantity) FILTER (WHERE side = 'ASK' AND rn <= 5) AS bigint), 0) AS ad,
         cast(count(*) FILTER (WHERE side = 'BID') AS int) AS bid_levels, cast(count(*) FILTER (WHERE side = 'ASK') AS int) AS ask_levels
  FROM ranked GROUP BY symbol, snapshot_ts),
spreads AS (SELECT *, CASE WHEN bid > 0 AND ask > 0 THEN ask - bid ELSE 0 END AS sp, CASE WHEN bid > 0 AND ask > 0 THEN (bid + ask) / 2 ELSE 0 END AS mid FROM sides)
SELECT symbol, timestamp, sequence_number, {best_bid} AS best_bid, {best_ask} AS best_ask, {spread} AS spread, {bps} AS spread_bps, {mid} AS mid_price,
       bd AS bid_depth_5, ad AS ask_depth_5, {imbalance} AS imbalance, bid_levels, ask_levels FROM spreads"""


def _metrics_sql() -> str:
    return METRICS_SQL.format(
        best_bid=rounded("bid", 4),
        best_ask=rounded("ask", 4),
        spread=rounded("sp", 4),
        bps=rounded("CASE WHEN mid > 0 THEN sp / mid * 10000 ELSE 0 END", 2),
        mid=rounded("mid", 4),
        imbalance=rounded("CASE WHEN bd + ad > 0 THEN cast(bd - ad AS double) / (bd + ad) ELSE 0 END", 4),
    )


@query("st_orderbook_metrics", _metrics_sql())
def st_orderbook_metrics(m):
    return orderbook.orderbook_metrics(m.books)


FEED_EVENTS = """arrivals AS (
  SELECT timestamp, status, ((n * 37) % 100 + 1) * 0.015::DOUBLE AS latency_seconds FROM feed WHERE NOT (extract(day FROM timestamp) = 12 AND extract(hour FROM timestamp) < 6))"""


def feed_events(m):
    """Outcome and latency of every message; the feed falls silent for six hours of the 12th."""
    silent = (F.dayofmonth("timestamp") == 12) & (F.hour("timestamp") < 6)
    checked = m.validated.filter(~silent)
    status = F.when(F.col("status") != "decoded", F.col("status")).when(F.col("is_valid"), "valid").otherwise("invalid")
    # The latency stands in for a measured one: 15 ms to 1.5 s, by the offset.
    latency = ((F.col("offset") * 37) % 100 + 1).cast("double") * F.lit(0.015)
    return checked.select("timestamp", status.alias("status"), latency.alias("latency_seconds"), "event_type", "data")


def _health_sql(minutes: int) -> str:
    bounds = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]
    counts = ", ".join(f"count(*) FILTER (WHERE latency_seconds <= {b}::DOUBLE) AS c{i}" for i, b in enumerate(bounds))
    cases, lower, before = [], "0::DOUBLE", "0"
    for i, b in enumerate([*bounds, None]):
        upper = f"{b}::DOUBLE" if b is not None else "top"
        c = f"c{i}" if b is not None else "received"
        cases.append(
            f"WHEN {c} >= 0.95::DOUBLE * received THEN {lower} + ({upper} - {lower}) * ((0.95::DOUBLE * received - {before}) / nullif({c} - {before}, 0))"
        )
        lower, before = upper, c
    return f"""SELECT window_start, received, rejected, dlq, cast(received AS double) / {minutes * 60} AS received_rate,
         cast(rejected AS double) / {minutes * 60} AS rejected_rate, CASE {' '.join(cases)} END AS latency_p95
  FROM (SELECT time_bucket(INTERVAL '{minutes} minutes', timestamp) AS window_start, count(*) AS received,
               count(*) FILTER (WHERE status = 'invalid') AS rejected, count(*) FILTER (WHERE status IN ('invalid', 'bad_json')) AS dlq,
               max(latency_seconds) AS top, {counts} FROM arrivals GROUP BY 1)"""


@query("ingest_health", f"WITH {FEED_EVENTS} {_health_sql(60)}")
def ingest_health(m):
    return health.ingest_health(feed_events(m), "1 hour")


@query(
    "ingest_topic_counts",
    f"""SELECT time_bucket(INTERVAL '1 day', timestamp) AS window_start, {TOPIC_SQL} AS topic, count(*) AS produced
FROM feed WHERE status = 'valid' GROUP BY 1, 2""",
)
def ingest_topic_counts(m):
    valid = m.validated.filter("is_valid")
    return health.topic_counts(ingest.route(valid), "1 day")


def _filled_sql(minutes: int) -> str:
    return f"""h{minutes} AS ({_health_sql(minutes)}),
f{minutes} AS (SELECT g.window_start, coalesce(received_rate, 0) AS received_rate, coalesce(rejected_rate, 0) AS rejected_rate, coalesce(dlq, 0) AS dlq, latency_p95
  FROM (SELECT unnest(generate_series((SELECT min(window_start) FROM h{minutes}), (SELECT max(window_start) FROM h{minutes}), INTERVAL '{minutes} minutes')) AS window_start) g
  LEFT JOIN h{minutes} USING (window_start))"""


@query(
    "ingest_alerts",
    f"""WITH {FEED_EVENTS}, {_filled_sql(5)}, {_filled_sql(10)}, {_filled_sql(15)}
SELECT 'BridgeThroughputZero' AS alert, 'critical' AS severity, window_start, received_rate AS measured FROM f5 WHERE received_rate = 0
UNION ALL SELECT 'BridgeThroughputDrop', 'warning', window_start, received_rate FROM f10 WHERE received_rate < 0.1::DOUBLE
UNION ALL SELECT 'KafkaBridgeHighDLQ', 'warning', window_start, cast(dlq AS double) FROM f15 WHERE dlq > 10
UNION ALL SELECT 'KafkaBridgeHighValidationFailures', 'warning', window_start, rejected_rate FROM f5 WHERE rejected_rate > 0.1::DOUBLE
UNION ALL SELECT 'KafkaBridgeHighLatency', 'warning', window_start, latency_p95 FROM f5 WHERE latency_p95 > 1.0""",
)
def ingest_alerts(m):
    return health.ingest_alerts(feed_events(m))
