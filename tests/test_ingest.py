import json

import pytest
from pyspark.sql import functions as F

from tapelake.operators import ingest, orderbook
from tapelake.functions.book import LEVELS

HEAD = {"event_id": "E1", "timestamp": "2024-01-01T00:00:00Z", "symbol": "AAA"}
TRADE = {
    **HEAD, "trade_id": "T1", "price": 10.5, "quantity": 3, "buy_order_id": "b", "sell_order_id": "s", "buyer_agent_id": "x",
    "seller_agent_id": "y", "is_aggressive_buy": True,
}
QUOTE = dict(HEAD)
BOOK = {**HEAD, "bids": [{"price": 1.5, "quantity": 2}], "asks": []}
HALT = {"symbol": "A", "reason": "r", "level": 1, "trigger_price": 1, "reference_price": 2.0, "decline_pct": 7, "halt_duration_secs": 300}
ACTION = {**HEAD, "agent_id": "g", "agent_type": "MarketMaker", "action": "BUY", "decision_factors": []}
ORDER = {**HEAD, "order_id": "o", "side": "Buy", "order_type": "Limit", "price": None, "quantity": 1, "agent_id": "g", "agent_type": "RetailTrader"}

CASES = [
    ("TradeExecuted", TRADE, True),
    ("TradeExecuted", {**TRADE, "extra": 1}, True),
    ("TradeExecuted", {k: v for k, v in TRADE.items() if k != "symbol"}, False),
    ("TradeExecuted", {"symbol": "AAA", "price": 1.0}, False),
    ("TradeExecuted", {**TRADE, "symbol": None}, False),
    ("TradeExecuted", {**TRADE, "symbol": 5}, False),
    ("TradeExecuted", {**TRADE, "quantity": "3"}, True),
    ("TradeExecuted", {**TRADE, "quantity": 3.0}, True),
    ("TradeExecuted", {**TRADE, "quantity": 3.5}, False),
    ("TradeExecuted", {**TRADE, "quantity": "x"}, False),
    ("TradeExecuted", {**TRADE, "price": "1e3"}, True),
    ("TradeExecuted", {**TRADE, "price": [1]}, False),
    ("TradeExecuted", {**TRADE, "is_aggressive_buy": "off"}, True),
    ("TradeExecuted", {**TRADE, "is_aggressive_buy": 1}, True),
    ("TradeExecuted", {**TRADE, "is_aggressive_buy": 2}, False),
    ("TradeExecuted", {**TRADE, "is_aggressive_buy": "maybe"}, False),
    ("QuoteUpdate", QUOTE, True),
    ("QuoteUpdate", {**QUOTE, "best_bid": None, "spread": 0.1}, True),
    ("QuoteUpdate", {**QUOTE, "best_bid_size": None}, False),
    ("QuoteUpdate", {**QUOTE, "best_bid_size": 4}, True),
    ("OrderBookSnapshot", BOOK, True),
    ("OrderBookSnapshot", {**BOOK, "sequence_number": None}, True),
    ("OrderBookSnapshot", {**BOOK, "bids": None}, False),
    ("OrderBookSnapshot", {**BOOK, "bids": [{"price": 1.5}]}, False),
    ("OrderBookSnapshot", {**BOOK, "bids": [{"price": 1.5, "quantity": 2, "order_count": 1.5}]}, False),
    ("OrderBookSnapshot", {**BOOK, "bids": {"price": 1.5}}, False),
    ("TradingHalt", HALT, True),
    ("TradingHalt", {**HALT, "level": 4}, False),
    ("TradingHalt", {**HALT, "level": 0}, False),
    ("TradingResume", {"symbol": "A", "halted_at": "t", "halt_duration_secs": 1, "level": 3}, True),
    ("AgentAction", ACTION, True),
    ("AgentAction", {**ACTION, "agent_type": "Robot"}, False),
    ("AgentAction", {**ACTION, "decision_factors": [1]}, False),
    ("AgentAction", {**ACTION, "decision_factors": "a"}, False),
    ("OrderPlaced", ORDER, True),
    ("OrderPlaced", {**ORDER, "side": "buy"}, False),
    ("OrderPlaced", {**ORDER, "order_type": "Stop"}, False),
    ("OrderPlaced", {k: v for k, v in ORDER.items() if k != "price"}, True),
    ("OrderCancelled", {**HEAD, "order_id": "o", "side": "Sell", "price": 1, "remaining_quantity": 0, "agent_id": "g", "reason": "r"}, True),
    ("OrderCancelled", {**HEAD, "order_id": "o", "side": "Sell", "price": None, "remaining_quantity": 0, "agent_id": "g", "reason": "r"}, False),
    ("MarketStats", {**HEAD, "open": 1, "high": 1, "low": 1, "close": 1, "volume": 1, "trade_count": 1, "vwap": 1.0}, True),
    ("MarketStats", {**HEAD, "open": 1, "high": 1, "low": 1, "last": 1, "volume": 1, "trade_count": 1, "vwap": 1.0}, False),
    ("Nonsense", TRADE, False),
]


@pytest.fixture(scope="module")
def checked(spark):
    texts = [(i, json.dumps({"event_type": kind, "data": data})) for i, (kind, data, _) in enumerate(CASES)]
    messages = spark.createDataFrame(texts, "id int, value string")
    return {r.id: r for r in ingest.validate(ingest.decode(messages)).select("id", "is_valid", "error").collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_validation(checked, i):
    assert checked[i].is_valid == CASES[i][2], CASES[i]
    assert (checked[i].error is None) == CASES[i][2]


def test_decode_outcomes(spark):
    texts = ["{", "", "[1, 2]", "5", '{"type": "welcome"}', '{"event_type": null}', '{"event_type": "X"}']
    df = ingest.decode(spark.createDataFrame([(t,) for t in texts], "value string"))
    got = {r.value: r.status for r in df.collect()}
    assert [got[t] for t in texts] == ["bad_json", "bad_json", "skipped", "skipped", "skipped", "decoded", "decoded"]


def test_the_text_is_parsed_once(market):
    valid = ingest.flatten(ingest.validate(ingest.decode(market.messages)).filter("is_valid")).select("flat")
    assert valid._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_bridge_splits_feed(market):
    good, bad = ingest.bridge(market.messages)
    assert {r.topic for r in bad.select("topic").distinct().collect()} == {ingest.DLQ_TOPIC}
    assert bad.filter("key IS NOT NULL").count() == 0
    topics = {r.topic for r in good.select("topic").distinct().collect()}
    assert topics == {t for t, _ in ingest.ROUTES.values()}
    agents = good.filter("topic = 'raw.agent-actions'").select("key").distinct().collect()
    assert [r.key for r in agents] == ["A7"]
    skipped = market.messages.filter("offset % 50 IN (1, 23)").count()
    assert good.count() + bad.count() + skipped == market.messages.count()


def test_broken_flat_text_is_dropped(spark):
    texts = [json.dumps({"event_type": "TradeExecuted", **TRADE}), "{broken", json.dumps({"symbol": "A"})]
    messages = spark.createDataFrame([(t, "raw.trades", 0, i) for i, t in enumerate(texts)], "value string, topic string, partition int, offset bigint")
    rows = ingest.parse_trades(messages).collect()
    assert [r.trade_id for r in rows] == ["T1"]
    assert (rows[0]._kafka_topic, rows[0]._kafka_offset) == ("raw.trades", 0)


def books(spark, bids, asks):
    level = lambda x: {"price": float(x[0]), "quantity": x[1], "order_count": 1}
    side = lambda xs: None if xs is None else [level(x) for x in xs]
    return spark.createDataFrame([("AAA", side(bids), side(asks))], f"symbol string, bids {LEVELS}, asks {LEVELS}")


def test_book_metrics(spark):
    bids = [(99, 10), (100, 20), (98, 30), (97, 40), (96, 50), (95, 60)]
    asks = [(102, 5), (101, 15)]
    row = orderbook.orderbook_metrics(books(spark, bids, asks)).collect()[0]
    assert (row.best_bid, row.best_ask, row.spread, row.mid_price) == (100.0, 101.0, 1.0, 100.5)
    assert row.spread_bps == 99.5
    assert (row.bid_depth_5, row.ask_depth_5, row.bid_levels, row.ask_levels) == (150, 20, 6, 2)
    assert row.imbalance == 0.7647


def test_book_metrics_of_an_empty_side(spark):
    row = orderbook.orderbook_metrics(books(spark, [(10, 4)], [])).collect()[0]
    assert (row.best_ask, row.spread, row.spread_bps, row.mid_price, row.imbalance) == (0.0, 0.0, 0.0, 0.0, 1.0)
    row = orderbook.orderbook_metrics(books(spark, [], [])).collect()[0]
    assert (row.imbalance, row.bid_levels) == (0.0, 0)


def test_malformed_books_are_dropped(spark):
    assert orderbook.orderbook_metrics(books(spark, None, [])).count() == 0
    missing = books(spark, [(10, 1)], []).withColumn("bids", F.transform("bids", lambda v: v.withField("price", F.lit(None).cast("double"))))
    assert orderbook.orderbook_metrics(missing).count() == 0
