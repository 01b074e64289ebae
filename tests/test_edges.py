"""Values at the edges of types, and messages in every form a producer may send."""

from __future__ import annotations

import json
import math
import statistics

from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.functions.masking import row_hash
from tapelake.functions.timing import event_time
from tapelake.operators import ingest
from tapelake.sources.files import read_or_empty
from tapelake.streaming.pipelines import rocksdb_state


def topic(spark, values):
    rows = [(v, "raw.trades", 0, n) for n, v in enumerate(values)]
    return spark.createDataFrame(rows, "value string, topic string, partition int, offset bigint")


def trade(**changes):
    base = {"trade_id": "T1", "symbol": "AAA", "price": 1.5, "quantity": 5, "timestamp": "2024-01-01T00:00:00Z", "is_aggressive_buy": True}
    return json.dumps({k: v for k, v in (base | changes).items() if v is not ...})


def test_row_hash_keeps_the_place_of_null(spark):
    rows = spark.createDataFrame([("A", None, "C"), ("A", "C", None), ("A", "C", ""), ("A", "b", "C")], "a string, b string, c string")
    found = [r.h for r in rows.select(row_hash("a", "b", "c").alias("h")).collect()]
    assert len(set(found)) == 4


def test_stddev_of_values_whose_squares_pass_38_digits(spark):
    values = [9_000_000_000_000_000_000 - k * 10**15 for k in range(300)]
    rows = spark.createDataFrame([(v,) for v in values], "x bigint")
    found = rows.select(fp.sample_stddev("x").alias("s")).first().s
    assert math.isclose(found, statistics.stdev(values), rel_tol=1e-6)
    small = spark.createDataFrame([(3,), (5,), (10,)], "x bigint").select(fp.sample_stddev("x").alias("s")).first().s
    assert small == math.sqrt(13)


def test_one_extreme_notional_does_not_end_the_sum(spark):
    rows = spark.createDataFrame([(1e5, 100_000_000), (0.1, 3), (2.5, -4)], "price double, quantity int")
    found = rows.agg(fp.notional_total().alias("t"), fp.notional_sum().alias("v"), fp.vwap().alias("p")).first()
    assert int(found.t) == 10**19 + 300_000 - 10_000_000
    assert found.v == float(10**19 + 300_000 - 10_000_000) / 1e6 and math.isclose(found.p, 1e5, rel_tol=1e-6)


def test_event_time_takes_any_number_of_fraction_digits(spark):
    texts = ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00.1Z", "2024-01-01T00:00:00.123Z", "2024-01-01T00:00:00.123456Z", "12:00:00", "soon", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(event_time("t").alias("e")).collect()
    assert [None if r.e is None else r.e.microsecond for r in rows] == [0, 100000, 123000, 123000, None, None, None]


def test_every_trade_message_is_accepted_or_rejected_with_a_reason(spark):
    values = {
        trade(): None,
        trade(quantity="5"): None,
        trade(price="1.5"): None,
        trade(quantity=5.0): None,
        trade(is_aggressive_buy="yes"): None,
        trade(quantity=3_000_000_000): "bad_quantity",
        trade(quantity=5.5): "bad_quantity",
        trade(price="1.5d"): "bad_price",
        trade(price="NaN"): "bad_price",
        trade(price=...): "missing_price",
        trade(trade_id=None): "missing_trade_id",
        trade(timestamp="soon"): "bad_timestamp",
        '{"trade_id":': "bad_json",
        "": "bad_json",
        None: "bad_json",
    }
    messages = topic(spark, values)
    kept = ingest.parse_trades(messages).collect()
    left = {r.offset: r.reason for r in ingest.rejects(ingest.read_trades(messages)).collect()}
    assert left == {n: reason for n, reason in enumerate(values.values()) if reason}
    assert sorted(r._kafka_offset for r in kept) == [n for n, reason in enumerate(values.values()) if not reason]
    assert {(r.price, r.quantity, r.is_aggressive_buy) for r in kept} == {(1.5, 5, True)}


def test_order_books_with_unreadable_numbers_are_rejected(spark):
    def book(**changes):
        level = {"price": 1.5, "quantity": 5, "order_count": 1} | changes.pop("level", {})
        return json.dumps({"symbol": "AAA", "timestamp": "2024-01-01T00:00:00Z", "bids": [level], "asks": []} | changes)

    values = [book(), book(level={"quantity": "7"}), book(level={"quantity": 3_000_000_000}), book(sequence_number=3_000_000_000), book(symbol=None)]
    messages = topic(spark, values)
    kept = {r._kafka_offset: (r.bids_json, r.sequence_number) for r in ingest.parse_orderbooks(messages).collect()}
    assert kept == {n: (f'[{{"price":1.5,"quantity":{q},"order_count":1}}]', 0) for n, q in ((0, 5), (1, 7))}
    left = {r.offset: r.reason for r in ingest.rejects(ingest.read_orderbooks(messages)).collect()}
    assert left == {2: "bad_bids", 3: "bad_sequence_number", 4: "missing_symbol"}


def test_numbers_past_int32_are_valid_only_where_they_fit(spark):
    stats = {"event_id": "E", "timestamp": "t", "symbol": "A", "open": 1, "high": 1, "low": 1, "close": 1, "trade_count": 1, "vwap": 1}
    sold = {
        "event_id": "E", "timestamp": "t", "trade_id": "T", "symbol": "A", "price": 1.0, "quantity": 5, "buy_order_id": "b", "sell_order_id": "s",
        "buyer_agent_id": "x", "seller_agent_id": "y", "is_aggressive_buy": True,
    }
    sent = [
        ("MarketStats", stats | {"volume": 9_007_199_254_740_993}),
        ("MarketStats", stats | {"volume": 10**20}),
        ("TradeExecuted", sold | {"quantity": 3_000_000_000}),
        ("TradeExecuted", sold | {"price": "1.5d"}),
    ]
    messages = topic(spark, [json.dumps({"event_type": kind, "data": data}) for kind, data in sent])
    rows = ingest.validate(ingest.decode(messages)).select("offset", "is_valid", "event_type", "data")
    assert {r.offset: r.is_valid for r in rows.select("offset", "is_valid").collect()} == {0: True, 1: False, 2: False, 3: False}
    flat = ingest.flatten(rows.filter("is_valid")).select(F.get_json_object("flat", "$.volume").alias("v")).first()
    assert flat.v == "9007199254740993"


def test_a_table_not_yet_written_is_empty(spark, tmp_path):
    assert read_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0


def test_stream_settings_end_with_the_block(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key, None) == before
