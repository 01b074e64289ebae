"""Feed messages derived from trades, covering all nine event types and the ways each can be malformed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How many distinct message shapes repeat along the feed.
CYCLE = 50


def message_text(n: str = "_kafka_offset") -> Column:
    """JSON text of the message at offset ``n``; the offset modulo ``CYCLE`` picks the shape."""
    slot = F.col(n) % CYCLE

    def text(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    symbol, price, qty = F.col("symbol"), F.col("price"), F.col("quantity")
    head = text('"event_id":"E', F.col(n), '","timestamp":"2024-01-01T00:00:00Z"')

    def envelope(kind: str, *body: str | Column) -> Column:
        return text('{"event_type":"', kind, '","data":{', *body, "}}")

    def trade(trade_id: Column, price_json: Column, qty_json: Column, flag: Column) -> Column:
        return envelope(
            "TradeExecuted", head, ',"trade_id":', trade_id, ',"symbol":"', symbol, '","price":', price_json,
            ',"quantity":', qty_json, ',"buy_order_id":"', F.col("buy_order_id"), '","sell_order_id":"',
            F.col("sell_order_id"), '","buyer_agent_id":"', F.col("buyer_agent_id"), '","seller_agent_id":"',
            F.col("seller_agent_id"), '","is_aggressive_buy":', flag,
        )

    trade_id = text('"', F.col("trade_id"), '"')
    flag = F.when(F.col("is_aggressive_buy"), F.lit("true")).otherwise(F.lit("false"))
    price_json, qty_json = price.cast("string"), qty.cast("string")

    def order(side: str) -> Column:
        return envelope(
            "OrderPlaced", head, ',"order_id":"O1","symbol":"', symbol, '","side":"', side,
            '","order_type":"Limit","price":null,"quantity":', qty,
            ',"agent_id":"A1","agent_type":"MarketMaker"',
        )

    def halt(level: str) -> Column:
        return envelope(
            "TradingHalt", '"symbol":"', symbol, '","reason":"drop","level":', level,
            ',"trigger_price":90.0,"reference_price":100.0,"decline_pct":10.0,"halt_duration_secs":600',
        )

    def action(factors: str) -> Column:
        return envelope(
            "AgentAction", head, ',"agent_id":"A7","agent_type":"RetailTrader","symbol":"', symbol,
            '","action":"BUY","decision_factors":', factors,
        )

    shapes = {
        0: text('{"event_type":"TradeExecuted","data":{"symbol":'),
        1: text('{"type":"welcome"}'),
        2: envelope("Mystery", '"symbol":"', symbol, '"'),
        3: envelope("TradeExecuted", '"symbol":"', symbol, '","price":', price),
        4: order("Buy"),
        5: order("Hold"),
        6: envelope(
            "OrderCancelled", head, ',"order_id":"O1","symbol":"', symbol,
            '","side":"Sell","price":', price, ',"remaining_quantity":0,"agent_id":"A1","reason":"user"',
        ),
        7: envelope("QuoteUpdate", head, ',"symbol":"', symbol, '"'),
        8: envelope(
            "OrderBookSnapshot", head, ',"symbol":"', symbol,
            '","bids":[{"price":', price, ',"quantity":5}],"asks":[]',
        ),
        9: envelope(
            "MarketStats", head, ',"symbol":"', symbol,
            '","open":1,"high":2.5,"low":1,"close":2,"volume":10,"trade_count":1,"vwap":1.5',
        ),
        10: halt("2"),
        11: halt("7"),
        12: envelope("TradingResume", '"symbol":"', symbol, '","halted_at":"x","halt_duration_secs":600,"level":1'),
        13: action('["momentum","spread"]'),
        14: action('"momentum"'),
        15: trade(trade_id, price_json, text('"', qty, '"'), flag),
        16: trade(trade_id, price_json, text(qty, ".5"), flag),
        17: trade(trade_id, price_json, text(qty, ".0"), flag),
        18: trade(trade_id, text('"', price, '"'), qty_json, flag),
        19: trade(trade_id, F.lit('"abc"'), qty_json, flag),
        20: trade(trade_id, price_json, qty_json, F.lit('"yes"')),
        21: trade(F.lit("77"), price_json, qty_json, flag),
        22: trade(F.lit("null"), price_json, qty_json, flag),
        23: text("[1,2]"),
        24: text('{"event_type":null,"data":{}}'),
        25: text('{"event_type":"TradeExecuted"}'),
        26: envelope(
            "OrderBookSnapshot", head, ',"symbol":"', symbol,
            '","bids":[{"price":"x","quantity":5}],"asks":[]',
        ),
    }
    out = trade(trade_id, price_json, qty_json, flag)
    picked = None
    for number, shape in shapes.items():
        picked = F.when(slot == number, shape) if picked is None else picked.when(slot == number, shape)
    return picked.otherwise(out)
