"""Order-book arithmetic on ARRAY<STRUCT<price, quantity, order_count>> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp

LEVEL = "struct<price:double,quantity:int,order_count:int>"
LEVELS = f"array<{LEVEL}>"
DEPTH_LEVELS = 5


def parse_levels(text: Column | str) -> Column:
    """JSON text of a book side to an array of levels; NULL or empty text is an empty side."""
    text = F.col(text) if isinstance(text, str) else text
    empty = F.from_json(F.lit("[]"), LEVELS)
    return F.coalesce(F.from_json(F.when(text != "", text), LEVELS), empty)


def by_price(levels: Column, ascending: bool) -> Column:
    """Levels sorted by price; levels of one price keep their arrival order."""
    keyed = F.transform(
        levels,
        lambda v, i: F.struct(
            (v["price"] if ascending else -v["price"]).alias("rank"), i.alias("seq"), v.alias("level")
        ),
    )
    return F.transform(F.array_sort(keyed), lambda v: v["level"])


def depth(levels: Column, n: int | None = None) -> Column:
    """Quantity on a side, over its first ``n`` levels when given."""
    if n is not None:
        levels = F.slice(levels, 1, n)
    return F.aggregate(levels, F.lit(0).cast("bigint"), lambda acc, v: acc + v["quantity"].cast("bigint"))


def top_of_book(bids: Column, asks: Column) -> dict[str, Column]:
    """Silver's rule: element 0 of each side as it arrived; spread and mid are NULL when a side is empty."""
    bid, ask = F.get(bids, F.lit(0)), F.get(asks, F.lit(0))
    return {
        "best_bid_price": bid["price"],
        "best_bid_qty": bid["quantity"],
        "best_ask_price": ask["price"],
        "best_ask_qty": ask["quantity"],
        "bid_depth": F.size(bids),
        "ask_depth": F.size(asks),
        "spread": ask["price"] - bid["price"],
        "mid_price": (ask["price"] + bid["price"]) / F.lit(2.0),
    }


def book_metrics(bids: Column, asks: Column) -> dict[str, Column]:
    """The stream analyzer's rule: sides sorted by price, 0.0 wherever a side is empty."""
    bids, asks = by_price(bids, ascending=False), by_price(asks, ascending=True)
    zero = F.lit(0.0)
    bid = F.coalesce(F.get(bids, F.lit(0))["price"], zero)
    ask = F.coalesce(F.get(asks, F.lit(0))["price"], zero)
    two_sided = (bid > 0) & (ask > 0)
    spread = F.when(two_sided, ask - bid).otherwise(zero)
    mid = F.when(two_sided, (bid + ask) / F.lit(2.0)).otherwise(zero)
    bid_qty, ask_qty = depth(bids, DEPTH_LEVELS), depth(asks, DEPTH_LEVELS)
    total = (bid_qty + ask_qty).cast("double")
    return {
        "best_bid": fp.round_half_up(bid, 4),
        "best_ask": fp.round_half_up(ask, 4),
        "spread": fp.round_half_up(spread, 4),
        "spread_bps": fp.round_half_up(F.when(mid > 0, spread / mid * F.lit(10000.0)).otherwise(zero), 2),
        "mid_price": fp.round_half_up(mid, 4),
        "bid_depth_5": bid_qty,
        "ask_depth_5": ask_qty,
        "imbalance": fp.round_half_up(F.when(total > 0, (bid_qty - ask_qty).cast("double") / total).otherwise(zero), 4),
        "bid_levels": F.size(bids),
        "ask_levels": F.size(asks),
    }
