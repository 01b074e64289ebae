"""Filter, lookup, ranking and paging queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.operators import selection as sel
from tapelake.operators.market import top_lists
from tapelake.operators.paging import Key, page_after, ranked_page
from tapelake.operators.selection import TradeFilter
from tapelake.operators.silver import silver_orderbook
from tapelake.plans.market_sql import rounded
from tapelake.plans.registry import query
from tapelake.session import scratch_folder
from tapelake.sources.lookup import lookup, write_lookup

BRIEF = "trade_id, symbol, price, quantity"


@query(
    "filter_trades",
    f"""SELECT {BRIEF}, is_aggressive_buy FROM trades WHERE symbol IN ('NATION_3', 'NATION_7', 'NATION_8')
AND is_aggressive_buy AND price >= 50 AND price <= 400 AND quantity >= 100 AND quantity <= 800
AND timestamp >= TIMESTAMP '2024-01-05' AND timestamp < TIMESTAMP '2024-01-21'""",
)
def filter_trades(m):
    wanted = TradeFilter(
        symbols=["NATION_3", "NATION_7", "NATION_8"],
        is_aggressive_buy=True,
        min_price=50,
        max_price=400,
        min_quantity=100,
        max_quantity=800,
        first_day="2024-01-05",
        last_day="2024-01-20",
    )
    return sel.filter_trades(m.trades, wanted).select("trade_id", "symbol", "price", "quantity", "is_aggressive_buy")


@query("trade_by_id", f"SELECT {BRIEF}, timestamp FROM trades WHERE trade_id = 'T0000000421' LIMIT 1")
def trade_by_id(m):
    return sel.trade_by_id(m.trades, "T0000000421").select("trade_id", "symbol", "price", "quantity", "timestamp")


LOOKED_UP = ["T0000000421", "T0000000007", "T0000004242", "T9999999999"]


@query("trade_by_id_lookup", f"SELECT {BRIEF}, timestamp FROM trades WHERE trade_id IN {tuple(LOOKED_UP)}")
def trade_by_id_lookup(m):
    """The trades laid out by id, and some looked up; the last id is nobody's."""
    path = f"{scratch_folder(m.spark, 'by-id')}/t"
    trades = m.trades.select("trade_id", "symbol", "price", "quantity", "timestamp")
    write_lookup(trades, path, "trade_id", buckets=16)
    return lookup(m.spark, path, trades.schema, "trade_id", LOOKED_UP, buckets=16)


@query(
    "filter_symbols",
    """SELECT symbol, company_name, sector, market_cap_category, is_current FROM dim_symbol_history
WHERE is_current AND market_cap_category = 'large' AND (symbol ILIKE '%n%' OR company_name ILIKE '%n%')""",
)
def filter_symbols(m):
    return sel.filter_symbols(m.dim_symbol_history, market_cap_category="large", search="N")


LIST_SQL = """requested AS (
  SELECT cast(p_size AS int) AS ordinal, (SELECT min(n_name) FROM nation WHERE n_nationkey = p_size % 30) AS found
  FROM (SELECT DISTINCT p_size FROM part)),
keys AS (SELECT ordinal, coalesce(found, 'UNLISTED-' || cast(ordinal AS varchar)) AS symbol FROM requested)"""


def requested_symbols(m):
    """A request list: every part size names a symbol, and the sizes past the last nation name one nobody lists."""
    nation = m.table("nation").select("n_nationkey", "n_name")
    sizes = m.table("part").select(F.col("p_size").alias("ordinal")).distinct()
    return sizes.join(nation, F.col("n_nationkey") == F.col("ordinal") % 30, "left").select(
        "ordinal",
        F.coalesce("n_name", F.concat(F.lit("UNLISTED-"), F.col("ordinal").cast("string"))).alias("symbol"),
    )


@query(
    "symbol_batch_lookup",
    f"""WITH {LIST_SQL}
SELECT k.ordinal, k.symbol, d.company_name, d.sector, d.market_cap_category
FROM keys k LEFT JOIN dim_symbol_history d ON d.symbol = k.symbol AND d.is_current""",
)
def symbol_batch_lookup(m):
    return sel.lookup_symbols(m.dim_symbol_history, requested_symbols(m))


@query(
    "q_watchlist",
    f"""WITH {LIST_SQL}
SELECT k.ordinal, k.symbol, d.close, d.change_pct
FROM keys k LEFT JOIN daily_trade_summary d ON d.symbol = k.symbol AND d.trade_date = DATE '2024-01-15'""",
)
def q_watchlist(m):
    return sel.watchlist(requested_symbols(m), m.daily, "2024-01-15")


SYMBOL = "NATION_8"
BUSY = f"'{SYMBOL}'"


@query(
    "trades_by_sector",
    "SELECT count(*) AS trade_count FROM trades WHERE sector = (SELECT sector FROM symbols WHERE symbol_key = 8)",
)
def trades_by_sector(m):
    sector = m.symbols.filter("symbol_key = 8").select("sector")
    return m.trades.join(sector, "sector", "left_semi").agg(F.count(F.lit(1)).alias("trade_count"))


@query(
    "trades_by_symbol",
    f"SELECT {BRIEF}, timestamp FROM trades WHERE symbol = {BUSY} ORDER BY timestamp DESC, trade_id DESC LIMIT 100",
)
def trades_by_symbol(m):
    return sel.newest_trades(m.trades, SYMBOL, 100).select("trade_id", "symbol", "price", "quantity", "timestamp")


@query(
    "daily_summary_range",
    f"""SELECT symbol, trading_date, open_price, close_price, vwap, total_volume FROM gold
WHERE symbol = {BUSY} AND trading_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
)
def daily_summary_range(m):
    rows = sel.daily_summary_range(m.gold, SYMBOL, "2024-01-05", "2024-01-20")
    return rows.select("symbol", "trading_date", "open_price", "close_price", "vwap", "total_volume")


BOOK = """symbol, timestamp, best_bid_price, best_bid_qty, best_ask_price, best_ask_qty, bid_depth, ask_depth, spread, mid_price"""


@query(
    "orderbook_latest",
    f"""SELECT {BOOK} FROM silver_books
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) = 1""",
)
def orderbook_latest(m):
    return sel.latest_book(silver_books(m)).select(*[c.strip() for c in BOOK.split(",")])


def silver_books(m):
    return silver_orderbook(m.bronze_orderbook, m.dim_symbol)


@query(
    "orderbook_spread",
    f"""SELECT symbol, timestamp, best_bid_price, best_ask_price, spread, mid_price, bid_depth, ask_depth FROM silver_books
WHERE symbol = {BUSY} ORDER BY timestamp DESC LIMIT 50""",
)
def orderbook_spread(m):
    return sel.book_spreads(silver_books(m), SYMBOL, 50)


@query(
    "derived_summary_cols",
    """SELECT symbol, trading_date, high_price - low_price AS price_range, close_price - open_price AS price_change,
       CASE WHEN open_price = 0 THEN 0.0::DOUBLE ELSE (close_price - open_price) / open_price * 100 END AS price_change_pct
FROM gold""",
)
def derived_summary_cols(m):
    return sel.with_change(m.gold).select("symbol", "trading_date", "price_range", "price_change", "price_change_pct")


@query(
    "change_pct_4dp",
    f"""SELECT symbol, trading_date, {rounded("(close_price - open_price) / nullif(open_price, 0) * 100", 4)} AS change_pct
FROM gold""",
)
def change_pct_4dp(m):
    return sel.change_pct_4dp(m.gold).select("symbol", "trading_date", "change_pct")


SIDED = """sided AS (
  SELECT *, CASE WHEN is_aggressive_buy THEN 'buy' ELSE 'sell' END AS side,
         CASE WHEN quantity < 50 THEN 'small' WHEN quantity < 200 THEN 'medium' WHEN quantity < 500 THEN 'large' ELSE 'block' END
           AS size_bucket FROM trades)"""


@query("trades_bid_ask_view", f"WITH {SIDED} SELECT {BRIEF}, side, size_bucket FROM sided")
def trades_bid_ask_view(m):
    return sel.bid_ask_view(m.trades).select("trade_id", "symbol", "price", "quantity", "side", "size_bucket")


@query(
    "large_trades",
    f"""WITH {SIDED} SELECT timestamp, symbol, side, price, quantity FROM sided WHERE quantity >= 500
ORDER BY quantity DESC, timestamp, trade_id LIMIT 500""",
)
def large_trades(m):
    return sel.block_trades(sel.bid_ask_view(m.trades), 500)


@query(
    "topk_notional",
    f"""SELECT {BRIEF}, cast(px * quantity AS double) / 1000000 AS notional FROM trades
ORDER BY px * quantity DESC, trade_id LIMIT 10""",
)
def topk_notional(m):
    return sel.top_notional(m.trades)


@query(
    "top_movers",
    """SELECT symbol, company_name, sector, open_price, close_price, high_price, low_price,
       (close_price - open_price) / nullif(open_price, 0) * 100 AS pct_change, total_volume, trade_count
FROM gold WHERE trading_date = DATE '2024-01-15' ORDER BY abs(pct_change) DESC, symbol LIMIT 5""",
)
def top_movers(m):
    return sel.top_movers(m.gold, "2024-01-15")


@query(
    "top_gain_lose_active",
    """WITH moved AS (
  SELECT *, CASE WHEN open_price = 0 THEN 0 ELSE (close_price - open_price) / open_price * 100 END AS pct FROM gold),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY trading_date ORDER BY pct DESC, symbol) AS g,
         row_number() OVER (PARTITION BY trading_date ORDER BY pct, symbol) AS l,
         row_number() OVER (PARTITION BY trading_date ORDER BY total_volume DESC, symbol) AS a FROM moved)
SELECT trading_date, 'top_gainers' AS list_name, cast(g AS int) AS rank, symbol, pct AS price_change_pct, total_volume FROM ranked WHERE g <= 5
UNION ALL SELECT trading_date, 'top_losers', cast(l AS int), symbol, pct, total_volume FROM ranked WHERE l <= 5
UNION ALL SELECT trading_date, 'most_active', cast(a AS int), symbol, pct, total_volume FROM ranked WHERE a <= 5""",
)
def top_gain_lose_active(m):
    return top_lists(m.gold)


@query(
    "topk_traders",
    "SELECT buyer_agent_id, count(*) AS trade_count FROM trades GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def topk_traders(m):
    counts = m.trades.groupBy("buyer_agent_id").agg(F.count(F.lit(1)).alias("trade_count"))
    return counts.orderBy(F.desc("trade_count"), "buyer_agent_id").limit(10)


@query(
    "page_offset",
    f"""SELECT {BRIEF}, (SELECT count(*) FROM trades WHERE quantity >= 200) AS total_count,
       (SELECT count(*) FROM trades WHERE quantity >= 200) > 60 AS has_next_page, true AS has_previous_page
FROM trades WHERE quantity >= 200 ORDER BY timestamp DESC, trade_id DESC LIMIT 20 OFFSET 40""",
)
def page_offset(m):
    rows = sel.filter_trades(m.trades, TradeFilter(min_quantity=200)).select(
        "trade_id", "symbol", "price", "quantity", "timestamp"
    )
    return sel.page(rows, [F.desc("timestamp"), F.desc("trade_id")], first=20, offset=40).drop("timestamp")


LATEST = [Key("timestamp", falling=True), Key("trade_id", falling=True)]


@query(
    "page_ranked",
    f"""SELECT {BRIEF}, (SELECT count(*) FROM trades) AS total_count, true AS has_next_page, true AS has_previous_page
FROM trades ORDER BY timestamp DESC, trade_id DESC LIMIT 50 OFFSET (SELECT count(*) // 2 FROM trades)""",
)
def page_ranked(m):
    """The page in the middle: ranges are counted until few rows are left to sort."""
    rows = m.trades.select("trade_id", "symbol", "price", "quantity", "timestamp")
    return ranked_page(rows, LATEST, first=50, offset=rows.count() // 2, most=1000).drop("timestamp")


@query(
    "page_keyset",
    f"""SELECT {BRIEF} FROM trades WHERE (timestamp, trade_id) < (SELECT (timestamp, trade_id) FROM trades WHERE trade_id = 'T0000000421')
ORDER BY timestamp DESC, trade_id DESC LIMIT 50""",
)
def page_keyset(m):
    """The page after a trade, found by its key."""
    rows = m.trades.select("trade_id", "symbol", "price", "quantity", "timestamp")
    return page_after(rows, LATEST, sel.trade_by_id(rows, "T0000000421").first(), first=50).drop("timestamp")


@query(
    "nulls_last_sort",
    """WITH scored AS (
  SELECT symbol, trade_date, close_px - lag(close_px) OVER (PARTITION BY symbol ORDER BY trade_date) AS move FROM daily_trade_summary)
SELECT symbol, trade_date, cast(move AS double) / 1000000 AS price_change FROM scored
ORDER BY move DESC NULLS LAST, symbol, trade_date""",
)
def nulls_last_sort(m):
    along = Window.partitionBy("symbol").orderBy("trade_date")
    move = fp.ticks("close") - F.lag(fp.ticks("close")).over(along)
    return (
        m.daily.select("symbol", "trade_date", fp.from_ticks(move).alias("price_change"))
        .orderBy(F.desc_nulls_last("price_change"), "symbol", "trade_date")
    )
