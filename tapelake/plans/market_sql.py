"""The market views as SQL over the base tables, for the comparison queries."""

from __future__ import annotations

import re

# Each view may use the ones above it.
VIEWS: dict[str, str] = {
    "symbols": """
SELECT n.n_nationkey AS symbol_key, n.n_name AS symbol, concat('Company ', n.n_name) AS company_name,
       r.r_name AS sector,
       CASE n.n_nationkey % 3 WHEN 0 THEN 'large' WHEN 1 THEN 'mid' ELSE 'small' END AS market_cap_category
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "dim_symbol": """
SELECT symbol_key, symbol, company_name, sector, market_cap_category, DATE '2024-01-01' AS effective_date,
       DATE '9999-12-31' AS expiry_date, true AS is_current,
       substr(sha256(symbol || '|' || company_name || '|' || sector || '|' || market_cap_category), 1, 16) AS row_hash
FROM symbols""",
    "dim_symbol_history": """
SELECT symbol_key, symbol, company_name, sector, market_cap_category,
       CASE WHEN symbol_key % 3 = 0 THEN DATE '2024-01-15' ELSE effective_date END AS effective_date,
       expiry_date, is_current, row_hash
FROM dim_symbol
UNION ALL
SELECT symbol_key + 100, symbol, 'Old ' || company_name, sector, 'small', DATE '2024-01-01', DATE '2024-01-14', false,
       substr(sha256(symbol || '|Old ' || company_name || '|' || sector || '|small'), 1, 16)
FROM dim_symbol WHERE symbol_key % 3 = 0""",
    "trades": """
SELECT concat('T', lpad(cast(e.event_id AS varchar), 10, '0')) AS trade_id, s.symbol AS symbol, e.value AS price,
       (cast(regexp_extract(e.props, '[0-9]+', 0) AS int) + 1) * 10 AS quantity,
       concat('B', cast(e.event_id AS varchar)) AS buy_order_id,
       concat('S', cast(e.event_id AS varchar)) AS sell_order_id,
       concat('ACC-', lpad(cast(e.user_id AS varchar), 6, '0')) AS buyer_agent_id,
       concat('ACC-', lpad(cast((e.user_id * 7 + 3) % 150 AS varchar), 6, '0')) AS seller_agent_id,
       e.event_id % 2 = 0 AS is_aggressive_buy, e.ts AS timestamp, cast(e.ts AS date) AS trading_date,
       e.event_id AS _kafka_offset, cast(e.event_id % 3 AS int) AS _kafka_partition,
       s.company_name AS company_name, s.sector AS sector,
       cast(round(e.value * 1000000) AS bigint) AS px
FROM events e JOIN symbols s ON s.symbol_key = e.user_id % 25""",
    "bronze_trades": """
SELECT * FROM trades
UNION ALL
SELECT trade_id, symbol, price + 1.0, quantity, buy_order_id, sell_order_id, buyer_agent_id, seller_agent_id,
       is_aggressive_buy, timestamp, trading_date, _kafka_offset + 100000000, _kafka_partition, company_name, sector,
       px + 1000000
FROM trades WHERE _kafka_offset % 10 = 0""",
    "silver_trades": """
SELECT trade_id, symbol, price, quantity, buy_order_id, sell_order_id, buyer_agent_id, seller_agent_id,
       is_aggressive_buy, timestamp, company_name, sector, px
FROM (SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY _kafka_offset, _kafka_partition) AS rn
      FROM bronze_trades) WHERE rn = 1""",
    "trades_enriched": """
SELECT trade_id, symbol, CASE WHEN is_aggressive_buy THEN 'BUY' ELSE 'SELL' END AS trade_type, price, quantity,
       cast(px * quantity AS double) / 1000000 AS value, timestamp AS traded_at, trading_date AS trade_date,
       cast(extract(hour FROM timestamp) AS int) AS trade_hour,
       CASE WHEN is_aggressive_buy THEN buyer_agent_id ELSE seller_agent_id END AS account_id, sector, px
FROM trades""",
    "gold": """
SELECT symbol, trading_date, first(price ORDER BY timestamp, trade_id) AS open_price,
       last(price ORDER BY timestamp, trade_id) AS close_price, max(price) AS high_price, min(price) AS low_price,
       cast(sum(px * quantity) AS double) / cast(sum(quantity) * 1000000 AS double) AS vwap,
       cast(sum(quantity) AS bigint) AS total_volume, cast(count(*) AS int) AS trade_count,
       cast(sum(px * quantity) AS double) / 1000000 AS total_value,
       max(company_name) AS company_name, max(sector) AS sector,
       last(px ORDER BY timestamp, trade_id) AS close_px, first(px ORDER BY timestamp, trade_id) AS open_px,
       sum(px * quantity) AS value_px
FROM trades GROUP BY symbol, trading_date""",
    "daily_trade_summary": """
SELECT symbol, trading_date AS trade_date, open_price, close_price AS close, high_price AS high, low_price AS low, vwap,
       total_volume, cast(trade_count AS bigint) AS trade_count, total_value AS total_value_traded,
       (close_price - open_price) / nullif(open_price, 0) * 100 AS change_pct, close_px, open_px, value_px
FROM gold""",
    "account_trades": """
SELECT trade_id, symbol, price, quantity, CASE WHEN is_aggressive_buy THEN 'BUY' ELSE 'SELL' END AS side,
       trading_date AS trade_date, timestamp,
       CASE WHEN is_aggressive_buy THEN buyer_agent_id ELSE seller_agent_id END AS account_id, sector AS region
FROM trades""",
    "book_levels": """
SELECT symbol, date_trunc('day', timestamp) AS snapshot_ts,
       CASE WHEN is_aggressive_buy THEN 'BID' ELSE 'ASK' END AS side,
       CASE WHEN is_aggressive_buy THEN price ELSE price + 500.0 END AS price, cast(sum(quantity) AS int) AS quantity,
       cast(count(*) AS int) AS order_count, min(trade_id) AS trade_id
FROM trades GROUP BY 1, 2, 3, 4""",
    "books_top": """
SELECT symbol, snapshot_ts AS timestamp,
       first(price ORDER BY trade_id) FILTER (WHERE side = 'BID') AS best_bid_price,
       first(quantity ORDER BY trade_id) FILTER (WHERE side = 'BID') AS best_bid_qty,
       first(price ORDER BY trade_id) FILTER (WHERE side = 'ASK') AS best_ask_price,
       first(quantity ORDER BY trade_id) FILTER (WHERE side = 'ASK') AS best_ask_qty,
       cast(count(*) FILTER (WHERE side = 'BID') AS int) AS bid_depth,
       cast(count(*) FILTER (WHERE side = 'ASK') AS int) AS ask_depth,
       cast(extract(day FROM snapshot_ts) AS int) AS sequence_number
FROM book_levels GROUP BY symbol, snapshot_ts""",
    "silver_books": """
SELECT b.symbol, b.timestamp, best_bid_price, best_bid_qty, best_ask_price, best_ask_qty, bid_depth, ask_depth,
       best_ask_price - best_bid_price AS spread, (best_ask_price + best_bid_price) / 2.0 AS mid_price, sequence_number,
       s.company_name, s.sector
FROM books_top b LEFT JOIN symbols s ON s.symbol = b.symbol""",
    "feed": """
SELECT _kafka_offset AS n, cast(_kafka_offset % 50 AS int) AS slot, symbol, price, quantity, timestamp, trade_id,
       CASE WHEN _kafka_offset % 50 = 0 THEN 'bad_json'
            WHEN _kafka_offset % 50 IN (1, 23) THEN 'skipped'
            WHEN _kafka_offset % 50 IN (2, 3, 5, 11, 14, 16, 19, 21, 22, 24, 25, 26) THEN 'invalid'
            ELSE 'valid' END AS status,
       CASE WHEN _kafka_offset % 50 IN (0, 1, 23, 24) THEN NULL
            WHEN _kafka_offset % 50 = 2 THEN 'Mystery'
            WHEN _kafka_offset % 50 IN (4, 5) THEN 'OrderPlaced'
            WHEN _kafka_offset % 50 = 6 THEN 'OrderCancelled'
            WHEN _kafka_offset % 50 = 7 THEN 'QuoteUpdate'
            WHEN _kafka_offset % 50 IN (8, 26) THEN 'OrderBookSnapshot'
            WHEN _kafka_offset % 50 = 9 THEN 'MarketStats'
            WHEN _kafka_offset % 50 IN (10, 11) THEN 'TradingHalt'
            WHEN _kafka_offset % 50 = 12 THEN 'TradingResume'
            WHEN _kafka_offset % 50 IN (13, 14) THEN 'AgentAction'
            ELSE 'TradeExecuted' END AS event_type
FROM trades""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it names, and the views those need, as common table expressions."""
    sql = sql.strip()
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(VIEWS[name])

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]}\n)" for name in VIEWS if name in needed)
    recursive = re.match(r"WITH\s+(RECURSIVE\s+)?", sql, re.IGNORECASE)
    if recursive:
        keyword = "WITH RECURSIVE" if recursive.group(1) else "WITH"
        return f"{keyword} {ctes},\n{sql[recursive.end():]}"
    return f"WITH {ctes}\n{sql}"


def rounded(expr: str, digits: int) -> str:
    """Round half up on the decimal reading of a double, as Spark does."""
    return f"cast(round(cast({expr} AS decimal(38,8)), {digits}) AS double)"


def stddev(n: str, s: str, q: str) -> str:
    """Sample deviation from exact integer moments. The spread goes through text because a direct cast of an integer
    past 64 bits to double is off by one in the last place."""
    spread = f"cast(cast({n} * {q} - {s} * {s} AS varchar) AS double)"
    return f"CASE WHEN {n} > 1 THEN sqrt({spread} / (cast({n} AS double) * cast({n} - 1 AS double))) END"
