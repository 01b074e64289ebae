"""Silver, gold, dimension and layer queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapelake.functions.timing import on_days
from tapelake.operators import dims, gold, scd, silver
from tapelake.plans.registry import query
from tapelake.sources import files
from tapelake.sources.views import AS_OF, PROCESSED_AT

GOLD_COLUMNS = """symbol, trading_date, open_price, close_price, high_price, low_price, vwap, total_volume, trade_count,
       total_value, company_name, sector, TIMESTAMP '2024-01-31 00:00:00' AS _aggregated_at"""
SILVER_COLUMNS = """trade_id, symbol, price, quantity, buy_order_id, sell_order_id, buyer_agent_id, seller_agent_id,
       is_aggressive_buy, timestamp, company_name, sector, TIMESTAMP '2024-01-31 00:00:00' AS _processed_at"""


@query("gold_daily_ohlcv", f"SELECT {GOLD_COLUMNS} FROM gold")
def gold_daily_ohlcv(m):
    return m.gold


@query(
    "gold_job",
    f"SELECT {GOLD_COLUMNS} FROM gold WHERE trading_date = DATE '2024-01-15'",
)
def gold_job(m):
    """The day job up to its write: one day's bars, the day reaching the scan as a timestamp range."""
    return gold.daily_ohlcv(m.trades, day="2024-01-15", aggregated_at=PROCESSED_AT)


@query("silver_trades", f"SELECT {SILVER_COLUMNS} FROM silver_trades")
def silver_trades(m):
    return m.silver_trades


@query(
    "silver_orderbook",
    """SELECT symbol, timestamp, best_bid_price, best_bid_qty, best_ask_price, best_ask_qty, bid_depth, ask_depth, spread,
       mid_price, sequence_number, company_name, sector, TIMESTAMP '2024-01-31 00:00:00' AS _processed_at
FROM silver_books""",
)
def silver_orderbook(m):
    return silver.silver_orderbook(m.bronze_orderbook, m.dim_symbol, processed_at=PROCESSED_AT)


@query(
    "join_enrich_left",
    """SELECT t.trade_id, t.symbol, t.price, d.company_name, d.sector
FROM trades t LEFT JOIN dim_symbol d ON d.symbol = t.symbol AND d.is_current AND d.symbol_key % 5 <> 0""",
)
def join_enrich_left(m):
    dim = m.dim_symbol.filter("symbol_key % 5 <> 0")
    return silver.enrich(m.trades.select("trade_id", "symbol", "price"), dim)


@query(
    "enrich_stream",
    """SELECT t.trade_id, t.symbol, t.price, t.quantity, coalesce(d.company_name, 'Unknown') AS company_name,
       coalesce(d.sector, 'Unknown') AS sector, coalesce(d.market_cap_category, 'Unknown') AS market_cap_category
FROM trades t LEFT JOIN symbols d ON d.symbol = t.symbol AND d.symbol_key % 5 <> 0""",
)
def enrich_stream(m):
    known = m.symbols.filter("symbol_key % 5 <> 0")
    return silver.enrich_or_unknown(m.trades.select("trade_id", "symbol", "price", "quantity"), known)


@query(
    "join_anti_existing",
    """SELECT b.trade_id, b.symbol, b._kafka_offset FROM bronze_trades b
WHERE NOT EXISTS (SELECT 1 FROM silver_trades s WHERE s.trade_id = b.trade_id AND s.timestamp < TIMESTAMP '2024-01-20')""",
)
def join_anti_existing(m):
    done = m.silver_trades.filter("timestamp < timestamp'2024-01-20'")
    return silver.drop_existing(m.bronze_trades, done, ["trade_id"]).select("trade_id", "symbol", "_kafka_offset")


@query(
    "merge_records",
    """WITH incoming AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01'),
existing AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
  FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01')
SELECT * FROM existing
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM incoming i
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM existing e WHERE e.l_orderkey = i.l_orderkey AND e.l_linenumber = i.l_linenumber)""",
)
def merge_records(m):
    """Order lines shipped from 1997 merged into those before; the table has natural duplicates."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    lines = m.table("lineitem")
    order = ["l_shipdate", *columns[2:], "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    split = F.lit("1997-01-01").cast("timestamp")
    merged = silver.merge_records(
        lines.filter(F.col("l_shipdate") < split),
        lines.filter(F.col("l_shipdate") >= split),
        ["l_orderkey", "l_linenumber"],
        order,
    )
    return merged.select(*columns)


@query(
    "scd2_hash",
    "SELECT symbol, row_hash FROM dim_symbol",
)
def scd2_hash(m):
    return m.dim_symbol.select("symbol", "row_hash")


INCOMING_SQL = """incoming AS (
  SELECT symbol, CASE WHEN symbol_key % 5 = 0 THEN company_name || ' Group' ELSE company_name END AS company_name, sector,
         market_cap_category FROM symbols WHERE symbol_key % 4 <> 1
  UNION ALL
  SELECT p_brand, 'Company ' || p_brand, 'Parts', 'small' FROM part GROUP BY p_brand),
hashed AS (
  SELECT *, substr(sha256(symbol || '|' || company_name || '|' || sector || '|' || market_cap_category), 1, 16) AS row_hash
  FROM incoming)"""


def incoming_symbols(m):
    """A reference delivery: a quarter of the symbols absent, every fifth renamed, and the part brands as new symbols."""
    known = m.symbols.filter("symbol_key % 4 <> 1").select(
        "symbol",
        F.when(F.col("symbol_key") % 5 == 0, F.concat("company_name", F.lit(" Group")))
        .otherwise(F.col("company_name"))
        .alias("company_name"),
        "sector",
        "market_cap_category",
    )
    brands = m.table("part").select(
        F.col("p_brand").alias("symbol"),
        F.concat(F.lit("Company "), "p_brand").alias("company_name"),
        F.lit("Parts").alias("sector"),
        F.lit("small").alias("market_cap_category"),
    )
    return known.unionByName(brands.distinct())


@query(
    "join_scd2_match",
    f"""WITH {INCOMING_SQL}
SELECT coalesce(h.symbol, d.symbol) AS symbol,
       CASE WHEN h.symbol IS NULL THEN 'absent' WHEN d.symbol IS NULL THEN 'new'
            WHEN h.row_hash = d.row_hash THEN 'unchanged' ELSE 'changed' END AS action
FROM hashed h FULL OUTER JOIN (SELECT * FROM dim_symbol_history WHERE is_current) d ON d.symbol = h.symbol""",
)
def join_scd2_match(m):
    return scd.match(incoming_symbols(m), m.dim_symbol_history).select("symbol", "action")


@query(
    "scd2_apply",
    f"""WITH {INCOMING_SQL},
fresh AS (
  SELECT h.*, (SELECT max(symbol_key) FROM dim_symbol_history) + row_number() OVER (ORDER BY substr(md5(h.symbol), 1, 3), h.symbol) AS symbol_key
  FROM hashed h LEFT JOIN (SELECT * FROM dim_symbol_history WHERE is_current) d ON d.symbol = h.symbol
  WHERE d.symbol IS NULL OR d.row_hash <> h.row_hash)
SELECT d.symbol_key, d.symbol, d.company_name, d.sector, d.market_cap_category, d.effective_date,
       CASE WHEN d.is_current AND f.symbol IS NOT NULL THEN DATE '2024-01-29' ELSE d.expiry_date END AS expiry_date,
       d.is_current AND f.symbol IS NULL AS is_current, d.row_hash,
       CASE WHEN d.is_current AND f.symbol IS NOT NULL THEN TIMESTAMP '2024-01-31 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS _updated_at
FROM dim_symbol_history d LEFT JOIN fresh f ON f.symbol = d.symbol
UNION ALL
SELECT cast(symbol_key AS int), symbol, company_name, sector, market_cap_category, DATE '2024-01-30', DATE '9999-12-31', true,
       row_hash, TIMESTAMP '2024-01-31 00:00:00' FROM fresh""",
)
def scd2_apply(m):
    return scd.apply_scd2(m.dim_symbol_history, incoming_symbols(m), today=AS_OF, updated_at=PROCESSED_AT)


@query(
    "scd2_as_of",
    """SELECT t.trade_id, t.symbol, d.company_name, d.market_cap_category FROM trades t
JOIN dim_symbol_history d ON d.symbol = t.symbol AND t.trading_date BETWEEN d.effective_date AND d.expiry_date""",
)
def scd2_as_of(m):
    trades = m.trades.select("trade_id", "symbol", "trading_date")
    return scd.as_of(trades, m.dim_symbol_history, "trading_date", ["company_name", "market_cap_category"]).drop(
        "trading_date"
    )


@query(
    "scd2_as_of_merge",
    """SELECT t.trade_id, t.symbol, d.company_name, d.market_cap_category FROM trades t
JOIN dim_symbol_history d ON d.symbol = t.symbol AND t.trading_date BETWEEN d.effective_date AND d.expiry_date""",
)
def scd2_as_of_merge(m):
    """The same by merging trades and versions in the order of time."""
    trades = m.trades.select("trade_id", "symbol", "trading_date")
    return scd.as_of_merge(trades, m.dim_symbol_history, "trading_date", ["company_name", "market_cap_category"]).drop(
        "trading_date"
    )


@query(
    "seed_dim_symbol",
    """SELECT cast(row_number() OVER (ORDER BY substr(md5(symbol), 1, 3), symbol) AS int) AS symbol_key, symbol, company_name, sector, market_cap_category,
       DATE '2024-01-30' AS effective_date, DATE '9999-12-31' AS expiry_date, true AS is_current, row_hash,
       TIMESTAMP '2024-01-31 00:00:00' AS _updated_at FROM dim_symbol""",
)
def seed_dim_symbol(m):
    reference = m.symbols.select("symbol", "company_name", "sector", "market_cap_category")
    return scd.seed(m.spark, reference, today=AS_OF, updated_at=PROCESSED_AT)


SESSION_SQL = """CASE WHEN hm >= 400 AND hm < 930 THEN 'pre-market' WHEN hm >= 930 AND hm < 1600 THEN 'regular'
            WHEN hm >= 1600 AND hm < 2000 THEN 'after-hours' ELSE 'closed' END"""


@query(
    "seed_dim_time",
    f"""SELECT cast(hm AS int) AS time_key, cast(hm // 100 AS int) AS hour, cast(hm % 100 AS int) AS minute,
       lpad(cast(hm // 100 AS varchar), 2, '0') || ':' || lpad(cast(hm % 100 AS varchar), 2, '0') AS time_of_day,
       {SESSION_SQL} AS trading_session, hm >= 930 AND hm < 1600 AS is_market_hours,
       (SELECT count(*) FROM trades WHERE extract(hour FROM timestamp) * 100 + extract(minute FROM timestamp) = hm) AS trade_count
FROM (SELECT (i // 60) * 100 + i % 60 AS hm FROM range(1440) r(i))""",
)
def seed_dim_time(m):
    """The 1440 minutes, each with the trades that fall in it."""
    counts = m.trades.groupBy(dims.time_key("timestamp").alias("time_key")).agg(F.count(F.lit(1)).alias("n"))
    return (
        dims.dim_time(m.spark)
        .join(counts, "time_key", "left")
        .withColumn("trade_count", F.coalesce("n", F.lit(0)))
        .drop("n")
    )


@query(
    "dim_time_join",
    f"""SELECT trading_session, is_market_hours, count(*) AS trade_count, cast(sum(quantity) AS bigint) AS total_volume
FROM (SELECT quantity, {SESSION_SQL} AS trading_session, hm >= 930 AND hm < 1600 AS is_market_hours
      FROM (SELECT quantity, extract(hour FROM timestamp) * 100 + extract(minute FROM timestamp) AS hm FROM trades))
GROUP BY ALL""",
)
def dim_time_join(m):
    return dims.volume_by_session(m.trades, dims.dim_time(m.spark))


@query(
    "schema_evolve",
    """SELECT trade_id, symbol, price, quantity AS shares, cast(NULL AS double) AS is_buy_score FROM trades""",
)
def schema_evolve(m):
    """One rename and one change of type, which drops the old values."""
    changes = [
        scd.ColumnChange("quantity", "shares"),
        scd.ColumnChange("is_aggressive_buy", "is_buy_score", "double"),
        scd.ColumnChange("symbol_code", "symbol"),
    ]
    return scd.evolve(m.trades, changes).select("trade_id", "symbol", "price", "shares", "is_buy_score")


@query(
    "scan_filtered",
    """SELECT trade_id, symbol, price, quantity FROM trades
WHERE timestamp >= TIMESTAMP '2024-01-10' AND timestamp < TIMESTAMP '2024-01-12' AND price >= 100""",
)
def scan_filtered(m):
    wanted = on_days("timestamp", "2024-01-10", "2024-01-11") & (F.col("price") >= 100)
    return files.scan(m.trades, ["trade_id", "symbol", "price", "quantity"], wanted)


@query(
    "scan_incremental",
    """SELECT trade_id, symbol, price, _kafka_offset, timestamp + INTERVAL 2 SECOND AS _ingested_at FROM bronze_trades
WHERE timestamp + INTERVAL 2 SECOND > TIMESTAMP '2024-01-25 12:00:00'""",
)
def scan_incremental(m):
    rows = files.scan_incremental(m.bronze_trades, "2024-01-25 12:00:00")
    return rows.select("trade_id", "symbol", "price", "_kafka_offset", "_ingested_at")


@query(
    "layer_counts",
    """SELECT 'raw_trades' AS layer, count(*) AS row_count FROM bronze_trades
UNION ALL SELECT 'raw_orderbook', (SELECT count(*) + count(*) FILTER (WHERE sequence_number % 2 = 0) FROM books_top)
UNION ALL SELECT 'silver_trades', count(*) FROM silver_trades""",
)
def layer_counts(m):
    return files.layer_counts(
        {"raw_trades": m.bronze_trades, "raw_orderbook": m.bronze_orderbook, "silver_trades": m.silver_trades}
    )


@query("sample_capped", "SELECT count(*) AS rows_kept FROM (SELECT * FROM trades LIMIT 100000)")
def sample_capped(m):
    """Which rows a cap keeps is open, so the size of the sample is what is compared."""
    return files.sample_capped(m.trades).agg(F.count(F.lit(1)).alias("rows_kept"))


@query(
    "union_layers",
    """SELECT trade_id, price, 'bronze' AS layer FROM bronze_trades
UNION ALL SELECT trade_id, price, 'silver' FROM silver_trades""",
)
def union_layers(m):
    bronze = m.bronze_trades.select("trade_id", "price", F.lit("bronze").alias("layer"))
    return bronze.unionByName(m.silver_trades.select("trade_id", "price", F.lit("silver").alias("layer")))


@query(
    "set_except",
    """SELECT DISTINCT trade_id FROM bronze_trades
EXCEPT SELECT trade_id FROM silver_trades WHERE timestamp < TIMESTAMP '2024-01-25'""",
)
def set_except(m):
    """Data loss: bronze ids missing from a silver table that stops on the 25th."""
    silver_ids = m.silver_trades.filter("timestamp < timestamp'2024-01-25'").select("trade_id")
    return m.bronze_trades.select("trade_id").join(silver_ids, "trade_id", "left_anti").distinct()


@query("set_distinct", "SELECT DISTINCT symbol, sector FROM trades")
def set_distinct(m):
    return m.trades.select("symbol", "sector").distinct()
