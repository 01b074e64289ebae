"""Fixed schemas of events and tables, as DDL strings Spark parses itself."""

# The base tables this repository reads.
BASE_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

# Table layouts of the lakehouse.
BRONZE_TRADES = (
    "trade_id string, symbol string, price double, quantity int, buy_order_id string, sell_order_id string, "
    "buyer_agent_id string, seller_agent_id string, is_aggressive_buy boolean, event_type string, "
    "timestamp timestamp, _kafka_topic string, _kafka_partition int, _kafka_offset bigint, _ingested_at timestamp"
)
BRONZE_ORDERBOOK = (
    "symbol string, bids_json string, asks_json string, sequence_number int, event_type string, "
    "timestamp timestamp, _kafka_topic string, _kafka_partition int, _kafka_offset bigint, _ingested_at timestamp"
)
SILVER_TRADES = (
    "trade_id string, symbol string, price double, quantity int, buy_order_id string, sell_order_id string, "
    "buyer_agent_id string, seller_agent_id string, is_aggressive_buy boolean, timestamp timestamp, "
    "company_name string, sector string, _processed_at timestamp"
)
SILVER_ORDERBOOK = (
    "symbol string, timestamp timestamp, best_bid_price double, best_bid_qty int, best_ask_price double, "
    "best_ask_qty int, bid_depth int, ask_depth int, spread double, mid_price double, sequence_number int, "
    "company_name string, sector string, _processed_at timestamp"
)
GOLD_DAILY = (
    "symbol string, trading_date date, open_price double, close_price double, high_price double, low_price double, "
    "vwap double, total_volume bigint, trade_count int, total_value double, company_name string, sector string, "
    "_aggregated_at timestamp"
)
DIM_SYMBOL = (
    "symbol_key int, symbol string, company_name string, sector string, market_cap_category string, "
    "effective_date date, expiry_date date, is_current boolean, row_hash string, _updated_at timestamp"
)
SYMBOL_REFERENCE = "symbol string, company_name string, sector string, market_cap_category string"

# Flat trade event as it travels on the trade topic.
TRADE_EVENT = (
    "event_type string, event_id string, timestamp string, trade_id string, symbol string, price double, "
    "quantity int, buy_order_id string, sell_order_id string, buyer_agent_id string, seller_agent_id string, "
    "is_aggressive_buy boolean"
)
BOOK_EVENT = (
    "event_type string, event_id string, timestamp string, symbol string, "
    "bids array<struct<price:double,quantity:int,order_count:int>>, "
    "asks array<struct<price:double,quantity:int,order_count:int>>, sequence_number int"
)


def column_names(ddl: str) -> list[str]:
    """Names of a flat DDL schema."""
    return [part.split()[0] for part in ddl.split(", ")]
