"""Data-quality queries. Bad input is made from the trades by fixed rules, so that every check has something to find."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapelake.operators import health, quality
from tapelake.plans.registry import query

DIRTY_SQL = """dirty AS (
  SELECT _kafka_offset AS n, CASE WHEN _kafka_offset % 97 = 0 THEN NULL ELSE trade_id END AS trade_id,
         CASE WHEN _kafka_offset % 89 = 0 THEN 'UNKNOWN' ELSE symbol END AS symbol,
         CASE WHEN _kafka_offset % 83 = 0 THEN NULL WHEN _kafka_offset % 79 = 0 THEN -price ELSE price END AS price,
         CASE WHEN _kafka_offset % 73 = 0 THEN 0 ELSE quantity END AS quantity, is_aggressive_buy, timestamp,
         _kafka_offset, _kafka_partition
  FROM bronze_trades)"""


def dirty_trades(m):
    """Bronze trades with NULLs, unknown symbols and impossible numbers at fixed offsets, beside the replays."""
    n = F.col("_kafka_offset")
    return m.bronze_trades.withColumns(
        {
            "trade_id": F.when(n % 97 != 0, F.col("trade_id")),
            "symbol": F.when(n % 89 == 0, "UNKNOWN").otherwise(F.col("symbol")),
            "price": F.when(n % 83 == 0, None).when(n % 79 == 0, -F.col("price")).otherwise(F.col("price")),
            "quantity": F.when(n % 73 == 0, 0).otherwise(F.col("quantity")),
        }
    )


def _percent(bad: str) -> str:
    return f"coalesce(cast({bad} AS double) / cast(nullif((SELECT count(*) FROM dirty), 0) AS double) * 100, 0)"


def _check(name: str, bad: str) -> str:
    return f"SELECT '{name}' AS expectation, ({bad}) = 0 AS success, cast(({bad}) AS bigint) AS unexpected_count, {_percent(f'({bad})')} AS unexpected_percent"


def _count(where: str) -> str:
    return f"SELECT count(*) FROM dirty WHERE {where}"


DUPLICATED = "SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM dirty WHERE trade_id IS NOT NULL GROUP BY trade_id HAVING count(*) > 1)"
NULL_CHECKS = [_check(f"not_null:{c}", _count(f"{c} IS NULL")) for c in ("trade_id", "symbol", "price", "quantity", "timestamp")]
RANGE_CHECKS = [
    _check("between:price", _count("price <= 0")),
    _check("between:quantity", _count("quantity < 1")),
]
BRONZE_COLUMNS = (
    "trade_id symbol price quantity buy_order_id sell_order_id buyer_agent_id seller_agent_id is_aggressive_buy event_type "
    "timestamp _kafka_topic _kafka_partition _kafka_offset _ingested_at"
).split()


def _exists(columns: list[str], missing: tuple[str, ...] = ()) -> list[str]:
    return [
        f"SELECT 'column_exists:{c}' AS expectation, {str(c not in missing).lower()} AS success, 0::BIGINT AS unexpected_count, 0::DOUBLE AS unexpected_percent"
        for c in columns
    ]


def _all(checks: list[str]) -> str:
    return f"WITH {DIRTY_SQL}\n" + "\nUNION ALL ".join(checks)


@query("dq_column_exists", _all(_exists(BRONZE_COLUMNS, missing=("event_type",))))
def dq_column_exists(m):
    suite = [e for e in quality.bronze_trades_suite() if e.kind == "column_exists"]
    return quality.run_suite(dirty_trades(m).drop("event_type"), suite)


ROWS_CHECK = "SELECT 'row_count' AS expectation, (SELECT count(*) FROM dirty) >= 1 AS success, 0::BIGINT AS unexpected_count, 0::DOUBLE AS unexpected_percent"


@query("dq_row_count", _all([ROWS_CHECK]))
def dq_row_count(m):
    return quality.run_suite(dirty_trades(m), [quality.row_count(1)])


@query("dq_not_null", _all(NULL_CHECKS))
def dq_not_null(m):
    columns = ("trade_id", "symbol", "price", "quantity", "timestamp")
    return quality.run_suite(dirty_trades(m), [quality.not_null(c) for c in columns])


@query("dq_between", _all(RANGE_CHECKS))
def dq_between(m):
    suite = [quality.between("price", low=0, strict=True), quality.between("quantity", low=1)]
    return quality.run_suite(dirty_trades(m), suite)


@query(
    "dq_in_set",
    _all(
        [
            _check("in_set:is_aggressive_buy", _count("is_aggressive_buy NOT IN (true, false)")),
            _check("in_set:symbol", _count("symbol IS NOT NULL AND symbol NOT IN (SELECT symbol FROM dim_symbol)")),
        ]
    ),
)
def dq_in_set(m):
    """One set as literals, the other as a joined reference."""
    reference = m.dim_symbol.filter("is_current").select(F.col("symbol").alias("known_symbol"))
    rows = dirty_trades(m).join(reference, F.col("symbol") == F.col("known_symbol"), "left")
    return quality.run_suite(rows, [quality.in_set("is_aggressive_buy", [True, False]), quality.known("symbol", "known_symbol")])


@query("dq_unique", _all([_check("unique:trade_id", DUPLICATED)]))
def dq_unique(m):
    return quality.run_suite(dirty_trades(m), [quality.unique("trade_id")])


@query(
    "dq_ohlcv_consistent",
    """WITH bent AS (SELECT *, CASE WHEN total_volume % 7 = 0 THEN low_price - 1 ELSE vwap END AS v,
                   CASE WHEN total_volume % 11 = 0 THEN open_price - 0.5::DOUBLE ELSE high_price END AS h FROM gold),
bad AS (SELECT count(*) FILTER (WHERE NOT (h >= open_price AND h >= close_price AND low_price <= open_price AND low_price <= close_price
                                           AND v >= low_price AND v <= h)) AS n, count(*) AS total FROM bent)
SELECT 'ohlcv_consistent' AS expectation, n = 0 AS success, n AS unexpected_count, cast(n AS double) / cast(total AS double) * 100 AS unexpected_percent FROM bad""",
)
def dq_ohlcv_consistent(m):
    bent = m.gold.withColumns(
        {
            "vwap": F.when(F.col("total_volume") % 7 == 0, F.col("low_price") - 1.0).otherwise(F.col("vwap")),
            "high_price": F.when(F.col("total_volume") % 11 == 0, F.col("open_price") - 0.5).otherwise(F.col("high_price")),
        }
    )
    return quality.run_suite(bent, [quality.ohlcv_consistent()])


@query(
    "dq_run_suite",
    _all(
        [
            *_exists(BRONZE_COLUMNS),
            ROWS_CHECK,
            *NULL_CHECKS,
            *RANGE_CHECKS,
            _check("in_set:is_aggressive_buy", _count("is_aggressive_buy NOT IN (true, false)")),
        ]
    ),
)
def dq_run_suite(m):
    return quality.run_suite(dirty_trades(m), quality.bronze_trades_suite())


@query(
    "dq_suite_summary",
    f"""WITH {DIRTY_SQL}, results AS (
{" UNION ALL ".join([*_exists(BRONZE_COLUMNS), ROWS_CHECK, *NULL_CHECKS, *RANGE_CHECKS])}
UNION ALL SELECT 'in_set:is_aggressive_buy', true, 0, 0)
SELECT count(*) AS evaluated, count(*) FILTER (WHERE success) AS successful, count(*) FILTER (WHERE NOT success) AS unsuccessful,
       cast(count(*) FILTER (WHERE success) AS double) / cast(count(*) AS double) * 100 AS success_percent, bool_and(success) AS success FROM results""",
)
def dq_suite_summary(m):
    return quality.suite_summary(quality.run_suite(dirty_trades(m), quality.bronze_trades_suite()))


SCORE_SQL = """parts AS (
  SELECT *, CASE WHEN rows = 0 THEN 1 ELSE greatest(0, least(1, 1 - cast(null_count AS double) / rows)) END AS completeness,
         CASE WHEN rows = 0 THEN 1 ELSE greatest(0, least(1, 1 - cast(invalid_count AS double) / rows)) END AS accuracy,
         CASE WHEN within_sla THEN 1::DOUBLE ELSE 0::DOUBLE END AS freshness,
         CASE WHEN rows = 0 THEN 1 ELSE greatest(0, least(1, 1 - cast(duplicate_count AS double) / rows)) END AS uniqueness FROM counts),
scored AS (SELECT *, completeness * 0.3::DOUBLE + accuracy * 0.3::DOUBLE + freshness * 0.2::DOUBLE + uniqueness * 0.2::DOUBLE AS overall FROM parts),
graded AS (SELECT *, CASE WHEN overall >= 0.95::DOUBLE THEN 'A' WHEN overall >= 0.85::DOUBLE THEN 'B' WHEN overall >= 0.7::DOUBLE THEN 'C'
                          WHEN overall >= 0.5::DOUBLE THEN 'D' ELSE 'F' END AS grade FROM scored)"""
COUNTS_SQL = """counts AS (
  SELECT symbol, count(*) AS rows, count(*) FILTER (WHERE trade_id IS NULL OR price IS NULL) AS null_count,
         count(*) FILTER (WHERE price <= 0 OR quantity < 1) AS invalid_count, count(trade_id) - count(DISTINCT trade_id) AS duplicate_count,
         max(timestamp) >= TIMESTAMP '2024-01-30 20:00:00' AS within_sla FROM dirty GROUP BY symbol)"""


def symbol_counts(m):
    """The inputs of a score for every symbol."""
    bad = (F.col("price") <= 0) | (F.col("quantity") < 1)
    return dirty_trades(m).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("trade_id").isNull() | F.col("price").isNull()).alias("null_count"),
        F.count_if(bad).alias("invalid_count"),
        (F.count("trade_id") - F.count_distinct("trade_id")).alias("duplicate_count"),
        (F.max("timestamp") >= F.lit("2024-01-30 20:00:00").cast("timestamp")).alias("within_sla"),
    )


@query(
    "dq_score",
    f"WITH {DIRTY_SQL}, {COUNTS_SQL}, {SCORE_SQL} SELECT symbol, completeness, accuracy, freshness, uniqueness, overall FROM graded",
)
def dq_score(m):
    scored = quality.quality_score(symbol_counts(m))
    return scored.select("symbol", "completeness", "accuracy", "freshness", "uniqueness", "overall")


@query(
    "dq_grade",
    """SELECT _kafka_offset % 101 AS percent, CASE WHEN _kafka_offset % 101 >= 95 THEN 'A' WHEN _kafka_offset % 101 >= 85 THEN 'B'
       WHEN _kafka_offset % 101 >= 70 THEN 'C' WHEN _kafka_offset % 101 >= 50 THEN 'D' ELSE 'F' END AS grade, count(*) AS trade_count
FROM trades GROUP BY 1, 2""",
)
def dq_grade(m):
    """Every whole percentage graded, so that each boundary is met."""
    percent = F.col("_kafka_offset") % 101
    score = percent.cast("double") / F.lit(100.0)
    return m.trades.groupBy(percent.alias("percent"), quality.grade(score).alias("grade")).agg(
        F.count(F.lit(1)).alias("trade_count")
    )


@query(
    "dq_layer_scores",
    f"""WITH counts AS (
  SELECT 'bronze' AS layer, count(*) AS rows, 0::BIGINT AS null_count, count(*) - count(DISTINCT trade_id) AS duplicate_count, 0::BIGINT AS invalid_count, count(*) FILTER (WHERE price <= 0 OR quantity < 1) = 0 AS within_sla FROM bronze_trades
  UNION ALL SELECT 'silver', count(*), 0, 0, 0, count(*) FILTER (WHERE price < 0.01::DOUBLE OR price > 100000 OR quantity < 1 OR quantity > 1000000) = 0 FROM silver_trades
  UNION ALL SELECT 'gold', count(*), 0, count(*) - count(DISTINCT symbol), 0, true FROM gold),
{SCORE_SQL}
SELECT layer, rows, null_count, duplicate_count, completeness, freshness, uniqueness, overall, grade FROM graded""",
)
def dq_layer_scores(m):
    scores = quality.layer_scores(
        {
            "bronze": (m.bronze_trades, "trade_id", quality.bronze_trades_suite()),
            "silver": (m.silver_trades, "trade_id", quality.silver_trades_suite()),
            "gold": (m.gold, "symbol", quality.gold_daily_suite()),
            "empty": (m.gold.limit(0), "symbol", quality.gold_daily_suite()),
        }
    )
    return scores.select(
        "layer", "rows", "null_count", "duplicate_count", "completeness", "freshness", "uniqueness", "overall", "grade"
    )


@query(
    "dq_kafka_offset_unique",
    """WITH replayed AS (SELECT _kafka_partition, _kafka_offset % 5000 AS _kafka_offset FROM bronze_trades)
SELECT _kafka_partition, _kafka_offset, count(*) AS copies FROM replayed GROUP BY 1, 2 HAVING count(*) > 1""",
)
def dq_kafka_offset_unique(m):
    """Offsets made to wrap around at 5000."""
    return quality.repeated_offsets(m.bronze_trades.withColumn("_kafka_offset", F.col("_kafka_offset") % 5000))


@query(
    "dq_bronze_silver_diff",
    """SELECT count(*) AS pairs, count(*) FILTER (WHERE abs(s.price - b.price) > 0.001) AS price_drift,
       count(*) FILTER (WHERE s.quantity <> b.quantity) AS quantity_drift, count(*) FILTER (WHERE s.timestamp <> b.timestamp) AS time_drift,
       0::BIGINT AS processed_before_ingested
FROM silver_trades s JOIN bronze_trades b USING (trade_id)""",
)
def dq_bronze_silver_diff(m):
    return quality.layer_drift(m.bronze_trades, m.silver_trades)


@query(
    "dq_cross_layer",
    """WITH kept AS (SELECT * FROM silver_trades WHERE timestamp < TIMESTAMP '2024-01-29'),
f AS (SELECT (SELECT count(*) FROM bronze_trades) AS b, (SELECT count(DISTINCT trade_id) FROM bronze_trades WHERE trade_id NOT IN (SELECT trade_id FROM kept)) AS lost,
  (SELECT count(*) FROM kept) AS s, (SELECT count(*) FROM gold) AS g, (SELECT cast(sum(quantity) AS bigint) FROM kept) AS sv, (SELECT cast(sum(total_volume) AS bigint) FROM gold) AS gv,
  (SELECT cast(sum(px * quantity) AS double) / 1000000 FROM kept) AS sx, (SELECT cast(sum(value_px) AS double) / 1000000 FROM gold) AS gx)
SELECT 'bronze_to_silver_loss' AS rule, cast(lost AS double) AS measured, 0::DOUBLE AS expected, lost = 0 AS success FROM f
UNION ALL SELECT 'silver_within_bronze', s, b, s <= b FROM f
UNION ALL SELECT 'gold_within_silver', g, s, g <= s FROM f
UNION ALL SELECT 'volume_equal', gv, sv, gv = sv FROM f
UNION ALL SELECT 'value_equal', gx, sx, abs(gx - sx) <= 0.01 FROM f""",
)
def dq_cross_layer(m):
    """Silver made to miss its last two days, which three of the five rules notice."""
    kept = m.silver_trades.filter("timestamp < timestamp'2024-01-29'")
    return quality.cross_layer(m.bronze_trades, kept, m.gold)


FRESH_SQL = """SELECT asset, last_seen, cast(epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(last_seen) AS double) / 3600000000 AS lag_hours,
       last_seen IS NULL OR cast(epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(last_seen) AS double) / 3600000000 > 24 AS breached
FROM ({seen})"""
SEEN_SQL = """SELECT 'bronze' AS asset, max(timestamp + INTERVAL 2 SECOND) AS last_seen FROM bronze_trades
UNION ALL SELECT 'silver', CASE WHEN count(*) > 0 THEN TIMESTAMP '2024-01-31 00:00:00' END FROM silver_trades
UNION ALL SELECT 'gold', CASE WHEN count(*) > 0 THEN TIMESTAMP '2024-01-31 00:00:00' END FROM gold
UNION ALL SELECT 'never', NULL"""


def assets(m):
    return health.latest(
        {
            "bronze": (m.bronze_trades, "_ingested_at"),
            "silver": (m.silver_trades, "_processed_at"),
            "gold": (m.gold, "_aggregated_at"),
            "never": (m.gold.limit(0), "_aggregated_at"),
        }
    )


@query("dq_freshness", FRESH_SQL.format(seen=SEEN_SQL))
def dq_freshness(m):
    return health.freshness(assets(m), "2024-02-01 00:00:00")


@query(
    "dq_layer_freshness",
    f"""WITH limits(asset, limit_seconds, severity) AS (VALUES ('bronze', 120, 'warning'), ('silver', 600, 'warning'), ('gold', 7200, 'warning'), ('bronze', 900, 'critical')),
seen AS ({SEEN_SQL})
SELECT asset, last_seen, limit_seconds, severity, cast(epoch_us(TIMESTAMP '2024-01-31 00:11:00') - epoch_us(last_seen) AS double) / 1000000 AS age_seconds
FROM seen JOIN limits USING (asset)
WHERE last_seen IS NULL OR cast(epoch_us(TIMESTAMP '2024-01-31 00:11:00') - epoch_us(last_seen) AS double) / 1000000 > limit_seconds""",
)
def dq_layer_freshness(m):
    return health.layer_freshness(m.spark, assets(m), "2024-01-31 00:11:00")
