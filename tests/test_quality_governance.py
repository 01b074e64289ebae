from datetime import date

import pytest
from pyspark.sql import functions as F

from tapelake.functions import masking as mk
from tapelake.functions import sql_functions
from tapelake.operators import governance as gov
from tapelake.operators import health, quality


def results(df, suite):
    return {r.expectation: (r.success, r.unexpected_count) for r in quality.run_suite(df, suite).collect()}


def test_clean_layers_pass(market):
    for df, suite in (
        (market.bronze_trades, quality.bronze_trades_suite()),
        (market.silver_trades, quality.silver_trades_suite(["NATION_%d" % i for i in range(25)])),
        (market.gold, quality.gold_daily_suite()),
    ):
        summary = quality.suite_summary(quality.run_suite(df, suite)).collect()[0]
        assert summary.success, results(df, suite)
        assert summary.unsuccessful == 0


def test_bounds_are_strict_or_not(spark):
    df = spark.createDataFrame([(0.0,), (0.01,), (100000.0,), (None,)], "price double")
    assert results(df, [quality.between("price", low=0, strict=True)]) == {"between:price": (False, 1)}
    assert results(df, [quality.between("price", 0.01, 100_000)]) == {"between:price": (False, 1)}
    assert results(df.filter("price > 0"), [quality.between("price", 0.01, 100_000)]) == {"between:price": (True, 0)}


def test_unique_counts_every_copy(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "trade_id string")
    assert results(df, [quality.unique("trade_id")]) == {"unique:trade_id": (False, 3)}
    assert quality.duplicates(df, ("trade_id",)).collect()[0].beyond_first == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "price double")
    assert results(df, [quality.row_count(1), quality.not_null("price")]) == {"row_count": (False, 0), "not_null:price": (True, 0)}


def test_row_checks_share_one_scan(market):
    suite = [e for e in quality.bronze_trades_suite()]
    plan = quality.run_suite(market.table("events").withColumnsRenamed({"value": "price", "ts": "timestamp"}), suite)
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


@pytest.mark.parametrize(
    "score,letter", [(0.95, "A"), (0.949, "B"), (0.85, "B"), (0.849, "C"), (0.7, "C"), (0.69, "D"), (0.5, "D"), (0.49, "F")]
)
def test_grade_boundaries(spark, score, letter):
    assert spark.range(1).select(quality.grade(F.lit(score))).collect()[0][0] == letter


@pytest.mark.parametrize(
    "counts,expected",
    [
        ((100, 0, 0, 0, True), (1.0, 1.0, 1.0, 1.0, "A")),
        ((100, 10, 20, 5, False), (0.9, 0.8, 0.0, 0.95, "C")),
        ((0, 0, 0, 0, True), (1.0, 1.0, 1.0, 1.0, "A")),
        ((0, 0, 0, 0, False), (1.0, 1.0, 0.0, 1.0, "C")),
        ((10, 50, 50, 50, False), (0.0, 0.0, 0.0, 0.0, "F")),
    ],
)
def test_scores(spark, counts, expected):
    schema = "rows bigint, null_count bigint, invalid_count bigint, duplicate_count bigint, within_sla boolean"
    row = quality.quality_score(spark.createDataFrame([counts], schema)).collect()[0]
    got = (row.completeness, row.accuracy, row.freshness, row.uniqueness)
    assert got == pytest.approx(expected[:4])
    assert row.grade == expected[4]


ACCOUNT = "account_id string, price double, quantity int"


@pytest.fixture
def accounts(spark):
    return spark.createDataFrame([("ACC-123", 10.126, 7), ("AB", 1.0, 1), (None, None, None)], ACCOUNT)


@pytest.mark.parametrize(
    "role,first",
    [
        ("admin", ("ACC-123", 10.126, 7)),
        ("data_engineer", ("ACC-123", 10.126, 7)),
        ("data_analyst", ("ACC-***", 10.13, 7)),
        ("business_user", ("***REDACTED***", 10.0, 7)),
        ("viewer", ("***REDACTED***", "***REDACTED***", "***REDACTED***")),
        ("who?", ("***REDACTED***", "***REDACTED***", "***REDACTED***")),
    ],
)
def test_role_masks(accounts, role, first):
    rows = gov.mask_for_role(accounts, role).collect()
    assert tuple(rows[0]) == first
    assert tuple(rows[2]) == (None, None, None)


def test_scientist_sees_md5(accounts):
    import hashlib

    assert gov.mask_for_role(accounts, "data_scientist").collect()[0].account_id == hashlib.md5(b"ACC-123").hexdigest()


def test_absent_fields_are_ignored(spark):
    assert gov.mask_for_role(spark.range(1), "viewer").columns == ["id"]


def test_partial_masks_differ(accounts):
    row = [tuple(r) for r in accounts.select(mk.mask_partial("account_id", 4), mk.mask_partial_padded("account_id", 4)).collect()]
    assert row == [("ACC-***", "ACC-***"), ("***", "***"), (None, None)]
    longer = accounts.select(F.concat("account_id", F.lit("456")).alias("a"))
    assert tuple(longer.select(mk.mask_partial("a", 4), mk.mask_partial_padded("a", 4)).collect()[0]) == ("ACC-***", "ACC-******")


def test_sql_functions_agree_with_columns(spark, accounts):
    sql_functions.register(spark)
    accounts.createOrReplaceTempView("accounts")
    sql = spark.sql("SELECT mask_hash(account_id), mask_partial(account_id, 4), mask_round(price, 2), hash_account_id(account_id) FROM accounts")
    columns = accounts.select(mk.mask_hash("account_id"), mk.mask_partial_padded("account_id", 4), mk.mask_round("price", 2), mk.pseudonym("account_id"))
    assert [tuple(r) for r in sql.collect()] == [tuple(r) for r in columns.collect()]


def test_roles_and_views():
    assert gov.primary_role(["viewer", "data_analyst"]) == "data_analyst"
    assert gov.primary_role([]) == "viewer"
    assert gov.cls_view_name("admin", "silver_trades") == "silver_trades"
    assert gov.cls_view_name("unheard_of", "silver_trades") == "silver_trades_cls_business"
    assert gov.cls_view_name("viewer", "daily_trading_summary") == "daily_summary_cls_all"
    assert gov.cls_view_name("viewer", "unmapped") == "unmapped"


def test_excluded_columns_are_not_read(market):
    market.spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = gov.read_as(market.account_trades, "silver_trades", "viewer")._jdf.queryExecution().executedPlan().toString()
    assert "value" not in plan


def test_row_security(market):
    assert gov.rls_account(market.account_trades, "").count() == 0
    assert gov.rls_account(market.account_trades, None).count() == 0
    everything = market.account_trades.count()
    assert gov.rls_region(market.account_trades).count() == everything
    assert 0 < gov.rls_region(market.account_trades, "ASIA").count() < everything


def test_retention_is_idempotent_and_skips_null(spark):
    data = [("A", date(2024, 1, 1)), (None, date(2024, 1, 1)), ("B", date(2024, 3, 1)), ("DELETED-x", date(2024, 1, 1))]
    df = spark.createDataFrame(data, "account_id string, trade_date date")
    once = gov.enforce_retention(df, "2024-02-01")
    assert gov.retention_report({"t": df}, "2024-02-01").collect()[0].rows_affected == 1
    assert gov.retention_report({"t": once}, "2024-02-01").collect()[0].rows_affected == 0
    got = [r.account_id for r in once.collect()]
    assert got[0].startswith("DELETED-") and len(got[0]) == 24
    assert got[1:] == [None, "B", "DELETED-x"]


def test_forgetting_keeps_other_rows(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "account_id string")
    assert [r.account_id for r in gov.forget_account(df, "A", gov.DeletionTarget("t", "delete")).collect()] == ["B", None]
    kept = gov.forget_account(df, "A", gov.DeletionTarget("t", "pseudonymise")).collect()
    assert kept[0].account_id.startswith("DELETED-") and len(kept) == 3
    report = gov.deletion_report({"t": df}, "A", [gov.DeletionTarget("t", "delete")]).collect()[0]
    assert (report.affected_rows, report.executed) == (1, False)


def test_catalog_scan(spark, market):
    columns = gov.scan_names(gov.catalog_columns(spark, {"account_trades": market.account_trades}))
    assert [r.column_name for r in columns.filter("is_pii").collect()] == ["account_id"]


def test_drift(spark):
    old = spark.createDataFrame([("a", "STRING"), ("b", "BIGINT"), ("c", "DOUBLE")], "name string, data_type string")
    new = spark.createDataFrame([("a", "STRING"), ("b", "STRING"), ("d", "DOUBLE")], "name string, data_type string")
    got = {r.name: (r.change, r.severity) for r in gov.schema_drift(old, new).collect()}
    assert got == {"b": ("retyped", "BREAKING"), "c": ("removed", "BREAKING"), "d": ("added", "INFO")}


def test_freshness(spark):
    seen = spark.sql("SELECT 'a' AS asset, timestamp'2024-01-01 00:00:00' AS last_seen UNION ALL SELECT 'b', timestamp'2024-01-02 12:00:00' UNION ALL SELECT 'c', NULL")
    got = {r.asset: r.breached for r in health.freshness(seen, "2024-01-03 00:00:00").collect()}
    assert got == {"a": True, "b": False, "c": True}


def latency(spark, values):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "valid", v) for v in values], "t string, status string, latency_seconds double")
    rows = health.ingest_health(df.withColumn("timestamp", F.col("t").cast("timestamp"))).collect()
    return rows[0].latency_p95


def test_quantile_from_buckets(spark):
    assert latency(spark, [i / 1000 for i in range(101)]) == pytest.approx(0.095, abs=0.002)
    assert 1.0 < latency(spark, [3.0] * 10) <= 3.0
    assert latency(spark, [None]) is None


def test_silent_windows_raise_alerts(spark):
    at = ["2024-01-01 00:00:00", "2024-01-01 00:00:01", "2024-01-01 00:21:00"]
    df = spark.createDataFrame([(t, "valid", 0.01) for t in at], "t string, status string, latency_seconds double")
    fired = health.ingest_alerts(df.withColumn("timestamp", F.col("t").cast("timestamp")))
    zero = sorted(str(r.window_start)[11:16] for r in fired.filter("alert = 'BridgeThroughputZero'").collect())
    assert zero == ["00:05", "00:10", "00:15"]


def test_alerts_read_the_feed_once(market):
    events = market.trades.select("timestamp", F.lit("valid").alias("status"), F.lit(0.1).alias("latency_seconds"))
    plan = health.ingest_alerts(events)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [event_id") == 1
