"""Governance queries: masking, column and row security, retention, deletion, PII and audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.functions import masking as mk
from tapelake.operators import governance as gov
from tapelake.plans.market_sql import rounded
from tapelake.plans.registry import query
from tapelake.plans.selection import silver_books


@query("mask_hash", "SELECT trade_id, md5(account_id) AS account_id, md5(cast(quantity AS varchar)) AS quantity FROM account_trades")
def mask_hash(m):
    return m.account_trades.select(
        "trade_id", mk.mask_hash("account_id").alias("account_id"), mk.mask_hash("quantity").alias("quantity")
    )


@query(
    "mask_redact",
    """SELECT trade_id, CASE WHEN quantity % 20 = 0 THEN NULL ELSE '***REDACTED***' END AS account_id FROM account_trades""",
)
def mask_redact(m):
    account = F.when(F.col("quantity") % 20 != 0, F.col("account_id"))
    return m.account_trades.select("trade_id", mk.mask_redact(account).alias("account_id"))


@query(
    "mask_partial",
    """SELECT trade_id, substr(account_id, 1, 4) || '***' AS api_form, substr(account_id, 1, 4) || repeat('*', length(account_id) - 4) AS view_form,
       '***' AS short_api, '***' AS short_view FROM account_trades""",
)
def mask_partial(m):
    return m.account_trades.select(
        "trade_id",
        mk.mask_partial("account_id", 4).alias("api_form"),
        mk.mask_partial_padded("account_id", 4).alias("view_form"),
        mk.mask_partial("side", 4).alias("short_api"),
        mk.mask_partial_padded("side", 4).alias("short_view"),
    )


@query("mask_round", f"SELECT trade_id, {rounded('price', 0)} AS p0, {rounded('price', 1)} AS p1 FROM account_trades")
def mask_round(m):
    return m.account_trades.select("trade_id", mk.mask_round("price", 0).alias("p0"), mk.mask_round("price", 1).alias("p1"))


ROLE_SQL = {
    "admin": ("price", "quantity", "account_id"),
    "data_scientist": ("price", "quantity", "md5(account_id)"),
    "data_analyst": (rounded("price", 2), "quantity", "substr(account_id, 1, 4) || '***'"),
    "business_user": (rounded("price", 0), "quantity", "'***REDACTED***'"),
    "viewer": ("'***REDACTED***'", "'***REDACTED***'", "'***REDACTED***'"),
}


@query(
    "mask_role_policy",
    " UNION ALL ".join(
        f"SELECT '{role}' AS role, trade_id, symbol, cast({p} AS varchar) AS price, cast({q} AS varchar) AS quantity, {a} AS account_id FROM account_trades"
        for role, (p, q, a) in {**ROLE_SQL, "stranger": ROLE_SQL["viewer"]}.items()
    ),
)
def mask_role_policy(m):
    """Every role, and one nobody defined, side by side; numbers as text, since a viewer's are redacted."""
    rows = m.account_trades.select("trade_id", "symbol", "price", "quantity", "account_id")
    out = None
    for role in [*ROLE_SQL, "stranger"]:
        seen = gov.mask_for_role(rows, role).select(
            F.lit(role).alias("role"),
            "trade_id",
            "symbol",
            F.col("price").cast("string").alias("price"),
            F.col("quantity").cast("string").alias("quantity"),
            "account_id",
        )
        out = seen if out is None else out.unionByName(seen)
    return out


SPREADS_SQL = """spreads AS (SELECT symbol, cast(timestamp AS date) AS trade_date,
  cast(sum(cast(round(spread * 1000000) AS bigint)) AS double) / (nullif(count(spread), 0) * 1000000) AS avg_bid_ask_spread FROM silver_books GROUP BY 1, 2),
summary AS (SELECT g.symbol, g.trading_date AS trade_date, g.sector AS region, total_volume, vwap, open_price, close_price, high_price, low_price, trade_count,
  avg_bid_ask_spread FROM gold g LEFT JOIN spreads s ON s.symbol = g.symbol AND s.trade_date = g.trading_date)"""
SUMMARY = "symbol, trade_date, total_volume, vwap, open_price, close_price, high_price, low_price, trade_count, avg_bid_ask_spread"


def summary(m):
    spreads = (
        silver_books(m)
        .groupBy("symbol", F.to_date("timestamp").alias("trade_date"))
        .agg(fp.price_mean("spread").alias("avg_bid_ask_spread"))
    )
    return gov.regional_summary(m.gold, spreads)


@query("cls_scientist", "SELECT trade_id, symbol, price, quantity, side, trade_date, md5(account_id) AS account_id FROM account_trades")
def cls_scientist(m):
    return gov.read_as(m.account_trades, "silver_trades", "data_scientist")


@query("cls_analyst", f"SELECT trade_id, symbol, {rounded('price', 2)} AS price, quantity, side, trade_date FROM account_trades")
def cls_analyst(m):
    return gov.read_as(m.account_trades, "silver_trades", "analyst")


@query("cls_business", "SELECT symbol, trade_date, quantity, side FROM account_trades")
def cls_business(m):
    return gov.read_as(m.account_trades, "silver_trades", "somebody_else")


@query("cls_summary", f"WITH {SPREADS_SQL} SELECT {SUMMARY} FROM summary")
def cls_summary(m):
    return gov.read_as(summary(m), "daily_trading_summary", "viewer")


@query("cls_views", "SELECT trade_id, symbol, price, quantity, side, trade_date, timestamp, account_id, region FROM account_trades")
def cls_views(m):
    """An engineer reads the base table."""
    return gov.read_as(m.account_trades, "silver_trades", "data_engineer")


@query(
    "masked_tables",
    f"""SELECT 'analyst' AS audience, trade_id, symbol, {rounded('price', 2)} AS price, quantity, side, trade_date, md5(account_id) AS account_id FROM account_trades
UNION ALL SELECT 'business', trade_id, symbol, {rounded('price', 0)}, quantity, side, trade_date, '***REDACTED***' FROM account_trades""",
)
def masked_tables(m):
    analyst = gov.cls_view(m.account_trades, "silver_trades_analyst").withColumn("audience", F.lit("analyst"))
    business = gov.cls_view(m.account_trades, "silver_trades_business").withColumn("audience", F.lit("business"))
    return analyst.unionByName(business)


@query(
    "masked_raw_analyst",
    """SELECT trade_id, symbol, price, quantity, side, timestamp, substr(account_id, 1, 4) || repeat('*', length(account_id) - 4) AS account_id
FROM account_trades""",
)
def masked_raw_analyst(m):
    return gov.cls_view(m.account_trades, "raw_trades_analyst")


@query("rls_account", "SELECT trade_id, symbol, account_id FROM account_trades WHERE account_id = 'ACC-000010'")
def rls_account(m):
    mine = gov.rls_account(m.account_trades, "ACC-000010")
    nobody = gov.rls_account(m.account_trades, None)
    return mine.unionByName(nobody).select("trade_id", "symbol", "account_id")


@query(
    "rls_region",
    f"""WITH {SPREADS_SQL}
SELECT 'one' AS viewer, symbol, trade_date, region, total_volume FROM summary WHERE region = 'AFRICA'
UNION ALL SELECT 'global', symbol, trade_date, region, total_volume FROM summary""",
)
def rls_region(m):
    rows = summary(m).select("symbol", "trade_date", "region", "total_volume")
    one = gov.rls_region(rows, "AFRICA").withColumn("viewer", F.lit("one"))
    return one.unionByName(gov.rls_region(rows).withColumn("viewer", F.lit("global")))


PSEUDONYM = "'DELETED-' || substr(sha256(account_id), 1, 16)"


@query(
    "udf_hash_account",
    f"SELECT DISTINCT account_id, {PSEUDONYM} AS pseudonym FROM account_trades",
)
def udf_hash_account(m):
    return m.account_trades.select("account_id", mk.pseudonym("account_id").alias("pseudonym")).distinct()


@query(
    "pii_retention",
    f"""SELECT trade_id, trade_date, CASE WHEN trade_date < DATE '2024-01-20' THEN {PSEUDONYM} ELSE account_id END AS account_id FROM account_trades""",
)
def pii_retention(m):
    """Applied twice, which must equal once."""
    once = gov.enforce_retention(m.account_trades, "2024-01-20")
    return gov.enforce_retention(once, "2024-01-20").select("trade_id", "trade_date", "account_id")


@query(
    "pii_retention_report",
    """SELECT 'trades' AS table_name, true AS dry_run, count(*) FILTER (WHERE trade_date < DATE '2024-01-20') AS rows_affected FROM account_trades
UNION ALL SELECT 'processed', true, 0""",
)
def pii_retention_report(m):
    done = gov.enforce_retention(m.account_trades, "2024-01-20")
    return gov.retention_report({"trades": m.account_trades, "processed": done}, "2024-01-20")


@query(
    "right_to_delete",
    f"""SELECT 'pseudonymised' AS outcome, trade_id, CASE WHEN account_id = 'ACC-000010' THEN {PSEUDONYM} ELSE account_id END AS account_id FROM account_trades
UNION ALL SELECT 'deleted', trade_id, account_id FROM account_trades WHERE account_id <> 'ACC-000010'""",
)
def right_to_delete(m):
    rows = m.account_trades.select("trade_id", "account_id")
    out = None
    for outcome, strategy in (("pseudonymised", "pseudonymise"), ("deleted", "delete")):
        left = gov.forget_account(rows, "ACC-000010", gov.DeletionTarget("trades", strategy))
        left = left.withColumn("outcome", F.lit(outcome))
        out = left if out is None else out.unionByName(left)
    return out


@query(
    "right_to_delete_report",
    """SELECT 'silver_trades' AS table_name, 'pseudonymise' AS strategy, count(*) FILTER (WHERE account_id = 'ACC-000010') AS affected_rows,
       count(*) FILTER (WHERE account_id = 'ACC-000010') > 0 AS executed FROM account_trades
UNION ALL SELECT 'raw_trades', 'delete', count(*) FILTER (WHERE buyer_agent_id = 'ACC-000010'), count(*) FILTER (WHERE buyer_agent_id = 'ACC-000010') > 0 FROM trades""",
)
def right_to_delete_report(m):
    targets = [
        gov.DeletionTarget("silver_trades", "pseudonymise"),
        gov.DeletionTarget("raw_trades", "delete", column="buyer_agent_id"),
    ]
    tables = {"silver_trades": m.account_trades, "raw_trades": m.trades}
    return gov.deletion_report(tables, "ACC-000010", targets, dry_run=False)


@query(
    "pii_scan",
    r"""SELECT lang, source, count(*) AS rows_scanned, count(*) FILTER (WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}')) AS email,
       count(*) FILTER (WHERE regexp_matches(text, '\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b')) AS ip_address,
       count(*) FILTER (WHERE regexp_matches(text, '\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b')) AS ssn FROM documents GROUP BY lang, source""",
)
def pii_scan(m):
    """Personal values in whole texts."""
    return gov.scan_values(m.table("documents"), "text", by=["lang", "source"])


NAME_RULE = "regexp_matches(lower(name), 'account_id|user_id|customer_id|email|phone|address|ssn|national_id|passport|ip_address|device_id')"


@query(
    "pii_scan_names",
    f"""WITH named AS (SELECT CASE event_id % 8 WHEN 0 THEN 'Account_ID' WHEN 1 THEN 'ip_address' WHEN 2 THEN 'HomeAddress' WHEN 3 THEN 'price'
   WHEN 4 THEN 'contact_EMAIL' WHEN 5 THEN 'symbol' WHEN 6 THEN 'user_id' ELSE 'event_type' END AS name FROM events)
SELECT name AS column_name, {NAME_RULE} AS is_pii, count(*) AS occurrences FROM named GROUP BY 1, 2""",
)
def pii_scan_names(m):
    """Column names as a table, as a catalog export holds them."""
    names = ["Account_ID", "ip_address", "HomeAddress", "price", "contact_EMAIL", "symbol", "user_id", "event_type"]
    slot = (F.col("event_id") % 8).cast("int")
    columns = m.table("events").select(F.get(F.array(*[F.lit(n) for n in names]), slot).alias("column_name"))
    return gov.scan_names(columns).groupBy("column_name", "is_pii").agg(F.count(F.lit(1)).alias("occurrences"))


ACCESS_SQL = """accesses AS (
  SELECT event_id, user_id, CASE user_id % 3 WHEN 0 THEN 'data_analyst' WHEN 1 THEN 'viewer' ELSE 'data_engineer' END AS user_role,
         CASE event_id % 2 WHEN 0 THEN 'silver.trades' ELSE 'bronze.raw_trades' END AS resource, event_type = 'click' AS touches,
         event_type <> 'error' AS granted, CASE WHEN event_id % 5 = 0 THEN '' ELSE 'SELECT ' || event_type END AS query FROM events)"""


def accesses(m):
    """An access log read off the events: clicks touch an account column, errors are denials."""
    e = m.table("events")
    role = F.when(F.col("user_id") % 3 == 0, "data_analyst").when(F.col("user_id") % 3 == 1, "viewer").otherwise("data_engineer")
    touched = F.when(F.col("event_type") == "click", F.array(F.lit("symbol"), F.lit("account_id"))).otherwise(
        F.array(F.lit("symbol"), F.lit("price"))
    )
    return e.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        role.alias("user_role"),
        F.when(F.col("event_id") % 2 == 0, "silver.trades").otherwise("bronze.raw_trades").alias("resource"),
        touched.alias("columns"),
        F.lit("SELECT").alias("operation"),
        F.when(F.col("event_id") % 5 == 0, "").otherwise(F.concat(F.lit("SELECT "), "event_type")).alias("query"),
        (F.col("event_type") != "error").alias("granted"),
    )


@query(
    "pii_audit",
    f"""WITH {ACCESS_SQL}
SELECT cast(user_id AS varchar) AS user_id, user_role, resource, CASE WHEN touches THEN 'account_id' ELSE 'symbol,price' END AS columns, 'SELECT' AS operation,
       CASE WHEN query = '' THEN '' ELSE sha256(query) END AS query_hash, granted FROM accesses WHERE touches OR NOT granted""",
)
def pii_audit(m):
    return gov.audit_events(accesses(m)).withColumn("columns", F.array_join("columns", ","))


@query(
    "pii_audit_rollup",
    f"""WITH {ACCESS_SQL}
SELECT user_role, resource, count(*) FILTER (WHERE granted) AS granted, count(*) FILTER (WHERE NOT granted) AS denied
FROM accesses WHERE touches OR NOT granted GROUP BY 1, 2""",
)
def pii_audit_rollup(m):
    return gov.audit_rollup(gov.audit_events(accesses(m)))


@query(
    "schema_drift",
    """SELECT 'k' AS name, 'BIGINT' AS old_type, CASE WHEN (SELECT count(*) FROM events WHERE event_id % 3 = 0) * 2 > (SELECT count(*) FROM events) THEN 'BIGINT' ELSE 'STRING' END AS new_type,
       'retyped' AS change, 'BREAKING' AS severity
UNION ALL SELECT 'old_only', 'STRING', NULL, 'removed', 'BREAKING' UNION ALL SELECT 'note', NULL, 'STRING', 'added', 'INFO'""",
)
def schema_drift(m):
    """Two generations of the events' JSON: later ones quote most numbers, lose one field and gain another."""
    e = m.table("events")
    before = e.select(F.regexp_replace("props", "}$", ', "old_only": "x"}').alias("doc"))
    quoted = F.regexp_replace("props", "([0-9]+)", '"$1"')
    after = e.select(
        F.regexp_replace(F.when(F.col("event_id") % 3 == 0, F.col("props")).otherwise(quoted), "}$", ', "note": "y"}').alias("doc")
    )
    old = gov.dominant_types(gov.field_census(before, "doc"))
    new = gov.dominant_types(gov.field_census(after, "doc"))
    return gov.schema_drift(old, new)
