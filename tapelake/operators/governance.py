"""Governance: role masking, column and row security, retention, deletion, PII scans, access audit, schema drift."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapelake.functions import masking as mk
from tapelake.functions.timing import as_date

# Masking rules, role -> field -> (strategy, argument).
MASKING_RULES: dict[str, dict[str, tuple]] = {
    "admin": {},
    "data_engineer": {},
    "data_scientist": {"account_id": ("hash",)},
    "data_analyst": {"account_id": ("partial", 4), "price": ("round", 2)},
    "business_user": {"account_id": ("redact",), "price": ("round", 0)},
    "viewer": {"account_id": ("redact",), "price": ("redact",), "quantity": ("redact",)},
}
MOST_RESTRICTED = "viewer"
# Roles from most to least privileged.
ROLE_ORDER = ("admin", "data_engineer", "data_scientist", "data_analyst", "analyst", "business_user", "viewer")

# Columns each column-security view exposes; a pair names a masking strategy.
TRADE_COLUMNS = ["trade_id", "symbol", "price", "quantity", "side", "trade_date"]
CLS_VIEWS: dict[str, list] = {
    "silver_trades_cls_scientist": [*TRADE_COLUMNS, ("account_id", ("hash",))],
    "silver_trades_cls_analyst": ["trade_id", "symbol", ("price", ("round", 2)), "quantity", "side", "trade_date"],
    "silver_trades_cls_business": ["symbol", "trade_date", "quantity", "side"],
    "silver_trades_analyst": [
        "trade_id", "symbol", ("price", ("round", 2)), "quantity", "side", "trade_date", ("account_id", ("hash",)),
    ],
    "silver_trades_business": [
        "trade_id", "symbol", ("price", ("round", 0)), "quantity", "side", "trade_date", ("account_id", ("redact",)),
    ],
    "raw_trades_analyst": [
        "trade_id", "symbol", "price", "quantity", "side", "timestamp", ("account_id", ("partial_padded", 4)),
    ],
    "daily_summary_cls_all": [
        "symbol", "trade_date", "total_volume", "vwap", "open_price", "close_price", "high_price", "low_price",
        "trade_count", "avg_bid_ask_spread",
    ],
}
# Which view a role reads; None is the base table.
CLS_ROLES: dict[str, dict[str, str | None]] = {
    "silver_trades": {
        "admin": None,
        "data_engineer": None,
        "data_scientist": "silver_trades_cls_scientist",
        "data_analyst": "silver_trades_cls_analyst",
        "analyst": "silver_trades_cls_analyst",
        "business_user": "silver_trades_cls_business",
        "viewer": "silver_trades_cls_business",
    },
    "daily_trading_summary": {role: "daily_summary_cls_all" for role in ROLE_ORDER},
}
GLOBAL_REGION = "GLOBAL"

# Column-name patterns and audited columns that count as personal data.
PII_NAME_PATTERNS = (
    "account_id", "user_id", "customer_id", "email", "phone", "address", "ssn", "national_id", "passport", "ip_address",
    "device_id",
)
PII_COLUMNS = (
    "account_id", "user_id", "customer_id", "email", "phone", "ip_address", "device_id", "ssn", "national_id",
)
# Patterns for values, of this repository's own making.
PII_VALUE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}",
    "ip_address": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
RETENTION_DAYS = 90


def _masked(column: Column, strategy: tuple, numeric: bool) -> Column:
    kind = strategy[0]
    if kind == "hash":
        return mk.mask_hash(column)
    if kind == "redact":
        return mk.mask_redact(column)
    if kind == "partial":
        return mk.mask_partial(column, strategy[1])
    if kind == "partial_padded":
        return mk.mask_partial_padded(column, strategy[1])
    return mk.mask_round(column, strategy[1]) if numeric else column


def mask_for_role(df: DataFrame, role: str) -> DataFrame:
    """Mask the fields the role may not see; an unknown role gets the most restrictive rules.

    A redacted number becomes a string column. Fields the table lacks are ignored.
    """
    rules = MASKING_RULES.get(role, MASKING_RULES[MOST_RESTRICTED])
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    masked = {name: _masked(F.col(name), how, name in numeric) for name, how in rules.items() if name in df.columns}
    return df.withColumns(masked) if masked else df


def primary_role(roles: list[str]) -> str:
    """The most privileged role held."""
    return next((role for role in ROLE_ORDER if role in roles), MOST_RESTRICTED)


def cls_view_name(role: str, table: str) -> str:
    """The view a role reads a table through; unknown roles get the most restricted one."""
    views = CLS_ROLES.get(table)
    if views is None:
        return table
    return views.get(role, views[MOST_RESTRICTED]) or table


def cls_view(df: DataFrame, view: str) -> DataFrame:
    """The columns a view exposes, masked as it says; columns left out never leave the scan."""
    columns = []
    for item in CLS_VIEWS[view]:
        name, strategy = item if isinstance(item, tuple) else (item, None)
        columns.append(_masked(F.col(name), strategy, True).alias(name) if strategy else F.col(name))
    return df.select(*columns)


def read_as(df: DataFrame, table: str, role: str) -> DataFrame:
    """A table as the role sees it."""
    view = cls_view_name(role, table)
    return df if view == table else cls_view(df, view)


def rls_account(df: DataFrame, account_id: str | None) -> DataFrame:
    """Only the session account's rows; without an account, none."""
    return df.filter(F.col("account_id") == account_id) if account_id else df.filter(F.lit(False))


def rls_region(df: DataFrame, region: str | None = None) -> DataFrame:
    """The user's region; the global region, also the default, sees every row."""
    region = region or GLOBAL_REGION
    return df if region == GLOBAL_REGION else df.filter(F.col("region") == region)


def regional_summary(gold: DataFrame, spreads: DataFrame) -> DataFrame:
    """Gold with the region and mean spread columns the security views name."""
    return gold.select(
        "symbol",
        F.col("trading_date").alias("trade_date"),
        F.col("sector").alias("region"),
        "total_volume",
        "vwap",
        "open_price",
        "close_price",
        "high_price",
        "low_price",
        "trade_count",
    ).join(spreads, ["symbol", "trade_date"], "left")


def retention_due(cutoff: date | str, column: str = "account_id", day: str = "trade_date") -> Column:
    """Rows whose account is due: older than the cutoff and not pseudonymised yet."""
    return F.coalesce((F.col(day) < as_date(cutoff)) & mk.needs_pseudonym(column), F.lit(False))


def enforce_retention(df: DataFrame, cutoff: date | str) -> DataFrame:
    """Replace due accounts by their pseudonym; running it again changes nothing."""
    due = retention_due(cutoff)
    return df.withColumn("account_id", F.when(due, mk.pseudonym("account_id")).otherwise(F.col("account_id")))


def retention_report(tables: dict[str, DataFrame], cutoff: date | str, dry_run: bool = True) -> DataFrame:
    """Rows affected per table."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count_if(retention_due(cutoff)).alias("rows_affected")).select(
            F.lit(name).alias("table_name"), F.lit(dry_run).alias("dry_run"), "rows_affected"
        )
        out = row if out is None else out.unionByName(row)
    return out


@dataclass(frozen=True)
class DeletionTarget:
    """How one table forgets an account: ``pseudonymise`` or ``delete``."""

    table: str
    strategy: str
    column: str = "account_id"


def forget_account(df: DataFrame, account_id: str, target: DeletionTarget) -> DataFrame:
    """The table after the account is forgotten."""
    mine = F.col(target.column) == account_id
    if target.strategy == "delete":
        return df.filter(~F.coalesce(mine, F.lit(False)))
    return df.withColumn(target.column, F.when(mine, mk.pseudonym(target.column)).otherwise(F.col(target.column)))


def deletion_report(
    tables: dict[str, DataFrame], account_id: str, targets: list[DeletionTarget], dry_run: bool = True
) -> DataFrame:
    """Rows of the account per table and strategy, and whether the deletion is carried out there."""
    out = None
    for target in targets:
        hits = tables[target.table].agg(F.count_if(F.col(target.column) == account_id).alias("affected_rows"))
        row = hits.select(
            F.lit(target.table).alias("table_name"),
            F.lit(target.strategy).alias("strategy"),
            "affected_rows",
            (F.lit(not dry_run) & (F.col("affected_rows") > 0)).alias("executed"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def is_pii_name(name: Column | str) -> Column:
    """A column name containing one of the patterns, whatever its case."""
    return F.coalesce((F.col(name) if isinstance(name, str) else name).rlike("(?i)" + "|".join(PII_NAME_PATTERNS)), F.lit(False))


def catalog_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Table and column names of DataFrames; reads schemas only."""
    rows = [(table, f.name, f.dataType.simpleString()) for table, df in tables.items() for f in df.schema]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def scan_names(columns: DataFrame) -> DataFrame:
    return columns.withColumn("is_pii", is_pii_name("column_name"))


def scan_values(df: DataFrame, column: str, patterns: dict[str, str] = PII_VALUE_PATTERNS, by: list[str] | None = None) -> DataFrame:
    """Rows whose text contains each kind of personal value; whole texts, one pass."""
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("rows_scanned"), *[F.count_if(F.col(column).rlike(p)).alias(name) for name, p in patterns.items()]
    )


def audit_events(accesses: DataFrame) -> DataFrame:
    """The accesses worth logging: those touching personal columns, and every denial.

    ``accesses``: user_id, user_role, resource, columns (array), operation, query, granted.
    """
    touched = F.array_intersect("columns", F.array(*[F.lit(c) for c in PII_COLUMNS]))
    return (
        accesses.withColumn("pii_columns", touched)
        .filter((F.size("pii_columns") > 0) | ~F.col("granted"))
        .select(
            "user_id",
            "user_role",
            "resource",
            F.when(F.size("pii_columns") > 0, F.col("pii_columns")).otherwise(F.col("columns")).alias("columns"),
            "operation",
            F.when(F.coalesce("query", F.lit("")) != "", F.sha2("query", 256)).otherwise("").alias("query_hash"),
            "granted",
        )
    )


def audit_rollup(audited: DataFrame) -> DataFrame:
    """Granted and denied accesses per role and resource."""
    return audited.groupBy("user_role", "resource").agg(
        F.count_if("granted").alias("granted"), F.count_if(~F.col("granted")).alias("denied")
    )


def field_census(df: DataFrame, column: str) -> DataFrame:
    """Field names and JSON types found in a column of JSON objects, with how many records have them."""
    doc = F.try_parse_json(column)
    pairs = df.select(F.explode(F.try_variant_get(doc, "$", "map<string,variant>")).alias("name", "value"))
    base = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    return pairs.groupBy("name", base.alias("data_type")).agg(F.count(F.lit(1)).alias("records"))


def schema_drift(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Changes between two (``name``, ``data_type``) lists: removed and retyped are breaking, added is informative."""
    before = baseline.select("name", F.col("data_type").alias("old_type"))
    after = current.select("name", F.col("data_type").alias("new_type"))
    change = (
        F.when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type").isNull(), "added")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
    )
    severity = F.when(F.col("change") == "added", "INFO").otherwise("BREAKING")
    return (
        before.join(after, "name", "full")
        .withColumn("change", change)
        .filter("change IS NOT NULL")
        .withColumn("severity", severity)
    )


def dominant_types(census: DataFrame) -> DataFrame:
    """One type per field, the most frequent one, for use as a baseline."""
    return census.groupBy("name").agg(F.max_by("data_type", F.struct("records", "data_type")).alias("data_type"))

