"""Data quality: suites of expectations evaluated in one pass, scores and grades, and checks between layers."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp
from tapelake.schemas import BRONZE_TRADES, GOLD_DAILY, SILVER_TRADES, column_names

# Fixed values of the scoring model.
WEIGHTS = {"completeness": 0.30, "accuracy": 0.30, "freshness": 0.20, "uniqueness": 0.20}
GRADES = [("A", 0.95), ("B", 0.85), ("C", 0.70), ("D", 0.50)]


@dataclass(frozen=True)
class Expectation:
    """One check. ``violated`` marks rows that break it; checks without it look at the table as a whole."""

    kind: str
    column: str | None = None
    violated: Column | None = None
    keys: tuple[str, ...] = ()
    minimum: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}" if self.column else self.kind


def exists(column: str) -> Expectation:
    return Expectation("column_exists", column)


def row_count(minimum: int = 1) -> Expectation:
    return Expectation("row_count", minimum=minimum)


def not_null(column: str) -> Expectation:
    return Expectation("not_null", column, F.col(column).isNull())


def between(column: str, low=None, high=None, strict: bool = False) -> Expectation:
    """NULLs pass: completeness is another check's business."""
    value = F.col(column)
    outside = F.lit(False)
    if low is not None:
        outside = outside | ((value <= low) if strict else (value < low))
    if high is not None:
        outside = outside | ((value >= high) if strict else (value > high))
    return Expectation("between", column, outside)


def in_set(column: str, values: list) -> Expectation:
    return Expectation("in_set", column, ~F.col(column).isin(*values))


def known(column: str, reference_column: str) -> Expectation:
    """Membership in a reference too large for a literal list: ``run_suite`` joins it as ``reference_column``."""
    return Expectation("in_set", column, F.col(column).isNotNull() & F.col(reference_column).isNull())


def unique(*keys: str) -> Expectation:
    return Expectation("unique", ",".join(keys), keys=keys)


def ohlcv_consistent() -> Expectation:
    """High and low bound open and close, and the VWAP lies between them."""
    high, low, vwap = F.col("high_price"), F.col("low_price"), F.col("vwap")
    sound = (
        (high >= F.col("open_price"))
        & (high >= F.col("close_price"))
        & (low <= F.col("open_price"))
        & (low <= F.col("close_price"))
        & (vwap >= low)
        & (vwap <= high)
    )
    return Expectation("ohlcv_consistent", None, ~sound)


def bronze_trades_suite() -> list[Expectation]:
    return [
        *[exists(c) for c in column_names(BRONZE_TRADES)],
        row_count(1),
        *[not_null(c) for c in ("trade_id", "symbol", "price", "quantity", "timestamp")],
        between("price", low=0, strict=True),
        between("quantity", low=1),
        in_set("is_aggressive_buy", [True, False]),
    ]


def silver_trades_suite(symbols: list[str] | None = None) -> list[Expectation]:
    """``symbols`` lists the known ones; without it the caller joins a reference and adds ``known``."""
    return [
        *[exists(c) for c in column_names(SILVER_TRADES)],
        *[not_null(c) for c in ("trade_id", "symbol", "price", "quantity", "timestamp")],
        unique("trade_id"),
        between("price", 0.01, 100_000),
        between("quantity", 1, 1_000_000),
        *([in_set("symbol", symbols)] if symbols else []),
    ]


def gold_daily_suite() -> list[Expectation]:
    required = column_names(GOLD_DAILY)[:9]
    return [
        *[exists(c) for c in column_names(GOLD_DAILY)],
        *[not_null(c) for c in required],
        between("trade_count", low=1),
        between("total_volume", low=1),
        ohlcv_consistent(),
    ]


def duplicates(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row: ``every_copy`` counts all rows of repeated keys, ``beyond_first`` the copies after the first."""
    repeated = df.dropna(subset=list(keys)).groupBy(*keys).count().filter("count > 1")
    return repeated.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("every_copy"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("beyond_first"),
    )


def _totals(df: DataFrame, suite: list[Expectation], extra: dict[str, Column] | None = None) -> DataFrame:
    """One row of counters: the rows, the offenders of check i as ``bad_i``, and anything ``extra``.

    All row checks are counters of a single aggregate over a single scan. A uniqueness check needs its own grouping,
    whose one-row result joins them, as ``bad_i`` and ``beyond_first_i``.
    """
    counters = [F.count(F.lit(1)).alias("rows")]
    counters += [F.count_if(e.violated).alias(f"bad_{i}") for i, e in enumerate(suite) if e.violated is not None]
    counters += [column.alias(name) for name, column in (extra or {}).items()]
    totals = df.agg(*counters)
    for i, e in enumerate(suite):
        if e.kind == "unique":
            copies = duplicates(df, e.keys)
            totals = totals.crossJoin(copies.toDF(f"bad_{i}", f"beyond_first_{i}"))
    return totals


def _passes(df: DataFrame, i: int, e: Expectation) -> Column:
    if e.kind == "column_exists":
        return F.lit(e.column in df.columns)
    return F.col("rows") >= e.minimum if e.kind == "row_count" else F.col(f"bad_{i}") == 0


def _applicable(df: DataFrame, suite: list[Expectation]) -> list[Expectation]:
    """Checks of absent columns are left to ``column_exists``."""
    return [e for e in suite if e.kind == "column_exists" or e.column is None or e.keys or e.column in df.columns]


def run_suite(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """One row per expectation: success, unexpected count and percentage."""
    suite = _applicable(df, suite)
    results = []
    for i, e in enumerate(suite):
        counted = e.violated is not None or e.kind == "unique"
        bad = F.col(f"bad_{i}").cast("bigint") if counted else F.lit(0).cast("bigint")
        results.append(
            F.struct(F.lit(e.name).alias("expectation"), _passes(df, i, e).alias("success"), bad.alias("unexpected_count"))
        )
    share = F.coalesce(
        F.col("r.unexpected_count").cast("double") / F.nullif(F.col("rows"), F.lit(0)).cast("double") * F.lit(100.0), F.lit(0.0)
    )
    return _totals(df, suite).select("rows", F.explode(F.array(*results)).alias("r")).select(
        "r.expectation", "r.success", "r.unexpected_count", share.alias("unexpected_percent")
    )


def suite_summary(results: DataFrame) -> DataFrame:
    """Statistics of a suite run; success means that every expectation passed."""
    passed = F.count_if("success")
    return results.agg(
        F.count(F.lit(1)).alias("evaluated"),
        passed.alias("successful"),
        F.count_if(~F.col("success")).alias("unsuccessful"),
        (passed.cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)).cast("double") * F.lit(100.0)).alias("success_percent"),
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
    )


def _clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def _share_good(bad: Column, rows: Column) -> Column:
    share = F.lit(1.0) - bad.cast("double") / F.nullif(rows, F.lit(0)).cast("double")
    return F.when(rows == 0, 1.0).otherwise(_clamp(share))


def grade(score: Column) -> Column:
    out = None
    for letter, least in GRADES:
        out = F.when(score >= least, letter) if out is None else out.when(score >= least, letter)
    return out.otherwise("F")


def quality_score(counts: DataFrame) -> DataFrame:
    """Score and grade from ``rows``, ``null_count``, ``invalid_count``, ``duplicate_count``, ``within_sla``."""
    rows = F.col("rows")
    parts = {
        "completeness": _share_good(F.col("null_count"), rows),
        "accuracy": _share_good(F.col("invalid_count"), rows),
        "freshness": F.when(F.col("within_sla"), 1.0).otherwise(0.0),
        "uniqueness": _share_good(F.col("duplicate_count"), rows),
    }
    overall = reduce(lambda a, b: a + b, [F.col(name) * F.lit(weight) for name, weight in WEIGHTS.items()])
    return counts.withColumns(parts).withColumn("overall", overall).withColumn("grade", grade(F.col("overall")))


def layer_counts(df: DataFrame, key: str, suite: list[Expectation]) -> DataFrame:
    """The inputs of a layer's score: rows, rows holding any NULL, copies beyond the first, and whether its suite passed.

    Two reads of the layer at most: one for all counters, one to group by the key.
    """
    suite = _applicable(df, suite)
    keyed = [i for i, e in enumerate(suite) if e.keys == (key,)]
    checked = suite if keyed else [*suite, unique(key)]
    at = keyed[0] if keyed else len(suite)
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in df.columns])
    totals = _totals(df, checked, {"null_count": F.count_if(any_null)})
    passed = reduce(lambda a, b: a & b, [_passes(df, i, e) for i, e in enumerate(suite)], F.lit(True))
    return totals.select(
        "rows",
        "null_count",
        F.lit(0).cast("bigint").alias("invalid_count"),
        F.col(f"beyond_first_{at}").alias("duplicate_count"),
        passed.alias("within_sla"),
    )


def layer_scores(layers: dict[str, tuple[DataFrame, str, list[Expectation]]]) -> DataFrame:
    """Score of every layer; empty layers are skipped."""
    out = None
    for name, (df, key, suite) in layers.items():
        row = layer_counts(df, key, suite).withColumn("layer", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return quality_score(out.filter("rows > 0"))


def repeated_offsets(bronze: DataFrame) -> DataFrame:
    """Source positions read more than once."""
    return (
        bronze.groupBy("_kafka_partition", "_kafka_offset").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    )


def layer_drift(bronze: DataFrame, silver: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """How many bronze and silver rows of one trade disagree on price, quantity, time, or the order of processing."""
    pairs = silver.select(
        "trade_id", "price", "quantity", "timestamp", F.col("_processed_at").alias("processed")
    ).join(
        bronze.select(
            "trade_id",
            F.col("price").alias("b_price"),
            F.col("quantity").alias("b_quantity"),
            F.col("timestamp").alias("b_timestamp"),
            F.col("_ingested_at").alias("ingested"),
        ),
        "trade_id",
    )
    return pairs.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.count_if(F.abs(F.col("price") - F.col("b_price")) > tolerance).alias("price_drift"),
        F.count_if(F.col("quantity") != F.col("b_quantity")).alias("quantity_drift"),
        F.count_if(F.col("timestamp") != F.col("b_timestamp")).alias("time_drift"),
        F.count_if(F.col("processed") < F.col("ingested")).alias("processed_before_ingested"),
    )


def cross_layer(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """One row per rule between the layers: nothing lost, no layer larger than its source, equal volumes and values."""
    lost = bronze.select("trade_id").join(silver.select("trade_id"), "trade_id", "left_anti")
    measures = (
        bronze.agg(F.count(F.lit(1)).alias("bronze_rows"))
        .crossJoin(lost.agg(F.count_distinct("trade_id").alias("lost")))
        .crossJoin(
            silver.agg(
                F.count(F.lit(1)).alias("silver_rows"),
                fp.quantity_sum().alias("silver_volume"),
                fp.notional_sum().alias("silver_value"),
            )
        )
        .crossJoin(
            gold.agg(
                F.count(F.lit(1)).alias("gold_rows"),
                F.sum("total_volume").alias("gold_volume"),
                fp.money_sum(fp.ticks("total_value")).alias("gold_value"),
            )
        )
    )

    def rule(name: str, measured: Column, expected: Column, ok: Column) -> Column:
        return F.struct(
            F.lit(name).alias("rule"),
            measured.cast("double").alias("measured"),
            expected.cast("double").alias("expected"),
            ok.alias("success"),
        )

    c = F.col
    rules = F.array(
        rule("bronze_to_silver_loss", c("lost"), F.lit(0), c("lost") == 0),
        rule("silver_within_bronze", c("silver_rows"), c("bronze_rows"), c("silver_rows") <= c("bronze_rows")),
        rule("gold_within_silver", c("gold_rows"), c("silver_rows"), c("gold_rows") <= c("silver_rows")),
        rule("volume_equal", c("gold_volume"), c("silver_volume"), c("gold_volume") == c("silver_volume")),
        rule("value_equal", c("gold_value"), c("silver_value"), F.abs(c("gold_value") - c("silver_value")) <= 0.01),
    )
    return measures.select(F.explode(rules).alias("r")).select("r.*")
