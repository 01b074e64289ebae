"""Slowly changing dimensions (type 2) and column evolution."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapelake.functions.masking import row_hash
from tapelake.functions.timing import as_date, ts_literal
from tapelake.schemas import DIM_SYMBOL, column_names

OPEN_END = date(9999, 12, 31)
TRACKED = ["symbol", "company_name", "sector", "market_cap_category"]


def hashed(reference: DataFrame) -> DataFrame:
    return reference.select(*TRACKED, row_hash(*TRACKED).alias("row_hash"))


def match(incoming: DataFrame, dim: DataFrame) -> DataFrame:
    """Incoming rows beside the current version: new, changed, unchanged, or absent from the delivery."""
    current = dim.filter("is_current").select(
        F.col("symbol").alias("_symbol"), F.col("row_hash").alias("_hash"), F.col("symbol_key").alias("current_key")
    )
    joined = hashed(incoming).join(current, F.col("symbol") == F.col("_symbol"), "full")
    action = (
        F.when(F.col("symbol").isNull(), "absent")
        .when(F.col("_symbol").isNull(), "new")
        .when(F.col("row_hash") == F.col("_hash"), "unchanged")
        .otherwise("changed")
    )
    return joined.withColumns({"action": action, "symbol": F.coalesce("symbol", "_symbol")}).drop("_symbol", "_hash")


def number_rows(df: DataFrame, key: str) -> DataFrame:
    """Number rows 1..n as ``_n``, by hash bucket of a unique key and then by the key, without one task seeing them all.

    Buckets come from the key alone, so a recomputed partition gets the same numbers; hashing spreads unique keys
    evenly, and only the 4096 bucket sizes meet in a single window.
    """
    bucketed = df.withColumn("_bucket", F.substring(F.md5(key), 1, 3))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    )
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        bucketed.withColumn("_rn", local)
        .join(before, "_bucket")
        .withColumn("_n", F.col("_rn") + F.col("_before"))
        .drop("_bucket", "_rn", "_before")
    )


def new_versions(fresh: DataFrame, max_key: DataFrame, today: date, updated_at: Column) -> DataFrame:
    """Current rows for new and changed symbols, keyed after every key ever used."""
    return (
        number_rows(fresh, "symbol")
        .crossJoin(max_key)
        .select(
            (F.coalesce("max_key", F.lit(0)) + F.col("_n")).cast("int").alias("symbol_key"),
            *TRACKED,
            F.lit(today).alias("effective_date"),
            F.lit(OPEN_END).alias("expiry_date"),
            F.lit(True).alias("is_current"),
            "row_hash",
            updated_at.alias("_updated_at"),
        )
    )


def apply_scd2(dim: DataFrame, incoming: DataFrame, today: date | str, updated_at: str | None = None) -> DataFrame:
    """The dimension after a delivery.

    Unchanged and absent symbols keep their rows; a changed symbol's row is closed the day before and a new version
    opens today; a new symbol is added. Applying a delivery twice changes nothing the second time.
    """
    today = as_date(today)
    stamp = ts_literal(updated_at) if updated_at else F.current_timestamp()
    matched = match(incoming, dim)
    changed = matched.filter("action = 'changed'").select("symbol", F.lit(True).alias("_closes"))
    closes = F.col("is_current") & F.coalesce("_closes", F.lit(False))
    kept = dim.join(changed, "symbol", "left").select(
        "symbol_key",
        *TRACKED,
        "effective_date",
        F.when(closes, F.lit(today - timedelta(days=1))).otherwise(F.col("expiry_date")).alias("expiry_date"),
        (F.col("is_current") & ~closes).alias("is_current"),
        "row_hash",
        F.when(closes, stamp).otherwise(F.col("_updated_at")).alias("_updated_at"),
    )
    fresh = matched.filter("action IN ('changed', 'new')").select(*TRACKED, "row_hash")
    # One row: a global maximum.
    max_key = dim.agg(F.max("symbol_key").alias("max_key"))
    return kept.unionByName(new_versions(fresh, max_key, today, stamp))


def scd2_counts(dim: DataFrame, incoming: DataFrame) -> DataFrame:
    """How many rows a delivery would expire and insert."""
    return match(incoming, dim).agg(
        F.count_if(F.col("action") == "changed").alias("expired"),
        F.count_if(F.col("action").isin("changed", "new")).alias("inserted"),
    )


def seed(spark: SparkSession, reference: DataFrame, today: date | str, updated_at: str | None = None) -> DataFrame:
    """First load, through the same path as every later one, so seeding twice cannot duplicate rows."""
    return apply_scd2(spark.createDataFrame([], DIM_SYMBOL), reference, today, updated_at).select(*column_names(DIM_SYMBOL))


def as_of(facts: DataFrame, dim: DataFrame, day: str, attributes: list[str]) -> DataFrame:
    """Facts with the dimension version valid on their day."""
    versions = dim.select("symbol", "effective_date", "expiry_date", *attributes)
    valid = F.col(day).between(F.col("effective_date"), F.col("expiry_date"))
    return facts.join(versions, "symbol").filter(valid).drop("effective_date", "expiry_date")


#: Facts of a key and a stretch of time that are looked at together.
TOGETHER = 100_000


def as_of_parts(facts: DataFrame, dim: DataFrame, day: str, attributes: list[str], chunk: str, together: int) -> DataFrame:
    """Facts and versions as one table in which every part, ``(symbol, _chunk, _part)``, can be merged by itself.

    Time is cut into ``chunk``s of the calendar. Each chunk with facts is given the version that was valid last before it,
    and a chunk with many facts of a symbol is dealt into parts that all get its versions.
    """
    version = F.struct("effective_date", "expiry_date", *attributes)
    cut = lambda column: F.date_trunc(chunk, column)
    versions = dim.filter("symbol is not null and effective_date is not null").select(
        "symbol", cut("effective_date").alias("_chunk"), F.col("effective_date").cast("timestamp").alias("_at"), version.alias("_version")
    )
    facts = facts.filter(F.col("symbol").isNotNull() & F.col(day).isNotNull())
    facts = facts.withColumns({"_chunk": cut(day), "_at": F.col(day).cast("timestamp")})
    held = facts.groupBy("symbol", "_chunk").agg(F.count(F.lit(1)).alias("n"))
    last = versions.groupBy("symbol", "_chunk").agg(F.max_by("_version", "_at").alias("last"))
    before = Window.partitionBy("symbol").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = held.join(last, ["symbol", "_chunk"], "full").withColumn("carried", F.last("last", True).over(before))
    parts = F.coalesce(F.ceil(F.col("n") / F.lit(together)), F.lit(0))
    chunks = chunks.select("symbol", "_chunk", parts.alias("parts"), "carried").filter("parts > 0")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("_part")
    carried = chunks.filter("carried is not null").select("symbol", "_chunk", every, F.col("_chunk").alias("_at"), F.col("carried").alias("_version"), F.lit(0).alias("_kind"))
    within = versions.join(chunks.select("symbol", "_chunk", "parts"), ["symbol", "_chunk"]).select("symbol", "_chunk", every, "_at", "_version", F.lit(1).alias("_kind"))
    crowded = chunks.filter("parts > 1").select("symbol", "_chunk", "parts")
    own = [F.col(c) for c in facts.columns if not c.startswith("_")]
    part = F.pmod(F.xxhash64(*own), F.coalesce("parts", F.lit(1)).cast("bigint"))
    rows = facts.join(crowded, ["symbol", "_chunk"], "left").withColumn("_part", part).drop("parts")
    rows = rows.withColumn("_kind", F.lit(2))
    return rows.unionByName(carried.unionByName(within), allowMissingColumns=True)


def as_of_merge(
    facts: DataFrame, dim: DataFrame, day: str, attributes: list[str], chunk: str = "month", together: int = TOGETHER
) -> DataFrame:
    """``as_of`` for dimensions with many versions of a key, which must not overlap.

    A join by key and range compares each fact with every version of its key. Here facts and versions are merged in
    the order of time, and each fact takes the version before it, if that has not expired. Symbols without a version on the
    day drop out, as do facts without a symbol or day.
    """
    rows = as_of_parts(facts, dim, day, attributes, chunk, together)
    up_to = Window.partitionBy("symbol", "_chunk", "_part").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_valid", F.last("_version", True).over(up_to))
    found = found.filter((F.col("_kind") == 2) & (F.col(day) <= F.col("_valid.expiry_date")))
    return found.select(*facts.columns, *[F.col(f"_valid.{a}").alias(a) for a in attributes])


@dataclass(frozen=True)
class ColumnChange:
    """A rename, or with ``new_type`` a replacement whose old values are not carried over."""

    old: str
    new: str
    new_type: str | None = None


def evolution_plan(columns: list[str], changes: list[ColumnChange]) -> list[tuple[ColumnChange, str]]:
    """What each change would do to a table with these columns; steps already taken are skipped."""
    plan, present = [], list(columns)
    for change in changes:
        if change.new in present:
            plan.append((change, "skip: already exists"))
        elif change.old not in present:
            plan.append((change, "skip: not found"))
        else:
            plan.append((change, "drop and add" if change.new_type else "rename"))
            present[present.index(change.old)] = change.new
    return plan


def evolve(df: DataFrame, changes: list[ColumnChange], dry_run: bool = False) -> DataFrame:
    """Apply column changes; running them again changes nothing."""
    for change, step in evolution_plan(df.columns, changes):
        if dry_run or step.startswith("skip"):
            continue
        if change.new_type is None:
            df = df.withColumnRenamed(change.old, change.new)
        else:
            df = df.drop(change.old).withColumn(change.new, F.lit(None).cast(change.new_type))
    return df
