"""Mixing sources to target weights: every document is repeated a Poisson number of times, then all copies are shuffled.

The number of copies is the inverse of the Poisson distribution at a hash of the document, with the source's repetition
rate as mean. So it needs no state, and a rerun or a retried task gives the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import fresh, settle, whole_text

#: Rates above this are drawn as a sum of several draws of an equal share, which keeps distribution tables short.
LARGEST_MEAN = 64.0


def digest(*parts) -> Column:
    return F.sha2(F.concat_ws(":", *parts).cast("binary"), 256)


def uniform(*parts) -> Column:
    """A number in [0, 1) from a hash: 52 bits."""
    return F.conv(F.substring(digest(*parts), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: dict[str | None, float] | None, alpha: float, growth: float) -> DataFrame:
    """``(source, rate)``: how often to repeat each source so that its characters take its share of the target."""
    sizes = settle(docs.groupBy("source").agg(F.sum(F.length(whole_text())).cast("double").alias("chars")), "source-sizes")
    if weights is None:
        weight = F.pow("chars", F.lit(alpha))
    else:
        weight = F.lit(0.0)
        for source, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(value))).otherwise(weight)
    sizes = sizes.withColumn("weight", F.when(F.col("chars") > 0, weight).otherwise(0.0))
    total, norm = sizes.agg(F.sum("chars"), F.sum("weight")).first()
    rate = F.lit(growth * (total or 0.0)) * F.col("weight") / F.lit(norm or 1.0) / F.col("chars")
    return sizes.select("source", F.when(F.col("chars") > 0, rate).otherwise(1.0).alias("rate"))


def distribution(mean: Column) -> Column:
    """The Poisson distribution function at 0, 1, ... as far as doubles tell it from 1; by logarithms, so that no term
    underflows the rest."""
    terms = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    start = F.struct((-mean).alias("log"), F.array(F.exp(-mean)).alias("cdf"))

    def add(state: Column, j: Column) -> Column:
        log = state["log"] + F.log(mean / j)
        return F.struct(log.alias("log"), F.array_append(state["cdf"], F.element_at(state["cdf"], -1) + F.exp(log)).alias("cdf"))

    return F.when(mean > 0, F.aggregate(F.sequence(F.lit(1), terms), start, add, lambda s: s["cdf"])).otherwise(F.array(F.lit(1.0)))


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    alpha: float = 0.5,
    growth: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """The rows of ``docs(doc_id, text, source, ...)``, each as often as drawn, with ``copy`` and ``shuffle_key``, shuffled.

    ``weights`` gives the share of characters of each source; a source left out gets none. Without weights they are the
    sources' characters to the power ``alpha``: 1 keeps the mix, 0 makes sources equal. The mixture has ``growth`` times the
    characters of docs, in expectation. A null source is a source; one without any characters keeps a rate of 1. Rows with
    the same doc_id get the same number of copies; one without doc_id is drawn by its text. Rows are dealt out by
    shuffle_key, a hash of document and copy, and sorted by it within each partition; sort by it for one total order.
    Columns named ``copy`` or ``shuffle_key`` are replaced; all others may have any name. An empty table stays empty.
    """
    of_, name_, times, draws, cdf = (fresh(x, docs.columns) for x in ("_of", "_name", "_copies", "_draws", "_cdf"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST_MEAN).cast("int"))
    table = rates(docs, weights, alpha, growth).withColumn("draws", parts)
    table = table.withColumn("cdf", distribution(F.col("rate") / F.col("draws")))
    table = table.select(F.struct(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("none")).alias(of_), F.col("draws").alias(draws), F.col("cdf").alias(cdf))
    columns = ["`" + c.replace("`", "``") + "`" for c in docs.columns if c.lower() not in ("copy", "shuffle_key")]
    name = F.coalesce(F.col("doc_id").cast("string"), F.sha2(whole_text().cast("binary"), 256))
    of = F.struct(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("none"))
    drawn = docs.select(*columns, of.alias(of_), name.alias(name_)).join(table, of_)
    copies = F.aggregate(
        F.sequence(F.lit(1), F.col(draws)),
        F.lit(0),
        lambda n, i: n + F.size(F.filter(cdf, lambda c: c <= uniform(F.lit(seed), name_, i.cast("string")))),
    )
    drawn = drawn.select(*columns, name_, copies.alias(times)).filter(F.col(times) > 0)
    drawn = drawn.select(*columns, name_, F.explode(F.sequence(F.lit(1), times)).alias("copy"))
    key = F.substring(digest(F.lit(seed), F.lit("order"), name_, F.col("copy").cast("string")), 1, 16)
    dealt = drawn.select(*columns, "copy", key.alias("shuffle_key")).repartition("shuffle_key")
    return dealt.sortWithinPartitions("shuffle_key")


SQL = """
WITH sizes AS (
  SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS chars FROM documents GROUP BY source),
weighted AS (SELECT *, CASE WHEN chars > 0 THEN pow(chars, 0.5) ELSE 0 END AS weight FROM sizes),
rates AS (
  SELECT source, CASE WHEN chars > 0 THEN (SELECT sum(chars) FROM weighted) * weight / (SELECT sum(weight) FROM weighted) / chars
    ELSE 1 END AS rate FROM weighted),
parts AS (SELECT source, rate / greatest(1, ceil(rate / 64)) AS mean, greatest(1, ceil(rate / 64))::INT AS draws FROM rates),
terms AS (SELECT source, draws, mean, unnest(range(0, ceil(mean + 12 * sqrt(mean) + 20)::INT + 1)) AS j FROM parts),
logs AS (
  SELECT source, draws, j, exp(-mean + sum(CASE WHEN j = 0 THEN 0 ELSE ln(mean / j) END)
    OVER (PARTITION BY source ORDER BY j)) AS p FROM terms),
cdfs AS (SELECT source, draws, list(c ORDER BY j) AS cdf FROM (
  SELECT *, sum(p) OVER (PARTITION BY source ORDER BY j) AS c FROM logs) GROUP BY source, draws),
drawn AS (
  SELECT d.*, list_sum(list_transform(range(1, draws + 1), lambda i: len(list_filter(cdf, lambda x: x <=
    ('0x' || substr(sha256('42:' || d.doc_id || ':' || i), 1, 13))::UBIGINT::DOUBLE / 4503599627370496))))::INT AS n
  FROM documents d JOIN cdfs c ON d.source IS NOT DISTINCT FROM c.source),
copies AS (SELECT * EXCLUDE (n), unnest(range(1, n + 1))::INT AS copy FROM drawn WHERE n > 0)
SELECT *, substr(sha256('42:order:' || doc_id || ':' || copy), 1, 16) AS shuffle_key FROM copies
"""
