"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours the least node it knows of."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").filter("a > m").select("m", F.col("a").alias("b"))
    return moved.union(least.select("m", "b")).select(F.col("m").alias("a"), "b").distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the least node that can be reached.

    Each round groups and joins rows of two numbers and is written to the shared folder. A round that changes nothing
    ends the loop: every node then points straight at its root. The number of rounds grows with the logarithm of the
    longest path; ``max_rounds`` only guards against a fault and raises. Loops and repeated edges do no harm; null
    ends are dropped; without edges the result is empty.
    """
    nodes = [f.dataType for f in edges.schema.fields]
    now = settle(
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == seen or mark[0] == 0:
            star = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
            roots = now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            return star.union(roots).select(F.col("node").cast(nodes[0]), F.col("root").cast(nodes[0]))
        seen = mark
        now = settle(_small_star(_large_star(now)), "edges")
    raise RuntimeError("components did not settle")
