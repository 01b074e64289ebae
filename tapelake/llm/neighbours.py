"""Approximate nearest neighbours by inner product: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample; every row is then put into a leaf. A query walks the tree through a priority queue
of nodes, best first, and so visits leaves in order of promise. How many leaves are visited is calibrated: for a sample of
queries the true neighbours among all rows are found, and visits widen until their measured recall reaches the target.
Leaves are scored in blocks of bounded size, large ones and much-visited ones split.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapelake.llm.common import settle

FOUND = "query_id long, vec_id long, score double"


@dataclass
class Tree:
    """Nodes in arrays; ``children[v]`` are node numbers, ``leaf[v]`` is a leaf's number or -1."""

    centre: np.ndarray
    spread: np.ndarray
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def visit(self, query: np.ndarray, most: int, held: np.ndarray | None = None, rows: int = 0) -> list[int]:
        """``most`` leaves in best-bin-first order, more while those visited hold under ``rows`` by the counts ``held``. A
        node's promise is the inner product with its centre and the reach of its spread along the query."""
        promise = self.centre @ query + self.spread * np.sqrt(query @ query)
        queue, out = [(0.0, 0)], []
        got = 0
        while queue and (len(out) < most or got < rows):
            _, node = heapq.heappop(queue)
            while self.leaf[node] < 0:
                ranked = sorted((-promise[c], c) for c in self.children[node])
                for other in ranked[1:]:
                    heapq.heappush(queue, other)
                node = ranked[0][1]
            out.append(self.leaf[node])
            got += held[self.leaf[node]] if held is not None else 0
        return out

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest centre at each level."""
        out = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, of = todo.pop()
            if self.leaf[node] >= 0:
                out[of] = self.leaf[node]
                continue
            kids = np.array(self.children[node])
            near = nearest(rows[of], self.centre[kids])
            todo += [(int(kid), of[near == k]) for k, kid in enumerate(kids) if (near == k).any()]
        return out


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1)[None, :] - 2 * rows @ centres.T, axis=1)


def cluster(rows: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """K-means; the cluster of each row."""
    centres = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        near = nearest(rows, centres)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return nearest(rows, centres)


def grow(rows: np.ndarray, leaf_rows: int, branching: int = 16, rounds: int = 8, seed: int = 42) -> Tree:
    """Split into ``branching`` clusters, each again, down to leaves of about ``leaf_rows`` rows of the sample."""
    rng = np.random.default_rng(seed)
    centre, spread, children, leaf = [], [], [], []
    leaves = 0
    todo = [(np.arange(len(rows)), -1)]
    while todo:
        of, parent = todo.pop()
        node, part = len(leaf), rows[of]
        middle = part.mean(axis=0)
        centre.append(middle)
        spread.append(np.sqrt(((part - middle) ** 2).sum(axis=1).mean() / max(1, rows.shape[1])))
        children.append([])
        leaf.append(-1)
        if parent >= 0:
            children[parent].append(node)
        kinds = cluster(part, k, rounds, rng) if (k := min(branching, len(of) // max(1, leaf_rows))) > 1 else np.zeros(len(of))
        groups = [of[kinds == c] for c in np.unique(kinds)]
        if len(groups) < 2:
            leaf[node], leaves = leaves, leaves + 1
        else:
            todo += [(g, node) for g in groups]
    return Tree(np.array(centre), np.array(spread), children, leaf)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> pa.Table:
    """Each query's k best rows, its own left out. Products are added one dimension after the other, so that equal vectors
    get equal scores, in any block."""
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    out = []
    for at in range(0, len(queries), 128):
        part, own = queries[at : at + 128], query_ids[at : at + 128]
        score = np.zeros((len(part), len(rows)))
        for d in range(rows.shape[1]):
            score += part[:, d, None] * rows[None, :, d]
        score[own[:, None] == ids[None, :]] = -np.inf
        top = np.argsort(-score, axis=1, kind="stable")[:, :k]
        value = np.take_along_axis(score, top, 1)
        q, c = np.nonzero(value > -np.inf)
        out.append(pa.table({"query_id": own[q], "vec_id": ids[top[q, c]], "score": value[q, c]}))
    return pa.concat_tables(out) if out else pa.table({"query_id": query_ids[:0], "vec_id": ids[:0], "score": np.zeros(0)})


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding)``: rows that take part, of the commonest length. See ``search``."""
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(F.col("vec_id").isNotNull() & ok & some)
    length = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).first()
    rows = rows.filter(F.size("embedding") == (length.n if length else 0))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def truth(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k nearest of a few given queries among all rows, by comparing with every row."""
    asked = queries.toArrow()
    wanted, own = matrix(asked["embedding"]), asked["vec_id"].to_numpy()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                ids = batch["vec_id"].to_numpy(zero_copy_only=False)
                yield from best(wanted, own, matrix(batch["embedding"]), ids, k).to_batches()

    return nearest_only(rows.mapInArrow(scan, FOUND), k)


def nearest_only(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def calibrate(tree: Tree, rows: DataFrame, queries: DataFrame, k: int, recall: float, sample: int) -> int:
    """The fewest leaves to visit so that the mean recall over a sample of queries reaches the target."""
    some = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    asked = some.toArrow()
    known = truth(rows.select("vec_id", "embedding"), some, k).join(rows.select("vec_id", "leaf"), "vec_id")
    homes: dict[int, list[int]] = {}
    for r in known.select("query_id", "leaf").collect():
        homes.setdefault(r.query_id, []).append(r.leaf)
    reached = np.zeros(tree.leaves)
    for query_id, query in zip(asked["vec_id"].to_pylist(), matrix(asked["embedding"])):
        place = {leaf: n for n, leaf in enumerate(tree.visit(query, tree.leaves))}
        for leaf in homes.get(query_id, ()):
            reached[place[leaf]] += 1 / len(homes[query_id])
    share = np.cumsum(reached) / max(1, len(homes))
    return int(np.argmax(share >= min(recall, share[-1]) - 1e-12)) + 1


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    recall: float = 0.97,
    sample: int = 20_000,
    leaves: int = 64,
    sample_queries: int = 128,
    block_rows: int = 4096,
    block_queries: int = 2048,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest rows of ``vectors(vec_id, embedding)`` to each row of ``is_query``.

    Nearest is the largest inner product in double precision, ties to the smaller vec_id; a query's own row is left out.
    Null, empty and zero vectors, those with null or non-finite components, rows without vec_id and vectors of another
    length than the commonest (the shorter if tied) take no part. Rows that share a vec_id count once, with the least
    vector. Queries with fewer rows to choose from return all of them; without vectors the result is empty.

    ``sample`` rows, the first by hash, fit the tree of about ``leaves`` leaves, each of at least 16 of the sample. That number
    does not grow with the table, so neither do the answers a query collects, k for each leaf it visits; larger leaves are
    scored in more blocks. ``sample_queries`` queries calibrate the visits to ``recall``.
    """
    valid = settle(usable(vectors), "vectors")
    n = valid.count()
    if n == 0:
        return valid.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fitted = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    tree = grow(matrix(fitted["embedding"]), max(16, len(fitted) // leaves))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.assign(matrix(batch["embedding"])) if len(batch) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    kind = valid.schema["embedding"].dataType.simpleString()
    rows = settle(valid.mapInArrow(place, f"vec_id long, embedding {kind}, leaf long"), "leaves")
    queries = rows.filter(is_query).select("vec_id", "embedding")
    visits = calibrate(tree, rows, queries, k, recall, sample_queries)

    held = np.zeros(tree.leaves, np.int64)
    # Leaves are bounded by the sample, so these counts are few.
    for r in rows.groupBy("leaf").count().collect():
        held[r.leaf] = r["count"]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in (batch.slice(at, 256) for at in range(0, len(batch), 256)):
                leaves = [tree.visit(q, visits, held, k + 1) for q in matrix(some["embedding"])]
                row = np.repeat(np.arange(len(some)), [len(x) for x in leaves])
                part = some.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.concatenate(leaves))], [*part.schema.names, "leaf"])

    routed = settle(queries.mapInArrow(route, f"vec_id long, embedding {kind}, leaf long"), "visits")
    parts = {leaf: -(-int(n) // block_rows) for leaf, n in enumerate(held) if n}
    turns = {r.leaf: -(-r["count"] // block_queries) for r in routed.groupBy("leaf").count().collect()}
    own, other = F.pmod(F.xxhash64("vec_id"), "own_n"), F.explode(F.sequence(F.lit(0), F.col("other_n") - 1))
    cells = [
        df.withColumn("own_n", counted(mine)).withColumn("other_n", counted(theirs)).withColumn("own", own)
        .withColumn("other", other).select("vec_id", "embedding", "leaf", *names)
        for df, mine, theirs, names in (
            (routed, turns, parts, (F.col("own").cast("long").alias("turn"), F.col("other").cast("long").alias("part"))),
            (rows.filter(F.col("leaf").isin(list(turns))), parts, turns, (F.col("other").cast("long").alias("turn"), F.col("own").cast("long").alias("part"))),
        )
    ]

    def score(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not len(asked) or not len(held):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return best(matrix(asked["embedding"]), asked["vec_id"].to_numpy(), matrix(held["embedding"]), held["vec_id"].to_numpy(), k)

    key = ["leaf", "turn", "part"]
    found = cells[0].groupBy(*key).cogroup(cells[1].groupBy(*key)).applyInArrow(score, FOUND)
    return nearest_only(found, k)


def counted(by_leaf: dict[int, int]) -> Column:
    """How many blocks a leaf has."""
    more = [F.lit(x) for leaf, n in by_leaf.items() if n > 1 for x in (leaf, n)]
    return F.coalesce(F.create_map(*more)[F.col("leaf")], F.lit(1)) if more else F.lit(1)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
