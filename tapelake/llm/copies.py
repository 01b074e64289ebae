"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Equal sets are one node. MinHash keys, four values each, put nodes into buckets; two of similarity 0.8 share none of the 24
keys with a probability of (1 - 0.8^4)^24, 3 in a million, and more similar ones less. What shares a bucket is compared by
the shingles themselves, in two rounds: first each with the bucket's most popular node, which in a group of edited copies is
the one the others are edits of; then those outside the bucket's largest component with all of other components, block by
block inside tasks, which give back only the links that join components. A bucket of one component costs no pairs, and no
pair that could join two is passed over. Pairs are never rows: a bucket of m nodes, k of them outside, sends each node to
about m / BLOCK or k / BLOCK tasks, which compare k times m sets. Groups that another method found are links as well.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType
from xxhash import xxh64_intdigest

from tapelake.llm.common import columns_of, settle, whole_text
from tapelake.llm.components import components
from tapelake.llm.simhash import first_of_each, near_duplicates

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
CHUNK = 1 << 12
#: Pairs of one node that are compared in one group.
GROUP = 64
#: Nodes of a bucket that are compared at once, on either side, and shared shingles that are counted at once.
BLOCK = 256
COLUMNS = 1 << 13
MIX = np.random.default_rng(42).integers(0, 1 << 64, (2, BANDS * ROWS, 1), np.uint64) | np.uint64(1)
MARK = StructType().add("node", LongType()).add("keys", ArrayType(LongType()))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Hashes of the different word shingles in rising order; of shorter texts of all their words; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        words, width = [b" ".join(words)], 1
    joined = map(b" ".join, zip(*(islice(words, k, None) for k in range(width))))
    return np.unique(np.fromiter(map(xxh64_intdigest, joined), np.uint64))


def node_of(found: np.ndarray) -> int:
    """One number for a set."""
    return xxh64_intdigest(found.tobytes())


def bucket_keys(found: np.ndarray) -> np.ndarray:
    """MinHash values, a key for each few; none for an empty set."""
    if not len(found):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(found), CHUNK):
        np.minimum(least, ((found[None, at : at + CHUNK] ^ MIX[0]) * MIX[1]).min(axis=1), out=least)
    bands = least.reshape(BANDS, ROWS)
    return np.array([xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(bands)], np.uint64).view(np.int64)


@F.pandas_udf(MARK)
def marks_column(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        found = [shingles(t) for t in texts]
        nodes = np.array([node_of(s) for s in found], np.uint64).view(np.int64)
        yield pd.DataFrame({"node": nodes, "keys": [bucket_keys(s) for s in found]})


@F.pandas_udf(ArrayType(LongType()))
def shingles_column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([shingles(t).view(np.int64) for t in texts], dtype=object)


def alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs(a, b, n)`` whose sets are so similar; a node ``a`` of many pairs is sent to several groups of them."""
    pairs = pairs.groupBy("a", "b").agg(F.max("n").alias("n"))
    pairs = settle(pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / GROUP)).alias("group")), "copy-pairs")
    left = pairs.select("a", "group").distinct().join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b").join(left, ["a", "group"])
    x, y = F.size("x"), F.size("y")
    both = both.filter(F.least(x, y) >= similarity * F.greatest(x, y) - 1e-9)
    shared = both.select("a", "b", (x + y).alias("all"), F.size(F.array_intersect("x", "y")).alias("shared"))
    return shared.filter(F.col("shared") >= similarity * (F.col("all") - F.col("shared")) - 1e-9).select("a", "b")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many numbers each set of ``left`` has in common with each of ``right``."""
    both = [np.concatenate(side) if side else np.zeros(0, np.int64) for side in (left, right)]
    known = np.intersect1d(*both)
    rows, places = [], []
    for side, values in zip((left, right), both):
        of = np.repeat(np.arange(len(side)), [len(x) for x in side])
        at = np.searchsorted(known, values)
        there = at < len(known)
        there[there] = known[at[there]] == values[there]
        rows.append(of[there])
        places.append(at[there])
    found = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, len(known), COLUMNS):
        parts = []
        for side, of, at in zip((left, right), rows, places):
            here = (at >= lo) & (at < lo + COLUMNS)
            part = np.zeros((len(side), min(COLUMNS, len(known) - lo)), np.float32)
            part[of[here], at[here] - lo] = 1
            parts.append(part)
        found += parts[0] @ parts[1].T
    return found.astype(np.int64)


def joining(nodes: np.ndarray, roots: np.ndarray, outer: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple]:
    """Links between nodes of different components, ``outer`` ones with the others: as many as join what can be joined."""
    x, y = np.flatnonzero(outer), np.flatnonzero(~outer)
    sizes = np.array([len(s) for s in sets])
    least, most = np.minimum.outer(sizes[x], sizes[y]), np.maximum.outer(sizes[x], sizes[y])
    open_ = (roots[x][:, None] != roots[y]) & (least >= similarity * most - 1e-9)
    own, other = open_.any(axis=1), open_.any(axis=0)
    if not own.any():
        return []
    x, y, open_ = x[own], y[other], open_[own][:, other]
    shared = shared_counts([sets[k] for k in x], [sets[k] for k in y])
    total = sizes[x][:, None] + sizes[y] - shared
    i, j = np.nonzero(open_ & (shared >= similarity * total - 1e-9))
    parent: dict[int, int] = {}

    def top(root: int) -> int:
        while parent.get(root, root) != root:
            root = parent[root]
        return root

    out = []
    for a, b in zip(x[i].tolist(), y[j].tolist()):
        one, two = top(int(roots[a])), top(int(roots[b]))
        if one != two:
            parent[max(one, two)] = min(one, two)
            out.append((nodes[a], nodes[b]))
    return out


def across(placed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: links that join components of ``placed(key, node, root)`` within a bucket."""
    parts = placed.groupBy("key", "root").agg(F.count("*").alias("size"))
    buckets = parts.groupBy("key").agg(F.max(F.struct("size", "root")).alias("l"), F.sum("size").alias("n"), F.count("*").alias("parts"))
    blocks = lambda n: F.ceil(n / F.lit(BLOCK))
    buckets = buckets.filter("parts > 1").select(
        "key", F.col("l.root").alias("largest"), blocks(F.col("n") - F.col("l.size")).alias("x"), blocks(F.col("n")).alias("y")
    )
    mixed = placed.select("key", "node", "root").join(buckets, "key")
    own = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    outer = mixed.filter("root <> largest").select("key", own(F.col("x"), 1).alias("x"), every(F.col("y")).alias("y"), "node", "root", F.lit(True).alias("outer"))
    whole = mixed.select("key", every(F.col("x")).alias("x"), own(F.col("y"), 2).alias("y"), "node", "root", F.lit(False).alias("outer"))
    group = ["key", "x", "y"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        held = next(batches, None)
        while held is not None:
            coming = next(batches, None)
            rows = held if rest is None else pd.concat([rest, held], ignore_index=True)
            keys = [rows[c].to_numpy() for c in group]
            cuts = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in keys], axis=0)) + 1).tolist()]
            # The last group may go on in the next batch.
            rest = rows.iloc[cuts.pop() :] if coming is not None and len(rows) else None
            ends = [*cuts[1:], len(rows) - (len(rest) if rest is not None else 0)]
            nodes, roots, outside, found = (rows[c].to_numpy() for c in ("node", "root", "outer", "shingles"))
            out = []
            for lo, hi in zip(cuts, ends):
                if lo < hi:
                    out += joining(nodes[lo:hi], roots[lo:hi], outside[lo:hi], list(found[lo:hi]), similarity)
            yield pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)
            held = coming

    dealt = outer.unionByName(whole).join(sets, "node").select(*group, "node", "root", "outer", "shingles")
    return dealt.repartition(*group).sortWithinPartitions(*group).mapInPandas(compare, "a long, b long")


def within(groups: DataFrame, marked: DataFrame) -> DataFrame:
    """``a, b``: links of each node to the least one that has rows in the same of ``groups(row_hash, group)``."""
    rows = marked.select("row_hash", "node").distinct()
    parts = rows.join(groups.select("row_hash", "group").distinct(), "row_hash").select("group", "node").distinct()
    parts = settle(parts, "copy-groups")
    least = parts.groupBy("group").agg(F.min("node").alias("a"), F.max("node").alias("hi")).filter("a < hi").select("group", "a")
    return parts.join(least, "group").filter("a <> node").select("a", F.col("node").alias("b"))


def near_copies(docs: DataFrame, row: Column, similarity: float = SIMILARITY, groups: DataFrame | None = None) -> DataFrame:
    """``(doc_id, fp, component_id, row_hash)``, one row per row of ``docs(doc_id, text)``; fp stands for the component,
    component_id is the smallest doc_id reached over near copies, null if there is none; ``row`` is a hash of the row.
    Rows of one of ``groups(row_hash, group)`` are linked too, whatever their similarity."""
    marked = docs.select("doc_id", row.alias("row_hash"), marks_column(whole_text()).alias("m"))
    marked = settle(marked.select("doc_id", "row_hash", "m.node", "m.keys"), "copy-marks")
    least = marked.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("row_hash").alias("row_hash"))
    least = settle(least, "copy-nodes")
    # A node's keys are the same in all its rows.
    keyed = marked.select("node", F.explode("keys").alias("key"))
    filled = keyed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("key")
    live = settle(keyed.join(filled, "key").distinct(), "copy-buckets")
    counts = live.groupBy("key").agg(F.count("*").alias("n"))
    live = live.join(counts, "key")
    fame = live.groupBy("node").agg(F.sum("n").alias("fame"))
    live = settle(live.join(fame, "node"), "copy-members")

    needed = live.select("node").distinct().join(least, "node").select("node", F.col("row_hash").alias("_row"))
    texts = docs.select(row.alias("_row"), whole_text().alias("text")).join(needed, "_row").dropDuplicates(["node"])
    sets = settle(texts.select("node", shingles_column("text").alias("shingles")), "copy-sets")

    heads = live.groupBy("key").agg(F.max(F.struct("fame", "node")).alias("head")).select("key", F.col("head.node").alias("a"))
    first = settle(alike(live.join(heads, "key").filter("a <> node").select("a", F.col("node").alias("b"), "n"), sets, similarity), "copy-links")
    if groups is not None:
        first = settle(first.union(within(groups, marked)), "copy-links")
    roots = components(first).withColumnRenamed("root", "r")
    placed = live.join(roots, "node", "left").select("key", "node", F.coalesce("r", "node").alias("root"))
    placed = settle(placed, "copy-roots")
    links = first.union(settle(across(placed, sets, similarity), "copy-joins"))

    ends = least.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = ends.groupBy("root").agg(F.min("least").alias("component_id"))
    found = marked.select("doc_id", "row_hash", "node").join(ends.join(names, "root").select("node", "root", "component_id"), "node")
    return found.select("doc_id", F.col("root").alias("fp"), "component_id", "row_hash")


def representatives(docs: DataFrame, similarity: float = SIMILARITY, radius: int | None = None) -> DataFrame:
    """The rows of ``docs`` less near copies: of each component the row with the smallest doc_id, once. With a ``radius``
    the near-duplicates of op1, fingerprints at most so many bits apart, are linked as near copies are.

    Null and wordless texts are copies of each other. Rows without a doc_id stay only where no row of their component has
    one; then the one with the least row hash stays. Texts of any length are compared whole; columns of docs may have any
    names and come back as they were.
    """
    row = F.xxhash64(*columns_of(docs))
    groups = None
    if radius is not None:
        # Rows go by their hash, so that those without a doc_id are told apart too.
        close = near_duplicates(docs.select(row.alias("doc_id"), "text"), radius)
        groups = close.select(F.col("doc_id").alias("row_hash"), F.col("component_id").alias("group"))
    return first_of_each(docs, row, near_copies(docs, row, similarity, groups))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
