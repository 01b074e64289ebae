"""Near copies among vectors, by NN-descent.

Equal vectors of a label are one node. A node has a sketch, the signs of 256 random projections, whose Hamming distances
estimate angles. Every node starts with the nearest of its neighbours in several sorted orders of the sketches. In each
round the neighbours of a node, both those it lists and those that list it, meet in groups of bounded size and take over
whom they find closer than the last of their lists. A list full of likely links is saturated and grows. Entries that may
be links are checked on the vectors in double precision, and linked nodes make components.

Lists need not hold all links of a node: they only have to connect it. Links are counted inside a component, all of them:
nodes whose angles to the component's centre add up to less than the threshold's angle are linked whatever their pair is, so
only the nodes too far out for that are compared, block by block. A tight group of a third of all rows costs no pairs.

An audit compares a bounded sample of nodes with all rows. While it finds links across components, rounds with longer lists
follow.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapelake.llm.common import settle
from tapelake.llm.components import components

SIMILARITY = 0.93
#: Bits of a sketch, as signed words of 64.
WORDS = 4
#: Length of a list at first, and as far as it may grow.
LIST, LONGEST = 8, 64
#: Nodes that meet at once.
MEET = 32
#: Nodes of a component that are compared at once.
BLOCK = 256
#: Rounds end when fewer than this share of all entries is new.
SETTLED = 0.02
ROUNDS = 8
#: Nodes of each kind an audit takes, the share of links it asks for, and how often lists grow for it.
AUDITED, RECALL, AUDITS = 256, 0.995, 3
#: Margin of angles.
SLACK = 1e-6


def likely(similarity: float) -> int:
    """Bits in which the sketches of a linked pair hardly ever exceed: the mean at the threshold and four deviations."""
    p = math.acos(similarity) / math.pi
    return math.ceil(64 * WORDS * p + 4 * math.sqrt(64 * WORDS * p * (1 - p)))


def sketches(vectors: np.ndarray) -> np.ndarray:
    """Signs of random projections, packed into words."""
    planes = np.random.default_rng(42).standard_normal((vectors.shape[1], 64 * WORDS))
    return np.packbits(vectors @ planes > 0, axis=1).view(np.int64)


def units(vectors: pd.Series) -> np.ndarray:
    """Vectors of one length as unit rows in double precision."""
    found = np.stack(vectors.to_numpy()).astype(np.float64)
    # The largest part first, so that squares neither overflow nor vanish.
    found /= np.abs(found).max(axis=1, keepdims=True)
    return found / np.sqrt(np.einsum("ij,ij->i", found, found))[:, None]


def _nodes(rows: DataFrame) -> DataFrame:
    """``node, label, size, vector, n, least, sketch``: different vectors of a label, with their copies counted."""
    same = rows.filter("usable").groupBy("label", "vector")
    found = same.agg(F.min("row").alias("node"), F.count("*").alias("n"), F.min("vec_id").alias("least"))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(batch["vector"].map(len)):
                yield part.assign(sketch=list(sketches(units(part["vector"]))))

    found = found.select("node", "label", F.size("vector").alias("size"), "vector", "n", "least")
    return found.mapInPandas(draw, f"{found.schema.simpleString()[7:-1]}, sketch array<bigint>")


def _meetings(group: list[str], least_size: int = 2) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows sorted by ``group``: every ``MEET`` in a row meet, and each names whom it finds nearer than its last."""

    def pairs(rows: pd.DataFrame, starts: np.ndarray, sizes: np.ndarray) -> Iterator[pd.DataFrame]:
        node, worst, cap = (rows[c].to_numpy() for c in ("node", "worst", "cap"))
        # Unsigned: the bits of a negative number are those of its absolute value to bitwise_count.
        sketch = np.stack(rows["sketch"].to_numpy()).view(np.uint64)
        for lo in range(0, len(starts), 128):
            start, size = starts[lo : lo + 128], sizes[lo : lo + 128]
            at = np.arange(size.max())
            there = at < size[:, None]
            who = np.where(there, start[:, None] + at, start[:, None])
            own = sketch[who]
            far = np.bitwise_count(own[:, :, None] ^ own[:, None]).sum(axis=3, dtype=np.int16)
            ids = node[who]
            far[~(there[:, :, None] & there[:, None]) | (ids[:, :, None] == ids[:, None])] = 999
            # A row names no more than its list can hold.
            kept = min(int(cap[who].max()), far.shape[2] - 1)
            order = np.argpartition(far, kept - 1, axis=2)[:, :, :kept] if kept else np.zeros((*far.shape[:2], 0), int)
            found = np.take_along_axis(far, order, axis=2)
            good = found < worst[who][:, :, None]
            g, x, _ = np.nonzero(good)
            yield pd.DataFrame({"a": ids[g, x], "b": ids[g, order[good]], "far": found[good]})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch, last in _with_last(batches):
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            keys = pd.MultiIndex.from_frame(rows[group]).factorize()[0] if len(rows) else np.zeros(0, int)
            new = np.r_[True, keys[1:] != keys[:-1]] if len(rows) else np.zeros(0, bool)
            first = np.flatnonzero(new)
            place = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)]))
            starts = np.flatnonzero(place % MEET == 0)
            sizes = np.diff(np.r_[starts, len(rows)])
            if not last and len(starts):
                # The last group may go on in the next batch.
                rest, starts, sizes = rows.iloc[starts[-1] :], starts[:-1], sizes[:-1]
            full = sizes >= least_size
            if full.any():
                yield from pairs(rows, starts[full], sizes[full])

    return meet


def _with_last(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, bool]]:
    """Each batch, and whether it is the last."""
    held = None
    for batch in batches:
        if held is not None:
            yield held, False
        held = batch
    if held is not None:
        yield held, True


def _lists(found: DataFrame, state: DataFrame) -> DataFrame:
    """The nearest of ``found(a, b, far, old)`` for each node, as many as its list holds."""
    near = Window.partitionBy("a").orderBy("far", "b")
    ranked = found.withColumn("rank", F.dense_rank().over(near)).filter(F.col("rank") <= LONGEST)
    once = ranked.groupBy("a", "b", "far", "rank").agg(F.max("old").alias("old"))
    caps = state.select(F.col("node").alias("a"), "cap")
    return once.join(caps, "a").filter("rank <= cap").select("a", "b", "far", "old")


def _first_lists(nodes: DataFrame) -> DataFrame:
    """Neighbours in sorted orders of the sketches: one for each word, and for each word with its halves exchanged."""
    word = [F.col("sketch")[k] for k in range(WORDS)]
    turned = [F.shiftleft(w, 32).bitwiseOR(F.shiftrightunsigned(w, 32)) for w in word]
    orders = F.posexplode(F.array(*word, *turned)).alias("turn", "key")
    rows = nodes.select("node", "label", "size", "sketch", F.lit(999).alias("worst"), F.lit(LIST).alias("cap"), orders)
    order = ["turn", "label", "size", "key", "node"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.mapInPandas(_meetings(["turn", "label", "size"]), "a long, b long, far int")


def _state(nodes: DataFrame, lists: DataFrame, similarity: float, least: int) -> DataFrame:
    """Per node its sketch, the length its list may have, and what a newcomer must be nearer than."""
    full = lists.groupBy("a").agg(F.count("*").alias("held"), F.max("far").alias("last"))
    rows = nodes.select("node", "sketch").join(full.withColumnRenamed("a", "node"), "node", "left")
    held = F.coalesce("held", F.lit(0))
    cap = F.greatest(F.lit(least), held)
    saturated = (held >= LIST) & (F.col("last") <= likely(similarity))
    cap = F.least(F.when(saturated, 2 * cap).otherwise(cap), F.lit(LONGEST))
    rows = rows.withColumn("cap", cap.cast("int"))
    return rows.withColumn("worst", F.when(held < F.col("cap"), 999).otherwise(F.col("last")).cast("int")).drop("held", "last")


def _round(lists: DataFrame, state: DataFrame, number: int) -> DataFrame:
    """Neighbours of a node meet; those of a node with many are dealt at random to several groups."""
    known = lists.select(F.col("a").alias("pivot"), F.col("b").alias("node"))
    members = known.union(lists.select(F.col("b").alias("pivot"), F.col("a").alias("node"))).distinct()
    many = members.groupBy("pivot").agg(F.count("*").alias("n")).filter(F.col("n") > MEET)
    mixed = F.xxhash64("node", F.lit(number))
    salt = F.pmod(mixed, F.coalesce(F.ceil(F.col("n") / F.lit(MEET)), F.lit(1)))
    rows = members.join(many, "pivot", "left").withColumn("salt", salt).join(state, "node")
    rows = rows.select("pivot", "salt", mixed.alias("mixed"), "node", "sketch", "worst", "cap")
    rows = rows.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "mixed")
    found = rows.mapInPandas(_meetings(["pivot", "salt"]), "a long, b long, far int")
    return _lists(found.withColumn("old", F.lit(0)).unionByName(lists.withColumn("old", F.lit(1))), state)


def neighbour_lists(nodes: DataFrame, similarity: float, least: int, lists: DataFrame | None = None) -> DataFrame:
    """``a, b, far``: the lists after as many rounds as change them."""
    if lists is None:
        blank = nodes.select("node", F.lit(LIST).alias("cap"))
        lists = settle(_lists(_first_lists(nodes).withColumn("old", F.lit(0)), blank), "lists")
    for number in range(ROUNDS):
        lists = settle(_round(lists.drop("old"), _state(nodes, lists, similarity, least), number), "lists")
        new, held = lists.agg(F.coalesce(F.sum(1 - F.col("old")), F.lit(0)), F.count("*")).first()
        if new <= SETTLED * held:
            break
    return lists


def _checked(lists: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The listed pairs that are links by their vectors."""
    pairs = lists.filter(F.col("far") <= likely(similarity)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(batch["x"].map(len)):
                cosine = np.einsum("ij,ij->i", units(part["x"]), units(part["y"]))
                yield part.loc[cosine >= similarity, ["a", "b"]]

    ends = [nodes.select(F.col("node").alias(c), F.col("vector").alias(v)) for c, v in (("a", "x"), ("b", "y"))]
    both = pairs.distinct().join(ends[0], "a").join(ends[1], "b")
    return both.select("a", "b", "x", "y").mapInPandas(check, "a long, b long")


def _placed(nodes: DataFrame, lists: DataFrame, similarity: float) -> DataFrame:
    """Nodes with the root of their component, their own number if alone."""
    roots = components(settle(_checked(lists, nodes, similarity), "links"))
    return settle(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "placed")


def audit(placed: DataFrame, similarity: float, most: int = AUDITED) -> tuple[int, int]:
    """Links between a sample of nodes and all others, and how many of them lie in one component.

    The sample, ``most`` nodes at random and as many of those in components, is compared with every row.
    """
    by_hash = F.xxhash64("node", F.lit("audit"))
    linked = placed.join(placed.groupBy("root").agg(F.count("*").alias("of")).filter("of > 1"), "root")
    sample = [x for df in (placed, linked) for x in df.orderBy(by_hash, "node").limit(most).select("node", "label", "vector", "root").collect()]
    sizes = {}
    for x in sample:
        sizes.setdefault(len(x["vector"]), {})[x["node"]] = x
    asked = {}
    for size, some in sizes.items():
        some = list(some.values())
        labels, numbers = pd.Series([x["label"] for x in some]), np.array([[x["node"], x["root"]] for x in some])
        asked[size] = units(pd.Series([x["vector"] for x in some])), labels, numbers[:, 0], numbers[:, 1]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch["vector"].map(len)):
                if size not in asked:
                    continue
                vectors, labels, node, root = asked[size]
                close = units(part["vector"]) @ vectors.T >= similarity
                close &= (part["label"].to_numpy()[:, None] == labels.to_numpy()) & (part["node"].to_numpy()[:, None] != node)
                same = close & (part["root"].to_numpy()[:, None] == root)
                yield pd.DataFrame({"links": [close.sum()], "found": [same.sum()]})

    seen = placed.select("node", "label", "vector", "root").mapInPandas(compare, "links long, found long")
    links, found = seen.agg(F.coalesce(F.sum("links"), F.lit(0)), F.coalesce(F.sum("found"), F.lit(0))).first()
    return links, found


def _link_counts(placed: DataFrame, similarity: float) -> DataFrame:
    """``node, links``: rows linked to each of the node's rows, itself not counted, for all nodes of components of two nodes or more."""
    angle = math.acos(similarity)
    whole = placed.groupBy("root").agg(F.sum("n").alias("rows"), F.count("*").alias("of")).filter("of > 1")
    members = placed.select("root", "node", "n", "vector").join(whole, "root")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    parts = members.select("root", F.posexplode("vector"), norm.alias("norm"))
    sums = parts.groupBy("root", "pos").agg(F.sum(F.col("col").cast("double") / F.col("norm")).alias("sum"))
    centres = sums.groupBy("root").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "sum"))), lambda x: x["sum"]).alias("centre"))

    def away(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(batch["vector"].map(len)):
                cosine = np.einsum("ij,ij->i", units(part["vector"]), units(part["centre"]))
                yield part.drop(columns="centre").assign(away=np.arccos(cosine.clip(-1, 1)))

    fields = members.select("root", "node", "n", "rows", "vector").schema.simpleString()[7:-1]
    put = members.join(centres, "root").select("root", "node", "n", "rows", "vector", "centre")
    put = settle(put.mapInPandas(away, f"{fields}, away double"), "angles")
    farthest = put.groupBy("root").agg(F.max("away").alias("farthest"))
    # A pair whose angles to the centre add up to less than the threshold's is linked.
    put = put.join(farthest, "root").withColumn("open", F.col("away") + F.col("farthest") >= angle - SLACK)
    settled = put.filter("not open").select("node", (F.col("rows") - 1).alias("links"))
    unsure = put.filter("open").drop("away", "farthest", "open")
    sums = unsure.groupBy("root").agg(F.sum("n").alias("open_rows"), F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    unsure = settle(unsure.join(sums, "root"), "unsure")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = unsure.select("root", "node", "n", "vector", own.alias("own"), every.alias("other"))
    dealt = dealt.select("root", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "n", "vector")

    def compare(keys: tuple, part: pd.DataFrame) -> pd.DataFrame:
        vectors, n, own = units(part["vector"]), part["n"].to_numpy(), part["own"].to_numpy()
        x, y = np.flatnonzero(own == keys[1]), np.flatnonzero(own == keys[2])
        links = np.zeros(len(part), np.int64)
        close = vectors[x] @ vectors[y].T >= similarity
        links[x] = close @ n[y]
        if keys[1] != keys[2]:
            links[y] = close.T @ n[x]
        return pd.DataFrame({"node": part["node"], "links": links})

    counted = dealt.groupBy("root", "x", "y").applyInPandas(compare, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    rest = unsure.join(counted, "node").select("node", (F.col("rows") - F.col("open_rows") + F.col("links") - 1).alias("links"))
    return settled.unionByName(rest)


def near_copies(vectors: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors(vec_id, embedding, label)``.

    Rows are linked if their labels are equal and not null and the cosine of their vectors, of one length, is at least
    ``similarity``. Vectors that are null, empty or zero or hold null or non-finite parts have no links, nor have rows
    without a label; they are components of their own. Repeated rows are copies and link with each other. component_id is the
    smallest vec_id reached, null ids left out; rows without an id are not kept unless ``vec_id = component_id`` can be told,
    so ``kept`` is null for them. An empty table gives no rows; further columns are ignored.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select("vec_id", "label", F.col("embedding").alias("vector"), F.coalesce(usable, F.lit(False)).alias("usable"))
    rows = settle(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    nodes = settle(_nodes(rows), "nodes")
    lists, least = None, LIST
    for _ in range(AUDITS):
        lists = neighbour_lists(nodes, similarity, least, lists)
        placed = _placed(nodes, lists, similarity)
        links, found = audit(placed, similarity)
        if found >= RECALL * links:
            break
        least = min(2 * least, LONGEST)
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    counts = _link_counts(placed, similarity)
    ends = placed.select("node", "root", "n").join(names, "root").join(counts, "node", "left")
    ends = ends.select("node", "component_id", F.coalesce("links", F.col("n") - 1).alias("n_links"), "n")
    ends = settle(ends, "ends")
    copies = placed.filter("n > 1").select("label", "vector", F.col("node").alias("of"))
    found = rows.filter("usable").join(copies, ["label", "vector"], "left").withColumn("node", F.coalesce("of", "row"))
    found = found.select("vec_id", "node").join(ends, "node").select("vec_id", "n_links", "component_id")
    alone = rows.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
