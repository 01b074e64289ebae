"""Near-duplicates by SimHash: fingerprints within a Hamming radius, found by the general pigeonhole principle.

The 64 bits are grouped into partitions of correlated bits. A fingerprint q gives partition i a threshold t_i >= -1 with
sum(t_i) = radius - partitions + 1; then any fingerprint within the radius of q is within t_i of it in some partition i
(-1: the partition is not probed). Dynamic programming picks, per fingerprint, the thresholds with the fewest estimated
candidates. Candidates of a bucket are compared pair by pair while one side is small. In buckets with many on both sides
the members are linked through midpoints instead: two fingerprints are within two bits exactly if some word is within one
bit of both, and at most 65 fingerprints are within one bit of a word. So work stays linear in the rows of a bucket.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from xxhash import xxh64_intdigest

from tapelake.llm.common import columns_of, fresh, settle, whole_text
from tapelake.llm.components import components

BITS = 64
SEED = 42
CHUNK = 1 << 15


def bit_columns(values: np.ndarray) -> np.ndarray:
    """Column k holds bit k of each 64-bit value."""
    return np.unpackbits(np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprint(text: str | None, width: int = 3) -> int:
    """Bits set in over half of the hashes of all word shingles, repeats included; no words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    total = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(width)))) if len(words) >= width else iter([b" ".join(words)])
    hashes = (xxh64_intdigest(s, SEED) for s in shingles)
    counts = np.zeros(BITS, np.int64)
    for _ in range(0, total, CHUNK):
        part = np.fromiter(islice(hashes, CHUNK), np.uint64)
        counts += bit_columns(part).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def fingerprint_column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series(np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64))


def hex_digits(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# Statistics over all fingerprints: 64 x 64 joint bit counts, then histograms of half partitions. Both are of fixed size.


def bit_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    joint = np.zeros((BITS, BITS))
    for batch in batches:
        bits = bit_columns(batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)).astype(np.float32)
        joint += bits.T @ bits
    at = np.flatnonzero(joint)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(joint.ravel()[at].astype(np.int64))], ["cell", "n"])


def correlated_groups(joint: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Split the bits into groups of near equal size, each grown around its most connected bit."""
    p = joint.diagonal() / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tie = np.abs(joint / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(tie, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda b: (tie[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (tie[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(group)
    return groups


def gather(bits: np.ndarray, group: list[int]) -> np.ndarray:
    """The number that the bits of a group spell, first bit lowest."""
    return bits[:, group].astype(np.int64) @ (1 << np.arange(len(group), dtype=np.int64))


def halves(groups: list[list[int]]) -> list[list[int]]:
    return [half for g in groups for half in (g[: len(g) // 2], g[len(g) // 2 :])]


def histogram(groups: list[list[int]]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = halves(groups)
        tables = [np.zeros(1 << len(h), np.int64) for h in parts]
        for batch in batches:
            bits = bit_columns(batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64))
            for counts, h in zip(tables, parts):
                counts += np.bincount(gather(bits, h), minlength=len(counts))
        for k, counts in enumerate(tables):
            at = np.flatnonzero(counts)
            cell = at + (k << 24)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(counts[at])], ["cell", "n"])

    return count


def around(counts: np.ndarray, radius: int) -> list[np.ndarray]:
    """For each distance, how many are at just that distance from each value."""
    width = len(counts).bit_length() - 1
    values = np.arange(len(counts))
    out = [counts.astype(float)]
    if radius >= 1:
        out.append(sum((counts[values ^ (1 << b)] for b in range(width)), np.zeros(len(counts))))
    if radius >= 2:
        pairs = ((1 << a) | (1 << b) for a in range(width) for b in range(a))
        out.append(sum((counts[values ^ f] for f in pairs), np.zeros(len(counts))))
    return out


def flips(width: int, radius: int) -> np.ndarray:
    """All changes of at most so many bits, none first."""
    out = [0]
    if radius >= 1:
        out += [1 << b for b in range(width)]
    if radius >= 2:
        out += [(1 << a) | (1 << b) for a in range(width) for b in range(a)]
    return np.array(out, np.int64)


def thresholds(costs: list[list[np.ndarray]], budget: int) -> np.ndarray:
    """Least total cost per row over all thresholds that sum to the budget; costs[i][t + 1] is the cost of threshold t in
    partition i. Dynamic programming over partitions; state: the sum so far."""
    rows, parts = len(costs[0][0]), len(costs)
    states = {0: (np.zeros(rows), np.zeros((rows, 0), np.int8))}
    for options in costs:
        reached: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for used, (cost, chosen) in states.items():
            for t, extra in enumerate(options, -1):
                total = cost + extra
                path = np.column_stack([chosen, np.full(rows, t, np.int8)])
                if used + t in reached:
                    known, kept = reached[used + t]
                    better = total < known
                    reached[used + t] = (np.where(better, total, known), np.where(better[:, None], path, kept))
                else:
                    reached[used + t] = (total, path)
        states = reached
    return states[budget][1].reshape(rows, parts)


def probes(groups: list[list[int]], tables: list[np.ndarray], n: int, radius: int):
    """Rows (key, fp, role) of the index (role 1), the probes (2) or both (3)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = [around(t, radius) for t in tables]
        sub = halves(groups)
        changes = [[flips(len(g), t) for t in range(radius + 1)] for g in groups]
        for batch in batches:
            fps = batch["fp"].to_numpy(zero_copy_only=False)
            bits = bit_columns(fps.view(np.uint64))
            keys, half = [gather(bits, g) for g in groups], [gather(bits, h) for h in sub]
            costs = []
            for i in range(len(groups)):
                first, second = ([c[half[k]] for c in near[k]] for k in (2 * i, 2 * i + 1))
                options = [np.zeros(len(fps))]
                for t in range(radius + 1):
                    found = sum(first[a] * second[b] for a in range(t + 1) for b in range(t + 1 - a)) / max(n, 1)
                    options.append(found + len(changes[i][t]))
                costs.append(options)
            chosen = thresholds(costs, radius - len(groups) + 1)
            for i, key in enumerate(keys):
                base = np.int64(i) << 40
                own = np.where(chosen[:, i] >= 0, 3, 1).astype(np.int8)
                yield _rows(base + key, fps, own)
                for t in range(1, radius + 1):
                    of = np.flatnonzero(chosen[:, i] == t)
                    change = changes[i][t][1:]
                    for some in np.array_split(of, max(1, len(of) * len(change) // 500_000)):
                        moved = (key[some][:, None] ^ change[None, :]).ravel()
                        yield _rows(base + moved, np.repeat(fps[some], len(change)), np.full(len(moved), 2, np.int8))

    return emit


def _rows(key, fp, role) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(fp, pa.int64()), pa.array(role, pa.int8())], ["key", "fp", "role"])


def midpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    change = np.concatenate([[0], np.uint64(1) << np.arange(BITS, dtype=np.uint64)]).astype(np.uint64)
    for batch in batches:
        fps = batch["fp"].to_numpy(zero_copy_only=False)
        words = (fps.view(np.uint64)[:, None] ^ change[None, :]).ravel().view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(np.repeat(fps, BITS + 1))], ["word", "fp"])


def links(fps: DataFrame, radius: int = 2, parts: int = 3, small_side: int = 64) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of all pairs of distinct ``fps(fp)`` within ``radius`` (0 to 2) bits.

    Every edge is such a pair, or both ends are in a chain of such pairs. ``small_side`` only chooses between comparing a
    bucket's pairs and linking through midpoints; both find every link.
    """
    if not 0 <= radius <= 2:
        raise ValueError("radius must be 0, 1 or 2")
    n = fps.count()
    joint = np.zeros(BITS * BITS)
    for cell, count in fps.mapInArrow(bit_pairs, "cell int, n long").groupBy("cell").agg(F.sum("n")).collect():
        joint[cell] = count
    groups = correlated_groups(joint.reshape(BITS, BITS), n, parts)
    tables = [np.zeros(1 << len(h), np.int64) for h in halves(groups)]
    for cell, count in fps.mapInArrow(histogram(groups), "cell int, n long").groupBy("cell").agg(F.sum("n")).collect():
        tables[cell >> 24][cell & 0xFFFFFF] = count

    rows = fps.mapInArrow(probes(groups, tables, n, radius), "key long, fp long, role byte")
    indexed, probed = F.col("role").bitwiseAND(1), F.shiftright("role", 1)
    buckets = (
        rows.groupBy("key")
        .agg(F.sum(indexed).alias("i"), F.sum(probed).alias("p"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
        .filter("lo < hi and i > 0 and p > 0")
        .select("key", (F.least("i", "p") > small_side).alias("crowded"))
    )
    live = settle(rows.join(buckets, "key"), "buckets")
    calm = live.filter(~F.col("crowded"))
    left = calm.filter(indexed == 1).select("key", F.col("fp").alias("a"))
    right = calm.filter(probed == 1).select("key", F.col("fp").alias("b"))
    pairs = (
        left.join(right, "key")
        .filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    words = live.filter("crowded").select("fp").distinct().mapInArrow(midpoints, "word long, fp long")
    stars = (
        words.groupBy("word")
        .agg(F.collect_set("fp").alias("fps"))  # at most 65 fingerprints are within one bit of a word
        .filter(F.size("fps") > 1)
        .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
        .filter("a <> b")
    )
    if radius < 2:
        stars = stars.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    return pairs.union(stars)


def near_duplicates(docs: DataFrame, radius: int = 2, extra: dict[str, F.Column] | None = None) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs(doc_id, text)``, and the ``extra`` columns of it.

    component_id is the smallest doc_id that can be reached over fingerprints at most ``radius`` bits apart, the row's own
    included. Null and wordless texts have fingerprint zero, which links like any other. Repeated rows give repeated rows;
    a null doc_id takes the id of its component, null if that has no id at all. Other columns of docs are not read.
    """
    marked = docs.select(
        F.col("doc_id"), fingerprint_column(whole_text()).alias("fp"), *(c.alias(k) for k, c in (extra or {}).items())
    )
    marked = settle(marked, "fingerprints")
    least = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(least.select("fp"), radius))
    placed = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(placed.join(names, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id", *(extra or {})
    )


def representatives(docs: DataFrame, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each component the row with the smallest doc_id, once.

    Rows without a doc_id stay only where no row of their component has one; then the one with the least row hash stays.
    """
    row = F.xxhash64(*columns_of(docs))
    return first_of_each(docs, row, near_duplicates(docs, radius, {"row_hash": row}))


def first_of_each(docs: DataFrame, row: Column, found: DataFrame) -> DataFrame:
    """Of each component of ``found(doc_id, row_hash, fp, component_id)`` the first row of docs, whose hashes ``row`` gives.
    Columns of docs may have any names."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash")
    chosen = found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("of")).agg(
        F.min(order).alias("o")
    )
    own, first, first_row, times = (fresh(name, docs.columns) for name in ("_hash", "_id", "_row", "_copies"))
    copies = found.groupBy("doc_id", "row_hash").agg(F.count("*").alias(times))
    chosen = chosen.select(F.col("o.doc_id").alias(first), F.col("o.row_hash").alias(first_row))
    chosen = chosen.join(copies, F.col(first).eqNullSafe(F.col("doc_id")) & (F.col(first_row) == F.col("row_hash")))
    chosen = chosen.select(first, first_row, times)
    kept = docs.withColumn(own, row).join(
        chosen, F.col("doc_id").eqNullSafe(F.col(first)) & (F.col(own) == F.col(first_row))
    )
    once = kept.filter(F.col(times) == 1).select(*columns_of(docs))
    repeated = kept.filter(F.col(times) > 1).dropDuplicates([first, first_row]).select(*columns_of(docs))
    return once.unionByName(repeated)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
