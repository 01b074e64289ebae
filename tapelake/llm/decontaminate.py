"""Benchmark decontamination: windows as long as an item, found by SimHash and confirmed by exact similarity.

The benchmark's own words are numbered; only runs of five of them in a text can be a shingle of an item, and only those are
hashed to see which are. For every item length, the windows of that many words that hold enough of these to reach the
similarity get a SimHash of their word shingles. Fingerprints of items are indexed in blocks of bits, each with all values a few flips away; with six blocks
and two flips any item within 17 bits of a window is met in some block. What is met is confirmed by the weighted Jaccard
similarity of the shingles themselves, a shingle's weight being how often it occurs.
"""

from __future__ import annotations

import re
import sys
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType
from xxhash import xxh64_intdigest

from tapelake.llm.common import columns_of, fresh, settle, whole_text
from tapelake.llm.simhash import bit_columns, flips

WIDTH = 5
SIMILARITY = 0.8
BLOCKS = (11, 11, 11, 11, 10, 10)
FLIPS = 2
RADIUS = len(BLOCKS) * (FLIPS + 1) - 1
WINDOWS_AT_ONCE = 4096
KEPT_WORDS = 400_000

MATCH = StructType(
    [
        StructField("item_id", LongType()),
        StructField("similarity", DoubleType()),
        StructField("start_word", IntegerType()),
        StructField("n_words", IntegerType()),
    ]
)
find_words = re.compile(r"[^\W_]+").findall


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def shingle_hashes(words: list[str], known: WordHashes) -> np.ndarray:
    """A 64-bit hash of every shingle of words."""
    if len(words) < WIDTH:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    return shingles_at(h, np.arange(len(words) - WIDTH + 1))


def shingles_at(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the shingles at some starts, from the hashes of all words."""
    out = np.zeros(len(starts), np.uint64)
    for k in range(WIDTH):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[starts + k]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def window_fingerprints(hashes: np.ndarray, n: int) -> np.ndarray:
    """SimHash of every run of n shingles."""
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bit_columns(hashes), axis=0, out=sums[1:])
    return np.packbits(2 * (sums[n:] - sums[:-n]) > n, axis=1, bitorder="little").view("<u8").ravel()


def block_values(fps: np.ndarray) -> np.ndarray:
    """Row per fingerprint: for each block, its number and bits as one key."""
    out, at = [], 0
    for b, width in enumerate(BLOCKS):
        part = (fps >> np.uint64(at)) & np.uint64((1 << width) - 1)
        out.append(part.astype(np.int64) | (b << 12))
        at += width
    return np.stack(out, axis=1)


@dataclass
class SameLength:
    """The items of one length."""

    ids: list[int] = field(default_factory=list)
    shingles: list[Counter] = field(default_factory=list)
    fps: np.ndarray = None
    keys: np.ndarray = None
    items: np.ndarray = None

    def index(self) -> None:
        keys = block_values(self.fps)
        near = [keys[:, b][:, None] ^ flips(width, FLIPS)[None, :] for b, width in enumerate(BLOCKS)]
        owner = np.concatenate([np.repeat(np.arange(len(self.ids)), part.shape[1]) for part in near])
        key = np.concatenate([part.ravel() for part in near])
        order = np.argsort(key, kind="stable")
        self.keys, self.items = key[order].astype(np.int32), owner[order].astype(np.int32)

    def candidates(self, fps: np.ndarray) -> set[tuple[int, int]]:
        """(window, item) with fingerprints within the radius."""
        probe = block_values(fps).astype(np.int32)
        low, high = np.searchsorted(self.keys, probe, "left").ravel(), np.searchsorted(self.keys, probe, "right").ravel()
        n = high - low
        window = np.repeat(np.repeat(np.arange(len(fps)), len(BLOCKS)), n)
        item = self.items[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
        near = np.bitwise_count(fps[window] ^ self.fps[item]) <= RADIUS
        return set(zip(window[near].tolist(), item[near].tolist()))


@dataclass
class Items:
    """A block of benchmark items, ready for probing."""

    by_length: dict[int, SameLength]
    shingles: np.ndarray
    numbers: dict[str, int]  # of the items' words, from 1
    hashes: np.ndarray  # of the words by number; 0 has none

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Items:
        by_length: dict[int, SameLength] = defaultdict(SameLength)
        known, seen, fps = WordHashes(), [np.zeros(0, np.uint64)], defaultdict(list)
        for item_id, text in rows:
            words = find_words((text or "").lower())
            if len(words) < WIDTH:
                continue
            same = by_length[len(words)]
            hashes = shingle_hashes(words, known)
            same.ids.append(item_id)
            same.shingles.append(Counter(zip(*(words[k:] for k in range(WIDTH)))))
            fps[len(words)].append(window_fingerprints(hashes, len(hashes)))
            seen.append(hashes)
        for length, same in by_length.items():
            same.fps = np.concatenate(fps[length])
            same.index()
        numbers = {word: k for k, word in enumerate(known, 1)}
        return cls(dict(by_length), np.unique(np.concatenate(seen)), numbers, np.array([0, *known.values()], np.uint64))

    def shared(self, words: list[str]) -> np.ndarray:
        """Positions of the shingles that items have too."""
        if len(words) < WIDTH or not len(self.shingles):
            return np.zeros(0, np.int64)
        numbers = np.fromiter(map(self.numbers.get, words, repeat(0)), np.int32, len(words))
        unknown = np.concatenate([[0], np.cumsum(numbers == 0)])
        starts = np.flatnonzero(unknown[WIDTH:] == unknown[:-WIDTH])
        hashes = shingles_at(self.hashes[numbers], starts)
        at = np.minimum(np.searchsorted(self.shingles, hashes), len(self.shingles) - 1)
        return starts[self.shingles[at] == hashes]

    def matches(self, text: str, known: WordHashes, similarity: float) -> list[tuple[int, float, int, int]]:
        """For each item the most similar window: (item, similarity, first word, words). Ties go to the first, then to the
        one with fewer words."""
        words = find_words(text.lower())
        held = self.shared(words)
        if not len(held):
            return []
        shared = np.zeros(len(words) - WIDTH + 2, np.int32)
        shared[held + 1] = 1
        np.cumsum(shared, out=shared)
        best: dict[int, tuple[float, int, int]] = {}
        for length, same in self.by_length.items():
            n = length - WIDTH + 1
            # A window with fewer shingles of items than this is not similar enough to any item.
            least = max(1, np.ceil(similarity * n - 1e-9))
            if len(held) < least:
                continue
            starts = np.flatnonzero(shared[n:] - shared[:-n] >= least)
            if not len(starts):
                continue
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                for first in range(run[0], run[-1] + 1, WINDOWS_AT_ONCE):
                    last = min(first + WINDOWS_AT_ONCE, run[-1] + 1)
                    fps = window_fingerprints(shingle_hashes(words[first : last + length - 1], known), n)
                    for window, item in sorted(same.candidates(fps)):
                        score = weighted_jaccard(words, first + window, length, same.shingles[item])
                        place = (-score, int(first + window), length)
                        if score >= similarity and place < best.get(same.ids[item], (0.0,)):
                            best[same.ids[item]] = place
        return [(item, -score, start, n) for item, (score, start, n) in sorted(best.items())]


def weighted_jaccard(words: list[str], start: int, length: int, item: Counter) -> float:
    span = words[start : start + length]
    own = Counter(zip(*(span[k:] for k in range(WIDTH))))
    both = sum((own & item).values())
    return both / (sum(own.values()) + sum(item.values()) - both)


def matches_column(items: Items, similarity: float) -> Column:
    """Matches of each text with a block of items."""

    @F.pandas_udf(ArrayType(MATCH))
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = WordHashes()
        for texts in batches:
            out = []
            for text in texts:
                out.append([dict(zip(MATCH.names, m)) for m in items.matches(text, known, similarity)])
                if len(known) > KEPT_WORDS:
                    known.clear()
            yield pd.Series(out)

    return found(whole_text())


def item_blocks(benchmark: DataFrame, block_chars: int, block_items: int) -> Iterator[Items]:
    """The benchmark in blocks of about this size; one is in the driver at a time, if the caller keeps none."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), whole_text().alias("text"))
    items = items.filter("item_id is not null").distinct()
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block_items), -(-chars // block_chars))
    for k in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield Items.of(sorted((r.item_id, r.text) for r in part.collect()))


def contamination(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_chars: int = 4_000_000, block_items: int = 2000
) -> DataFrame:
    """The rows of ``docs`` and ``matches``: for each item of ``benchmark(item_id, text)`` the most similar window, ties
    going to the first and then to the one with fewer words.

    Words are runs of letters and digits in lower case, shingles five words. Null and empty texts match nothing; nor do
    items under five words, which have no shingle, or with a null id. Items that share an id count as one, whatever blocks
    their texts are in. A column of docs named ``matches`` is replaced; all others may have any name. A benchmark beyond a
    block is searched block by block: each is a pass over the texts whose matches are written before the next is read.
    """
    blocks = item_blocks(benchmark, block_chars, block_items)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return docs.withColumn("matches", matches_column(first, similarity))
    row = fresh("_row", docs.columns)
    docs = settle(docs.drop("matches").withColumn(row, F.monotonically_increasing_id()), "block-docs")

    def found(items: Items) -> DataFrame:
        all_of = docs.select(row, F.explode_outer(matches_column(items, similarity)).alias("m"))
        return settle(all_of.filter("m is not null"), "block-matches")

    parts = found(first).unionByName(found(second))
    del first, second
    for items in blocks:
        parts = parts.unionByName(found(items))
    place = F.struct(-F.col("m.similarity"), "m.start_word", "m.n_words")
    best = parts.groupBy(row, "m.item_id").agg(F.min_by("m", place).alias("m"))
    best = best.groupBy(row).agg(F.array_sort(F.collect_list("m")).alias("matches"))
    none = F.array().cast(ArrayType(MATCH))
    return docs.join(best, row, "left").withColumn("matches", F.coalesce("matches", none)).drop(row)


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(doc_id, item_id, similarity, start_word, n_words)``: every document and item it holds, with the best window."""
    found = contamination(docs.select("doc_id", "text"), benchmark, similarity)
    # explode() would add a filter on the matches before it, for which they would be searched twice.
    matches = found.select("doc_id", F.explode_outer("matches").alias("m")).filter("m is not null")
    return matches.select("doc_id", "m.*")


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that hold no item, in their own columns, whatever their names."""
    inner = docs.withColumnRenamed("matches", fresh("_held", docs.columns))
    kept = contamination(inner, benchmark, similarity).filter(F.size("matches") == 0)
    return kept.select(*columns_of(inner)).toDF(*docs.columns)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
