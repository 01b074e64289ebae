"""Periodic runs of words: stretches that repeat a period four times or more.

Texts are taken in blocks of a bounded number of words (or one longer text). Prefix doubling gives every substring of
dyadic length a class, which is an interval of the suffix array. A run of period q and length 4q or more holds an aligned
block of dyadic length B, q < B <= 2q, and that block occurs again q words further on or back. So each aligned block asks
the suffix array for the occurrences next to its own: a wavelet tree over the array finds the least position above, and the
greatest below, in the block's interval. Occurrences that close form a progression, whose step is the candidate period. A
candidate is then extended both ways by comparing classes, longest first.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from hashlib import sha256
from itertools import count
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A run is at least so long, and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Texts are joined up to so many words; a longer one is taken alone.
AT_ONCE = 1 << 17

FOUND = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
    "collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>, collapsed string"
)


class SuffixArray:
    """Suffix array of numbers that end in one that occurs nowhere else, by prefix doubling.

    ``classes[k][i]`` is the first place in the array of the substrings equal to the one of length 2^k at ``i``. Only
    what is not yet alone in its class is sorted again, so ordinary text costs a few rounds.
    """

    def __init__(self, first: np.ndarray):
        """``first[i]`` is the position at which the number at ``i`` occurs first."""
        n = len(first)
        sizes = np.bincount(first, minlength=n)
        rank = (np.cumsum(sizes) - sizes)[first]
        self.order = np.empty(n, np.int64)
        alone = sizes[first] == 1
        self.order[rank[alone]] = np.flatnonzero(alone)
        self.classes, self.blocks = [rank], []
        rest, width = np.flatnonzero(~alone), 1
        while len(rest):
            key = rank[rest] * n + rank[rest + width]
            by_key = np.argsort(key, kind="stable")
            rest, key = rest[by_key], key[by_key]
            old = rank[rest]
            at = np.arange(len(rest))
            new_old = np.r_[True, old[1:] != old[:-1]]
            offset = at - at[new_old][np.cumsum(new_old) - 1]
            self.order[old + offset] = rest
            starts = np.r_[True, key[1:] != key[:-1]]
            group = np.cumsum(starts) - 1
            rank = rank.copy()
            rank[rest] = old + offset[starts][group]
            size = np.diff(np.r_[at[starts], len(rest)])[group]
            width *= 2
            self.classes.append(rank)
            keep = size > 1
            rest, size = rest[keep], size[keep]
            aligned = rest % width == 0
            if aligned.any():
                lo = rank[rest[aligned]]
                self.blocks.append((rest[aligned], lo, lo + size[aligned], np.full(aligned.sum(), width)))
            rest = np.sort(rest)

    def common(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How far the texts from ``a`` and ``b`` on (``step`` 1), or up to them (-1), agree."""
        far = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.classes))):
            reach = 1 << k
            if step > 0:
                x, y = a + far, b + far
                same = self.classes[k][x] == self.classes[k][y]
            else:
                x, y = a - far - reach, b - far - reach
                same = (x >= 0) & (self.classes[k][np.maximum(x, 0)] == self.classes[k][np.maximum(y, 0)])
            far += same * reach
        return far


class WaveletTree:
    """Ranks and order statistics of any interval of an array of numbers, a bit at a time, many queries at once."""

    def __init__(self, values: np.ndarray):
        self.levels = []
        for bit in reversed(range(max(1, int(values.max(initial=0)).bit_length()))):
            ones = (values >> bit) & 1
            zeros = np.r_[0, np.cumsum(1 - ones)]
            self.levels.append((bit, zeros))
            values = np.concatenate([values[ones == 0], values[ones == 1]])

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many numbers of each interval are less than ``bound``."""
        found = np.zeros(len(lo), np.int64)
        for bit, zeros in self.levels:
            one = (bound >> bit) & 1 == 1
            a, b = zeros[lo], zeros[hi]
            found += np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return found

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest number of each interval, from 0."""
        value = np.zeros(len(lo), np.int64)
        for bit, zeros in self.levels:
            a, b = zeros[lo], zeros[hi]
            one = k >= b - a
            value |= one.astype(np.int64) << bit
            k = np.where(one, k - (b - a), k)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return value


def find_runs(first: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period; see ``SuffixArray`` for ``first``."""
    suffixes = SuffixArray(first)
    if not suffixes.blocks:
        return np.zeros((0, 3), np.int64)
    at, lo, hi, width = map(np.concatenate, zip(*suffixes.blocks))
    tree = WaveletTree(suffixes.order)
    less = tree.below(lo, hi, at)
    pairs = []
    for has, rank in ((less + 1 < hi - lo, less + 1), (less > 0, less - 1)):
        other = tree.smallest(lo[has], hi[has], rank[has])
        a, b = np.minimum(at[has], other), np.maximum(at[has], other)
        near = (b - a < width[has]) & (b - a >= width[has] // 2)
        pairs.append((a[near], b[near]))
    a, b = map(np.concatenate, zip(*pairs))
    period, start = b - a, a - suffixes.common(a, b, -1)
    length = b + suffixes.common(a, b, 1) - start
    long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    return np.unique(np.stack([start, length, period], axis=1)[long], axis=0)[:, [0, 1, 2]]


def repeated(doc_id: int | None, n: int) -> np.ndarray | None:
    """The original word at each place, if the rule of the query makes this text periodic."""
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def _described(doc_id, words: list[bytes], runs: np.ndarray, texts: bool) -> tuple:
    """One row of the result; runs by start, then period."""
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs.tolist():
        dropped[start + period] += 1
        dropped[start + length] -= 1
    kept = words if not len(runs) else [w for w, d in zip(words, np.cumsum(dropped[:-1]).tolist()) if not d]
    text = b" ".join(kept)
    said = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist())
    best = (None,) * 4
    if len(runs):
        start, length, period = min(runs.tolist(), key=lambda r: (-r[1], r[0], r[2]))
        best = (start, length, period, 1000 * length // period)
    whole = ([tuple(r) for r in runs.tolist()], text.decode("utf-8", "replace")) if texts else (None, None)
    return doc_id, len(runs), *best, sha256(said.encode()).hexdigest(), sha256(text).hexdigest(), *whole


def _block(docs: list[tuple], texts: bool) -> list[tuple]:
    """Rows of a few ``(doc_id, words)``: all are searched at once, with a mark that occurs nowhere else after each."""
    firsts, at = [], [0]
    for _, words in docs:
        base, seen = at[-1], {}
        firsts.append(np.fromiter(map(seen.setdefault, words, count(base)), np.int64, len(words)))
        firsts.append(np.array([base + len(words)]))
        at.append(base + len(words) + 1)
    runs = find_runs(np.concatenate(firsts))
    cuts = np.searchsorted(runs[:, 0], at)
    return [
        _described(doc_id, words, runs[lo:hi] - [base, 0, 0], texts)
        for (doc_id, words), base, lo, hi in zip(docs, at, cuts, cuts[1:])
    ]


def periodic_runs(docs: DataFrame, rule=None, texts: bool = True, at_once: int = AT_ONCE) -> DataFrame:
    """Runs of each row of ``docs(doc_id, text)``: how many, the longest (ties: smallest start, then period) and digests;
    with ``texts`` also all runs and the text without the repeats, words joined by one space.

    A run is a stretch of words with smallest period q, at least ``max(6, 4 q)`` long, that no neighbouring word extends.
    A word is a repeat if a run holds it after its first q words. ``rule(doc_id, n)`` may give the word that stands at each
    of a text's n places. Null and wordless texts have no runs and the digest of an empty text; a null doc_id stays null;
    repeated rows give repeated rows; no rows give none; columns besides the two named are ignored. A text is searched whole
    however long it is, in memory of some 300 bytes a word; shorter texts share a search of ``at_once`` words.
    """
    names = [c.split(" ")[0] for c in FOUND.split(", ")[:8]] + ["runs", "collapsed"]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out(waiting: list[tuple]) -> pd.DataFrame:
            found = pd.DataFrame(_block(waiting, texts), columns=names, dtype=object)
            return found.astype(dict.fromkeys(["doc_id", "n_runs", "start", "length", "period", "exponent_milli"], "Int64"))

        for batch in batches:
            waiting, held = [], 0
            for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"]):
                doc_id = None if doc_id is pd.NA else int(doc_id)
                words = text.encode("utf-8", "surrogatepass").split()
                moved = rule(doc_id, len(words)) if rule else None
                words = words if moved is None else [words[k] for k in moved.tolist()]
                if waiting and held + len(words) > at_once:
                    yield out(waiting)
                    waiting, held = [], 0
                waiting.append((doc_id, words))
                held += len(words) + 1
            if waiting:
                yield out(waiting)

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = rows.mapInPandas(search, FOUND)
    return found if texts else found.drop("runs", "collapsed")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
