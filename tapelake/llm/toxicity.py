"""Toxicity by bags of subwords: character n-grams have embeddings, averaged over a document's words into a linear softmax.

A document's bag is its few most toxic different words, wherever they stand, so that a few words in a long text count, but
one alone does not decide. Embeddings and softmax are trained jointly: first on the mean of all different words of each
document, then on its most toxic ones. Misspelt and inflected
words share n-grams, hence vectors, with those seen. As the model is linear in the averages, scoring needs one number for
each n-gram bucket: the product of its embedding with the difference of the two classes' weights.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tapelake.llm.common import columns_of, fresh, settle, whole_text

GRAMS = (3, 4, 5, 6)
BUCKET_BITS = 18
#: So many different words, the most toxic ones, make a document's bag.
TOP = 3
GAIN = 10.0
SMOOTH = 2.0
#: An n-gram of fewer training documents is not learnt, as it could only be learnt by heart.
LEAST_DOCUMENTS = 3
#: Validation takes no probability for lower than this, so that a few wrong labels do not end training early.
CLIP = 0.2
#: The weight of the toxic class in the loss, near its share of labels, so that a score of 0.7 is seldom wrong.
TOXIC_SHARE = 0.12
CHARS_AT_ONCE = 500_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@dataclass
class Grams:
    """The n-grams of some texts, in order of the words they belong to."""

    starts: np.ndarray  #: where each word starts
    ends: np.ndarray
    at: list[np.ndarray]  #: for each n, positions of n-grams' second characters
    bucket: list[np.ndarray]


def word_letters() -> np.ndarray:
    """Which of the first 65,536 characters are letters or digits."""
    return np.array([chr(c).isalnum() for c in range(0x10000)])


def plain(text: str) -> str:
    return unicodedata.normalize("NFKC", text).lower()


def grams(codes: np.ndarray, letters: np.ndarray) -> Grams:
    """N-grams of words, which are runs of letters and digits with a boundary mark on either side, and the words."""
    inside = letters[np.minimum(codes, 0xFFFF)] & (codes < 0x10000)
    inside = np.concatenate([[False], inside, [False]])
    marked = np.where(inside, np.concatenate([[0], codes, [0]]), 1).astype(np.uint64)
    edges = np.flatnonzero(np.diff(inside.view(np.int8)))
    at, bucket = [], []
    for n in GRAMS:
        if len(marked) < n:
            break
        ok = inside[1 : len(inside) - n + 2].copy()
        for k in range(2, n - 1):
            ok &= inside[k : len(inside) - n + 1 + k]
        start = np.flatnonzero(ok)
        h = np.full(len(start), n, np.uint64)
        for k in range(n):
            h = (h ^ marked[start + k]) * MULTIPLIER
            h ^= h >> np.uint64(29)
        at.append(start + 1)
        bucket.append((h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    starts, ends = edges[::2] + 1, edges[1::2] + 1
    # Whole words, as differences of running sums: the powers of an odd number can be undone.
    power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(marked), MULTIPLIER)]))
    back = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(marked), INVERSE)]))
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(marked * power[:-1])])
    h = (run[ends] - run[starts]) * back[starts]
    h = (h ^ (h >> np.uint64(31))) * MULTIPLIER
    at.append(starts)
    bucket.append((h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return Grams(starts, ends, at, bucket)


def grams_of(vocabulary: list[str], letters: np.ndarray, at_once: int = 50_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the words' n-grams and the words' numbers, some words at a time."""
    for first in range(0, len(vocabulary), at_once):
        codes = np.frombuffer(" ".join(vocabulary[first : first + at_once]).encode("utf-32-le", "surrogatepass"), "<u4")
        found = grams(codes, letters)
        owner = np.searchsorted(found.starts, np.concatenate(found.at), "right") - 1 + first
        yield np.concatenate(found.bucket).astype(np.int32), owner.astype(np.int32)


def word_means(found: Grams, size: int, value: np.ndarray) -> np.ndarray:
    """For each word the mean of the values of its n-grams that training knew; SMOOTH stands for one or two more of value 0."""
    total, number = np.zeros(size + 3), np.zeros(size + 3)
    for at, bucket in zip(found.at, found.bucket):
        total[at + 1] += value[bucket]
        number[at + 1] += value[bucket] != 0
    total, number = np.cumsum(total), np.cumsum(number)
    return (total[found.ends] - total[found.starts]) / (number[found.ends] - number[found.starts] + SMOOTH)


def most_toxic(doc: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Which rows are among the ``most`` best of their document, the first if tied; ``doc`` does not fall."""
    if not len(doc):
        return np.zeros(0, np.int64)
    new = np.diff(doc, prepend=-1) > 0
    heads, number = np.flatnonzero(new), np.cumsum(new) - 1
    left, out = score.astype(float), []
    for _ in range(most):
        best = np.maximum.reduceat(left, heads)
        at = np.flatnonzero((left == best[number]) & (left > -np.inf))
        out.append(at[np.flatnonzero(np.diff(number[at], prepend=-1))])
        left[out[-1]] = -np.inf
    return np.concatenate(out)


@dataclass
class Model:
    """What scoring needs: a number for each bucket, and the bias."""

    value: np.ndarray
    bias: float

    def logits(self, texts: list[str], letters: np.ndarray) -> np.ndarray:
        """Of each text's most toxic words; the bias alone for one without words."""
        codes, ends = [], []
        for text in texts:
            one = np.frombuffer(plain(text).encode("utf-32-le", "surrogatepass"), "<u4")
            codes += [one, np.zeros(1, "<u4")]
            ends.append(len(one) + 1)
        joined = np.concatenate(codes)
        found = grams(joined, letters)
        score = word_means(found, len(joined), self.value)
        doc = np.searchsorted(np.cumsum(ends), found.starts - 1, "right")
        _, different = np.unique((doc << BUCKET_BITS) | found.bucket[-1], return_index=True)
        doc, score = doc[different], score[different]
        top = most_toxic(doc, score, TOP)
        total, number = np.bincount(doc[top], score[top], len(texts)), np.bincount(doc[top], minlength=len(texts))
        return GAIN * total / np.maximum(number, 1) + self.bias


def train(texts: list[str], toxic: np.ndarray, width: int = 8, warm: int = 30, rounds: int = 150, rate: float = 0.03, seed: int = 42) -> Model:
    """Joint training of n-gram embeddings and softmax weights by Adam, all documents in each step.

    One document in six is kept aside; the model of the round with the least loss on these is returned.
    """
    letters = word_letters()
    place: dict[str, int] = {}
    docs = [np.array([place.setdefault(w, len(place)) for w in words(plain(t))], np.int64) for t in texts]
    keep = [k for k, d in enumerate(docs) if len(d)]
    y = toxic[keep].astype(float)
    if not len(y) or y.min() == y.max():
        rate_of_toxic = float(np.mean(toxic)) if len(toxic) else 0.0
        share = min(max(rate_of_toxic, 0.01), 0.99)
        return Model(np.zeros(1 << BUCKET_BITS), float(np.log(share / (1 - share))))
    tokens = np.concatenate([docs[k] for k in keep])
    token_doc = np.repeat(np.arange(len(keep)), [len(docs[k]) for k in keep])
    doc, word = np.divmod(np.unique(token_doc * len(place) + tokens), len(place))
    in_docs = np.bincount(word, minlength=len(place))  # at least as many for the words' n-grams
    common = np.zeros(1 << BUCKET_BITS)
    for b, w in grams_of(list(place), letters):
        common += np.bincount(b, in_docs[w], 1 << BUCKET_BITS)
    known = [(b[ok], w[ok]) for b, w in grams_of(list(place), letters) for ok in [common[b] >= LEAST_DOCUMENTS]]
    number = sum(np.bincount(w, minlength=len(place)) for _, w in known) + SMOOTH
    aside = np.arange(len(y)) % 6 == 5
    weight = np.where(y > 0, TOXIC_SHARE / max(1, y[~aside].sum()), (1 - TOXIC_SHARE) / max(1, (1 - y[~aside]).sum()))

    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (1 << BUCKET_BITS, width)).astype(np.float32)
    softmax = np.concatenate([rng.normal(0, 0.3, (2, width)), np.zeros((2, 1))], axis=1)
    moments = [np.zeros_like(vectors), np.zeros_like(vectors), np.zeros_like(softmax), np.zeros_like(softmax)]
    used = np.flatnonzero(common >= LEAST_DOCUMENTS)
    least, kept = np.inf, None
    for step in range(1, warm + rounds + 1):
        tilt = softmax[1, :-1] - softmax[0, :-1]
        value = vectors[used] @ tilt
        full = np.zeros(1 << BUCKET_BITS)
        full[used] = value
        means = sum(np.bincount(w, full[b], len(place)) for b, w in known) / number
        top = slice(None) if step <= warm else most_toxic(doc, means[word], TOP)
        of, which = doc[top], word[top]
        bag = np.bincount(of, minlength=len(y))
        mean = np.bincount(of, means[which], len(y)) / bag
        logit = GAIN * mean + softmax[1, -1] - softmax[0, -1]
        p = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
        if step > warm:
            loss = -(weight * np.log(np.maximum(np.where(y > 0, p, 1 - p), CLIP)))[aside].sum()
            if loss < least:
                least, kept = loss, Model(full, float(softmax[1, -1] - softmax[0, -1]))
        error = np.where(aside, 0.0, weight * (p - y))
        by_word = np.bincount(which, (GAIN * error / bag)[of], len(place)) / number
        by_bucket = sum(np.bincount(b, by_word[w], 1 << BUCKET_BITS) for b, w in known)[used]
        to_softmax = np.append(vectors[used].T @ by_bucket, error.sum())
        gradients = (by_bucket[:, None] * tilt + 1e-6 * vectors[used], np.stack([-to_softmax, to_softmax]))
        for what, gradient, k, at in ((vectors, gradients[0], 0, used), (softmax, gradients[1], 2, slice(None))):
            moments[k][at] = 0.9 * moments[k][at] + 0.1 * gradient
            moments[k + 1][at] = 0.99 * moments[k + 1][at] + 0.01 * gradient**2
            ahead = moments[k][at] / (1 - 0.9**step)
            what[at] -= rate * ahead / (np.sqrt(moments[k + 1][at] / (1 - 0.99**step)) + 1e-8)
    return kept


def words(text: str) -> list[str]:
    """Runs of the letters and digits that n-grams are made of."""
    return ["".join(run) for inside, run in groupby(text, lambda c: c.isalnum() and c < "\U00010000") if inside]


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, most: int, most_chars: int) -> DataFrame:
    """``(doc_id, text, toxic)``: up to ``most`` documents of each class, the first by hash of doc_id, once each; longer texts
    than ``most_chars`` are passed over, as the sample must fit the driver. Ids are chosen first and only the chosen texts
    move: the ids broadcast are at most twice ``most``."""
    marks = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    short = docs.filter(usable & (F.length(whole_text()) <= most_chars)).select("doc_id").distinct().join(marks, "doc_id")
    order = F.xxhash64("doc_id")
    sides = [short.filter((F.col("toxic") > 0) == side).orderBy(order, "doc_id").limit(most) for side in (False, True)]
    chosen = settle(sides[0].union(sides[1]), "training-ids")
    rows = docs.select("doc_id", whole_text().alias("text")).filter(F.length("text") <= most_chars)
    return rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, most: int = 1500, most_chars: int = 20_000) -> Model:
    rows = training_rows(docs, labels, usable, most, most_chars).toPandas().sort_values("doc_id")
    return train(rows["text"].tolist(), rows["toxic"].to_numpy() > 0)


def score_column(model: Model, text: Column) -> Column:
    """The probability of label 1."""

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        letters = word_letters()
        for texts in batches:
            out, group, size = [], [], 0
            for t in texts:
                group.append(t)
                size += len(t)
                if size >= CHARS_AT_ONCE:
                    out.append(model.logits(group, letters))
                    group, size = [], 0
            if group:
                out.append(model.logits(group, letters))
            logits = np.concatenate(out) if out else np.zeros(0)
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -40, 40))))

    return score(text)


def held_out() -> Column:
    """Documents never trained on: one in three by a checksum of doc_id; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, most: int = 1500) -> DataFrame:
    """The rows of ``docs`` with ``held_out``, ``score`` and ``predicted``.

    The model learns from ``labels(doc_id, toxic)`` of documents that are not held out, at most ``most`` of each class, and
    sees nothing but texts. A document with several labels counts as toxic if one says so; null labels are passed over.
    With no labels, or of one class only, every document scores the share of toxic labels. Null and empty texts have no
    words and get the bias. Repeated rows and rows without doc_id are scored like others; columns of docs named like the
    three are replaced.
    """
    model = fit(docs, labels, ~held_out(), most)
    scored = docs.withColumn("held_out", held_out()).withColumn("score", score_column(model, whole_text()))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, most: int = 1500) -> DataFrame:
    """The rows of ``docs`` that ``toxicity`` would not predict as toxic, in their own columns, whatever their names."""
    score = fresh("_score", docs.columns)
    scored = docs.withColumn(score, score_column(fit(docs, labels, ~held_out(), most), whole_text()))
    return scored.filter(F.col(score) < threshold).select(*columns_of(docs))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
