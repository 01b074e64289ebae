"""Near copies by five-word shingles against all pairs."""

import random

import numpy as np
import pytest

from tapelake.llm import copies
from tapelake.llm.simhash import fingerprint


def plain_components(texts, similarity=0.8):
    sets = [frozenset(copies.shingles(t).tolist()) for t in texts]
    names = list(range(len(texts)))
    links = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if sets[i] == sets[j] or sets[i] and sets[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9
    ]
    while True:
        old = list(names)
        for i, j in links:
            names[i] = names[j] = min(names[i], names[j])
        if old == names:
            return names


def corpus(rng):
    """Families around the threshold: their members share buckets, but only some are links."""
    word = lambda: "w" + str(rng.randrange(3000))
    texts = ["", None, "one", "one", "a b c"]
    for family in range(6):
        base = [word() for _ in range(rng.choice((30, 90, 400)))]
        for _ in range(40):
            edited = list(base)
            for _ in range(rng.randrange(1, 2 + len(base) // 45)):
                edited[rng.randrange(len(edited))] = word()
            texts.append(" ".join(edited))
    return texts


@pytest.mark.parametrize("block", [4, 256])
def test_components_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(copies, "BLOCK", block)
    monkeypatch.setattr(copies, "COLUMNS", 64)
    texts = corpus(random.Random(17))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    from pyspark.sql import functions as F

    found = copies.near_copies(docs, F.xxhash64("doc_id", "text"))
    got = {r.doc_id: r.component_id for r in found.collect()}
    want = plain_components(texts)
    assert 20 < len(set(want)) < len(texts) - 40
    assert got == dict(enumerate(want))


def test_shared_counts_are_sizes_of_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(-60, 60, rng.integers(0, 80))) for _ in range(30)]
    got = copies.shared_counts(sets[:13], sets[13:])
    assert got.tolist() == [[len(np.intersect1d(x, y)) for y in sets[13:]] for x in sets[:13]]


PHRASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda".split()


def both_ways():
    """Texts linked by op1's fingerprints alone, by five-word shingles alone, and in a chain of the two."""
    rng = random.Random(23)
    tail = lambda n: [f"t{rng.randrange(10**6)}" for _ in range(n)]
    apart = [PHRASE * 40 + tail(16) for _ in range(3)]
    base = tail(80)
    edited = [*base[:40], "edit", *base[41:]]
    shared = tail(60)
    chain = [PHRASE * 40 + shared, PHRASE * 2 + shared, PHRASE * 2 + [*shared[:30], "edit", *shared[31:]]]
    return [" ".join(w) for w in (tail(50), *apart, base, edited, *chain)]


def test_stage_drops_what_op1_links_and_what_shingles_link(spark):
    import corpus_pipeline

    texts = both_ways()
    sets = [set(copies.shingles(t).tolist()) for t in texts]
    like = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    bits = lambda a, b: (fingerprint(texts[a]) ^ fingerprint(texts[b])).bit_count()
    assert max(like(1, 2), like(1, 3), like(2, 3), like(1, 6)) < 0.5 and max(bits(1, 2), bits(1, 3), bits(1, 6)) <= 2
    assert like(4, 5) >= 0.8 and bits(4, 5) > 2
    assert like(6, 7) == 1 and bits(6, 7) > 2 and 0.8 <= like(7, 8) < 1 and bits(7, 8) > 2
    rows = [(k, t) for k, t in enumerate(texts)] + [(20, None), (21, " "), (4, texts[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 4, 20]


def test_stage_keeps_one_of_copies_without_ids(spark):
    import corpus_pipeline

    rows = [(None, t) for t in both_ways()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [r.text for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    texts = both_ways()
    assert len(kept) == 3 and texts[0] in kept
    assert sum(t in kept for t in texts[4:6]) == 1


def test_groups_of_rows_are_links(spark):
    """Components with op1's groups equal those of all pairs that either method links."""
    rng = random.Random(31)
    texts = corpus(rng)[:125]
    texts += [" ".join(PHRASE[: 3 + 2 * (k % 4)] * 40 + [f"t{rng.randrange(50)}" for _ in range(rng.randrange(40))]) for k in range(40)]
    fps = [fingerprint(t) for t in texts]
    names = plain_components(texts)
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    alone = list(names)
    for i, j in links:
        low, high = sorted((names[i], names[j]))
        names = [low if n == high else n for n in names]
    assert len(set(names)) < len(set(alone))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = [r.doc_id for r in copies.representatives(docs, radius=2).collect()]
    assert sorted(kept) == sorted(set(names))
    assert sorted(r.doc_id for r in copies.representatives(docs).collect()) == sorted(set(alone))
