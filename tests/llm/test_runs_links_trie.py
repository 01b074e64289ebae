"""Periodic runs, vector copies and the conversation trie against plain versions."""

from hashlib import sha256
from zlib import crc32

import duckdb
import numpy as np
import pandas as pd
import pytest

from tapelake.llm import descent, runs, trie

DOCS = "doc_id long, text string"


def plain_runs(words):
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i : i + length]
            if length >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.add((i, length, q))
            i = max(j, i + 1)
    return sorted(out)


def plain_row(doc_id, text, rule):
    words = (text or "").encode().split()
    if rule and doc_id is not None:
        h, n = crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    said = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, sha256(said.encode()).hexdigest(), sha256(kept).hexdigest())


@pytest.mark.parametrize("rule", [None, runs.repeated])
def test_runs_equal_a_search_of_every_period(spark, rule):
    rng = np.random.default_rng(3)
    texts = ["", None, " \t\n", "a", "a a a a a", "a a a a a a", "ab " * 7, "x\x0by\x0cx y x y x y", "über Öl " * 4]
    texts += [" ".join(rng.choice(list("abc"[: 1 + k % 3]), rng.integers(0, 70))) for k in range(300)]
    texts += [" ".join(np.tile(rng.choice(list("abcdefgh"), q), 9)[: q * 5 + 3]) for q in range(1, 30)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, "a"), (None, "b b b b b b b"), (None, None)]
    got = runs.periodic_runs(spark.createDataFrame(rows, DOCS).repartition(3), rule, texts=False, at_once=100).collect()
    want = [plain_row(*row, rule) for row in rows]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in got]), key=key) == sorted(want, key=key)


def test_runs_give_texts_and_stand_odd_tables(spark):
    docs = spark.createDataFrame([(1, "x " + "a b c " * 5 + "y", "clash")], DOCS + ", runs string")
    row = runs.periodic_runs(docs).first()
    assert row.collapsed == "x a b c y" and [tuple(r) for r in row.runs] == [(1, 15, 3)]
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    long = "w " * 300_000 + "end"
    row = runs.periodic_runs(spark.createDataFrame([(1, long)], DOCS), texts=False).first()
    assert (row.n_runs, row.start, row.length, row.period) == (1, 0, 300_000, 1)


def plain_links(rows, similarity):
    """(vec_id, n_links, component_id) for each row, by all pairs."""
    good = []
    for vec_id, vector, label in rows:
        v = np.array([np.nan if x is None else x for x in vector], float) if vector is not None else np.zeros(0)
        fit = label is not None and len(v) and np.isfinite(v).all() and v.any()
        good.append(v / np.linalg.norm(v) if fit else None)
    n = len(rows)
    near = [
        [j for j in range(n) if j != i and good[i] is not None and good[j] is not None and rows[i][2] == rows[j][2]
         and len(good[i]) == len(good[j]) and good[i] @ good[j] >= similarity]
        for i in range(n)
    ]
    names = [r[0] for r in rows]
    while True:
        new = [min([x for x in [names[i], *(names[j] for j in near[i])] if x is not None], default=None) for i in range(n)]
        if new == names:
            return [(rows[i][0], len(near[i]), names[i]) for i in range(n)]
        names = new


def vectors():
    rng = np.random.default_rng(5)
    rows, unit = [], lambda k, d=24: rng.standard_normal((k, d))
    rows += [(v, 0) for v in unit(150)]
    rows += [(unit(1)[0] + 0.0 * v, 1) for v in unit(1)]
    centre = unit(1)[0]
    rows += [(centre + 0.05 * v, 1) for v in unit(260)]  # tight: saturates lists, is counted without pairs
    wide = unit(1)[0]
    rows += [(wide + 0.24 * v, 2) for v in unit(300)]  # pairs on both sides of the threshold
    step = unit(2)
    rows += [(np.cos(a) * step[0] + np.sin(a) * step[1], 3) for a in np.arange(0, 3, 0.2)]  # a chain
    rows += [(2 * centre + 0.1 * v, 0) for v in unit(3)]  # near, but of another label
    pairs = unit(20)
    rows += [(p * s, 4) for p in pairs for s in (1.0, 3.5)]
    return [(7 * k + 3, v.astype(np.float32).tolist(), label) for k, (v, label) in enumerate(rows)]


def test_links_of_vectors_equal_all_pairs(spark):
    rows = vectors()
    rows += [rows[0], rows[200], rows[200]]  # repeated rows are copies
    rows += [(9001, None, 1), (9002, [0.0] * 24, 1), (9003, [float("nan")] * 24, 1), (9004, [float("inf")] + [1.0] * 23, 1)]
    rows += [(9005, [None] + [1.0] * 23, 1), (9006, rows[200][1], None), (None, rows[201][1], 1), (None, None, None)]
    rows += [(9007, [1.0, 2.0], 1), (9008, [2.0, 4.0], 1), (9009, [], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    key = lambda r: tuple(str(x) for x in r)
    got = descent.near_copies(df.repartition(4)).collect()
    want = plain_links(rows, descent.SIMILARITY)
    assert sorted([(r.vec_id, r.n_links, r.component_id) for r in got], key=key) == sorted(want, key=key)
    assert all(r.kept == (None if r.vec_id is None else r.vec_id == r.component_id) for r in got)


def test_links_of_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert descent.near_copies(none).count() == 0
    assert descent.near_copies(spark.createDataFrame([(1, [1.0], 1)], none.schema)).collect()[0].n_links == 0


def test_audit_sees_a_broken_component(spark):
    df = spark.createDataFrame([(k, 1, [1.0, 0.01 * k], 0) for k in range(10)], "node long, label int, vector array<float>, root long")
    assert descent.audit(df, 0.93) == (90, 90)
    assert descent.audit(df.selectExpr("node", "label", "vector", "node % 2 as root"), 0.93) == (90, 40)


def openings(spark, rows):
    """Rows of the trie, and of the SQL, in one order."""
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth string")
    got = trie.opened_trie(df.repartition(3)).toPandas()
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    want = con.execute(trie.SQL).df()
    assert sorted(got.columns) == sorted(want.columns)
    by = ["depth", "conv_id"]
    return [f[sorted(f.columns)].sort_values(by).astype(object).where(f.notna(), None).values.tolist() for f in (got, want)]


def test_trie_equals_sql_on_odd_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 8)
    monkeypatch.setattr(trie, "IDS", 16)
    rng, rows = np.random.default_rng(11), []
    for c in range(0, 90):
        if c in (0, 40):
            continue  # conversations that others open with are absent
        for t in range(int(rng.integers(1, 7))):
            rows.append((c, t, ["user", "bot", None][t % 3], [f"so {rng.integers(2)}", None, "", "a b  c"][rng.integers(4)], "x"))
    rows += [(c, None, "user", f"first {c % 3}", "x") for c in range(60, 70)]
    rows += [(None, 1, "user", "nobody", "x")]
    for c in range(200, 220):  # branches nested in branches
        rows += [(c, t, "r", "same", "x") for t in range(c - 199)] + [(c, 500, "r", f"own {c}", "x")]
    rows += [(c, t, "r", f"t{t}", "x") for c in (300, 301) for t in range(30)]  # hashed in parts
    rows += [(-7, 0, "r", "below", "x"), (-7, 1, "r", "zero", "x")]
    got, want = openings(spark, rows)
    assert got == want


def test_trie_of_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.opened_trie(none).count() == 0
    got = trie.prefix_trie(trie.numbered(none), spark.createDataFrame([(4,), (9,)], "conv_id long")).collect()
    assert [(r.conv_id, r.depth, r.n_convs, r.n_leaves, r.ends_sha256) for r in got] == [(4, 0, 2, 1, sha256(b"4,9").hexdigest())]


def test_two_fattest(spark):
    df = spark.createDataFrame([(a, b) for a in range(0, 20) for b in range(a + 1, 40)], "a long, b long")
    for a, b, f in df.select("a", "b", trie.two_fattest(df.a, df.b)).collect():
        assert f == max(range(a + 1, b + 1), key=lambda k: k & -k)
