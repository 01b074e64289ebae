"""Secret scans: fixed patterns, and tokens that a battery of randomness tests cannot tell from random ones.

A token's alphabet is inferred from its characters. Chi-squared uniformity over the alphabet, runs above and below its
middle, and correlation of neighbours each give a p-value under randomness; Fisher's method combines them. Words fail these
tests and have p-values near 0, random tokens have uniform ones. So, in each class of encoding and length, the tokens with
p over a half tell how many are random in all, and hence the share of words among those over any threshold. The lowest
threshold that keeps this share, the false discoveries, under a limit decides. Short tokens, whose tests have
little power, so face a stricter threshold than long ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import fresh, whole_text

#: Fixed patterns of the contract; what they match is kept if long enough.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
#: Runs that may be tokens, with base64's padding; the encodings they are tried as: name, what it may hold, its alphabet.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
PADDING = "=+$"
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", "^[0-9A-F]+$", "0123456789ABCDEF"),
    ("letters", "^[a-z]+$", "abcdefghijklmnopqrstuvwxyz"),
    ("LETTERS", "^[A-Z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "^[a-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", "^[A-Z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "^[A-Za-z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
)
BINS = 50
#: How many elements are scanned as one, and how often blocks are made of blocks.
BLOCK = 64
DEPTH = 3
MASK = "[SECRET]"
SPAN = "struct<start:bigint,kind:int,end:bigint,text:string>"


def named(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once: inside a lambda an expression is otherwise computed for every element."""
    return F.element_at(F.transform(F.array(value), then), 1)


def blocks_of(items: Column) -> Column:
    """The items in blocks of BLOCK, the last one shorter; items must be a column or named."""
    starts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(BLOCK)))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda at: F.slice(items, at, BLOCK))


def running(items: Column, combine: Callable[[Column, Column], Column], zero: Column, depth: int = DEPTH) -> Column:
    """For each item the combination of zero and all items before it, as in a scan; combine must be associative.

    An array that grows by an element is copied each time, so blocks of bounded size are scanned, from starts that come
    from scanning the blocks' totals: the work is about BLOCK an item.
    """
    kind = F.array(zero)

    def scan_from(first: Column, part: Column) -> Column:
        start = F.struct(first.alias("at"), F.slice(kind, 1, 0).alias("out"))
        step = lambda s, x: F.struct(combine(s["at"], x).alias("at"), F.array_append(s["out"], s["at"]).alias("out"))
        return F.aggregate(part, start, step, lambda s: s["out"])

    if depth == 0:
        return scan_from(zero, items)

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda part: F.aggregate(part, zero, combine))
        firsts = named(totals, lambda t: running(t, combine, zero, depth - 1))
        return F.flatten(F.zip_with(parts, firsts, lambda part, first: scan_from(first, part)))

    return named(blocks_of(items), joined)


def located(text: str, matches: str, pattern: str, kind: int) -> Column:
    """Spans of all matches of a pattern, whose texts are in column ``matches``: the texts between them tell where."""
    none = F.array().cast(f"array<{SPAN}>")

    def length(found: Column, gap: Column) -> Column:
        return F.struct(F.length(gap).cast("long").alias("gap"), F.length(found).cast("long").alias("own"), found.alias("text"))

    def spans(pairs: Column) -> Column:
        steps = F.transform(pairs, lambda p: p["gap"] + p["own"])
        before = named(steps, lambda n: running(n, lambda a, b: a + b, F.lit(0).cast("long")))

        def span(p: Column, at: Column) -> Column:
            begin = at + p["gap"]
            return F.struct(begin.alias("start"), F.lit(kind).alias("kind"), (begin + p["own"]).alias("end"), p["text"].alias("text"))

        return F.zip_with(pairs, before, span)

    # The text after the last match is no gap: split() gives one element more than there are matches.
    pairs = named(F.split(F.col(text), pattern, -1), lambda g: F.zip_with(F.col(matches), F.slice(g, 1, F.size(matches)), length))
    return F.when(F.size(matches) > 0, named(pairs, spans)).otherwise(none)


def apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of ``others``; both in order, and ``spans`` without overlaps among themselves.

    In the order of starts, a span is met from the left if an earlier other ends after its start, and from the right if
    the next other starts before its end.
    """
    far = F.lit(2**62).cast("long")

    def marked(of: Column, own: bool) -> Column:
        return F.transform(of, lambda s: F.struct(s["start"].alias("start"), F.lit(own).alias("own"), s.alias("s")))

    def kept(merged: Column) -> Column:
        def end(s: Column) -> Column:
            return F.when(s["own"], F.lit(0).cast("long")).otherwise(s["s"]["end"])

        def start(s: Column) -> Column:
            return F.when(s["own"], far).otherwise(s["start"])

        left = named(F.transform(merged, end), lambda ends: running(ends, lambda a, b: F.greatest(a, b), F.lit(0).cast("long")))
        starts = F.reverse(F.transform(merged, start))
        right = F.reverse(named(starts, lambda back: running(back, lambda a, b: F.least(a, b), far)))
        bounds = F.arrays_zip(merged.alias("m"), left.alias("left"), right.alias("right"))
        free = F.filter(bounds, lambda v: v["m"]["own"] & (v["left"] <= v["m"]["start"]) & (v["right"] >= v["m"]["s"]["end"]))
        return F.transform(free, lambda v: v["m"]["s"])

    # Others come first among equal starts, so that they are met from the left.
    merged = F.array_sort(F.concat(marked(others, False), marked(spans, True)))
    return F.when((F.size(spans) == 0) | (F.size(others) == 0), spans).otherwise(named(merged, kept))


def tail(z: Column) -> Column:
    """The normal distribution's upper tail, by the Abramowitz and Stegun 26.2.17 polynomial."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) * (1 / math.sqrt(2 * math.pi)) * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def tested(token: Column) -> Column:
    """``struct(stratum, p)`` of a token: encoding and length class, and the combined p-value under randomness. Padding is
    no part of it."""
    token = F.regexp_replace(token, PADDING, "")
    encoding, alphabet = F.lit(ENCODINGS[-1][0]), F.lit(ENCODINGS[-1][2])
    for name, holds, letters in reversed(ENCODINGS[:-1]):
        encoding = F.when(token.rlike(holds), name).otherwise(encoding)
        alphabet = F.when(token.rlike(holds), letters).otherwise(alphabet)
    raw = F.struct(token.alias("token"), encoding.alias("encoding"), alphabet.alias("alphabet"))

    def statistics(r: Column) -> Column:
        letters = F.filter(F.split(r["token"], ""), lambda c: c != "")
        codes = F.transform(letters, lambda c: F.call_function("locate", c, r["alphabet"]) - 1)
        return F.struct(r["encoding"].alias("encoding"), F.length(r["alphabet"]).alias("a"), codes.alias("x"))

    def sums(s: Column) -> Column:
        n, a, x = F.size(s["x"]), s["a"], s["x"]
        counts = F.transform(F.array_distinct(x), lambda v: F.size(F.filter(x, lambda y: y == v)))
        squares = F.aggregate(counts, F.lit(0), lambda t, c: t + c * c)
        pairs = F.zip_with(F.slice(x, 1, n - 1), F.slice(x, 2, n - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
        above = F.size(F.filter(x, lambda v: 2 * v >= a))
        runs = 1 + F.size(F.filter(pairs, lambda v: (2 * v["p"] >= a) != (2 * v["q"] >= a)))
        mean = F.aggregate(x, F.lit(0.0), lambda t, v: t + v) / n
        spread = F.aggregate(x, F.lit(0.0), lambda t, v: t + (v - mean) * (v - mean))
        lagged = F.aggregate(pairs, F.lit(0.0), lambda t, v: t + (v["p"] - mean) * (v["q"] - mean))
        return F.struct(
            s["encoding"].alias("encoding"), n.alias("n"), a.alias("a"), squares.alias("squares"), above.alias("above"),
            runs.alias("runs"), spread.alias("spread"), lagged.alias("lagged"),
        )

    def result(s: Column) -> Column:
        n, free = s["n"], s["a"] - 1
        chi = s["a"] * s["squares"] / n - n
        cube = 2 / (9 * free)
        z_chi = (F.pow(chi / free, F.lit(1 / 3)) - (1 - cube)) / F.sqrt(cube)
        up, down = s["above"], n - s["above"]
        middle = 2.0 * up * down / n + 1
        width = (middle - 1) * (middle - 2) / (n - 1)
        z_runs = F.when(width > 0, (s["runs"] - middle) / F.sqrt(width)).otherwise(9.0)
        z_lag = F.when(s["spread"] > 0, (s["lagged"] / s["spread"] + 1 / n) * F.sqrt(n)).otherwise(9.0)
        logs = F.struct(*[F.log(F.greatest(p, F.lit(1e-300))).alias(k) for k, p in (("c", tail(z_chi)), ("r", 2 * tail(F.abs(z_runs))), ("l", 2 * tail(F.abs(z_lag))))])
        return F.struct(F.concat_ws("/", s["encoding"], F.floor(2 * F.log2(n)).cast("string")).alias("stratum"), logs.alias("logs"))

    def combined(s: Column) -> Column:
        total = -(s["logs"]["c"] + s["logs"]["r"] + s["logs"]["l"])
        p = F.exp(-total) * (1 + total + total * total / 2)
        return F.struct(s["stratum"].alias("stratum"), F.least(F.lit(1.0), p).alias("p"))

    # transform() over one element names a value, so that what follows does not repeat it.
    steps = F.array(raw)
    for step in (statistics, sums, result, combined):
        steps = F.transform(steps, step)
    return F.element_at(steps, 1)


def thresholds(docs: DataFrame, limit: float) -> dict[str, int]:
    """For each stratum the first of BINS bins of p whose tokens, with those above, hold at most ``limit`` words. A token
    counts once, however often it is copied."""
    found = F.transform(F.regexp_extract_all(whole_text(), F.lit(TOKEN), F.lit(0)), lambda t: F.regexp_replace(t, PADDING, ""))
    tests = docs.select(F.explode(found).alias("token")).distinct().select(tested(F.col("token")).alias("t")).select("t.stratum", F.least(F.floor(F.col("t.p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"))
    found: dict[str, list[int]] = {}
    for stratum, bin_, n in tests.groupBy("stratum", "bin").count().collect():  # strata and bins are few at any size
        found.setdefault(stratum, [0] * BINS)[bin_] = n
    out = {}
    for stratum, bins in found.items():
        random = 2 * sum(bins[BINS // 2 :])
        for first in range(1, BINS // 2 + 1):
            over = sum(bins[first:])
            if over and 1 - random * (1 - first / BINS) / over <= limit:
                out[stratum] = first
                break
    return out


def scan(docs: DataFrame, limit: float = 0.05, into: str = "spans") -> DataFrame:
    """The rows of ``docs(text, ...)`` with ``spans``, or what ``into`` says: an array of ``(start, kind, end)`` in order.

    kind is 0 to 2 for the fixed patterns assign, access and hex, and 3 for tokens found random, unless these overlap a
    fixed one; positions are code points, the end excluded. ``limit`` bounds the estimated share of words among random
    different tokens, over all of docs. Null and empty texts have no spans; repeated rows are found alike and count once; a
    column of docs named like the new one is replaced.
    """
    passed = [F.lit(x) for item in thresholds(docs, limit).items() for x in item]
    columns = [c for c in docs.columns if c != into]
    patterns = (ASSIGN, ACCESS, HEX, TOKEN)
    taken = [*docs.columns, into]
    text, base = fresh("_text", taken), fresh("_base", taken)
    m, s = ([fresh(f"_{c}{k}", taken) for k in range(len(patterns))] for c in "ms")
    found = docs.select(*columns, whole_text().alias(text))
    found = found.select("*", *[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(m[k]) for k, p in enumerate(patterns)])
    found = found.select(*columns, *[located(text, m[k], p, k).alias(s[k]) for k, p in enumerate(patterns)])
    long_enough = F.filter(s[0], lambda v: F.length(F.regexp_extract(v["text"], ASSIGN, 2)) >= 6)
    found = found.select(*columns, F.array_sort(F.concat(long_enough, s[1], s[2])).alias(base), s[3])
    found = found.select(*columns, base, apart(F.col(s[3]), F.col(base)).alias(s[3]))
    random = F.col(s[3])
    if passed:
        bar = F.create_map(*passed)
        pairs = F.transform(random, lambda v: F.struct(v.alias("s"), tested(v["text"]).alias("t")))
        random = F.transform(F.filter(pairs, lambda v: v["t"]["p"] * BINS >= F.coalesce(bar[v["t"]["stratum"]], F.lit(BINS + 1))), lambda v: v["s"])
    else:
        random = F.array().cast(f"array<{SPAN}>")
    spans = F.transform(F.array_sort(F.concat(base, random)), lambda v: F.struct(v["start"].alias("start"), v["kind"].alias("kind"), v["end"].alias("end")))
    return found.select(*columns, spans.alias(into))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame, limit: float = 0.05) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` of each row of docs."""
    found = scan(docs.select("doc_id", "text"), limit).select("doc_id", F.col("spans").alias("all"))
    base = F.filter("all", lambda s: s["kind"] < 3)
    kinds = F.transform("all", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("all")).alias("spans"))


def masked(docs: DataFrame, limit: float = 0.05) -> DataFrame:
    """The rows of docs with each secret, or run of overlapping ones, replaced by a mask; ``n_chars``, where there is such
    a column, follows the text."""
    spans, cut = fresh("_spans", docs.columns), fresh("_cut", docs.columns)
    text = F.col("text").cast("string")

    def gaps(found: Column) -> Column:
        """What lies between one span and the furthest end before it; none where they overlap."""
        ends = F.transform(found, lambda v: v["end"])
        before = named(ends, lambda e: running(e, lambda x, y: F.greatest(x, y), F.lit(0).cast("long")))
        pairs = F.zip_with(before, found, lambda at, v: F.struct(at.alias("at"), v["start"].alias("to")))
        return F.filter(pairs, lambda g: g["to"] >= g["at"])

    def piece(of: Column, at: Column, to: Column) -> Column:
        return F.substring(of, at.cast("int") + 1, (to - at).cast("int"))

    def parts(block: Column) -> Column:
        """The gaps of a block, cut from its own stretch of the text: positions are found by walking there."""
        first = block[0]["at"]
        stretch = F.struct(piece(text, first, F.element_at(block, -1)["to"]).alias("text"), first.alias("at"))
        return named(stretch, lambda v: F.transform(block, lambda g: F.concat(piece(v["text"], g["at"] - v["at"], g["to"] - v["at"]), F.lit(MASK))))

    pieces = named(gaps(F.col(spans)), lambda g: F.flatten(F.transform(blocks_of(g), parts)))
    rest = F.substring(text, F.array_max(F.transform(spans, lambda v: v["end"])).cast("int") + 1, F.length(text))
    found = scan(docs, limit, spans)
    found = found.withColumn(cut, F.when(F.size(spans) > 0, F.concat(F.array_join(pieces, ""), rest)))
    out = {"text": F.coalesce(F.col(cut), F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col(cut).isNotNull(), F.length(cut).cast(kind)).otherwise(F.col("n_chars"))
    return found.withColumns(out).select(*docs.columns)
