"""URL filters: allow and block rules by host and path, and gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import settle

#: Fixed values of the contract: verdict, host and path of each rule.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
FEATURES = (
    "url_chars", "host_chars", "path_chars", "query_chars", "host_labels", "depth", "digit_ratio", "host_digit_ratio", "hyphens",
    "symbol_ratio", "entropy", "host_entropy", "parameters", "fragment", "secure", "longest_part", "suffix_rows", "suffix_block_rate",
    "domain_rows", "domain_block_rate",
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(pages: DataFrame) -> DataFrame:
    """The rows with ``host`` and ``path`` of their url; both empty for a null url and one without ://."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER)
    return pages.withColumns({"host": host, "path": F.regexp_extract(url, pattern, 2)})


def rule_columns(rules: Iterable[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, action).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits per character."""
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    counts = F.transform(F.array_distinct(letters), lambda c: F.size(F.filter(letters, lambda d: d == c)).cast("double"))
    n = F.size(letters).cast("double")
    bits = F.aggregate(counts, F.lit(0.0), lambda total, k: total - k / n * F.log2(k / n))
    return F.when(n > 0, bits).otherwise(0.0)


def lexical(rows: DataFrame) -> DataFrame:
    """Features that a url alone gives, and its suffix and domain: the last label of the host, and the last two."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    labels = F.split("host", r"\.")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    share = lambda text, pattern: F.length(F.regexp_replace(text, pattern, "")) / F.greatest(F.length(text), F.lit(1))
    number = {
        "url_chars": F.length(url),
        "host_chars": F.length("host"),
        "path_chars": F.length("path"),
        "query_chars": F.length(query),
        "host_labels": F.size(labels),
        "depth": F.size(F.filter(F.split("path", "/"), lambda p: p != "")),
        "digit_ratio": share(url, "[^0-9]"),
        "host_digit_ratio": share(F.col("host"), "[^0-9]"),
        "hyphens": F.length(F.regexp_replace("host", "[^-_]", "")),
        "symbol_ratio": share(url, "[A-Za-z0-9]"),
        "entropy": entropy(url),
        "host_entropy": entropy(F.col("host")),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda p: p != "")),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
        "secure": F.startswith(url, F.lit("https:")).cast("double"),
        "longest_part": F.aggregate(F.split(F.concat_ws("/", "host", "path"), r"[./_-]"), F.lit(0), lambda m, p: F.greatest(m, F.length(p))),
    }
    tail = {"suffix": F.element_at(labels, -1), "domain": F.concat_ws(".", F.slice(labels, -2, 2))}
    tail["domain"] = F.when(F.size(labels) > 1, tail["domain"]).otherwise(F.col("host"))
    return rows.withColumns({k: v.cast("double") for k, v in number.items()} | tail)


def with_statistics(rows: DataFrame, prior: float = 10.0) -> DataFrame:
    """For suffix and domain, over all rows: how many there are, and the share of blocked among the labelled ones, drawn
    towards a half where these are few."""
    for part in ("suffix", "domain"):
        known, blocked = F.count("label"), F.coalesce(F.sum("label"), F.lit(0.0))
        found = rows.groupBy(part).agg(
            F.log1p(F.count("*").cast("double")).alias(f"{part}_rows"),
            ((blocked + prior / 2) / (known + prior)).alias(f"{part}_block_rate"),
        )
        rows = rows.join(found, part)
    return rows


def fit(rows: DataFrame, most: int, seed: int) -> GBTClassificationModel | float:
    """Trees from labelled rows, at most ``most``, the first by hash; with labels of one kind or none, that kind."""
    some = rows.filter("label is not null").orderBy(F.xxhash64("url"), "url").limit(most)
    some = settle(some.select("features", "label"), "labelled-urls")
    kinds = [r.label for r in some.select("label").distinct().collect()]
    if len(kinds) < 2:
        return kinds[0] if kinds else 0.0
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=10, maxDepth=4, stepSize=0.2, seed=seed).fit(some)


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, most: int = 20_000, seed: int = 42) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for each row of ``pages(page_id, url)``.

    A rule (verdict, host, path) fits its host and all subdomains where the url's path starts with the rule's; the longest
    that fits decides, and is shown as host and path. Urls under a rule are the labelled ones: trees learn from up to
    ``most`` of them what blocked urls look like and decide the rest. With labels of one kind the rest gets that kind;
    without labels it is allowed. A null url, and one without ://, has an empty host and path and is judged by the trees.
    Repeated rows give repeated rows; other columns are not read; without rows the result is empty.
    """
    rule, verdict = rule_columns(rules)
    rows = parsed(pages.select("page_id", F.col("url").cast("string").alias("url"))).withColumns({"rule": rule, "verdict": verdict})
    label = F.when(F.col("verdict").isNotNull(), (F.col("verdict") == "block").cast("double"))
    rows = with_statistics(lexical(rows.withColumn("label", label)))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    rows = settle(rows.select("page_id", "url", "host", "path", "rule", "verdict", "label", "features"), "url-features")
    model = fit(rows, most, seed)
    if isinstance(model, float):
        judged = rows.withColumn("prediction", F.lit(model))
    else:
        judged = model.transform(rows)
    guess = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", guess).alias("verdict"))
