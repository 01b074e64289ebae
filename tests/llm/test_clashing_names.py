"""Documents whose other columns are named like those the operators add for themselves."""

from pyspark.sql import functions as F

from tapelake.llm import copies, decontaminate, mixing, neighbours, simhash, toxicity

NAMES = (
    "_hash", "_id", "_row", "_copies", "copies", "_of", "_name", "_draws", "_cdf", "draws", "cdf", "_score", "score", "predicted",
    "Matches", "_held", "row_hash", "fp", "a.b", "a`c",
)


def clashing(spark):
    text = " ".join(f"word{i}" for i in range(60))
    base = [(1, text, "x"), (2, text, "x"), (3, "another text of seven words in all", "y"), (3, "another text of seven words in all", "y"), (4, None, "y")]
    docs = spark.createDataFrame(base, "doc_id long, text string, source string")
    for k, name in enumerate(NAMES):
        docs = docs.withColumn(name, F.lit(100 + k))
    return docs


def as_they_were(found, docs, ids):
    assert found.columns == docs.columns
    rows = [tuple(r) for r in found.collect()]
    assert sorted(r[0] for r in rows) == ids
    assert all(r[3:] == tuple(100 + k for k in range(len(NAMES))) for r in rows)


def test_filters_return_rows_as_they_were(spark):
    docs = clashing(spark)
    as_they_were(simhash.representatives(docs), docs, [1, 3, 4])
    as_they_were(copies.representatives(docs), docs, [1, 3, 4])
    items = spark.createDataFrame([(1, "another text of seven words in all")], "item_id long, text string")
    as_they_were(decontaminate.clean(docs, items), docs, [1, 2, 4])
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 0)], "doc_id long, toxic int")
    as_they_were(toxicity.clean(docs, labels), docs, [1, 2, 3, 3, 4])


def test_mix_keeps_columns(spark):
    docs = clashing(spark)
    found = mixing.mix(docs, growth=5.0)
    assert found.columns == [*docs.columns, "copy", "shuffle_key"]
    plain = mixing.mix(docs.select("doc_id", "text", "source"), growth=5.0)
    key = lambda df: sorted(map(tuple, df.select("doc_id", "copy", "shuffle_key").collect()))
    assert key(found) == key(plain) and found.count() > 0
    assert {tuple(r)[3 : 3 + len(NAMES)] for r in found.collect()} == {tuple(100 + k for k in range(len(NAMES)))}


def test_queries_whose_first_leaves_hold_few_rows(spark):
    """Visits go on until the leaves hold a query's rows, whatever number of leaves the calibration gave."""
    rows = [(i, [float(i % 7 == k) + i / 1e4 for k in range(7)]) for i in range(60)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.search(vectors, F.col("vec_id") % 20 == 0, recall=0.05, leaves=20)
    assert sorted(r["count"] for r in found.groupBy("query_id").count().collect()) == [20, 20, 20]
