"""Pages by range and by key against a sort of everything."""

import random

import pytest
from pyspark.sql import functions as F

from tapelake.operators.paging import Key, page_after, ranked_page

ORDERS = [
    [Key("a"), Key("id")],
    [Key("a", falling=True), Key("id")],
    [Key("s", falling=True), Key("a"), Key("id", falling=True)],
]


@pytest.fixture(scope="module")
def table(spark):
    """A third of all rows share a key, some have none."""
    rng = random.Random(2)
    rows = [(rng.choice([7, 7, rng.randrange(50), None, rng.randrange(10**9)]), rng.choice("abc") if rng.random() < 0.9 else None, k) for k in range(600)]
    return spark.createDataFrame(rows, "a bigint, s string, id bigint").repartition(5).cache()


def ordered(table, order):
    return [r.id for r in table.orderBy(*[k.column() for k in order]).collect()]


@pytest.mark.parametrize("order", ORDERS)
def test_ranked_pages(table, order):
    want = ordered(table, order)
    for offset, first in ((0, 10), (137, 60), (590, 30), (600, 5), (10_000, 5)):
        got = ranked_page(table, order, first, offset, ranges=4, sample=50, most=20).collect()
        assert [r.id for r in got] == want[offset : offset + first]
        assert all((r.total_count, r.has_next_page, r.has_previous_page) == (600, 600 > offset + first, offset > 0) for r in got)


@pytest.mark.parametrize("order", ORDERS)
def test_pages_by_key_walk_the_whole_table(table, order):
    got, last = [], None
    while page := page_after(table, order, last, 120).collect():
        got += [r.id for r in page]
        last = page[-1]
    assert got == ordered(table, order)


def test_pages_of_nothing(table):
    assert ranked_page(table.limit(0), ORDERS[0]).collect() == []
    assert page_after(table.limit(0), ORDERS[0], None).collect() == []


def test_a_far_page_sorts_few_rows_and_skips_files(spark, tmp_path):
    """Page 100,000 of 2 million rows: the sorted part is under the bound, and whole files are left out."""
    path = str(tmp_path / "t")
    spark.range(2_000_000).select(F.col("id").alias("a"), (F.col("id") * 7).alias("id")).repartitionByRange(20, "a").write.parquet(path)
    df = ranked_page(spark.read.parquet(path), [Key("a"), Key("id")], first=10, offset=1_000_000, most=50_000)
    assert [r.a for r in df.collect()] == list(range(1_000_000, 1_000_010))
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1]
    assert "GreaterThanOrEqual(a," in pushed and "LessThanOrEqual(a," in pushed
