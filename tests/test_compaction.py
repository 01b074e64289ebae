"""Packing of files, and compactions that stop between any two steps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapelake.sources import compaction as cp


def small_files(spark, tmp_path, rows=2000):
    """Three days: one of many files, one that holds most rows, one of a single file."""
    path = str(tmp_path / "t")
    day = F.when(F.col("id") % 10 == 0, "2024-01-01").when(F.col("id") % 10 == 1, "2024-01-03").otherwise("2024-01-02")
    df = spark.range(rows).select("id", F.concat(F.lit("S"), F.col("id") % 7).alias("symbol"), day.cast("date").alias("day"))
    df.filter("day < '2024-01-03'").repartition(20, "id").write.partitionBy("day").parquet(path)
    df.filter("day = '2024-01-03'").coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    return path


def ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).select("id").collect())


def files_by_day(spark, path):
    return {r.folder: r["count"] for r in cp.file_sizes(spark, path).groupBy("folder").count().collect()}


def test_first_fit_decreasing():
    assert cp.packed(np.array([5, 7, 3, 5, 20]), 10).tolist() == [2, 1, 1, 2, 0]
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 60, 500)
    bins = cp.packed(sizes, 100)
    full = np.bincount(bins, sizes)
    assert full.max() <= 100 and len(full) <= 1.23 * sizes.sum() / 100 + 1
    assert cp.packed(np.zeros(0, np.int64), 10).tolist() == []


def test_compaction_packs_and_keeps_rows(spark, tmp_path):
    path, work = small_files(spark, tmp_path), str(tmp_path / "work")
    before = files_by_day(spark, path)
    assert before == {"day=2024-01-01": 20, "day=2024-01-02": 20, "day=2024-01-03": 1}
    target = 3 * max(r.bytes for r in cp.file_sizes(spark, path).collect())
    bins = cp.compaction_plan(cp.file_sizes(spark, path), target).groupBy("folder").agg(F.countDistinct("bin").alias("n"))
    want = {r.folder: r.n for r in bins.collect()}
    assert cp.compact_in_place(spark, path, work, "day", target) == 40
    assert ids(spark, path) == list(range(2000))
    after = files_by_day(spark, path)
    assert after["day=2024-01-03"] == 1 and all(after[d] <= n for d, n in want.items())
    assert cp.compact_in_place(spark, path, work, "day", 1) == 0


def test_a_folder_of_very_many_files_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(cp, "PACKED_AT_ONCE", 100)
    sizes = spark.range(1000).select(F.lit("day=1").alias("folder"), F.col("id").cast("string").alias("file"), F.lit(10).cast("bigint").alias("bytes"))
    plan = cp.compaction_plan(sizes, 100)
    rows = plan.groupBy("bin").agg(F.sum("bytes").alias("b")).collect()
    assert plan.count() == 1000 and max(r.b for r in rows) <= 100 and 100 <= len(rows) <= 115


@pytest.mark.parametrize("stop", ["write_packed", "note", "swap", "close", "half"])
def test_a_run_that_stops_between_steps(spark, tmp_path, monkeypatch, stop):
    """The next run ends with every row once, wherever the one before it stopped."""
    path, work = small_files(spark, tmp_path, 400), str(tmp_path / "work")
    with monkeypatch.context() as m:
        real_note, real_swap = cp.note, cp.swap

        def ended(*_):
            raise RuntimeError("stopped")

        def no_close(spark, journal, run, copy, state):
            return ended() if state == "closed" else real_note(spark, journal, run, copy, state)

        def half(spark, path, copy, partition):
            """Only some of the old partitions are gone or replaced, as when the commit was cut off."""
            one = spark.read.parquet(copy).filter("day = '2024-01-01'").limit(0)
            real_swap(spark, path, copy, partition)
            held = spark.read.parquet(path).filter("day = '2024-01-02'").limit(3).collect()
            spark.createDataFrame(held, one.schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
            ended()

        m.setattr(cp, *{"close": ("note", no_close), "half": ("swap", half)}.get(stop, (stop, ended)))
        with pytest.raises(RuntimeError):
            cp.compact_in_place(spark, path, work, "day")
    if stop in ("write_packed", "note", "swap"):
        assert ids(spark, path) == list(range(400))
    cp.compact_in_place(spark, path, work, "day")
    assert ids(spark, path) == list(range(400))
    assert cp.finish(spark, path, work, "day") == 0
