"""Windows put out on time and corrected later, against windows over all rows at once."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tapelake.streaming import corrections
from tapelake.streaming.aggregates import tumbling

ROW = "symbol string, price double, quantity int, event_time timestamp"
T0 = datetime(2024, 1, 2, 10)


def trades(spark, rows):
    return spark.createDataFrame([(s, p, q, None if t is None else T0 + timedelta(seconds=t)) for s, p, q, t in rows], ROW)


def run(spark, base, batches, lateness="2 hours", replay=()):
    """Fold batches, those in ``replay`` a second time right after."""
    for k, rows in enumerate(batches):
        for _ in range(2 if k in replay else 1):
            corrections.fold_batch(
                trades(spark, rows), k, "1m", f"{base}/changes", f"{base}/late", f"{base}/state", "5 seconds", lateness
            )
    return spark.read.schema(corrections.CHANGES).parquet(f"{base}/changes")


def plain(rows):
    return sorted(map(str, rows))


def test_changes_add_up_to_the_windows_of_all_rows(spark, tmp_path):
    """One symbol has most of the rows; a batch is replayed; an empty one and one without times come between."""
    rng = random.Random(3)
    def row(lo, hi):
        return rng.choice("AAAAAAB") if rng.random() > 0.02 else None, rng.randrange(100, 999) / 10, rng.randrange(1, 9), rng.randrange(lo, hi)

    batches = [[row(0, 600) for _ in range(400)], [row(100, 1200) for _ in range(400)], [], [("A", 1.0, 1, None)]]
    batches += [[row(0, 1300) for _ in range(300)], [("END", 1.0, 1, 5000)]]
    changes = run(spark, tmp_path, batches, replay=(1, 4)).cache()
    whole = tumbling(trades(spark, [r for b in batches for r in b if r[3] is not None]), "1m").filter("window_end <= '2024-01-02 11:20:00'")
    got = corrections.latest(changes)
    assert got.filter("version > 1").count() > 10
    assert plain(got.select(*whole.columns).collect()) == plain(whole.collect()) and whole.count() > 40
    assert spark.read.schema(ROW).parquet(f"{tmp_path}/late").count() == 0
    # What was taken back is what was put out before, and only the last version stands.
    values = [c for c in changes.columns if c not in ("change", "batch_id")]
    added, taken = (plain(changes.filter(F.col("change") == c).select(*values).collect()) for c in ("add", "retract"))
    assert not set(taken) - set(added) and len(set(added)) == len(added) and len(set(taken)) == len(taken)
    assert len(added) - len(taken) == got.count()


def test_rows_beyond_the_lateness_go_to_a_table_of_their_own(spark, tmp_path):
    batches = [[("A", 1.0, 1, 0), ("A", 2.0, 1, 9000)], [("A", 3.0, 1, 10), ("A", 4.0, 1, 8000)]]
    changes = run(spark, tmp_path, batches)
    late = spark.read.schema(ROW).parquet(f"{tmp_path}/late").collect()
    assert [r.price for r in late] == [3.0]
    assert sorted((r.high_price, r.version) for r in corrections.latest(changes).collect()) == [(1.0, 1), (4.0, 1)]
    held = spark.read.schema(corrections.STATE).parquet(f"{tmp_path}/state/windows/1").collect()
    assert sorted(r.high for r in held) == [2.0, 4.0]  # the first window is settled and no longer held
