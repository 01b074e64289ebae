"""Order-book analytics per snapshot; stateless, so the batch and streaming forms are the same transformation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.functions.book import book_metrics


def orderbook_metrics(books: DataFrame) -> DataFrame:
    """Spread, depth and imbalance of snapshots with array sides; a snapshot lacking a side or holding a level without
    price or quantity is malformed and dropped."""

    def sound(side: str):
        return F.forall(side, lambda v: v["price"].isNotNull() & v["quantity"].isNotNull())

    rows = books.filter(F.coalesce(sound("bids") & sound("asks"), F.lit(False)))
    return rows.withColumns(book_metrics(F.col("bids"), F.col("asks"))).drop("bids", "asks")
