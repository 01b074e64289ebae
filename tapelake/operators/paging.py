"""Pages deep in a large order: find the range of the order that holds the page, and sort that alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Ranges an order is cut into at a time, rows sampled to cut it, and rows that are simply sorted.
RANGES, SAMPLE, SORTED = 64, 4096, 200_000


@dataclass(frozen=True)
class Key:
    """A column of an order. NULLs come first in a rising order and last in a falling one, as Spark sorts them."""

    name: str
    falling: bool = False

    def column(self) -> Column:
        return F.desc(self.name) if self.falling else F.asc(self.name)

    def before(self, value: object) -> Column:
        c = F.col(self.name)
        if self.falling:
            return c.isNotNull() if value is None else F.coalesce(c > F.lit(value), F.lit(False))
        return F.lit(False) if value is None else F.coalesce(c < F.lit(value), F.lit(True))

    def not_beyond(self, value: object) -> Column:
        """A plain comparison, which files can be skipped by, that all rows up to ``value`` pass."""
        c = F.col(self.name)
        if value is None:
            return F.lit(True)
        return c >= F.lit(value) if self.falling else c.isNull() | (c <= F.lit(value))

    def not_short_of(self, value: object) -> Column:
        """The same for all rows from ``value`` on."""
        c = F.col(self.name)
        if value is None:
            return F.lit(True)
        return c.isNull() | (c <= F.lit(value)) if self.falling else c >= F.lit(value)


def before(order: list[Key], row: Row) -> Column:
    """Whether a row sorts before ``row``."""
    out, same = F.lit(False), F.lit(True)
    for key in order:
        out = out | (same & key.before(row[key.name]))
        same = same & F.col(key.name).eqNullSafe(F.lit(row[key.name]))
    return out


def _from(df: DataFrame, order: list[Key], row: Row) -> DataFrame:
    return df.filter(order[0].not_short_of(row[order[0].name])).filter(~before(order, row))


def _until(df: DataFrame, order: list[Key], row: Row) -> DataFrame:
    return df.filter(order[0].not_beyond(row[order[0].name])).filter(before(order, row))


def _cuts(df: DataFrame, order: list[Key], ranges: int, sample: int) -> list[Row]:
    """Rows that cut the order into about equal ranges, from the rows of least hash."""
    names = [key.name for key in order]
    some = df.select(*names).orderBy(F.xxhash64(*names), *names).limit(sample)
    rows = some.orderBy(*[key.column() for key in order]).collect()
    return list(dict.fromkeys(rows[len(rows) * k // ranges] for k in range(1, ranges))) if rows else []


def _range_of(order: list[Key], cuts: list[Row]) -> Column:
    """The number of the range a row falls in: a search tree over the cuts, so a row is compared with few of them."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(before(order, cuts[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))

    return search(0, len(cuts))


def ranked_page(
    df: DataFrame, order: list[Key], first: int = 20, offset: int = 0, ranges: int = RANGES, sample: int = SAMPLE, most: int = SORTED
) -> DataFrame:
    """The rows of one page, with the total and whether pages exist on either side.

    Rows are counted by range of the order; the ranges that hold the page are cut again until they hold no more than
    ``most`` rows, and only those are sorted. The driver sees ``sample`` rows of keys and ``ranges`` counts at a time,
    however far the page is. ``order`` should be total, or equal rows may change places between pages. These jobs run
    while the DataFrame is built. A page past the end is empty.
    """
    names = [key.column() for key in order]
    total, skip, rest = None, offset, df
    while True:
        cuts = _cuts(rest, order, ranges, sample)
        counts = dict(rest.groupBy(_range_of(order, cuts).alias("range")).count().collect())
        held = sum(counts.values())
        total = held if total is None else total
        if not cuts or not counts:
            break
        sizes, lo, passed = [counts.get(k, 0) for k in range(len(cuts) + 1)], 0, 0
        while lo < len(cuts) and passed + sizes[lo] <= skip:
            passed += sizes[lo]
            lo += 1
        hi, reached = lo, passed + sizes[lo]
        while hi < len(cuts) and reached < skip + first:
            hi += 1
            reached += sizes[hi]
        if lo > 0:
            rest = _from(rest, order, cuts[lo - 1])
        if hi < len(cuts):
            rest = _until(rest, order, cuts[hi])
        skip -= passed
        if reached - passed <= most or reached - passed == held:
            break
    return rest.orderBy(*names).offset(skip).limit(first).withColumns(
        {"total_count": F.lit(total).cast("bigint"), "has_next_page": F.lit(total > offset + first), "has_previous_page": F.lit(offset > 0)}
    )


def page_after(df: DataFrame, order: list[Key], last: Row | dict | None, first: int = 20) -> DataFrame:
    """The page after the row ``last`` of the page before, or the first one: no count, and nothing before is sorted.

    ``order`` must be total. The first key alone is compared plainly as well, so that files before the page are skipped.
    """
    if last is not None:
        same = F.lit(True)
        for key in order:
            same = same & F.col(key.name).eqNullSafe(F.lit(last[key.name]))
        df = _from(df, order, last).filter(~same)
    return df.orderBy(*[key.column() for key in order]).limit(first)
