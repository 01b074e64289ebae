"""Order-independent sums of money.

A sum of doubles depends on the order in which partial sums merge, so it can change between two runs of one job.
Amounts are therefore added as whole millionths. Integer sums stay in generated code and are about ten times cheaper
than sums of wide decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

TICKS_PER_UNIT = 1_000_000
_LOW_BITS = 20


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ticks(price: Column | str) -> Column:
    """An amount in whole ticks of a millionth, as bigint."""
    return F.rint(_col(price) * F.lit(float(TICKS_PER_UNIT))).cast("bigint")


def notional_ticks(price: Column | str = "price", quantity: Column | str = "quantity") -> Column:
    """price * quantity in ticks, a whole number as double, which an extreme trade's notional cannot overflow.

    The product is rounded, not the price, so a tiny price times a large quantity keeps its digits.
    """
    return F.rint(_col(price) * _col(quantity) * F.lit(float(TICKS_PER_UNIT)))


def notional_total(price: Column | str = "price", quantity: Column | str = "quantity") -> Column:
    """Exact sum of notionals in ticks, as ``exact_sum`` gives it; a single notional may reach 9.6e18."""
    x, unit = notional_ticks(price, quantity), float(1 << _LOW_BITS)
    high = F.floor(x / F.lit(unit)).cast("bigint")
    low = (x - high.cast("double") * F.lit(unit)).cast("bigint")
    return _joined(F.sum(high), F.sum(low))


def exact_sum(x: Column | str, over: WindowSpec | None = None) -> Column:
    """Sum of a bigint that cannot overflow.

    The high and low bits are summed apart as bigint and joined at the end as decimal(38,0), so the per-row work
    is two integer additions while the total may pass 2**63.
    """
    x = _col(x)
    high = F.sum(F.shiftright(x, _LOW_BITS))
    low = F.sum(x.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
    if over is not None:
        high, low = high.over(over), low.over(over)
    return _joined(high, low)


def _joined(high: Column, low: Column) -> Column:
    return high.cast("decimal(20,0)") * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low.cast("decimal(20,0)")


def from_ticks(x: Column) -> Column:
    """Ticks back to a double amount."""
    return x.cast("double") / F.lit(float(TICKS_PER_UNIT))


def money_sum(x: Column | str, over: WindowSpec | None = None) -> Column:
    """Exact sum of a tick column, as a double amount."""
    return from_ticks(exact_sum(x, over))


def notional_sum(price: Column | str = "price", quantity: Column | str = "quantity") -> Column:
    """Traded value: the exact sum of price * quantity."""
    return from_ticks(notional_total(price, quantity))


def price_mean(price: Column | str = "price", over: WindowSpec | None = None) -> Column:
    """Mean price from the exact sum in one division; NULL prices do not count."""
    n = F.count(_col(price))
    if over is not None:
        n = n.over(over)
    scaled = F.nullif(n, F.lit(0)).cast("double") * F.lit(float(TICKS_PER_UNIT))
    return exact_sum(ticks(price), over).cast("double") / scaled


def round_half_up(x: Column | str, digits: int = 0) -> Column:
    """Round half up after dropping noise past the eighth decimal, so that 38.394999999999996 rounds as 38.395."""
    return F.round(_col(x).cast("decimal(38,8)"), digits).cast("double")


def quantity_sum(quantity: Column | str = "quantity") -> Column:
    return F.sum(_col(quantity).cast("bigint"))


def vwap_from(value_ticks: Column | str, volume: Column | str) -> Column:
    """Volume-weighted price in one division, NULL without volume.

    Both operands are whole numbers, so the quotient is correctly rounded: one trade's VWAP is its price.
    """
    scaled = F.nullif(_col(volume).cast("double") * F.lit(float(TICKS_PER_UNIT)), F.lit(0.0))
    return _col(value_ticks).cast("double") / scaled


def within(x: Column, low: Column | str, high: Column | str) -> Column:
    """Clamp to a range it can leave only by rounding; NULL stays NULL."""
    return F.when(x.isNotNull(), F.greatest(_col(low), F.least(_col(high), x)))


def vwap(price: Column | str = "price", quantity: Column | str = "quantity") -> Column:
    """Volume-weighted price, NULL where nothing traded."""
    return vwap_from(notional_total(price, quantity), quantity_sum(quantity))


def sample_stddev(x: Column | str, over: WindowSpec | None = None) -> Column:
    """Sample deviation of a bigint from exact moments; NULL below two values.

    Where the moments pass 38 digits, at some 10**8 values of 10**11 ticks, it comes from Spark's running moments in
    doubles, whose last digits may depend on the order of rows.
    """
    wide = _col(x).cast("decimal(19,0)")
    n, s, q, rough = F.count(wide), F.sum(wide), F.try_sum(wide * wide), F.stddev_samp(_col(x).cast("double"))
    if over is not None:
        n, s, q, rough = n.over(over), s.over(over), q.over(over), rough.over(over)
    spread = F.try_subtract(F.try_multiply(n.cast("decimal(19,0)"), q), F.try_multiply(s, s)).cast("double")
    return F.when(n > 1, F.coalesce(F.sqrt(spread / (n.cast("double") * (n - 1).cast("double"))), rough))


def price_stddev(price: Column | str = "price", over: WindowSpec | None = None) -> Column:
    return sample_stddev(ticks(price), over) / F.lit(float(TICKS_PER_UNIT))
