"""Masking and pseudonyms as Column expressions; NULL stays NULL throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapelake.functions import fixedpoint as fp

# Fixed values of the masking contract.
REDACTED = "***REDACTED***"
DELETED_PREFIX = "DELETED-"
NULL_MARK = "\x00"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mask_hash(x: Column | str) -> Column:
    """MD5 hex of the text form."""
    return F.md5(_col(x).cast("string"))


def mask_redact(x: Column | str) -> Column:
    return F.when(_col(x).isNotNull(), F.lit(REDACTED))


def mask_partial(x: Column | str, n: int) -> Column:
    """API form: the first ``n`` characters and three stars, whatever the length."""
    s = _col(x).cast("string")
    return F.when(F.length(s) > n, F.concat(F.left(s, F.lit(n)), F.lit("***"))).when(s.isNotNull(), F.lit("***"))


def mask_partial_padded(x: Column | str, n: int) -> Column:
    """SQL-view form: stars pad to the original length, so only text of at most ``n`` characters changes length."""
    s = _col(x).cast("string")
    stars = F.repeat(F.lit("*"), (F.length(s) - F.lit(n)).cast("int"))
    return F.when(F.length(s) <= n, F.lit("***")).otherwise(F.concat(F.left(s, F.lit(n)), stars))


def mask_round(x: Column | str, n: int) -> Column:
    """Numbers rounded half up to ``n`` decimals."""
    return fp.round_half_up(_col(x).cast("double"), n)


def pseudonym(x: Column | str) -> Column:
    """The stable stand-in for a deleted account: prefix and 16 hex digits of SHA-256."""
    return F.concat(F.lit(DELETED_PREFIX), F.substring(F.sha2(_col(x).cast("string"), 256), 1, 16))


def needs_pseudonym(x: Column | str) -> Column:
    return _col(x).isNotNull() & ~_col(x).startswith(DELETED_PREFIX)


def row_hash(*columns: Column | str) -> Column:
    """Change-detection hash of a dimension row: 16 hex digits over the values joined by a pipe.

    NULL is written as a character that no attribute holds, so it keeps its place and differs from every value.
    """
    values = [F.coalesce(_col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.substring(F.sha2(F.concat_ws("|", *values), 256), 1, 16)
