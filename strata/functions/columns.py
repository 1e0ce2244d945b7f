"""Scalar column expressions used by the operators.

Spark 4 runs with ANSI mode on, where bad casts, unparsable dates and
division by zero raise. The pipelines we rebuild treat all of these as NULL,
so every cast and division here goes through the ``try_*`` family.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed value: separator of the bronze row hash.
ROW_HASH_SEPARATOR = "||"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_hash(cols: Iterable[ColumnOrName], null_token: str | None = None) -> Column:
    """SHA-256 (lower-case hex) of the columns cast to string, joined by ``||``.

    ``concat_ws`` skips NULLs, so ``(a, NULL, b)`` hashes like ``(a, b)``; pass
    ``null_token`` for a variant where NULL takes a visible place.
    """
    parts = [_col(c).cast("string") for c in cols]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.sha2(F.concat_ws(ROW_HASH_SEPARATOR, *parts), 256)


# Text shape of the ISO date pattern; with it the plain date cast parses
# exactly what ``to_date(s, 'yyyy-MM-dd')`` accepts, at half the cost.
_ISO_DATE_SHAPE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def to_date_safe(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Date from text (NULL when unparsable) or from a date/timestamp column."""
    col = _col(c)
    if fmt is None:
        return F.try_to_date(col)
    if fmt == "yyyy-MM-dd":
        return F.when(col.rlike(_ISO_DATE_SHAPE), col.try_cast("date"))
    return F.try_to_date(col, fmt)


def to_timestamp_ntz_safe(c: ColumnOrName, fmt: str) -> Column:
    """Wall-clock timestamp without time zone from text; NULL when unparsable.

    ``try_to_timestamp`` validates; the NTZ parse only runs on valid rows, so the
    value never passes through the session time zone.
    """
    col = _col(c)
    return F.when(
        F.try_to_timestamp(col, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(col, F.lit(fmt))
    )


def nanos_to_timestamp(c: ColumnOrName) -> Column:
    """Timestamp from a long of nanoseconds since the epoch (pandas-written Parquet
    read with ``nanosAsLong``). Reading the long as seconds would be wrong.

    Floor division in exact integer arithmetic: a double holds about 16
    digits, and epoch nanoseconds have 19. Subtracting the non-negative
    remainder first makes the truncating ``div`` a floor before 1970 too."""
    ns = _col(c)
    thousand = F.lit(1000)
    return F.timestamp_micros(F.call_function("div", ns - F.pmod(ns, thousand), thousand))


def high_value_flag(amount: ColumnOrName, threshold: float) -> Column:
    """True when amount > threshold; false otherwise, NULL amounts included."""
    return F.coalesce(_col(amount) > F.lit(threshold), F.lit(False))


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den, NULL when den is NULL or 0."""
    return F.try_divide(_col(num), _col(den))


def trunc_int(c: ColumnOrName) -> Column:
    """Truncation toward zero, as Python ``int()`` does on a float."""
    return _col(c).cast("int")


def pixel_distance(
    x1: ColumnOrName,
    y1: ColumnOrName,
    x2: ColumnOrName,
    y2: ColumnOrName,
    w: ColumnOrName,
    h: ColumnOrName,
    truncate: bool = True,
) -> Column:
    """Euclidean distance in pixels between two normalised points.

    With ``truncate`` each coordinate is first truncated to an int pixel, so the
    differences are exact integers and ``sqrt(dx*dx + dy*dy)`` is exact to the
    last bit.
    """
    w, h = _col(w), _col(h)
    if truncate:
        dx = (trunc_int(_col(x2) * w) - trunc_int(_col(x1) * w)).cast("double")
        dy = (trunc_int(_col(y2) * h) - trunc_int(_col(y1) * h)).cast("double")
    else:
        dx = (_col(x1) - _col(x2)) * w
        dy = (_col(y1) - _col(y2)) * h
    return F.sqrt(dx * dx + dy * dy)


def clamp(c: ColumnOrName, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(_col(c), F.lit(hi)))


def format_card_money(c: ColumnOrName, prefix: str = "") -> Column:
    """``1,234.50``-style text with two decimals."""
    return F.concat(F.lit(prefix), F.format_number(_col(c), 2))


def format_card_int(c: ColumnOrName, prefix: str = "") -> Column:
    """``1,234``-style text for a whole number."""
    return F.concat(F.lit(prefix), F.format_number(_col(c), 0))
