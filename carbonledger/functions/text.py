"""String helpers for dirty delimited input (all native expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_blank(col) -> Column:
    """Null or only whitespace (the raw drops use a single space for 'missing')."""
    c = _c(col)
    return c.isNull() | (F.trim(c) == "")


def blank_to_null(col) -> Column:
    c = _c(col)
    return F.when(is_blank(c), F.lit(None).cast("string")).otherwise(F.trim(c))


def blank_to_sentinel(col, sentinel: str = "NULL") -> Column:
    c = _c(col)
    return F.when(is_blank(c), F.lit(sentinel)).otherwise(c)


def canonical_label(col) -> Column:
    """Trimmed, case-folded key for exact joins between dirty category spellings."""
    return F.lower(F.trim(_c(col)))


def parse_place(col) -> Column:
    """Parse ``"City, Country"`` into ``struct(city, country)``.

    Null when blank or when the text holds more than one comma; the country is
    null when there is no comma.
    """
    c = _c(col)
    parts = F.split(c, ",")
    ok = ~is_blank(c) & (F.size(parts) <= 2)
    city = F.trim(F.element_at(parts, 1))
    country = F.when(F.size(parts) == 2, F.trim(F.element_at(parts, 2)))
    return F.when(ok & (city != ""), F.struct(city.alias("city"), country.alias("country")))


def clamp_low(col, minimum) -> Column:
    """``max(col, minimum)`` that keeps nulls null (``greatest`` would not)."""
    c = _c(col)
    return F.when(c < F.lit(minimum), F.lit(minimum)).otherwise(c)
