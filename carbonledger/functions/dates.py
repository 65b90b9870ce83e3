"""Date helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def age_years(birth, at) -> Column:
    """Whole years as ``floor(datediff(at, birth) / 365.25)``."""
    at_col = F.to_date(F.lit(at)) if isinstance(at, (str, dt.date)) else _c(at)
    return F.floor(F.datediff(at_col, _c(birth)) / F.lit(365.25))


def year_month(col) -> Column:
    return F.date_format(_c(col), "yyyy-MM")


def day_range(col, start, end) -> Column:
    """Inclusive day window on a timestamp or date column, written as a half-open
    timestamp range so that Parquet min/max statistics can prune row groups."""
    s = dt.date.fromisoformat(str(start))
    e = dt.date.fromisoformat(str(end)) + dt.timedelta(days=1)
    c = _c(col)
    # String literals are cast to the column's own type (TIMESTAMP or TIMESTAMP_NTZ)
    # and constant-folded, so the predicate reaches the Parquet scan as PushedFilters.
    return (c >= F.lit(f"{s} 00:00:00")) & (c < F.lit(f"{e} 00:00:00"))


def day_range_sql(col: str, start, end) -> str:
    s = dt.date.fromisoformat(str(start))
    e = dt.date.fromisoformat(str(end)) + dt.timedelta(days=1)
    return f"({col} >= TIMESTAMP '{s} 00:00:00' AND {col} < TIMESTAMP '{e} 00:00:00')"
