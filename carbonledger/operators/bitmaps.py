"""Distinct counts that add up: bitmaps over dense keys.

A table of distinct persons per (site, function, month) cannot be added up to
years or to all sites, because a person may be in several cells.  A bitmap per
cell can: cells are united by ``bitmap_or_agg`` and counted by ``bitmap_count``,
so any total over any of the columns comes from one stored table, and the tables of
two periods or sites are merged in the same way.

Keys are whole numbers from 0 on, dense by construction (a surrogate key of a
registry); a bitmap covers 32,768 of them, so a cell has a row per range of keys
that it touches, and a group of any size is built by partial aggregation.  Null
keys count for nothing, as in ``count(DISTINCT ...)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmap_cells(df: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """(``by`` columns, bucket, bitmap): the distinct keys of every cell."""
    return (df.filter(F.col(key).isNotNull())
            .groupBy(*by, F.bitmap_bucket_number(F.col(key)).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))).alias("bitmap")))


def merge_cells(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cells with fewer columns, or the cells of several tables united."""
    return cells.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_keys(cells: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    """Number of distinct keys per ``by`` columns (one row for none)."""
    merged = merge_cells(cells, by).select(*by, F.bitmap_count("bitmap").alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias(out)
    return merged.groupBy(*by).agg(total) if by else merged.agg(total)
