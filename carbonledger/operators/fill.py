"""Null-fill from a keyed source and anti-join append selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_nulls_by_key(dst: DataFrame, src: DataFrame, key: str | Sequence[str], target: str, value: str,
                      resolve: str = "max") -> DataFrame:
    """Fill nulls of ``dst[target]`` with ``src[value]`` matched on ``key``.

    The source is first reduced to one non-null value per key (``resolve`` =
    max/min/first), so duplicated source keys never multiply destination rows;
    partial aggregation keeps that step cheap even for a hot key.  Non-null
    targets are unchanged and the destination's column order is kept.
    """
    keys = [key] if isinstance(key, str) else list(key)
    agg = {"max": F.max, "min": F.min, "first": F.first}[resolve]
    s = (src.filter(F.col(value).isNotNull()).groupBy(*keys).agg(agg(value).alias("__fill")))
    # One row per key on the right: AQE broadcasts it by its measured size or splits a hot key on the left.
    return (dst.join(s, keys, "left")
            .withColumn(target, F.coalesce(F.col(target), F.col("__fill")))
            .select(*dst.columns))


def new_rows(src: DataFrame, target: DataFrame, key_specs: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """Rows of ``src`` absent from ``target`` under every key spec (a chain of left-anti joins).

    The result has the columns common to both frames, in source order.  Keys are
    compared null-safe: a row whose key is null matches a target row with the
    same null, so appending twice adds nothing.  Without a key spec nothing is
    compared: all rows are new (the caller asked for no de-duplication).
    """
    common = [c for c in src.columns if c in target.columns]
    out = src.select(*common)
    for spec in key_specs or ():
        # distinct first: partial aggregation collapses a hot key before the shuffle
        known = target.select(*[F.col(c).alias(f"__t_{c}") for c in spec]).distinct()
        match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__t_{c}")) for c in spec])
        out = out.join(known, match, "left_anti")
    return out


def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
