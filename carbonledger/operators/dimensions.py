"""Dimension builder: pool columns -> distinct -> drop blanks -> surrogate key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_sentinel, is_blank
from .keys import sequential_index
from .registry import register_keys


def pool(frames: Sequence[DataFrame], columns: Sequence[Sequence[str]], names: Sequence[str]) -> DataFrame:
    """Union (by position) the ``columns[i]`` of ``frames[i]`` renamed to ``names``."""
    parts = [f.select(*[F.col(c).alias(n) for c, n in zip(cols, names)]) for f, cols in zip(frames, columns)]
    return reduce(lambda a, b: a.unionByName(b), parts)


def build_dimension(values: DataFrame, key: str, blank_policy: str = "drop", sentinel: str = "NULL",
                    order_cols: Sequence[str] | None = None, bounded: bool = False,
                    registry: str | None = None) -> DataFrame:
    """Distinct rows of ``values`` with a dense ``key`` 1..n in sort order.

    ``blank_policy``: ``"drop"`` removes rows where any column is null/blank,
    ``"sentinel"`` replaces blanks by ``sentinel`` (the notebook's ``"NULL"``
    model), ``"keep"`` keeps them as they are.  ``bounded``: the values come
    from a domain of fixed size (labels, calendar days, a gazetteer), so the
    distinct values are numbered by one window instead of a range partitioning.
    ``registry``: path of a key registry (``operators.registry``); values it holds
    keep their key over builds, and the dimension is the whole registry.
    """
    cols = values.columns
    if blank_policy == "drop":
        cond = reduce(lambda a, b: a & b, [~is_blank(F.col(c).cast("string")) for c in cols])
        values = values.filter(cond)
    elif blank_policy == "sentinel":
        values = values.select(*[blank_to_sentinel(F.col(c), sentinel).alias(c) for c in cols])
    elif blank_policy != "keep":
        raise ValueError(f"unknown blank_policy {blank_policy!r}")
    if registry:
        return register_keys(values, registry, key)
    distinct = values.distinct()
    if bounded:
        order = [F.col(c).asc_nulls_last() for c in (order_cols or cols)]
        return distinct.select(F.row_number().over(Window.orderBy(*order)).cast("long").alias(key), *cols)
    keyed = sequential_index(distinct, order_cols=list(order_cols or cols), out=key,
                             split_ties=order_cols is not None)
    return keyed.select(key, *cols)
