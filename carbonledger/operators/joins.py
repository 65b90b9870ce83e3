"""Join shapes that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint


def left_join_dimension(dim: DataFrame, facts: DataFrame, keys: Sequence[str], materialize: bool = True
                        ) -> DataFrame:
    """``dim LEFT JOIN facts`` for a ``dim`` with one row per key and ``facts`` that may be skewed.

    AQE splits a skewed sort-merge partition only on the left (streamed) side
    of a left outer join, so one key holding a third of the facts would be
    joined by one task.  The same result is built as

      (facts INNER JOIN dim)  -- AQE can split the hot fact partition
      UNION ALL
      (dim LEFT ANTI JOIN distinct(facts.keys))  -- partial aggregation first
                                                  -- collapses a hot key to one row per task

    with the fact-only columns null on the second branch.  ``facts`` is used
    twice, so it is materialised once (reliable checkpoint) unless
    ``materialize=False``.
    """
    keys = list(keys)
    f = reliable_checkpoint(facts) if materialize else facts
    matched = f.join(dim, keys, "inner")
    seen = f.select(*keys).distinct()
    lonely = dim.join(seen, keys, "left_anti")
    types = dict(f.dtypes)
    fact_only = [c for c in f.columns if c not in dim.columns]
    lonely = lonely.select(*dim.columns, *[F.lit(None).cast(types[c]).alias(c) for c in fact_only])
    return matched.unionByName(lonely.select(*matched.columns))
