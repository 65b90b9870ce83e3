"""Grouped totals with a labelled coarser level (one scan, GROUPING SETS)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def totals_with_label(df: DataFrame, fine: Sequence[str], coarse: Sequence[str], label_col: str, label: str,
                      aggs: Sequence[Column]) -> DataFrame:
    """Aggregate at ``fine`` and at ``coarse`` in one pass; rows of the coarse
    level carry ``label`` in ``label_col`` (e.g. site = "Global Total").

    ``label_col`` must be in ``fine`` and not in ``coarse``.  ``grouping()``
    tells real nulls apart from rolled-up ones.
    """
    fine, coarse = list(fine), list(coarse)
    g = df.groupingSets([fine, coarse], *fine).agg(*aggs, F.grouping(label_col).alias("__g"))
    return g.withColumn(label_col, F.when(F.col("__g") == 1, F.lit(label)).otherwise(F.col(label_col).cast("string"))
                        ).drop("__g")
