"""Surrogate keys that survive a rebuild.

A registry is a Parquet table of values and their keys.  ``register_keys`` keeps
the key of every value it holds and numbers the new ones after the highest key,
in order and without gaps: the new values are range-partitioned and numbered by
offsets (``sequential_index``), so no task sees them all.  The new rows are
appended in one write; a build that fails before it changes nothing, and a build
repeated after it finds its values registered.  One writer at a time is assumed.

Values that a later build does not contain keep their row, so a key is never used
twice.  Nulls are values like any other (dimension builders drop or replace blanks
before).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, table_scope
from ..sources.sinks import path_exists
from .keys import sequential_index


def register_keys(values: DataFrame, path: str, key: str) -> DataFrame:
    """The registry at ``path`` (``key`` and the columns of ``values``) after adding the values it lacks."""
    spark, cols = values.sparkSession, values.columns
    with table_scope(spark):
        fresh, top = values.distinct(), 0
        if path_exists(spark, path):
            known = spark.read.parquet(path)
            top = known.agg(F.max(key)).first()[0] or 0
            same = reduce(lambda a, b: a & b, [F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}")) for c in cols])
            fresh = fresh.alias("n").join(known.alias("k"), same, "left_anti")
        fresh = reliable_checkpoint(fresh)
        if not top or not fresh.isEmpty():
            numbered = sequential_index(fresh, cols, out=key, split_ties=False)
            rows = reliable_checkpoint(numbered.select((F.col(key) + top).alias(key), *cols))
            rows.write.mode("append").parquet(path)
    return spark.read.parquet(path).select(key, *cols)
