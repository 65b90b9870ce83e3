"""Small column-set helpers (projection by name rules, view registration, literal relations)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def drop_prefixed(df: DataFrame, prefixes: Sequence[str] = ("ID_",), keep: Sequence[str] = ()) -> DataFrame:
    """Drop every column whose name starts with one of ``prefixes``, except ``keep``."""
    doomed = [c for c in df.columns if c.startswith(tuple(prefixes)) and c not in set(keep)]
    return df.drop(*doomed)


def common_columns(*frames: DataFrame) -> list[str]:
    """Columns present in every frame, in the first frame's order."""
    first, rest = frames[0], frames[1:]
    return [c for c in first.columns if all(c in f.columns for f in rest)]


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def site_dimension(spark: SparkSession, sites: Mapping[int, str] | None = None) -> DataFrame:
    """The site relation (key, name) as a DataFrame; defaults to the reference's six sites."""
    from ..fixed import SITES
    rows = sorted((sites or SITES).items())
    schema = T.StructType([T.StructField("site_id", T.IntegerType(), False), T.StructField("site", T.StringType(), False)])
    return spark.createDataFrame(rows, schema)
