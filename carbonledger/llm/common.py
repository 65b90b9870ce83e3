"""Helpers shared by the corpus operators: tables, word pattern, lineage cuts, size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

#: A word is a maximal run of anything but ASCII white space (space, \t \n \v \f \r).
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Cut the lineage: write a frame once as Parquet in the shared checkpoint folder and reread it.
cut = reliable_checkpoint


def words_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, everything else unchanged."""
    return F.translate(text, UPPER, LOWER)


def unsigned_crc_mod(key: Column, m: int) -> Column:
    """crc32 of the key's decimal text, modulo ``m`` (null key: null)."""
    return F.crc32(key.cast("string").cast("binary")) % m


def broadcast_if_small(df: DataFrame, rows: int, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` when its measured row count is at most ``max_rows``; beyond, AQE chooses the join."""
    return F.broadcast(df) if rows <= max_rows else df
