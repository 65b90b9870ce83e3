"""Dense sequential keys without a single-partition window.

``Window.orderBy(k)`` (no partition) or ``Window.partitionBy(site)`` moves a whole
table -- or a whole hot group -- into one task.  ``sequential_index`` numbers rows
1..n inside each group of ``partition_cols`` in ``order_cols`` order using only
distributed steps:

1. range-partition on (group, order) and sort inside partitions -- a hot group is
   spread over many range partitions;
2. tag each row with its partition id and position (``monotonically_increasing_id``
   packs both), then checkpoint so that recomputation cannot move rows;
3. count rows per (partition, group) -- at most partitions + groups rows -- and turn
   the counts into per-group offsets with a window over that small table;
4. key = offset + position within the partition's run of the group + 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

_POS_MASK = (1 << 33) - 1


def _sort_col(c) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(c).asc_nulls_last()


def sequential_index(df: DataFrame, order_cols: Sequence, partition_cols: Sequence[str] = (),
                     out: str = "idx", num_partitions: int | None = None, checkpoint: bool = True,
                     split_ties: bool = True) -> DataFrame:
    """Number rows 1..n per group of ``partition_cols`` in ``order_cols`` order.

    ``split_ties``: rows may repeat on (group, order) -- a hot group of copies.
    Range partitioning cannot split equal keys, so each row first gets a unique
    tie-break id on a checkpointed copy of the input (stable under
    recomputation) and that id becomes the last sort key.  Pass ``False`` when
    the input is known to be distinct on those columns (dimension builders).
    """
    spark = df.sparkSession
    part = list(partition_cols)
    order = [_sort_col(c) for c in order_cols]
    keys = [F.col(c).asc_nulls_last() for c in part] + order
    if split_ties:
        df = reliable_checkpoint(df.withColumn("__tie", F.monotonically_increasing_id()))
        keys = keys + [F.col("__tie").asc()]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    mid = F.monotonically_increasing_id()
    tagged = ranged.withColumn("__pid", F.spark_partition_id()).withColumn(
        "__pos", mid.bitwiseAND(F.lit(_POS_MASK)))
    if checkpoint:
        # Reliable checkpoint (shared spark.checkpoint.dir): partition ids and
        # positions survive executor loss and recomputation.
        tagged = reliable_checkpoint(tagged)
    runs = tagged.groupBy("__pid", *part).agg(F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*part).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1) if part else \
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__offset", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    # runs holds at most (#partitions + #groups) rows; materialised, the planner knows its bytes and broadcasts it
    # below the threshold.
    r = runs.select(F.col("__pid").alias("__rpid"), *[F.col(c).alias(f"__g_{c}") for c in part], "__first",
                    "__offset")
    r = F.broadcast(r) if not part else reliable_checkpoint(r)
    cond = [F.col("__pid") == F.col("__rpid")] + [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in part]
    joined = tagged.join(r, cond, "inner")
    idx = (F.col("__offset") + (F.col("__pos") - F.col("__first")) + 1).cast("long")
    return joined.withColumn(out, idx).drop("__pid", "__pos", "__rpid", "__first", "__offset", "__tie",
                                            *[f"__g_{c}" for c in part])


def dense_keys(df: DataFrame, cols: Sequence[str], out: str, **kw) -> DataFrame:
    """Distinct values of ``cols`` numbered 1..n in sort order (surrogate key of a dimension)."""
    return sequential_index(df.select(*cols).distinct(), order_cols=list(cols), out=out, split_ties=False, **kw)
