"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Every source has a weight and a size (its words).  The mix shares a budget by
weight, but no source may be repeated more than ``max_epochs`` times:

1. water level ``t`` = (budget - sum of capped sources' limits) / (sum of the
   other sources' weights); a source whose ``t * weight`` is above its limit is
   clamped to the limit and the excess is reshared.  Clamped sources stay
   clamped (the level only rises), so the rounds end when none is above.
2. epochs of a source = target / size.  Every document is taken
   floor(epochs) times whole; the fractional rest takes one more copy of a
   seeded part of the documents.  Documents fall into 4096 buckets by a hash of
   (seed, doc_id); the buckets are gone through in order (those far above the mean
   first, the largest before the others), and each is taken if it still fits, so
   one that does not is passed over and the filling goes on.
   Of the buckets left over, the one with the most documents is split by
   further digits of the hash and filled in the same way, and once more
   (``LEVELS``).  A source stays below its target by less than what the smallest
   bucket left at the last level holds: a document, unless a billion share a
   source.  Reruns agree, since nothing depends on partitioning.

Scale: a partial aggregation (source, bucket) per level and a join of each
document with its source's row; the filling of a source sees its at most 4096
buckets, a hot source is pre-aggregated map-side.  The water-filling works on the
table of sources; only three sums per round reach the driver.

Defined cases: null text has size 0; a null source is a source of its own, last
in order; a null or repeated doc_id is a document like any other (equal ids
are taken together); sources of size 0 get target 0; an empty table
gives an empty result; other columns are carried along untouched by
``apply_mix`` (working columns are prefixed and cannot clash).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, words_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 17
BUCKETS_HEX = 3  # 16**3 = 4096 buckets
LEVELS = 3
LARGE = 8  # buckets above so many times the mean go first: they would hardly fit later
PLAN_ROWS = 20_000  # of a broadcast plan: some 2 KB a source


def bucket_of(doc_id: Column, seed: int = SEED, level: int = 0) -> Column:
    """Seeded bucket 0..4095 of a document id; each level takes further digits of one hash."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    digits = F.substring(F.md5(key.cast("binary")), 1 + level * BUCKETS_HEX, BUCKETS_HEX)
    return F.conv(digits, 16, 10).cast("int")


def buckets_of(doc_id: Column, seed: int) -> list[Column]:
    return [bucket_of(doc_id, seed, level).alias(f"b{level}") for level in range(LEVELS)]


def source_sizes(sized: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """One row per source: size and weight (weights repeat over the sources in code point order, null last)."""
    per = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    # One row per source: the order over this table is a window on the pre-aggregated sources.
    pos = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (pos % len(weights) + 1).cast("int"))
    return per.withColumn("weight", w)


def water_fill(sources: DataFrame, budget: float | None = None, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to a table of (source, source_size, weight).  ``budget``: all sizes by default."""
    lim = F.col("source_size") * F.lit(float(max_epochs))
    total, = sources.agg(F.sum("source_size")).first()
    budget = float(total or 0) if budget is None else float(budget)
    level = 0.0
    while True:
        over = F.lit(level) * F.col("weight") >= lim
        capped, rest, n = sources.agg(
            F.coalesce(F.sum(F.when(over, lim)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(over, 1))).first()
        new = max(level, (budget - capped) / rest) if rest else level
        newly = sources.filter((F.lit(new) * F.col("weight") >= lim) & ~over).count() if rest else 0
        level = new
        if not newly:
            break
    return sources.withColumn("target", F.least(F.lit(level) * F.col("weight"), lim))


_FILLED = "source string, words array<long>, pick int, room double"


def fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """Buckets of one source (bucket, mass, n, room) gone through in order; those taken as bits of 64 words, the
    bucket to split next and the room left."""
    large = pdf["mass"] * len(pdf) > LARGE * pdf["mass"].sum()
    pdf = pdf.assign(first=(-pdf["mass"]).where(large, 0)).sort_values(["first", "bucket"])
    room, words, pick = float(pdf["room"].iloc[0]), np.zeros(16 ** BUCKETS_HEX // 64, np.uint64), (0, None)
    for bucket, mass, n in zip(pdf["bucket"].tolist(), pdf["mass"].tolist(), pdf["n"].tolist()):
        if mass <= room:
            room -= mass
            words[bucket >> 6] |= np.uint64(1 << (bucket & 63))
        elif n > pick[0]:
            pick = (n, bucket)
    return pd.DataFrame({"source": pdf["source"].iloc[:1].tolist(), "words": [words.view(np.int64)],
                         "pick": pd.array([pick[1]], "Int32"), "room": [room]})


def _bit(words: Column, bucket: Column) -> Column:
    word = F.get(words, F.shiftright(bucket, 6))
    return F.coalesce(F.call_function("shiftright", word, bucket.bitwiseAND(63)).bitwiseAND(F.lit(1).cast("long")) == 1,
                      F.lit(False))


def plan_mix(sized: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS,
             budget: float | None = None) -> DataFrame:
    """Per source: source_size, weight, target, whole (epochs for all) and, per level, the words of the buckets with
    an extra copy and the bucket that the next level splits.  ``sized`` has source, size, b0, b1, b2."""
    srcs = cut(source_sizes(sized, weights))
    srcs = water_fill(srcs, budget, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = (srcs.withColumn("whole", F.floor(epochs).cast("long"))
            .withColumn("room", F.col("target") - F.col("whole") * F.col("source_size")))
    for level in range(LEVELS):
        plan = cut(plan)
        own = F.col("source").eqNullSafe(F.col("p_source"))
        for above in range(level):  # documents of the bucket that is split
            own &= F.col(f"b{above}") == F.col(f"pick{above}")
        p = plan.withColumnRenamed("source", "p_source").select("p_source", "room", *[f"pick{a}" for a in range(level)])
        rows = sized if not level else sized.join(broadcast_if_small(p, plan.count(), PLAN_ROWS), own).select(sized["*"])
        # At most 4096 rows per source, whatever its size.
        buckets = rows.groupBy("source", F.col(f"b{level}").alias("bucket")).agg(
            F.sum("size").alias("mass"), F.count(F.lit(1)).alias("n"))
        filled = (buckets.join(p.select("p_source", "room"), F.col("source").eqNullSafe(F.col("p_source")))
                  .select("source", "bucket", "mass", "n", "room").groupBy("source").applyInPandas(fill, _FILLED)
                  .select(F.col("source").alias("f_source"), F.col("words").alias(f"words{level}"),
                          F.col("pick").alias(f"pick{level}"), F.col("room").alias("left")))
        plan = (plan.join(filled, F.col("source").eqNullSafe(F.col("f_source")), "left")
                .withColumn("room", F.coalesce("left", "room")).drop("f_source", "left"))
    return plan


def copies_of(prefix: str = "") -> Column:
    """Copies of a document (b0, b1, b2) by its source's plan."""
    def c(name):
        return F.col(prefix + name)

    extra = F.lit(False)
    for level in range(LEVELS - 1, -1, -1):
        deeper = extra & F.coalesce(c(f"b{level}") == c(f"pick{level}"), F.lit(False))
        extra = _bit(c(f"words{level}"), c(f"b{level}")) | deeper
    return c("whole") + extra.cast("long")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS,
        budget: float | None = None, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target (its source's), copies, taken = size * copies."""
    sized = cut(docs.select("doc_id", "source", words_count(F.col("text")).alias("size"),
                            *buckets_of(F.col("doc_id"), seed)))
    plan = cut(plan_mix(sized, weights, max_epochs, budget))
    plan = broadcast_if_small(plan.withColumnRenamed("source", "p_source"), plan.count(), PLAN_ROWS)
    return (sized.join(plan, F.col("source").eqNullSafe(F.col("p_source")))
            .select("doc_id", "source", "size", "source_size", "target", copies_of().alias("copies"),
                    (F.col("size") * copies_of()).alias("taken")))


def apply_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS,
              budget: float | None = None, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every document repeated as often as the mix takes it (0 times: left out)."""
    cols = docs.columns
    sized = cut(docs.select("doc_id", "source", words_count(F.col("text")).alias("size"),
                            *buckets_of(F.col("doc_id"), seed)))
    plan = cut(plan_mix(sized, weights, max_epochs, budget))
    used = ["whole", *[f"{x}{level}" for level in range(LEVELS) for x in ("words", "pick")]]
    p = plan.select(F.col("source").alias("__mix_source"), *[F.col(c).alias(f"__mix_{c}") for c in used])
    p = broadcast_if_small(p, plan.count(), PLAN_ROWS)
    placed = docs.withColumns({f"__mix_b{level}": bucket_of(F.col("doc_id"), seed, level) for level in range(LEVELS)})
    return (placed.join(p, F.col("source").eqNullSafe(F.col("__mix_source")))
            .withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(1), copies_of("__mix_").cast("int"))))
            .select(*cols))
