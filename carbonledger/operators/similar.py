"""Names found under other spellings: q-gram prefix filter, then native edit distance.

Two names within ``d`` edits share many of their q-grams: of the longer one's
(with q - 1 blanks around it) every edit breaks at most q.  So the ``q d + 1``
rarest grams of one and of the other have one in common, and it is enough to
join these prefixes; grams are ordered by how often they occur on both sides, so
the joined ones are rare.  Pairs whose names are both too short to be sure of a
common gram meet through their spellings with up to ``d`` letters left out.
Every candidate pair is then measured by ``levenshtein``; no pair within the
distance is missed.

``normal_name`` makes spellings comparable first: lower case, no accents, letters
and digits only, so ``Los-Angeles`` and ``Losangeles`` are equal.

Defined cases: null or empty names (after normalising) match nothing; names equal
after normalising have distance 0; repeated names give their rows once per
distinct value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

Q, DISTANCE = 2, 2
_ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿß"
_PLAIN = "aaaaaaceeeeiiiinoooooouuuuyys"


def normal_name(col) -> Column:
    """Lower-case letters and digits of a name without accents."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(F.translate(F.lower(c), _ACCENTED, _PLAIN), r"[^\p{L}\p{N}]", "")


def _grams(name: Column, q: int) -> Column:
    """q-grams of a padded name, each with its number among equal ones."""
    pad = F.lit("\x02" * (q - 1))
    text = F.concat(pad, name, pad)
    grams = F.transform(F.sequence(F.lit(1), F.length(text) - q + 1), lambda i: F.substring(text, i, F.lit(q)))
    return F.transform(grams, lambda g, i: F.concat(g, F.size(F.filter(
        F.slice(grams, F.lit(1), i + 1), lambda x: x == g)).cast("string")))


def _shorter(name: Column, d: int) -> Column:
    """The name with up to ``d`` letters left out."""
    out = F.array(name)
    for _ in range(d):
        out = F.array_distinct(F.concat(out, F.flatten(F.transform(out, lambda s: F.transform(
            F.sequence(F.lit(0), F.greatest(F.length(s) - 1, F.lit(0))),
            lambda i: F.concat(F.substring(s, F.lit(1), i), F.substring(s, i + 2, F.length(s))))))))
    return out


def similar_pairs(left: DataFrame, right: DataFrame, block: Sequence[str] = (), max_distance: int = DISTANCE,
                  q: int = Q) -> DataFrame:
    """(block columns, left, right, distance) of all pairs within ``max_distance`` edits.

    ``left`` and ``right`` hold normalised names in a column ``name``; only pairs
    with equal ``block`` columns count (a country, a label's domain).
    """
    d, by = max_distance, list(block)
    sides = {}
    for side, df in (("l", left), ("r", right)):
        df = df.select(*by, "name").filter(F.length("name") > 0).distinct()
        sides[side] = df.withColumn("length", F.length("name"))
    both = reliable_checkpoint(sides["l"].withColumn("side", F.lit("l"))
                               .unionByName(sides["r"].withColumn("side", F.lit("r"))))
    grams = both.select("side", *by, "name", "length", F.explode(_grams(F.col("name"), q)).alias("key"))
    often = reliable_checkpoint(grams.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    rare = (grams.join(often, "key").groupBy("side", *by, "name", "length")
            .agg(F.slice(F.array_sort(F.collect_list(F.struct("n", "key"))), 1, q * d + 1).alias("g"))
            .select("side", *by, "name", "length", F.explode("g.key").alias("key")))
    # Both shorter than this may share no gram.
    brief = (both.filter(F.col("length") < q * d - q + 2)
             .select("side", *by, "name", "length", F.explode(_shorter(F.col("name"), d)).alias("key")))
    keys = reliable_checkpoint(rare.unionByName(brief.withColumn("key", F.concat(F.lit("\x03"), "key"))))
    a = keys.filter("side = 'l'").select(*by, "key", F.col("name").alias("left"), F.col("length").alias("m"))
    b = keys.filter("side = 'r'").select(*by, "key", F.col("name").alias("right"), F.col("length").alias("n"))
    pairs = a.join(b, [*by, "key"]).filter(F.abs(F.col("m") - F.col("n")) <= d).select(*by, "left", "right").distinct()
    return (pairs.withColumn("distance", F.levenshtein("left", "right", d)).filter("distance >= 0")
            .select(*by, "left", "right", "distance"))


def match_names(values: DataFrame, known: DataFrame, value: str, target: str, block: Sequence[str] = (),
                score: str | None = None, max_distance: int = DISTANCE) -> tuple[DataFrame, DataFrame]:
    """(found: block columns, ``value``, ``target``, distance; unmatched: block columns, ``value``).

    For each distinct ``values[value]`` the closest ``known[target]`` spelling:
    smallest distance, then highest ``score`` (if given), then first in order.
    """
    by = list(block)
    v = values.select(*by, value, normal_name(value).alias("name")).distinct()
    best = F.max(score) if score else F.lit(0)
    k = known.select(*by, target, normal_name(target).alias("name"), *([score] if score else [])) \
        .groupBy(*by, target, "name").agg(best.alias("__score"))
    pairs = reliable_checkpoint(similar_pairs(v, k, by, max_distance))
    order = F.struct("distance", -F.col("__score"), F.col(target))
    found = (pairs.join(v.withColumnRenamed("name", "left"), [*by, "left"])
             .join(k.withColumnRenamed("name", "right"), [*by, "right"])
             .groupBy(*by, value).agg(F.min_by(F.struct(target, "distance"), order).alias("x"))
             .select(*by, value, f"x.{target}", "x.distance"))
    found = reliable_checkpoint(found)
    return found, values.select(*by, value).distinct().join(found, [*by, value], "left_anti")


def harmonise_similar(df: DataFrame, column: str, labels: DataFrame, label: str, max_distance: int = DISTANCE
                      ) -> DataFrame:
    """``df`` with ``column`` replaced by its closest label; values that no label is near are kept."""
    found, _ = match_names(df.filter(F.col(column).isNotNull()), labels, column, label, max_distance=max_distance)
    near = found.select(F.col(column).alias("__v"), F.col(label).alias("__label"))
    return (df.join(near, F.col(column) == F.col("__v"), "left")
            .withColumn(column, F.coalesce("__label", F.col(column))).drop("__v", "__label"))
