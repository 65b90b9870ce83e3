"""Gazetteer matching, route distance and mission distance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import geodesic_km
from ..functions.rules import rule_expr
from ..functions.text import clamp_low
from .similar import match_names


def gazetteer_match(places: DataFrame, candidates: DataFrame, allowed_types: Sequence[str],
                    score: str = "score", tiebreak: str = "display_name") -> tuple[DataFrame, DataFrame]:
    """Pick one coordinate per (city, country) from geocoder-style candidates.

    ``places``: (city, country) to locate.  ``candidates``: (city, country,
    display_name, place_type, lat, lon, score).  Candidates of an allowed type
    compete per place; the highest score wins, ties broken by ``tiebreak``.
    The choice is an aggregate (``max_by``), so a place with a huge number of
    candidates is reduced by partial aggregation instead of one sorted group.
    Returns (gazetteer(country, city, lat, lon), not_found(country, city)).
    """
    ok = candidates.filter(F.col("place_type").isin(list(allowed_types)) & F.col("lat").isNotNull()
                           & F.col("lon").isNotNull())
    best = (ok.groupBy("city", "country")
            .agg(F.max_by(F.struct("lat", "lon"), F.struct(F.col(score), F.col(tiebreak))).alias("__b"))
            .select("country", "city", F.col("__b.lat").alias("lat"), F.col("__b.lon").alias("lon")))
    wanted = places.select("country", "city").distinct()
    found = wanted.join(best, ["country", "city"], "inner")
    missing = wanted.join(best, ["country", "city"], "left_anti")
    return found, missing


def with_route_distance(df: DataFrame, gazetteer: DataFrame, dep=("dep_city", "dep_country"),
                        dst=("dst_city", "dst_country"), out: str = "km_one_way") -> DataFrame:
    """Add the geodesic km between departure and destination.

    The gazetteer is joined twice (role-playing) on (city, country) -- never on
    the city alone; the planner broadcasts it below the byte threshold.  An
    unknown place gives a null distance (left joins keep the trip).
    """
    g = gazetteer.select("city", "country", "lat", "lon")
    d = g.select(F.col("city").alias("__dc"), F.col("country").alias("__dk"), F.col("lat").alias("__dlat"),
                 F.col("lon").alias("__dlon"))
    a = g.select(F.col("city").alias("__ac"), F.col("country").alias("__ak"), F.col("lat").alias("__alat"),
                 F.col("lon").alias("__alon"))
    j = (df.join(d, (F.col(dep[0]) == F.col("__dc")) & (F.col(dep[1]) == F.col("__dk")), "left")
         .join(a, (F.col(dst[0]) == F.col("__ac")) & (F.col(dst[1]) == F.col("__ak")), "left"))
    return (j.withColumn(out, geodesic_km("__dlat", "__dlon", "__alat", "__alon"))
            .drop("__dc", "__dk", "__dlat", "__dlon", "__ac", "__ak", "__alat", "__alon"))


def mission_distance(df: DataFrame, one_way: str = "km_one_way", is_return: str = "is_return",
                     min_km: float | None = None, out: str = "distance_km") -> DataFrame:
    """Total trip km: one-way x 2 for a return trip, then floored at ``min_km``.

    The distance is computed once and multiplied (not evaluated in both branches).
    A falsy ``min_km`` (None or 0) disables the floor; a null distance stays null.
    """
    km = F.col(one_way) * F.when(F.col(is_return), F.lit(2.0)).otherwise(F.lit(1.0))
    if min_km:
        km = clamp_low(km, float(min_km))
    return df.withColumn(out, km)


def adjust_distance(df: DataFrame, rules, condition_col: str = "transport", target_col: str = "distance_km",
                    out: str = "adjusted_km") -> DataFrame:
    return df.withColumn(out, rule_expr(condition_col, target_col, rules))


def unlocated_places(trips: DataFrame, gazetteer: DataFrame, dep=("dep_city", "dep_country"),
                     dst=("dst_city", "dst_country")) -> DataFrame:
    """Trip ends missing from the gazetteer, counted per place and role (departure / destination).

    Those trips get a null distance and, for known modes, a null emission --
    never a silent 0 -- so this report is the reject count that goes with
    every distance-based total.  Both ends are pooled and counted (partial
    aggregation per task), then the places are anti-joined to the gazetteer on
    (city, country).
    """
    d = trips.select(F.lit("departure").alias("role"), F.col(dep[0]).alias("city"), F.col(dep[1]).alias("country"))
    a = trips.select(F.lit("destination").alias("role"), F.col(dst[0]).alias("city"), F.col(dst[1]).alias("country"))
    g = gazetteer.select("city", "country").distinct()
    ends = d.unionByName(a).groupBy("role", "city", "country").agg(F.count(F.lit(1)).alias("n_trips"))
    known = (F.col("e.city").eqNullSafe(F.col("g.city"))) & (F.col("e.country").eqNullSafe(F.col("g.country")))
    return ends.alias("e").join(g.alias("g"), known, "left_anti")


def gazetteer_match_similar(places: DataFrame, candidates: DataFrame, allowed_types: Sequence[str],
                            score: str = "score", tiebreak: str = "display_name", max_distance: int = 2
                            ) -> tuple[DataFrame, DataFrame]:
    """``gazetteer_match`` that also finds places under other spellings, within one country.

    Names that are found as they are stay so; the others take the closest known
    spelling of their country (``operators.similar``) and its best candidate.
    Returns (country, city, matched_city, distance, lat, lon) and the places not found.
    """
    found, missing = gazetteer_match(places, candidates, allowed_types, score, tiebreak)
    usable = candidates.filter(F.col("place_type").isin(list(allowed_types)) & F.col("lat").isNotNull()
                               & F.col("lon").isNotNull())
    known = usable.select("country", F.col("city").alias("matched_city"), score)
    near, unmatched = match_names(missing.select("country", "city"), known, "city", "matched_city", ["country"], score,
                                  max_distance)
    spots, _ = gazetteer_match(near.select("country", F.col("matched_city").alias("city")), usable, allowed_types, score,
                               tiebreak)
    others = near.join(spots.withColumnRenamed("city", "matched_city"), ["country", "matched_city"])
    exact = found.select("country", "city", F.col("city").alias("matched_city"), F.lit(0).alias("distance"), "lat", "lon")
    return exact.unionByName(others.select(*exact.columns)), unmatched
