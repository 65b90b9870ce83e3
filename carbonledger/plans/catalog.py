"""Registered queries: Spark implementation and SQL oracle, side by side.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs on the whole driver tables.
``ORACLE[name]`` is the same computation as DuckDB SQL over the same tables.
Measures are rounded identically on both sides (sums of doubles are
order-dependent), and every top-k has a total tie-break.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.emissions import FACTOR_SCHEMA, emission, emissions_by_join, factor_table
from ..functions.geo import geodesic_exact_km, geodesic_sql
from ..functions.rules import apply_rules_by_join
from ..functions.text import parse_place
from ..operators.bitmaps import bitmap_cells, count_keys
from ..operators.broadcast import fixed_broadcast
from ..operators.dimensions import build_dimension
from ..operators.fill import fill_nulls_by_key, new_rows
from ..operators.harmonise import harmonise, translation_table
from ..operators.impute import impute_category, impute_pair
from ..operators.places import (adjust_distance, gazetteer_match, gazetteer_match_similar, mission_distance,
                                 unlocated_places, with_route_distance)
from ..operators.similar import match_names
from ..operators.quality import has_atypicals, max_by_condition, profile, unique_values
from ..session import reliable_checkpoint, scoped, scratch_folder
from ..sources import schemas
from ..sources.headers import batch_lines
from ..sources.key_index import KeyIndex
from ..sources.raw import parse_drops
from . import oracle_text as text
from . import questions as q
from . import star
from .model import DriverModel, ModelSQL
from .refresh import TripStore

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = scoped(lambda spark, sf_dir: fn(DriverModel(spark, sf_dir)))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


S = ModelSQL
MAY_OCT = ("1998-05-01", "1998-10-31")
MAY_SEP = ("1998-05-01", "1998-09-30")
JULY = ("1998-07-01", "1998-07-31")
JUNE = ("1998-06-01", "1998-06-30")
MAY = ("1998-05-01", "1998-05-31")
JUL_SEP = ("1998-07-01", "1998-09-30")
EUROPE = (1, 3, 4)
T = "1000.0e0"


def _in(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


# --- Q1-Q3 headcount --------------------------------------------------------
@register("headcount_by_function", f"""
WITH per AS ({S.persons()}), mis AS ({S.missions()})
SELECT site_id, job_function, count(DISTINCT person_id) AS headcount
FROM (SELECT p.person_id, p.site_id, p.job_function FROM per p LEFT JOIN mis m ON p.person_id = m.person_id) f
GROUP BY GROUPING SETS ((site_id, job_function), (job_function))""")
def _q1(m):
    return q.headcount_by_function(m)


# --- Q4-Q7 purchases --------------------------------------------------------
@register("purchase_count_window", f"""
WITH {S.equipment_ctes(MAY_OCT)}
SELECT count(*) AS n_purchases FROM eq WHERE equip_type = 'PC portable'""")
def _q4(m):
    return q.purchase_count_window(m, "PC portable", MAY_OCT)


@register("purchase_carbon", f"""
WITH {S.equipment_ctes(MAY_OCT)}
SELECT count(*) AS n_purchases, round(sum(impact_kg) / {T}, 2) AS carbon_t FROM eqi WHERE equip_type = 'PC portable'""")
def _q5(m):
    return q.purchase_carbon(m, "PC portable", MAY_OCT)


@register("purchase_carbon_sites_function", f"""
WITH {S.equipment_ctes(MAY_SEP)}
SELECT count(*) AS n_purchases, round(sum(impact_kg) / {T}, 2) AS carbon_t FROM eqi
WHERE equip_type = 'PC fixe sans ecran' AND site_id IN (1, 4) AND job_function = 'Data Engineer'""")
def _q6(m):
    return q.purchase_carbon(m, "PC fixe sans ecran", MAY_SEP, sites=[1, 4], job_function="Data Engineer")


@register("purchase_carbon_function", f"""
WITH {S.equipment_ctes(MAY_SEP)}
SELECT count(*) AS n_purchases, round(sum(impact_kg) / {T}, 2) AS carbon_t FROM eqi
WHERE equip_type = 'Ecran' AND job_function = 'Business Executive'""")
def _q7(m):
    return q.purchase_carbon(m, "Ecran", MAY_SEP, job_function="Business Executive")


# --- Q8, Q13 period emissions ----------------------------------------------
@register("site_period_emissions", f"""
WITH {S.enriched_ctes(JULY, EUROPE)}
SELECT count(*) AS n_missions, count(*) - count(km_one_way) AS n_unlocated,
       round(sum(carbon_kg) / {T}, 2) AS carbon_t FROM em""")
def _q8(m):
    return q.period_emissions(m, JULY, EUROPE)


@register("site_type_period_emissions", f"""
WITH {S.enriched_ctes(JULY, (2,))}
SELECT count(*) AS n_missions, count(*) - count(km_one_way) AS n_unlocated,
       round(sum(carbon_kg) / {T}, 2) AS carbon_t FROM em
WHERE mission_type = 'Vocational Training'""")
def _q13(m):
    return q.period_emissions(m, JULY, [2], mission_type="Vocational Training")


@register("site_period_emissions_dedup", f"""
WITH {S.enriched_ctes(JULY, EUROPE)}
SELECT count(*) AS n_missions, count(*) - count(km_one_way) AS n_unlocated,
       round(sum(carbon_kg) / {T}, 2) AS carbon_t FROM (
  SELECT DISTINCT person_id, mission_date, dep_city, dep_country, dst_city, dst_country, transport, is_return,
         km_one_way, carbon_kg FROM em) d""")
def _q8_dedup(m):
    return q.period_emissions(m, JULY, EUROPE, dedup="reference")


# --- Q9 top days ----------------------------------------------------------------
@register("top_emission_days", f"""
WITH {S.enriched_ctes()}
SELECT mission_date, round(kg / {T}, 2) AS carbon_t FROM (
  SELECT mission_date, sum(carbon_kg) AS kg FROM em WHERE transport = 'plane' GROUP BY mission_date) d
ORDER BY kg DESC, mission_date LIMIT 5""")
def _q9(m):
    return q.top_emission_days(m, 5, fixed.PLANE)


# --- Q10, Q11 combined ------------------------------------------------------
def _combined_sql(by: str, site_name: bool = False, how: str = "JOIN", missing: str = "") -> str:
    name_join = "JOIN st ON x.site_id = st.site_id" if site_name else ""
    name_col = "st.site, " if site_name else ""
    return f"""
WITH {S.enriched_ctes()}, {S.equipment_ctes()},
a AS (SELECT {by}, sum(carbon_kg) AS mk FROM em {missing} GROUP BY {by}),
b AS (SELECT {by}, sum(impact_kg) AS ek FROM eqi GROUP BY {by}),
x AS (SELECT coalesce(a.{by}, b.{by}) AS {by}, coalesce(a.mk, 0.0e0) AS mk, coalesce(b.ek, 0.0e0) AS ek
      FROM a {how} b ON a.{by} = b.{by})
SELECT CAST(row_number() OVER (ORDER BY mk + ek DESC, x.{by}) AS INTEGER) AS rank, x.{by}, {name_col}
       round(mk / {T}, 2) AS mission_t, round(ek / {T}, 2) AS equipment_t, round((mk + ek) / {T}, 2) AS total_t
FROM x {name_join}"""


@register("emissions_by_function_combined", _combined_sql("job_function"))
def _q10(m):
    return q.combined_emissions(m, "job_function")


@register("emissions_by_site_combined", _combined_sql("site_id", site_name=True))
def _q11(m):
    return q.emissions_by_site_combined(m)


@register("emissions_by_model_full_outer", f"""
WITH {S.enriched_ctes()}, {S.equipment_ctes()},
a AS (SELECT dep_city AS label, sum(carbon_kg) AS mk FROM em GROUP BY dep_city),
b AS (SELECT CASE WHEN equip_model < 'Brand#30' THEN 'NATION_' || CAST(site_id AS VARCHAR) ELSE equip_model END AS label,
             sum(impact_kg) AS ek FROM eqi GROUP BY 1)
SELECT coalesce(a.label, b.label) AS label, round(coalesce(mk, 0.0e0) / {T}, 2) AS mission_t,
       round(coalesce(ek, 0.0e0) / {T}, 2) AS equipment_t
FROM a FULL OUTER JOIN b ON a.label = b.label""")
def _j10_outer(m):
    """Groups that only one side has stay, with 0 for the other: places of departure and models under one label."""
    a = m.enriched_missions().groupBy(F.col("dep_city").alias("label")).agg(F.sum("carbon_kg").alias("mk"))
    label = F.when(F.col("equip_model") < "Brand#30", F.concat(F.lit("NATION_"), F.col("site_id").cast("string"))) \
        .otherwise(F.col("equip_model"))
    b = m.equipment_with_impact().groupBy(label.alias("label")).agg(F.sum("impact_kg").alias("ek"))
    t = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.0)) / 1000.0, 2)
    return a.join(b, "label", "full_outer").select("label", t("mk").alias("mission_t"), t("ek").alias("equipment_t"))


# --- Q12 inter-site ---------------------------------------------------------
@register("intersite_emissions", f"""
WITH {S.enriched_ctes(MAY)}
SELECT e.site_id, st.site, e.n_missions, e.carbon_t FROM (
  SELECT site_id, count(*) AS n_missions, round(sum(carbon_kg) / {T}, 2) AS carbon_t FROM em
  WHERE dep_city IN ({_in(q.SITE_CITIES)}) AND dst_city IN ({_in(q.SITE_CITIES)}) GROUP BY site_id) e
JOIN st ON e.site_id = st.site_id""")
def _q12(m):
    return q.intersite_emissions(m, MAY)


# --- Q14, Q17 grouped -------------------------------------------------------
def _by_sql(by: str, window, where: str = "", sites=None, k: int | None = None) -> str:
    lim = f"LIMIT {k}" if k else ""
    return f"""
WITH {S.enriched_ctes(window, sites)}
SELECT {by}, n_missions, round(kg / {T}, 2) AS carbon_t FROM (
  SELECT {by}, count(*) AS n_missions, sum(carbon_kg) AS kg FROM em {where} GROUP BY {by}) g
ORDER BY kg DESC, {by} {lim}"""


@register("emissions_by_function_for_type", _by_sql("job_function", MAY_OCT, "WHERE mission_type = 'Business Meeting'"))
def _q14(m):
    return q.emissions_by(m, "job_function", MAY_OCT, mission_type="Business Meeting")


@register("top_mission_types", _by_sql("mission_type", JUNE, "WHERE job_function = 'Business Executive'", EUROPE, 3))
def _q17(m):
    return q.emissions_by(m, "mission_type", JUNE, job_function="Business Executive", sites=EUROPE, k=3)


# --- Q15 average age --------------------------------------------------------
@register("average_age", f"""
WITH per AS ({S.persons()}), mis AS ({S.missions(JUL_SEP)})
SELECT count(*) AS n_rows,
       round(avg(floor(date_diff('day', p.birth_date, DATE '1998-09-30') / 365.25e0)), 5) AS average_age
FROM mis m JOIN per p ON m.person_id = p.person_id WHERE m.mission_type = 'Vocational Training'""")
def _q15(m):
    return q.average_age(m, "Vocational Training", JUL_SEP, "1998-09-30")


@register("average_age_distinct_people", f"""
WITH per AS ({S.persons()}), mis AS ({S.missions(JUL_SEP)})
SELECT count(*) AS n_rows,
       round(avg(floor(date_diff('day', p.birth_date, DATE '1998-09-30') / 365.25e0)), 5) AS average_age
FROM (SELECT DISTINCT person_id FROM mis WHERE mission_type = 'Vocational Training') m
JOIN per p ON m.person_id = p.person_id""")
def _q15_people(m):
    return q.average_age(m, "Vocational Training", JUL_SEP, "1998-09-30", distinct_people=True)


# --- Q16 destination --------------------------------------------------------
@register("worst_destination", f"""
WITH {S.enriched_ctes(MAY_OCT)}
SELECT CAST(row_number() OVER (ORDER BY kg DESC NULLS LAST, dst_city, dst_country) AS INTEGER) AS rank, dst_city,
       dst_country, n_missions, round(kg / {T}, 2) AS carbon_t
FROM (SELECT dst_city, dst_country, count(*) AS n_missions, sum(carbon_kg) AS kg FROM em GROUP BY dst_city, dst_country) g
""")
def _q16(m):
    return q.worst_destination(m, MAY_OCT)


# --- Q18 single missions ----------------------------------------------------
@register("top_single_missions", f"""
WITH {S.enriched_ctes(None, (1,))}
SELECT mission_key, leg, dep_city, dep_country, dst_city, dst_country, transport, round(carbon_kg, 3) AS carbon_kg
FROM em ORDER BY em.carbon_kg DESC, mission_key, leg, dst_city LIMIT 5""")
def _q18(m):
    return q.top_single_missions(m, 1, 5)


@register("top_single_missions_dedup", f"""
WITH {S.enriched_ctes(None, (1,))}
SELECT person_id, mission_date, dep_city, dep_country, dst_city, dst_country, transport, is_return,
       round(carbon_kg, 3) AS carbon_kg FROM (
  SELECT DISTINCT person_id, mission_date, dep_city, dep_country, dst_city, dst_country, transport, is_return,
         km_one_way, carbon_kg FROM em) d
ORDER BY d.carbon_kg DESC, person_id, mission_date, dep_city, dep_country, dst_city, dst_country, transport, is_return
LIMIT 5""")
def _q18_dedup(m):
    return q.top_single_missions(m, 1, 5, dedup="reference")


# --- Q19, Q20 monthly -------------------------------------------------------
@register("monthly_distance", f"""
WITH {S.enriched_ctes()}
SELECT site, strftime(mission_date, '%Y-%m') AS year_month, count(*) AS n_missions, round(sum(km_one_way), 2) AS total_km
FROM em GROUP BY site, strftime(mission_date, '%Y-%m')""")
def _q19(m):
    return q.monthly_distance(m)


@register("monthly_emissions_by_transport", f"""
WITH {S.enriched_ctes()}
SELECT site, strftime(mission_date, '%Y-%m') AS year_month, transport, count(*) AS n_missions,
       round(sum(carbon_kg) / {T}, 2) AS carbon_t
FROM em GROUP BY site, strftime(mission_date, '%Y-%m'), transport""")
def _q19b(m):
    return q.monthly_emissions_by_transport(m)


@register("monthly_with_global_total", f"""
WITH {S.enriched_ctes()}, mm AS (SELECT site, strftime(mission_date, '%Y-%m') AS year_month, km_one_way FROM em)
SELECT CASE WHEN g = 1 THEN 'Global Total' ELSE site END AS site, year_month, n_missions, total_km FROM (
  SELECT site, year_month, grouping(site) AS g, count(*) AS n_missions, round(sum(km_one_way), 2) AS total_km
  FROM mm GROUP BY GROUPING SETS ((site, year_month), (year_month))) t""")
def _q20(m):
    return q.monthly_with_global_total(m)


# --- D5a / D5b / D2 / D3 / D4 per-mission operators ----------------------------
@register("mission_emissions_a", f"""
WITH {S.enriched_ctes()}
SELECT mission_key, leg, person_id, transport, is_return, round(km_one_way, 3) AS km_one_way,
       round(carbon_kg, 4) AS carbon_kg FROM em""")
def _d5a(m):
    e = m.enriched_missions()
    return e.select("mission_key", "leg", "person_id", "transport", "is_return",
                    F.round("km_one_way", 3).alias("km_one_way"), F.round("carbon_kg", 4).alias("carbon_kg"))


MIN_KM = 500.0


_DIST_SQL = "(km_one_way * CASE WHEN is_return THEN 2.0e0 ELSE 1.0e0 END)"
_FLOOR_SQL = f"(CASE WHEN {_DIST_SQL} < {MIN_KM!r}e0 THEN {MIN_KM!r}e0 ELSE {_DIST_SQL} END)"


@register("mission_emissions_b", f"""
WITH {S.enriched_ctes()}, adj AS (SELECT *, {text.ADJUSTED_KM.format(mode='transport', km=_FLOOR_SQL)} AS adjusted_km FROM em)
SELECT mission_key, leg, person_id, mission_date, dep_city, transport, dst_city, mission_type,
       round({text.EMISSION_B.format(mode='transport', km='adjusted_km')}, 7) AS emissions_t FROM adj""")
def _d5b(m):
    e = adjust_distance(mission_distance(m.enriched_missions(), min_km=MIN_KM), fixed.NOTEBOOK_DISTANCE_RULES)
    return e.select("mission_key", "leg", "person_id", "mission_date", "dep_city", "transport", "dst_city",
                    "mission_type", F.round(emission("transport", "adjusted_km", None, "B"), 7).alias("emissions_t"))


@register("route_distance", f"""
WITH {S.enriched_ctes()}
SELECT DISTINCT dep_city, dep_country, dst_city, dst_country, round(km_one_way, 3) AS km FROM em""")
def _d2(m):
    r = m.route_distances()
    return r.select("dep_city", "dep_country", "dst_city", "dst_country", F.round("km_one_way", 3).alias("km"))


@register("mission_distance_floor", f"""
WITH {S.enriched_ctes()}
SELECT mission_key, leg, is_return, round({_FLOOR_SQL}, 3) AS distance_km FROM em""")
def _d3(m):
    e = mission_distance(m.enriched_missions(), min_km=MIN_KM)
    return e.select("mission_key", "leg", "is_return", F.round("distance_km", 3).alias("distance_km"))


@register("rule_adjusted_distance", f"""
WITH {S.enriched_ctes()}
SELECT mission_key, leg, transport, round({text.ADJUSTED_KM.format(mode='transport', km=_DIST_SQL)}, 3) AS adjusted_km FROM em""")
def _d4(m):
    e = adjust_distance(mission_distance(m.enriched_missions()), fixed.NOTEBOOK_DISTANCE_RULES)
    return e.select("mission_key", "leg", "transport", F.round("adjusted_km", 3).alias("adjusted_km"))


_RULES_SCHEMA = "value string, op string, operand double, priority int"


@register("rule_table_distance", f"""
WITH {S.enriched_ctes()}
SELECT mission_key, leg, transport, round({text.ADJUSTED_KM.format(mode='transport', km=_DIST_SQL)}, 3) AS adjusted_km FROM em""")
def _d4_join(m):
    """The same rules as a table; a second, later rule for taxi must not win or fan rows out."""
    rules = [*fixed.NOTEBOOK_DISTANCE_RULES, (fixed.TAXI, "mul", 99.0)]
    table = m.spark.createDataFrame([(v, op, x, i) for i, (v, op, x) in enumerate(rules)], _RULES_SCHEMA)
    e = apply_rules_by_join(mission_distance(m.enriched_missions()), table, "transport", "distance_km", "adjusted_km")
    return e.select("mission_key", "leg", "transport", F.round("adjusted_km", 3).alias("adjusted_km"))


@register("mission_emissions_factor_table", f"""
WITH {S.enriched_ctes()}
SELECT mission_key, leg, person_id, transport, is_return, round(carbon_kg, 4) AS carbon_kg FROM em""")
def _d5a_join(m):
    """Set A as a factor table: equi-join on the mode, the band as residual condition."""
    e = mission_distance(m.enriched_missions()).drop("carbon_kg")
    e = emissions_by_join(e, factor_table(m.spark, "A"), "transport", "km_one_way", "distance_km", "carbon_kg", 0.0)
    return e.select("mission_key", "leg", "person_id", "transport", "is_return",
                    F.round("carbon_kg", 4).alias("carbon_kg"))


def _sliced(m, km: float = 2.0, most: float = 20_040.0):
    """Factor set A with every band cut into slices of ``km`` (some 40,000 bands); the factors stay."""
    rows = []
    for b in fixed.FACTOR_SETS["A"].bands:
        low, high = b.lo or 0.0, most if b.hi is None else b.hi
        cuts = [low + km * i for i in range(1, int((high - low) / km))]
        ends = [(b.lo, b.lo_closed), *[(c, True) for c in cuts]], [*[(c, False) for c in cuts], (b.hi, b.hi_closed)]
        rows += [("A", b.mode, lo, hi, lc, hc, float(b.add_km), float(b.mul), b.factor)
                 for (lo, lc), (hi, hc) in zip(*ends)]
    return m.spark.createDataFrame(rows, FACTOR_SCHEMA)


@register("mission_emissions_many_bands", f"""
WITH {S.enriched_ctes()}
SELECT mission_key, leg, transport, round(carbon_kg, 4) AS carbon_kg FROM em""")
def _d5a_bands(m):
    """Set A in slices of two kilometres: the same emissions through an index of tens of thousands of bands."""
    e = mission_distance(m.enriched_missions()).drop("carbon_kg")
    e = emissions_by_join(e, _sliced(m), "transport", "km_one_way", "distance_km", "carbon_kg", 0.0)
    return e.select("mission_key", "leg", "transport", F.round("carbon_kg", 4).alias("carbon_kg"))


# --- D2 geodesic for any two points ---------------------------------------------------
_A, _F = repr(fixed.WGS84_A_KM), repr(fixed.WGS84_F)
_EXACT_STEP = f"""
  SELECT *, atan2(lead_ * sin(s2), cos(s2)) - atan2(lead_ * sin(s1), cos(s1))
         - (1 - c) * {_F} * lead_ * (arc + c * sin(arc) * (cos(s1 + s2) + c * cos(arc) * (2 * pow(cos(s1 + s2), 2) - 1))) AS longitude
  FROM (SELECT *, s2 - s1 AS arc, {_F} / 16 * (1 - lead_ * lead_) * (4 + {_F} * (4 - 3 * (1 - lead_ * lead_))) AS c
    FROM (SELECT *, atan2(sin(b1), cos(az) * cos(b1)) AS s1,
                 atan2(sin(b2), sqrt(greatest(0.0e0, pow(cos(az) * cos(b1), 2) + (pow(cos(b2), 2) - pow(cos(b1), 2))))) AS s2
      FROM (SELECT *, sin(az) * cos(b1) AS lead_ FROM (SELECT *, (low + high) / 2 AS az FROM {{0}}) a1) a2) a3) a4"""


@register("route_distance_exact", f"""
WITH RECURSIVE loc AS ({S.locations()}), r AS (SELECT DISTINCT p.home_location_id AS dep, m.dst_location_id AS dst
  FROM ({S.missions()}) m JOIN ({S.persons()}) p ON m.person_id = p.person_id),
ends AS (
  SELECT dep, dst, false AS opposite, d.lat AS lat1, d.lon AS lon1, a.lat AS lat2, a.lon AS lon2
  FROM r JOIN loc d ON r.dep = d.location_id JOIN loc a ON r.dst = a.location_id
  UNION ALL
  SELECT dep, dst, true, d.lat, d.lon, -d.lat + a.lat / 100, d.lon + 180 - a.lat / 50
  FROM r JOIN loc d ON r.dep = d.location_id JOIN loc a ON r.dst = a.location_id),
reduced AS (
  SELECT dep, dst, opposite, atan((1 - {_F}) * tan(radians(lat1))) AS u, atan((1 - {_F}) * tan(radians(lat2))) AS v,
         abs(radians(lon2) - radians(lon1)) % (2 * pi()) AS t FROM ends),
points AS (
  SELECT dep, dst, opposite, CASE WHEN first > 0 THEN -first ELSE first END AS b1,
         CASE WHEN first > 0 THEN -other ELSE other END AS b2, turn
  FROM (SELECT *, CASE WHEN abs(u) < abs(v) THEN v ELSE u END AS first, CASE WHEN abs(u) < abs(v) THEN u ELSE v END AS other,
               CASE WHEN t > pi() THEN 2 * pi() - t ELSE t END AS turn FROM reduced)),
halved AS (
  SELECT dep, dst, opposite, b1, b2, turn, 0.0e0 AS low, pi() AS high, 0 AS n FROM points
  UNION ALL
  SELECT dep, dst, opposite, b1, b2, turn, CASE WHEN longitude < turn THEN az ELSE low END,
         CASE WHEN longitude < turn THEN high ELSE az END, n + 1
  FROM ({_EXACT_STEP.format('halved')}) WHERE n < 64),
ready AS (
  SELECT *, (1 - lead_ * lead_) * (pow({_A}, 2) - pow({_A} * (1 - {_F}), 2)) / pow({_A} * (1 - {_F}), 2) AS k, cos(s1 + s2) AS mid
  FROM ({_EXACT_STEP.format('(SELECT * FROM halved WHERE n = 64)')})),
measured AS (
  SELECT *, {_A} * (1 - {_F}) * (1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))) * (arc
    - small * sin(arc) * (mid + small / 4 * (cos(arc) * (2 * mid * mid - 1)
      - small / 6 * mid * (4 * pow(sin(arc), 2) - 3) * (4 * mid * mid - 3)))) AS km
  FROM (SELECT *, k / 1024 * (256 + k * (-128 + k * (74 - 47 * k))) AS small FROM ready))
SELECT d.city AS dep_city, a.city AS dst_city, opposite,
       round(CASE WHEN b1 = b2 AND turn = 0 THEN 0.0e0 ELSE km END, 4) AS km
FROM measured JOIN loc d ON dep = d.location_id JOIN loc a ON dst = a.location_id""")
def _d2_exact(m):
    """Travelled routes, and from each departure to a point nearly opposite, within a metre."""
    r = m.named_routes(m.routes()).select("dep_city", "dst_city", F.col("__dlat").alias("lat1"), F.col("__dlon").alias("lon1"),
                                          F.col("__alat").alias("lat2"), F.col("__alon").alias("lon2"))
    far = r.select("dep_city", "dst_city", F.lit(True).alias("opposite"), "lat1", "lon1",
                   (-F.col("lat1") + F.col("lat2") / 100).alias("lat2"),
                   (F.col("lon1") + 180 - F.col("lat2") / 50).alias("lon2"))
    both = r.withColumn("opposite", F.lit(False)).unionByName(far)
    return both.select("dep_city", "dst_city", "opposite",
                       F.round(geodesic_exact_km("lat1", "lon1", "lat2", "lon2"), 4).alias("km"))


# --- A2 distinct people from bitmaps ----------------------------------------------------
@register("distinct_travellers", f"""
WITH per AS ({S.persons()}), mis AS ({S.missions()}),
t AS (SELECT p.person_id, CAST(p.site_id AS VARCHAR) AS site_id, p.job_function, strftime(m.mission_date, '%Y-%m') AS year_month
      FROM mis m JOIN per p ON m.person_id = p.person_id)
SELECT 'site' AS kind, site_id AS value, count(DISTINCT person_id) AS travellers FROM t GROUP BY site_id
UNION ALL SELECT 'function', job_function, count(DISTINCT person_id) FROM t GROUP BY job_function
UNION ALL SELECT 'month', year_month, count(DISTINCT person_id) FROM t GROUP BY year_month
UNION ALL SELECT 'all', 'all', count(DISTINCT person_id) FROM t""")
def _a2_bitmaps(m):
    """Distinct travellers per site, function, month and in all, from one stored table of bitmaps."""
    trips = m.missions(people=m.persons().select("person_id", "site_id", "job_function"), places=False).select(
        "person_id", F.col("site_id").cast("string").alias("site_id"), "job_function",
        F.date_format("mission_date", "yyyy-MM").alias("year_month"))
    cells = reliable_checkpoint(bitmap_cells(trips, ["site_id", "job_function", "year_month"], "person_id"))
    parts = [count_keys(cells, [c], "travellers").select(F.lit(kind).alias("kind"), F.col(c).alias("value"), "travellers")
             for kind, c in (("site", "site_id"), ("function", "job_function"), ("month", "year_month"))]
    total = count_keys(cells, [], "travellers").select(F.lit("all").alias("kind"), F.lit("all").alias("value"), "travellers")
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(total)


# --- S6 / D8 / A11 incremental refresh ----------------------------------------------------
@register("refreshed_monthly_totals", f"""
WITH {S.enriched_ctes()}, mm AS (
  SELECT CAST(site_id AS VARCHAR) AS site, strftime(mission_date, '%Y-%m') AS year_month,
         CAST(km_one_way AS DECIMAL(28, 6)) AS km FROM em)
SELECT CASE WHEN g = 1 THEN 'Global Total' ELSE site END AS site, year_month, n_missions, total_km FROM (
  SELECT site, year_month, grouping(site) AS g, count(*) AS n_missions, CAST(round(sum(km), 2) AS DOUBLE) AS total_km
  FROM mm GROUP BY GROUPING SETS ((site, year_month), (year_month))) t""")
def _refreshed(m):
    """Monthly totals after three overlapping deliveries of the trips, each rewriting only what it touches."""
    e = reliable_checkpoint(m.enriched_missions().select("mission_key", "leg", "site_id", "person_id", "mission_date",
                                                         "transport", "km_one_way", "carbon_kg"))
    store = TripStore(m.spark, scratch_folder(m.spark, "trips"))
    for window in ("mission_date < '1996-03-15'", "mission_date BETWEEN '1996-03-01' AND '1997-01-31'",
                   "mission_date > '1997-01-20' OR mission_date IS NULL"):
        store.refresh(e.filter(window))
    return store.monthly_with_global()


@register("mission_route_join", f"""
WITH {S.enriched_ctes()},
r AS (SELECT DISTINCT dep_city, dep_country, dst_city, dst_country, transport, km_one_way AS km FROM em)
SELECT em.mission_key, em.leg, em.transport, round(r.km, 3) AS km FROM em JOIN r
  ON em.dep_city = r.dep_city AND em.dep_country = r.dep_country AND em.dst_city = r.dst_city
 AND em.dst_country = r.dst_country AND em.transport = r.transport""")
def _j3(m):
    """Five-key join of the trips to a route table, distinct first, so that repeated routes fan nothing out."""
    keys = ["dep_city", "dep_country", "dst_city", "dst_country", "transport"]
    e = m.enriched_missions()
    used = e.select(*keys).distinct()
    routes = m.route_distances().select(*keys[:4], F.col("km_one_way").alias("km"))
    table = used.join(routes, keys[:4]).select(*keys, "km")
    return e.select("mission_key", "leg", *keys).join(table, keys).select("mission_key", "leg", "transport",
                                                                         F.round("km", 3).alias("km"))


# --- D7 dimensions ----------------------------------------------------------
@register("dim_date", """
SELECT row_number() OVER (ORDER BY d) AS date_id, d AS date FROM (
  SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem) u
WHERE d IS NOT NULL""")
def _dim_date(m):
    return star.dim_date(m)


@register("dim_location", f"""
WITH {S.enriched_ctes()}
SELECT row_number() OVER (ORDER BY city, country) AS location_id, city, country FROM (
  SELECT dep_city AS city, dep_country AS country FROM em UNION SELECT dst_city, dst_country FROM em) u
WHERE city IS NOT NULL AND trim(city) <> '' AND country IS NOT NULL AND trim(country) <> ''""")
def _dim_location(m):
    return star.dim_location(m)


@register("dim_equipment_type", f"""
WITH {S.equipment_ctes()}
SELECT row_number() OVER (ORDER BY equip_type) AS type_id, equip_type FROM (
  SELECT DISTINCT equip_type FROM eq WHERE equip_type IS NOT NULL AND trim(equip_type) <> '') u""")
def _dim_type(m):
    return build_dimension(m.equipment_labels().select("equip_type"), "type_id", blank_policy="drop", bounded=True)


def _some_blank(labels):
    """Models with one brand blanked, so that the blank rule has a case: ' ' becomes the sentinel."""
    return labels.select(F.when(F.col("equip_model") == "Brand#11", F.lit(" ")).otherwise(F.col("equip_model"))
                         .alias("equip_model"))


@register("dim_model", f"""
WITH {S.equipment_ctes()}
SELECT row_number() OVER (ORDER BY equip_model) AS model_id, equip_model FROM (
  SELECT DISTINCT CASE WHEN equip_model = 'Brand#11' THEN 'NULL' ELSE equip_model END AS equip_model FROM eq) u""")
def _dim_model(m):
    return build_dimension(_some_blank(m.equipment_labels()), "model_id", blank_policy="sentinel")


@register("dim_transport", f"""
WITH mis AS ({S.missions()})
SELECT row_number() OVER (ORDER BY transport) AS transport_id, transport FROM (
  SELECT DISTINCT transport FROM mis WHERE transport IS NOT NULL AND trim(transport) <> '') u""")
def _dim_transport(m):
    return star.dim_transport(m)


@register("dim_mission_type", f"""
WITH mis AS ({S.missions()})
SELECT row_number() OVER (ORDER BY mission_type) AS type_id, mission_type FROM (
  SELECT DISTINCT mission_type FROM mis WHERE mission_type IS NOT NULL AND trim(mission_type) <> '') u""")
def _dim_mission_type(m):
    return star.dim_mission_type(m)


@register("stable_date_keys", """
WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL),
s AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_shipdate IS NOT NULL)
SELECT row_number() OVER (ORDER BY d) AS date_id, d AS date FROM o
UNION ALL
SELECT (SELECT count(*) FROM o) + row_number() OVER (ORDER BY d), d FROM s WHERE d NOT IN (SELECT d FROM o)""")
def _stable_dates(m):
    """Date keys of two builds on one registry: the days of the orders first, then with those of the purchases."""
    path = scratch_folder(m.spark, "registry")
    days = m.table("orders").select(F.to_date("o_orderdate").alias("date"))
    build_dimension(days, "date_id", registry=path)
    more = days.unionByName(m.table("lineitem").select(F.to_date("l_shipdate").alias("date")))
    return build_dimension(more, "date_id", registry=path)


# --- D8, D9 facts -----------------------------------------------------------
_DATES = """dd AS (SELECT row_number() OVER (ORDER BY d) AS date_id, d AS date FROM (
  SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem) u
  WHERE d IS NOT NULL)"""


@register("fact_mission", f"""
WITH {S.enriched_ctes()}, {_DATES},
tr AS (SELECT row_number() OVER (ORDER BY transport) AS transport_id, transport FROM (
  SELECT DISTINCT transport FROM mis) u),
ty AS (SELECT row_number() OVER (ORDER BY mission_type) AS type_id, mission_type FROM (
  SELECT DISTINCT mission_type FROM mis) u),
pl AS (SELECT row_number() OVER (ORDER BY city, country) AS location_id, city, country FROM (
  SELECT dep_city AS city, dep_country AS country FROM em UNION SELECT dst_city, dst_country FROM em) u
  WHERE city IS NOT NULL AND country IS NOT NULL),
np AS (SELECT loc.location_id AS natural_id, pl.location_id FROM loc JOIN pl ON loc.city = pl.city AND loc.country = pl.country),
f AS (SELECT p.site_id, p.person_id, m.mission_key, m.leg, m.mission_date, dd.date_id, d.location_id AS dep_location_id,
             a.location_id AS dst_location_id, ty.type_id, tr.transport_id, m.is_return
      FROM per p LEFT JOIN mis m ON p.person_id = m.person_id
      LEFT JOIN tr ON m.transport = tr.transport LEFT JOIN ty ON m.mission_type = ty.mission_type
      LEFT JOIN dd ON m.mission_date = dd.date LEFT JOIN np d ON p.home_location_id = d.natural_id
      LEFT JOIN np a ON m.dst_location_id = a.natural_id)
SELECT row_number() OVER (PARTITION BY site_id ORDER BY person_id NULLS LAST, mission_date NULLS LAST,
         mission_key NULLS LAST, leg NULLS LAST, dst_location_id NULLS LAST, type_id NULLS LAST,
         transport_id NULLS LAST, is_return NULLS LAST) AS fact_id, *
FROM f""")
def _fact_mission(m):
    return star.fact_mission(m)


@register("fact_equipment", f"""
WITH {S.equipment_ctes()}, {_DATES},
f AS (SELECT p.site_id, p.person_id, e.equipment_key, e.leg, e.purchase_date, dd.date_id, e.equip_type, e.equip_model
      FROM eper p LEFT JOIN eq e ON p.person_id = e.person_id LEFT JOIN dd ON e.purchase_date = dd.date)
SELECT row_number() OVER (PARTITION BY site_id ORDER BY person_id NULLS LAST, purchase_date NULLS LAST,
         equipment_key NULLS LAST, leg NULLS LAST, equip_type NULLS LAST, equip_model NULLS LAST) AS fact_id, *
FROM f""")
def _fact_equipment(m):
    return star.fact_equipment(m)


@register("people_without_trips_july", f"""
WITH per AS ({S.persons()}), mis AS ({S.missions(JULY)})
SELECT site_id, person_id FROM per p WHERE NOT EXISTS (SELECT 1 FROM mis WHERE mis.person_id = p.person_id)""")
def _t1(m):
    return star.people_without_trips(m, JULY)


# --- D10 harmonisation ------------------------------------------------------
@register("harmonise_labels", f"""
SELECT c_custkey AS person_id, c_mktsegment AS segment, {text.JOB_FUNCTION.format(col='c_mktsegment')} AS job_function
FROM customer""")
def _d10(m):
    table = translation_table(m.spark, {("job_function", "segment"): fixed.SEGMENT_JOB, **fixed.TRANSLATIONS})
    c = m.table("customer").select(F.col("c_custkey").alias("person_id"), F.col("c_mktsegment").alias("segment"),
                                   F.col("c_mktsegment").alias("job_function"))
    return harmonise(c, {"job_function": "job_function"}, table)


# --- D11 quality profile ----------------------------------------------------
_PROFILE_COLS = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                 ("n_chars", "bigint"), ("quality", "int"), ("toxic", "int"), ("share", "double")]


def _profile_sql() -> str:
    parts = []
    for c, t in _PROFILE_COLS:
        for k in ("null", "nan", "empty"):
            if k == "null":
                n, ok = f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)", "true"
            elif k == "nan" and t in ("double", "float"):
                n, ok = f"sum(CASE WHEN isnan({c}) THEN 1 ELSE 0 END)", "true"
            elif k == "empty" and t == "string":
                n, ok = f"sum(CASE WHEN trim({c}) = '' THEN 1 ELSE 0 END)", "true"
            else:
                n, ok = "0", "false"
            parts.append(f"SELECT '{c}' AS column_name, '{k}' AS kind, CAST(coalesce({n}, 0) AS BIGINT) AS n_affected, "
                         f"count(*) AS n_rows, CASE WHEN count(*) > 0 THEN round(coalesce({n}, 0) * 100.0e0 / count(*), 4) "
                         f"ELSE 0.0e0 END AS pct, {ok} AS applicable FROM dl")
    return (f"WITH dl AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic, "
            f"CASE WHEN l.quality = 0 THEN CAST('NaN' AS DOUBLE) ELSE l.quality * 0.5e0 END AS share "
            f"FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) " + " UNION ALL ".join(parts))


def _documents_labels(m):
    d = m.table("documents").select("doc_id", "text", "lang", "source", "n_chars")
    lab = m.table("labels").select("doc_id", "quality", "toxic")
    # A double column with NaN (0 / 0), so that the NaN count has something to find.
    share = F.when(F.col("quality") == 0, F.lit(float("nan"))).otherwise(F.col("quality") * F.lit(0.5))
    return d.join(lab, "doc_id", "left").select("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic",
                                               share.alias("share"))


@register("quality_profile", _profile_sql())
def _d11(m):
    return profile(_documents_labels(m))


@register("has_atypicals", f"""
WITH p AS ({_profile_sql()})
SELECT kind, coalesce(max(n_affected > 0), false) AS has_atypicals FROM p WHERE applicable GROUP BY kind""")
def _d11b(m):
    return has_atypicals(_documents_labels(m))


# --- A13 unique values --------------------------------------------------------
@register("unique_values", """
SELECT DISTINCT nation_key FROM (SELECT c_nationkey AS nation_key FROM customer UNION ALL
  SELECT s_nationkey FROM supplier) u WHERE nation_key IS NOT NULL""")
def _a13(m):
    c = m.table("customer").withColumnRenamed("c_nationkey", "nation_key")
    s = m.table("supplier").withColumnRenamed("s_nationkey", "nation_key")
    return unique_values([c, s], ["nation_key", "not_a_column"], "nation_key")


# --- A8 max per condition -----------------------------------------------------
MAX_TUPLES = [(1, fixed.PLANE), (3, fixed.TRAIN), (4, fixed.TAXI), (0, fixed.OTHER), (9, fixed.PLANE)]


@register("max_by_condition", f"""
WITH {S.enriched_ctes()}, want(site_id, transport) AS (VALUES {', '.join(f"({s}, '{t}')" for s, t in MAX_TUPLES)})
SELECT w.site_id, w.transport, round(max(e.carbon_kg), 4) AS max_value
FROM want w LEFT JOIN em e ON w.site_id = e.site_id AND w.transport = e.transport GROUP BY w.site_id, w.transport""")
def _a8(m):
    out = max_by_condition(m.enriched_missions(), "carbon_kg", ["site_id", "transport"], MAX_TUPLES)
    return out.select("site_id", "transport", F.round("max_value", 4).alias("max_value"))


@register("max_emission", f"""
WITH {S.enriched_ctes()} SELECT round(max(carbon_kg), 4) AS max_value FROM em""")
def _a7(m):
    return max_by_condition(m.enriched_missions(), "carbon_kg").select(F.round("max_value", 4).alias("max_value"))


# --- J8 fill nulls by key -----------------------------------------------------
@register("fill_nulls_by_key", """
WITH dl AS (SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
s AS (SELECT lang, max(quality) AS q FROM dl WHERE quality IS NOT NULL GROUP BY lang)
SELECT dl.doc_id, dl.lang, coalesce(dl.quality, s.q) AS quality FROM dl LEFT JOIN s ON dl.lang = s.lang""")
def _j8(m):
    d = m.table("documents").select("doc_id", "lang")
    lab = m.table("labels").select("doc_id", "quality")
    dst = d.join(lab, "doc_id", "left")
    return fill_nulls_by_key(dst, dst, "lang", "quality", "quality")


# --- S9 / J6 append-if-new ------------------------------------------------------
@register("append_new_rows", """
SELECT d.doc_id, d.lang, d.source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM documents t JOIN labels l ON t.doc_id = l.doc_id WHERE t.doc_id = d.doc_id)""")
def _s9(m):
    src = m.table("documents").select("doc_id", "lang", "source")
    target = (m.table("documents").join(m.table("labels"), "doc_id")
              .select("doc_id", "lang", "source", "quality"))
    return new_rows(src, target, [["doc_id"]])


@register("indexed_append", """
SELECT d.doc_id, d.lang, d.source, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _s9_indexed(m):
    """The labelled documents as a table, then all documents appended twice through its key index."""
    docs = m.table("documents").select("doc_id", "lang", "source")
    path = scratch_folder(m.spark, "appended")
    docs.join(m.table("labels").select("doc_id", "quality"), "doc_id").write.parquet(path)
    index = KeyIndex(m.spark, path, {"doc_id": ["doc_id"]})
    for batch in (docs, docs):
        index.append(batch)
    index.drop()
    return m.spark.read.parquet(path).select("doc_id", "lang", "source", "quality")


# --- S1 drops by header -----------------------------------------------------------
def _write_drops(m, root: str) -> None:
    """The trips as daily-drop files of one folder a site, every site with a header of its own: the schema's,
    reversed, with an unknown column in between, without the transport, and without the key."""
    p = m.persons().select("person_id", "site_id")
    t = reliable_checkpoint(m.missions(people=p).select(
        "site_id", F.concat_ws("-", "mission_key", "leg").alias("ID_MISSION"),
        F.col("person_id").cast("string").alias("ID_PERSONNEL"),
        F.date_format("mission_ts", "yyyy-MM-dd HH:mm:ss").alias("DATE_MISSION"),
        F.col("mission_type").alias("TYPE_MISSION"), F.col("dst_location_id").cast("string").alias("VILLE_DESTINATION"),
        F.col("transport").alias("TRANSPORT"), F.when(F.col("is_return"), "oui").otherwise("non").alias("ALLER_RETOUR")))
    known = t.columns[1:]
    full = [F.col(f.name) if f.name in known else F.lit(" ").alias(f.name) for f in schemas.MISSION.fields]
    layouts = [full, [F.col(c) for c in reversed(known)],
               [*[F.col(c) for c in known[3:]], F.lit("x;y").alias("NOTE"), *[F.col(c) for c in known[:3]]],
               [F.col(c) for c in known if c != "TRANSPORT"], [F.col(c) for c in known if c != "ID_MISSION"]]
    for site, cells in enumerate(layouts):  # the five regions
        name = f"DROP_{chr(ord('A') + site)}"
        t.filter(F.col("site_id") == site).select(*cells).write.option("header", True).option("sep", ";").csv(
            f"{root}/{name}/{name}_MISSION")


@register("drops_by_header", f"""
WITH per AS ({S.persons()}), mis AS ({S.missions()}),
j AS (SELECT m.*, p.site_id FROM mis m JOIN per p ON m.person_id = p.person_id)
SELECT site_id, count(*) FILTER (site_id <> 4) AS n_rows, count(*) FILTER (site_id = 4) AS n_rejected,
       count(DISTINCT person_id) FILTER (site_id <> 4) AS n_people,
       count(*) FILTER (site_id < 3 AND transport = 'plane') AS n_planes,
       count(*) FILTER (site_id <> 4 AND is_return) AS n_returns,
       min(CASE WHEN site_id <> 4 THEN mission_date END) AS first_day,
       max(CASE WHEN site_id <> 4 THEN mission_date END) AS last_day
FROM j GROUP BY site_id""")
def _s1(m):
    """Drops of five headers read back by their headers; the files without the key are rejected and counted."""
    root = scratch_folder(m.spark, "drops")
    _write_drops(m, root)
    read = parse_drops(batch_lines(m.spark, f"{root}/*/*_MISSION/*.csv"), "mission")
    site = F.ascii(F.regexp_extract("file", r"DROP_([A-Z])_MISSION/[^/]+$", 1)) - ord("A")
    rows = read.rows.select(site.alias("site_id"), "ID_PERSONNEL", "TRANSPORT", "ALLER_RETOUR",
                            F.to_date("DATE_MISSION").alias("day"))
    counted = rows.groupBy("site_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("ID_PERSONNEL").alias("n_people"),
        F.count(F.when(F.col("TRANSPORT") == fixed.PLANE, 1)).alias("n_planes"),
        F.count(F.when(F.col("ALLER_RETOUR") == "oui", 1)).alias("n_returns"), F.min("day").alias("first_day"),
        F.max("day").alias("last_day"))
    rejected = read.report().groupBy(site.alias("site_id")).agg(F.sum("n_rejected").alias("n_rejected"))
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_rows", "n_people", "n_planes", "n_returns")]
    return (rejected.filter("site_id IS NOT NULL").join(counted, "site_id", "left")
            .select("site_id", *zero, "n_rejected", "first_day", "last_day"))


# --- D1 gazetteer ---------------------------------------------------------------
ALLOWED_PLACE_TYPES = ("city", "town")


def _candidates(m):
    """Geocoder-style candidates: a supplier is a place found for its nation's name, displayed as "city, country".

    Every seventh nation (key % 7 = 3) has hamlets only, so no allowed candidate; every fifth supplier's display
    name lacks the country.
    """
    s = m.table("supplier")
    loc = fixed_broadcast(m.locations())
    j = s.join(loc, s["s_nationkey"] == loc["location_id"])
    kind = F.when((F.col("s_acctbal") < 0) | (F.col("location_id") % 7 == 3), F.lit("hamlet")) \
        .when(F.col("s_acctbal") < 5000, F.lit("town")).otherwise(F.lit("city"))
    jitter = (F.col("s_suppkey") % 7) * F.lit(0.01)
    shown = F.when(F.col("s_suppkey") % 5 == 0, F.col("city")).otherwise(F.concat_ws(", ", "city", "country"))
    return j.select("city", "country", F.col("s_name").alias("display_name"), shown.alias("label"),
                    kind.alias("place_type"), (F.col("lat") + jitter).alias("lat"), (F.col("lon") - jitter).alias("lon"),
                    F.col("s_acctbal").alias("score"))


def _found(m):
    return gazetteer_match(m.locations().select("city", "country"), _candidates(m), ALLOWED_PLACE_TYPES)


_CAND_SQL = f"""loc AS ({S.locations()}),
cand AS (SELECT loc.city, loc.country, s.s_name AS display_name, s.s_suppkey,
  CASE WHEN s.s_suppkey % 5 = 0 THEN loc.city ELSE loc.city || ', ' || loc.country END AS label,
  CASE WHEN s.s_acctbal < 0 OR loc.location_id % 7 = 3 THEN 'hamlet' WHEN s.s_acctbal < 5000 THEN 'town'
       ELSE 'city' END AS place_type,
  loc.lat + (s.s_suppkey % 7) * 0.01e0 AS lat, loc.lon - (s.s_suppkey % 7) * 0.01e0 AS lon, s.s_acctbal AS score
  FROM supplier s JOIN loc ON s.s_nationkey = loc.location_id),
places AS (SELECT DISTINCT city, country FROM loc),
best AS (SELECT city, country, lat, lon FROM (
  SELECT *, row_number() OVER (PARTITION BY city, country ORDER BY score DESC, display_name DESC) AS rn
  FROM cand WHERE place_type IN ({_in(ALLOWED_PLACE_TYPES)})) r WHERE rn = 1)"""


@register("parsed_places", f"""
WITH {_CAND_SQL}
SELECT DISTINCT label, trim(split_part(label, ',', 1)) AS city,
       CASE WHEN label LIKE '%,%' THEN trim(split_part(label, ',', 2)) ELSE country END AS country
FROM cand""")
def _place_parsing(m):
    """City and country of the display labels; a bare city takes the country of its candidate."""
    p = _candidates(m).select("label", parse_place("label").alias("p"), "country")
    return p.select("label", F.col("p.city").alias("city"),
                    F.coalesce("p.country", "country").alias("country")).distinct()


@register("gazetteer_match", f"""
WITH {_CAND_SQL}
SELECT p.country, p.city, round(b.lat, 4) AS lat, round(b.lon, 4) AS lon
FROM places p JOIN best b ON p.city = b.city AND p.country = b.country""")
def _d1(m):
    found, _ = _found(m)
    return found.select("country", "city", F.round("lat", 4).alias("lat"), F.round("lon", 4).alias("lon"))


@register("gazetteer_unmatched", f"""
WITH {_CAND_SQL}
SELECT p.country, p.city FROM places p WHERE NOT EXISTS (
  SELECT 1 FROM best b WHERE p.city = b.city AND p.country = b.country)""")
def _d1b(m):
    return _found(m)[1]


_NORMAL = ("regexp_replace(translate(lower({0}), 'àáâãäåçèéêëìíîïñòóôõöøùúûüýÿß', 'aaaaaaceeeeiiiinoooooouuuuyys'), "
           "'[^\\p{{L}}\\p{{N}}]', '', 'g')")


def _respelled(m):
    """The places under other spellings: a blank for the underscore, or without their fourth letter."""
    city, k = F.col("city"), F.col("location_id") % 3
    spelled = F.when(k == 1, F.initcap(F.translate(city, "_", " "))).when(
        k == 2, F.concat(F.substring(city, 1, 3), F.expr("substr(city, 5)"))).otherwise(city)
    return m.locations().select("country", spelled.alias("city"))


@register("gazetteer_match_similar", f"""
WITH {_CAND_SQL},
p AS (SELECT DISTINCT country, CASE location_id % 3 WHEN 1 THEN 'Nation ' || substr(city, 8)
        WHEN 2 THEN substr(city, 1, 3) || substr(city, 5) ELSE city END AS city FROM loc),
d AS (SELECT p.country, p.city, b.city AS matched, b.lat, b.lon,
             CASE WHEN p.city = b.city THEN 0 ELSE levenshtein({_NORMAL.format('p.city')}, {_NORMAL.format('b.city')}) END AS distance,
             max(c.score) AS score
      FROM p JOIN best b ON p.country = b.country JOIN cand c ON c.country = b.country AND c.city = b.city
       AND c.place_type IN ({_in(ALLOWED_PLACE_TYPES)}) GROUP BY ALL)
SELECT country, city, matched AS matched_city, distance, round(lat, 4) AS lat, round(lon, 4) AS lon FROM (
  SELECT *, row_number() OVER (PARTITION BY country, city ORDER BY city <> matched, distance, score DESC, matched) AS k
  FROM d WHERE distance <= 2) WHERE k = 1""")
def _d1_similar(m):
    found, _ = gazetteer_match_similar(_respelled(m), _candidates(m), ALLOWED_PLACE_TYPES)
    return found.select("country", "city", "matched_city", "distance", F.round("lat", 4).alias("lat"),
                        F.round("lon", 4).alias("lon"))


@register("similar_labels", f"""
WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-zà-ÿ]{{4,}}')) AS word FROM benchmark),
h AS (SELECT word, CAST(('0x' || substr(md5(word), 1, 2)) AS INTEGER) AS k FROM w),
m AS (SELECT word, CASE k % 5 WHEN 0 THEN word
        WHEN 1 THEN substr(word, 1, k % length(word)) || substr(word, k % length(word) + 2)
        WHEN 2 THEN substr(word, 1, k % length(word)) || 'x' || substr(word, k % length(word) + 1)
        WHEN 3 THEN upper(substr(word, 1, k % length(word))) || '-' || substr(word, k % length(word) + 1)
        ELSE 'zzz' || word END AS spelled FROM h),
s AS (SELECT DISTINCT spelled, {_NORMAL.format('spelled')} AS a FROM m),
t AS (SELECT word, {_NORMAL.format('word')} AS b FROM w),
p AS (SELECT spelled, word, levenshtein(a, b) AS distance FROM s JOIN t ON abs(length(a) - length(b)) <= 2
      WHERE levenshtein(a, b) <= 2),
best AS (SELECT spelled, word AS label, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY spelled ORDER BY distance, word) AS k FROM p) WHERE k = 1)
SELECT s.spelled, best.label, best.distance FROM s LEFT JOIN best ON s.spelled = best.spelled""")
def _d10_similar(m):
    """Words of the benchmark with planted misspellings, each with its closest known word; null where none is near."""
    text = F.regexp_extract_all(F.lower("text"), F.lit("[a-zà-ÿ]{4,}"), F.lit(0))
    words = reliable_checkpoint(m.table("benchmark").select(F.explode(text).alias("word")).distinct())
    k = F.conv(F.substring(F.md5("word"), 1, 2), 16, 10).cast("int")
    at = k % F.length("word")

    def part(first, length=None):
        return F.substring("word", first, F.length("word") if length is None else length)

    spelled = (F.when(k % 5 == 0, F.col("word")).when(k % 5 == 1, F.concat(part(F.lit(1), at), part(at + 2)))
               .when(k % 5 == 2, F.concat(part(F.lit(1), at), F.lit("x"), part(at + 1)))
               .when(k % 5 == 3, F.concat(F.upper(part(F.lit(1), at)), F.lit("-"), part(at + 1)))
               .otherwise(F.concat(F.lit("zzz"), "word")))
    values = words.select(spelled.alias("spelled"))
    found, missing = match_names(values, words.withColumnRenamed("word", "label"), "spelled", "label")
    none = missing.select("spelled", F.lit(None).cast("string").alias("label"), F.lit(None).cast("int").alias("distance"))
    return found.unionByName(none)


@register("route_distance_by_name", f"""
WITH {_CAND_SQL}, r AS (SELECT DISTINCT p.home_location_id AS dep, m.dst_location_id AS dst
  FROM ({S.missions()}) m JOIN ({S.persons()}) p ON m.person_id = p.person_id)
SELECT d.city AS dep_city, d.country AS dep_country, a.city AS dst_city, a.country AS dst_country,
       round({geodesic_sql('bd.lat', 'bd.lon', 'ba.lat', 'ba.lon')}, 3) AS km
FROM r JOIN loc d ON r.dep = d.location_id JOIN loc a ON r.dst = a.location_id
LEFT JOIN best bd ON bd.city = d.city AND bd.country = d.country
LEFT JOIN best ba ON ba.city = a.city AND ba.country = a.country""")
def _j9(m):
    """Coordinates looked up by (city, country) in the matched gazetteer; an unknown end leaves the distance null."""
    routes = m.route_distances().drop("km_one_way")
    out = with_route_distance(routes, _found(m)[0], out="km")
    return out.select("dep_city", "dep_country", "dst_city", "dst_country", F.round("km", 3).alias("km"))


@register("unlocated_places", f"""
WITH {_CAND_SQL}, ends AS (
  SELECT 'departure' AS role, p.home_location_id AS place
  FROM ({S.missions()}) m JOIN ({S.persons()}) p ON m.person_id = p.person_id
  UNION ALL
  SELECT 'destination', m.dst_location_id
  FROM ({S.missions()}) m JOIN ({S.persons()}) p ON m.person_id = p.person_id)
SELECT role, loc.city, loc.country, count(*) AS n_trips FROM ends LEFT JOIN loc ON ends.place = loc.location_id
WHERE NOT EXISTS (SELECT 1 FROM best g WHERE g.city = loc.city AND g.country = loc.country)
GROUP BY role, loc.city, loc.country""")
def _t13(m):
    return unlocated_places(m.enriched_missions(), _found(m)[0])


# --- D6 imputation --------------------------------------------------------------
def _nb_sql(rows: str, text_col: str, label_col: str, name: str) -> str:
    """CTEs that fit on the labelled rows of ``rows`` (id, text, label) and end with ``name`` (id, label): the
    multinomial naive Bayes score of every label for every row to fill, the first label of the highest."""
    tok = f"unnest(regexp_extract_all(lower(coalesce({text_col}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}'))"
    return f"""
{name}_k AS (SELECT id, trim({label_col}) AS label, {text_col} FROM {rows} WHERE {label_col} IS NOT NULL AND trim({label_col}) <> ''),
{name}_c AS (SELECT label, token, count(*) AS n FROM (SELECT label, {tok} AS token FROM {name}_k) t GROUP BY label, token),
{name}_v AS (SELECT count(DISTINCT token) AS v FROM {name}_c),
{name}_l AS (SELECT k.label, ln(count(*) / CAST((SELECT count(*) FROM {name}_k) AS DOUBLE)) AS prior,
                    coalesce((SELECT sum(n) FROM {name}_c c WHERE c.label = k.label), 0) AS total
             FROM {name}_k k GROUP BY k.label),
{name}_m AS (SELECT id, {text_col} FROM {rows} WHERE {label_col} IS NULL OR trim({label_col}) = ''),
{name}_b AS (SELECT id, token, count(*) AS c FROM (SELECT id, {tok} AS token FROM {name}_m) t
             WHERE token IN (SELECT token FROM {name}_c) GROUP BY id, token),
{name}_s AS (SELECT m.id, l.label, round(l.prior + coalesce((
               SELECT sum(b.c * ln((coalesce(c.n, 0) + 1.0e0) / (l.total + v.v)))
               FROM {name}_b b LEFT JOIN {name}_c c ON c.token = b.token AND c.label = l.label WHERE b.id = m.id), 0.0e0), 6) AS s
             FROM {name}_m m CROSS JOIN {name}_l l CROSS JOIN {name}_v v),
{name} AS (SELECT id, arg_min(label, row(-s, label)) AS label FROM {name}_s GROUP BY id)"""


@register("impute_category", f"""
WITH r AS (SELECT d.doc_id AS id, d.text, CASE WHEN l.doc_id IS NOT NULL THEN d.lang END AS lang
           FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id),
{_nb_sql('r', 'text', 'lang', 'f')}
SELECT r.id AS doc_id, coalesce(r.lang, f.label) AS lang, r.lang IS NULL AS lang_imputed
FROM r LEFT JOIN f ON r.id = f.id""")
def _d6(m):
    d = m.table("documents").select("doc_id", "text", "lang")
    labelled = m.table("labels").select("doc_id").distinct().withColumn("__has", F.lit(True))
    d = (d.join(labelled, "doc_id", "left")
         .withColumn("lang", F.when(F.col("__has"), F.col("lang"))).drop("__has"))
    out = impute_category(d, "text", "lang")
    return out.select("doc_id", "lang", "lang_imputed")


@register("impute_type_then_model", f"""
WITH r AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS kind,
                  CASE WHEN p_partkey % 7 = 0 THEN ' ' ELSE p_brand END AS model FROM part),
{_nb_sql('r', 'model', 'kind', 'f')},
r2 AS (SELECT r.id, coalesce(r.kind, f.label) AS kind, r.model FROM r LEFT JOIN f ON r.id = f.id),
g_src AS (SELECT id, kind, model FROM r),
{_nb_sql('g_src', 'kind', 'model', 'g').replace("g_m AS (SELECT id, kind FROM g_src WHERE model IS NULL OR trim(model) = '')",
                                               "g_m AS (SELECT id, kind FROM r2 WHERE model IS NULL OR trim(model) = '')")}
SELECT r2.id AS part_id, trim(r2.kind) AS kind, CASE WHEN trim(r2.model) = '' THEN g.label ELSE trim(r2.model) END AS model
FROM r2 LEFT JOIN g ON r2.id = g.id""")
def _d6_pair(m):
    """Types from models, then models from the filled types; both are learnt from the given cells only."""
    key = F.col("p_partkey")
    p = m.table("part").select(key.alias("part_id"), F.when(key % 11 != 0, F.col("p_type")).alias("kind"),
                               F.when(key % 7 == 0, F.lit(" ")).otherwise(F.col("p_brand")).alias("model"))
    return impute_pair(p, "model", "kind").select("part_id", "kind", "model")
