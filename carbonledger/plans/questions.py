"""The twenty questions as parameterised functions ``(model, params) -> DataFrame``.

Every question is a pure function of the input tables: no driver-side
collection, no hidden state between questions.  Defaults translate the
notebook's parameters onto the driver's data (2024 windows move to 1998; the
European sites {1, 3, 4} keep their keys).

Dedup semantics: every trip is a fact row and is counted once.  The notebook's
``dropDuplicates`` after a fan-out join is not needed because distances are
computed per row, not joined from a duplicated route table; ``dedup="reference"``
reproduces the notebook's collapse of identical narrow rows where it differs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions.dates import age_years, year_month
from ..operators.rollup import totals_with_label
from .model import DriverModel, Window

TONNES = 1000.0


def _t(col: str = "carbon_kg", name: str = "carbon_t", digits: int = 2):
    return F.round(F.sum(col) / F.lit(TONNES), digits).alias(name)


# Columns that identify a trip in the notebook's narrow frames once the ids are dropped.
TRIP_COLS = ("person_id", "mission_date", "dep_city", "dep_country", "dst_city", "dst_country", "transport",
             "is_return", "km_one_way", "carbon_kg")


def _dedup(df: DataFrame, dedup: str, cols: Sequence[str]) -> DataFrame:
    if dedup == "reference":
        return df.select(*cols).dropDuplicates()
    if dedup != "mission":
        raise ValueError("dedup must be 'mission' or 'reference'")
    return df


def _trips(m: DriverModel, window: Window = None, sites: Sequence[int] | None = None, dedup: str = "mission",
           keep: Sequence[str] = ()) -> DataFrame:
    """Enriched trips; ``dedup="reference"`` collapses trips that are identical once their ids
    are dropped (the notebook's ``dropDuplicates``), keeping ``TRIP_COLS`` + ``keep``.
    The collapse is an aggregate (partial per task), not a sort of one group."""
    e = m.enriched_missions(window, sites)
    return _dedup(e, dedup, list(dict.fromkeys([*TRIP_COLS, *keep])))


# Q1-Q3 ----------------------------------------------------------------------
def headcount_by_function(m: DriverModel) -> DataFrame:
    """Distinct people per (site, job function) and per job function over all sites.

    The notebook counts people in the mission fact, which is ``person LEFT JOIN
    missions`` -- so people without a mission count too.  A left
    join cannot add or remove left-side people, so the distinct count equals
    the count over ``persons`` alone: the plan reads only customer and nation
    and never shuffles the line items (Catalyst cannot drop that join itself
    once GROUPING SETS put an Expand above it).  ``site_id`` is null on the
    all-sites rows.
    """
    p = m.persons().select("person_id", "site_id", "job_function")
    g = p.groupingSets([["site_id", "job_function"], ["job_function"]], "site_id", "job_function")
    return g.agg(F.countDistinct("person_id").alias("headcount"))


# Q4-Q7 ----------------------------------------------------------------------
def purchase_count_window(m: DriverModel, equip_type: str = "PC portable",
                          window: Window = ("1998-05-01", "1998-10-31")) -> DataFrame:
    e = m.equipment(window, buyers=False)  # the question names no buyer: orders and people are not read
    return e.filter(F.col("equip_type") == equip_type).agg(F.count(F.lit(1)).alias("n_purchases"))


def purchase_carbon(m: DriverModel, equip_type: str = "PC portable",
                    window: Window = ("1998-05-01", "1998-10-31"), sites: Sequence[int] | None = None,
                    job_function: str | None = None) -> DataFrame:
    e = m.equipment_with_impact(window, buyers=sites is not None or job_function is not None).filter(F.col("equip_type") == equip_type)
    if sites is not None:
        e = e.filter(F.col("site_id").isin(list(sites)))
    if job_function is not None:
        e = e.filter(F.col("job_function") == job_function)
    return e.agg(F.count(F.lit(1)).alias("n_purchases"), _t("impact_kg"))


# Q8, Q13 ----------------------------------------------------------------------
def period_emissions(m: DriverModel, window: Window, sites: Sequence[int] | None = None,
                     mission_type: str | None = None, dedup: str = "mission") -> DataFrame:
    e = m.enriched_missions(window, sites)
    if mission_type is not None:
        e = e.filter(F.col("mission_type") == mission_type)
    e = _dedup(e, dedup, TRIP_COLS)
    # Trips between unknown places have no distance: they count, and the total states how many they are.
    return e.agg(F.count(F.lit(1)).alias("n_missions"), F.count(F.when(F.col("km_one_way").isNull(), 1))
                 .alias("n_unlocated"), _t())


# Q9 -------------------------------------------------------------------------
def top_emission_days(m: DriverModel, k: int = 5, transport: str = "plane", dedup: str = "mission") -> DataFrame:
    e = _trips(m, dedup=dedup).filter(F.col("transport") == transport)
    days = e.groupBy("mission_date").agg(F.sum("carbon_kg").alias("__kg"))
    top = days.orderBy(F.col("__kg").desc(), F.col("mission_date").asc()).limit(k)
    return top.select("mission_date", F.round(F.col("__kg") / TONNES, 2).alias("carbon_t"))


# Q10, Q11 ---------------------------------------------------------------------
def combined_emissions(m: DriverModel, by: str, how: str = "inner", dedup: str = "mission") -> DataFrame:
    """Mission and equipment emissions per ``by`` (job_function or site), joined, summed.

    Both sides are aggregated before the join (a handful of rows each), so the
    join is between two tiny results.  ``how="full_outer"`` keeps groups present
    on one side only (missing side = 0); ``"inner"`` is the notebook's choice.
    """
    mis = _trips(m, dedup=dedup, keep=[by]).groupBy(by).agg(F.sum("carbon_kg").alias("__mk"))
    eq = m.equipment_with_impact().groupBy(by).agg(F.sum("impact_kg").alias("__ek"))
    j = mis.join(eq, by, how)
    mk, ek = F.coalesce(F.col("__mk"), F.lit(0.0)), F.coalesce(F.col("__ek"), F.lit(0.0))
    # A handful of groups: ranked by the unrounded total, worst first.
    place = F.row_number().over(W.orderBy((mk + ek).desc(), F.col(by).asc()))
    out = j.select(place.alias("rank"), by, F.round(mk / TONNES, 2).alias("mission_t"),
                   F.round(ek / TONNES, 2).alias("equipment_t"), F.round((mk + ek) / TONNES, 2).alias("total_t"))
    return out.orderBy("rank")


def emissions_by_site_combined(m: DriverModel) -> DataFrame:
    """The sites' names are joined first, the ranking is ordered last (a join drops the order below it)."""
    out = combined_emissions(m, "site_id")
    return out.join(m.small(m.sites()), "site_id").select("rank", "site_id", "site", "mission_t", "equipment_t",
                                                         "total_t").orderBy("rank")


# Q12 ------------------------------------------------------------------------
SITE_CITIES = ("NATION_0", "NATION_1", "NATION_2", "NATION_3", "NATION_4")


def intersite_emissions(m: DriverModel, window: Window = ("1998-05-01", "1998-05-31"),
                        site_cities: Sequence[str] = SITE_CITIES, dedup: str = "mission") -> DataFrame:
    e = _trips(m, window, dedup=dedup, keep=["site_id"]).filter(F.col("dep_city").isin(list(site_cities)) &
                                           F.col("dst_city").isin(list(site_cities)))
    g = e.groupBy("site_id").agg(F.count(F.lit(1)).alias("n_missions"), _t())
    return g.join(m.small(m.sites()), "site_id").select("site_id", "site", "n_missions", "carbon_t")


# Q14, Q17 -------------------------------------------------------------------
def emissions_by(m: DriverModel, by: str, window: Window, mission_type: str | None = None,
                 job_function: str | None = None, sites: Sequence[int] | None = None,
                 k: int | None = None, dedup: str = "mission") -> DataFrame:
    e = m.enriched_missions(window, sites)
    if mission_type is not None:
        e = e.filter(F.col("mission_type") == mission_type)
    if job_function is not None:
        e = e.filter(F.col("job_function") == job_function)
    e = _dedup(e, dedup, list(dict.fromkeys([*TRIP_COLS, by])))
    g = e.groupBy(by).agg(F.count(F.lit(1)).alias("n_missions"), F.sum("carbon_kg").alias("__kg"))
    g = g.orderBy(F.col("__kg").desc(), F.col(by).asc())
    if k is not None:
        g = g.limit(k)
    return g.select(by, "n_missions", F.round(F.col("__kg") / TONNES, 2).alias("carbon_t"))


# Q15 ------------------------------------------------------------------------
def average_age(m: DriverModel, mission_type: str = "Vocational Training",
                window: Window = ("1998-07-01", "1998-09-30"), at: str = "1998-09-30",
                distinct_people: bool = False) -> DataFrame:
    """Average age at ``at`` over missions (the notebook's reading) or over distinct people."""
    mis = m.missions(window, places=False).filter(F.col("mission_type") == mission_type).select("person_id")
    if distinct_people:
        mis = mis.distinct()
    p = m.persons().select("person_id", "birth_date")
    j = mis.join(p, "person_id")
    return j.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.round(F.avg(age_years("birth_date", at)), 5).alias("average_age"))


# Q16 ------------------------------------------------------------------------
def worst_destination(m: DriverModel, window: Window = ("1998-05-01", "1998-10-31"),
                      dedup: str = "mission") -> DataFrame:
    """Emissions per destination (city, country) -- keyed on both, never the city alone."""
    e = _trips(m, window, dedup=dedup)
    g = e.groupBy("dst_city", "dst_country").agg(F.count(F.lit(1)).alias("n_missions"),
                                                 F.sum("carbon_kg").alias("__kg"))
    # One row per place: ranked by the unrounded sum.
    place = F.row_number().over(W.orderBy(F.col("__kg").desc(), "dst_city", "dst_country"))
    return (g.select(place.alias("rank"), "dst_city", "dst_country", "n_missions",
                     F.round(F.col("__kg") / TONNES, 2).alias("carbon_t")).orderBy("rank"))


# Q18 ------------------------------------------------------------------------
def top_single_missions(m: DriverModel, site: int = 1, k: int = 5, dedup: str = "mission") -> DataFrame:
    if dedup == "reference":  # without ids, so equal trips of a person are one
        e = _trips(m, sites=[site], dedup=dedup)
        shown = ["person_id", "mission_date", "dep_city", "dep_country", "dst_city", "dst_country", "transport",
                 "is_return"]
        return e.orderBy(F.col("carbon_kg").desc(), *shown).limit(k).select(
            *shown, F.round("carbon_kg", 3).alias("carbon_kg"))
    e = _trips(m, sites=[site], dedup=dedup)
    top = e.orderBy(F.col("carbon_kg").desc(), "mission_key", "leg", "dst_city").limit(k)
    return top.select("mission_key", "leg", "dep_city", "dep_country", "dst_city", "dst_country", "transport",
                      F.round("carbon_kg", 3).alias("carbon_kg"))


# Q19, Q20 ---------------------------------------------------------------------
def monthly_distance(m: DriverModel, dedup: str = "mission") -> DataFrame:
    """What the notebook's code computes: one-way km by site and month."""
    e = _trips(m, dedup=dedup, keep=["site"]).withColumn("year_month", year_month("mission_date"))
    return (e.groupBy("site", "year_month")
            .agg(F.count(F.lit(1)).alias("n_missions"), F.round(F.sum("km_one_way"), 2).alias("total_km"))
            .orderBy("site", "year_month"))


def monthly_emissions_by_transport(m: DriverModel, dedup: str = "mission") -> DataFrame:
    """What the notebook's question asks: emissions by site, month and transport."""
    e = _trips(m, dedup=dedup, keep=["site"]).withColumn("year_month", year_month("mission_date"))
    return (e.groupBy("site", "year_month", "transport")
            .agg(F.count(F.lit(1)).alias("n_missions"), _t())
            .orderBy("site", "year_month", "transport"))


def monthly_with_global_total(m: DriverModel, label: str = "Global Total", dedup: str = "mission") -> DataFrame:
    e = _trips(m, dedup=dedup, keep=["site"]).withColumn("year_month", year_month("mission_date"))
    out = totals_with_label(e, ["site", "year_month"], ["year_month"], "site", label,
                            [F.count(F.lit(1)).alias("n_missions"), F.round(F.sum("km_one_way"), 2).alias("total_km")])
    return out.orderBy("year_month", "site")
