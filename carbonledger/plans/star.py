"""Materialise the star schema (dimensions + facts) as Parquet tables.

Facts are written partitioned by site and month so that the questions'
site and period filters prune whole directories.  The fact ids are per-site
sequential keys built without a per-site window (see ``operators.keys``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import year_month
from ..operators.dimensions import build_dimension, pool
from ..operators.joins import left_join_dimension
from ..operators.keys import sequential_index
from ..session import reliable_checkpoint, table_scope
from ..sources.sinks import save_parquet
from .model import DriverModel, Window


def _kept(registry: str | None, name: str) -> str | None:
    return f"{registry}/{name}" if registry else None


def dim_date(m: DriverModel, registry: str | None = None) -> DataFrame:
    """Calendar days of orders and purchases (at most one row per day of the calendar).

    ``registry`` (here and below): folder of key registries, so that keys outlive a build.
    """
    o = m.table("orders").select(F.to_date("o_orderdate").alias("d"))
    li = m.table("lineitem").select(F.to_date("l_shipdate").alias("d"))
    return build_dimension(pool([o, li], [["d"], ["d"]], ["date"]), "date_id", blank_policy="drop", bounded=True,
                           registry=_kept(registry, "dimension_date"))


def dim_location(m: DriverModel, trips: DataFrame | None = None, registry: str | None = None) -> DataFrame:
    """Departure and destination places of the trips (distinct routes first, then names).

    ``trips``: the materialised trips with their travellers, where a build has
    them; then no line item is read again.
    """
    r = m.named_routes(m.routes(trips=trips))
    places = pool([r, r], [["dep_city", "dep_country"], ["dst_city", "dst_country"]], ["city", "country"])
    return build_dimension(places, "location_id", blank_policy="drop", bounded=True,
                           registry=_kept(registry, "dimension_place"))


def dim_transport(m: DriverModel) -> DataFrame:
    return build_dimension(m.transports(), "transport_id", bounded=True)


def dim_mission_type(m: DriverModel) -> DataFrame:
    return build_dimension(m.mission_types(), "type_id", bounded=True)


def trips_once(m: DriverModel, window: Window = None) -> DataFrame:
    """The trips (line item / order / supplier join), materialised once, with a tie-break id."""
    return reliable_checkpoint(m.missions(window).select(
        "person_id", "mission_key", "leg", "mission_date", "dst_location_id", "mission_type", "transport",
        "is_return", F.monotonically_increasing_id().alias("__tie")))


def label_dimensions(trips: DataFrame, registry: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(transports, mission types) of the materialised trips."""
    return (build_dimension(trips.select("transport"), "transport_id", bounded=True,
                            registry=_kept(registry, "dimension_transport")),
            build_dimension(trips.select("mission_type"), "type_id", bounded=True,
                            registry=_kept(registry, "dimension_mission_type")))


def fact_mission(m: DriverModel, window: Window = None, trips: DataFrame | None = None,
                 registry: str | None = None) -> DataFrame:
    """person LEFT JOIN missions (people without a trip keep one row of nulls), with the keys of five dimensions:
    date, mission type, transport, departure and destination.

    ``window`` restricts the trips, not the people; None (the default) takes all.
    The trips are materialised once and feed the label dimensions, the keyed
    trips and the people without trips; a second materialisation holds the
    range-partitioned rows for numbering.  Labels, calendar days and places are
    tables of fixed size and are broadcast.
    """
    mis = trips if trips is not None else trips_once(m, window)
    tr, ty = label_dimensions(mis, registry)
    day = dim_date(m, registry).withColumnRenamed("date", "mission_date")
    loc, names = dim_location(m, mis, registry), m.locations().select("location_id", "city", "country")
    place = names.withColumnRenamed("location_id", "__natural").join(loc, ["city", "country"]).select(
        "__natural", "location_id")
    here = place.select(F.col("__natural").alias("home_location_id"), F.col("location_id").alias("dep_location_id"))
    there = place.select(F.col("__natural").alias("dst_location_id"), F.col("location_id").alias("__dst"))
    p = m.persons().select("site_id", "person_id", "home_location_id").join(
        m.small(here), "home_location_id", "left").drop("home_location_id")
    keyed = (mis.join(F.broadcast(tr), "transport", "left").join(F.broadcast(ty), "mission_type", "left")
             .join(F.broadcast(day), "mission_date", "left").join(m.small(there), "dst_location_id", "left")
             .select("person_id", "mission_key", "leg", "mission_date", "date_id",
                     F.col("__dst").alias("dst_location_id"), "type_id", "transport_id", "is_return", "__tie"))
    f = left_join_dimension(p, keyed, ["person_id"], materialize=False)
    order = ["person_id", "mission_date", "mission_key", "leg", "dst_location_id", "type_id", "transport_id",
             "is_return"]
    out = sequential_index(f, [*order, "__tie"], partition_cols=["site_id"], out="fact_id", split_ties=False)
    return out.select("fact_id", "site_id", "person_id", "mission_key", "leg", "mission_date", "date_id",
                      "dep_location_id", "dst_location_id", "type_id", "transport_id", "is_return")


def fact_equipment(m: DriverModel, window: Window = None) -> DataFrame:
    """person LEFT JOIN purchases, with the date key; type and model keep their natural values."""
    day = F.broadcast(dim_date(m).withColumnRenamed("date", "purchase_date"))
    e = reliable_checkpoint(m.purchases(window).join(day, "purchase_date", "left").withColumn(
        "__tie", F.monotonically_increasing_id()))
    p = m.persons().select("site_id", "person_id")
    f = left_join_dimension(p, e, ["person_id"], materialize=False)
    order = ["person_id", "purchase_date", "equipment_key", "leg", "equip_type", "equip_model"]
    out = sequential_index(f, [*order, "__tie"], partition_cols=["site_id"], out="fact_id", split_ties=False)
    return out.select("fact_id", "site_id", "person_id", "equipment_key", "leg", "purchase_date", "date_id",
                      "equip_type", "equip_model")


def people_without_trips(m: DriverModel, window: Window) -> DataFrame:
    """(site_id, person_id) of the people without any trip in ``window``."""
    seen = m.missions(window, places=False).select("person_id").distinct()
    return m.persons().select("site_id", "person_id").join(seen, "person_id", "left_anti").select(
        "site_id", "person_id")


def write_star_schema(m: DriverModel, out_dir: str, window: Window = None, overwrite: bool = True,
                      registry: str | None = None) -> list[str]:
    """Write the dimensions and both facts under ``out_dir``; returns the table names.

    The trips are joined once and feed the transport and mission type
    dimensions and the fact.  The fact's location keys point into
    ``dimension_place`` (the travelled places); ``dimension_location`` is the
    gazetteer under its natural key, which the questions use.  Facts are
    partitioned by site and month, so ``StarModel`` questions prune directories
    by site and period.  The materialised intermediate tables are deleted at the
    end.  With ``registry`` (a durable folder) a value keeps its key from one
    build to the next.
    """
    with table_scope(m.spark):
        trips = trips_once(m, window)
        fact = fact_mission(m, window, trips, registry)
        natural = m.locations().select(F.col("location_id").alias("dst_natural_id"), "city", "country")
        places, (transports, types) = dim_location(m, trips, registry), label_dimensions(trips, registry)
        place = places.join(natural, ["city", "country"]).select(
            F.col("location_id").alias("dst_location_id"), "dst_natural_id")
        tables = {
            "dimension_site": (m.sites(), ()),
            "dimension_location": (m.locations(), ()),
            "dimension_place": (places, ()),
            "dimension_date": (dim_date(m, registry), ()),
            "dimension_person": (m.persons(), ()),
            "dimension_transport": (transports, ()),
            "dimension_mission_type": (types, ()),
            "it_impacts": (m.impacts(), ()),
            "fact_mission": (fact.join(m.small(place), "dst_location_id", "left")
                             .withColumn("year_month", year_month("mission_date")), ("site_id", "year_month")),
            "fact_equipment": (fact_equipment(m, window).withColumn("year_month", year_month("purchase_date")),
                               ("site_id", "year_month")),
        }
        for name, (df, parts) in tables.items():
            save_parquet(df, f"{out_dir}/{name}", overwrite=overwrite, partition_by=parts)
    return list(tables)


def raw_star_tables(raw, window: Window = None) -> dict[str, DataFrame]:
    """The star schema built from the raw daily drops (``RawModel``).

    Dimensions: site, person, model (blank -> "NULL"), type, date (purchase and
    mission days pooled), transport, mission type, location (departure and
    destination pairs pooled).  Facts: person LEFT JOIN missions with
    dimension keys, person LEFT JOIN purchases with natural type/model values;
    both carry a per-site sequential fact id.
    """
    mis = raw.missions(window)
    eq = raw.equipment(window)
    persons = raw.persons()
    dims = {
        "dimension_site": raw.sites(),
        "dimension_person": persons,
        "dimension_model": build_dimension(eq.select(F.col("equip_model").alias("model")), "model_id",
                                           blank_policy="sentinel"),
        "dimension_type": build_dimension(eq.select(F.col("equip_type").alias("type")), "type_id"),
        "dimension_date": build_dimension(pool([eq, mis], [["purchase_date"], ["mission_date"]], ["date"]),
                                          "date_id"),
        "dimension_transport": build_dimension(mis.select("transport"), "transport_id"),
        "dimension_mission_type": build_dimension(mis.select("mission_type"), "mission_type_id"),
        "dimension_location": build_dimension(
            pool([mis, mis], [["dep_city", "dep_country"], ["dst_city", "dst_country"]], ["city", "country"]),
            "location_id"),
    }
    # Materialised, the planner knows each dimension's bytes and broadcasts it below the threshold.
    dims = {k: v if k == "dimension_person" else reliable_checkpoint(v) for k, v in dims.items()}
    b = dims
    loc = b["dimension_location"]
    d = loc.select(F.col("location_id").alias("dep_location_id"), F.col("city").alias("dep_city"),
                   F.col("country").alias("dep_country"))
    a = loc.select(F.col("location_id").alias("dst_location_id"), F.col("city").alias("dst_city"),
                   F.col("country").alias("dst_country"))
    m = (mis.join(d, ["dep_city", "dep_country"], "left").join(a, ["dst_city", "dst_country"], "left")
         .join(b["dimension_transport"], "transport", "left")
         .join(b["dimension_mission_type"], "mission_type", "left")
         .join(b["dimension_date"].withColumnRenamed("date", "mission_date"), "mission_date", "left")
         .select("person_id", "mission_key", "date_id", "dep_location_id", "dst_location_id", "mission_type_id",
                 "transport_id", "is_return", "mission_date"))
    f = left_join_dimension(persons.select("person_id", "site_id"), m, ["person_id"])
    fm = sequential_index(f, ["person_id", "mission_date", "mission_key"], partition_cols=["site_id"], out="fact_id")
    e = eq.drop("site_id", "job_function", "leg", "purchase_ts")
    fe = left_join_dimension(persons.select("person_id", "site_id"), e, ["person_id"])
    fe = sequential_index(fe, ["person_id", "purchase_date", "equipment_key"], partition_cols=["site_id"],
                          out="fact_id")
    return {**dims, "fact_mission": fm.drop("mission_date").select("fact_id", *[c for c in fm.columns
                                                                                 if c not in ("fact_id", "mission_date")]),
            "fact_equipment": fe.select("fact_id", *[c for c in fe.columns if c != "fact_id"])}


def write_raw_star_schema(raw, out_dir: str, window: Window = None, overwrite: bool = True) -> list[str]:
    with table_scope(raw.spark):
        tables = raw_star_tables(raw, window)
        for name, df in tables.items():
            parts = ("site_id",) if name.startswith("fact_") else ()
            save_parquet(df, f"{out_dir}/{name}", overwrite=overwrite, partition_by=parts)
        raw.forget()  # its purchases were materialised among the tables now released
    return list(tables)
