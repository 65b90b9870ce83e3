"""

``DriverModel`` exposes the model's entities as DataFrames built from the
given Parquet tables; ``ModelSQL`` writes the same entities as SQL CTEs for the
DuckDB oracle, with factors and labels written out in ``oracle_text``.

Physical plan, per entity:

* ``region`` (5 rows) and ``nation`` (25 rows) have a fixed cardinality by
  definition and are broadcast explicitly;
* ``customer``, ``supplier``, ``part`` and ``orders`` grow with the data and are
  never hinted: AQE broadcasts them at runtime only when the measured shuffle
  size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``, else keeps a
  sort-merge join and splits skewed partitions (a customer with a third of all
  orders);
* the date window is written on the raw timestamp column so it reaches the
  Parquet scan as ``PushedFilters``; other filters are pushed by Catalyst;
* distances and emissions are column expressions evaluated in the join's
  codegen stage, never Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.dates import day_range, day_range_sql
from ..functions.emissions import emission_sql
from ..functions.geo import geodesic_sql, with_geodesic_km
from ..functions.text import canonical_label
from ..operators.broadcast import fixed_broadcast
from ..operators.harmonise import translate_expr
from . import oracle_text as text

Window = tuple[str, str] | None


def _map_or(col_sql: str, mapping: dict, default: str) -> Column:
    """``mapping[col]`` or ``default``, parsed from SQL text (the same text the oracle uses)."""
    return F.expr(ModelSQL._map_sql(col_sql, mapping, default))


@dataclass
class DriverModel:
    spark: SparkSession
    sf_dir: str
    _tables: dict = field(default_factory=dict, repr=False)

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        """The table, read once per model (its schema from the Parquet footer)."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(self.path(name))
        return self._tables[name]

    def small(self, df: DataFrame) -> DataFrame:
        """Hint for the sites and locations: region (5 rows) and nation (25 rows) have a fixed size."""
        return fixed_broadcast(df)

    # -- fixed-size dimensions --------------------------------------------
    def sites(self) -> DataFrame:
        return self.table("region").select(F.col("r_regionkey").alias("site_id"), F.col("r_name").alias("site"))

    def locations(self) -> DataFrame:
        """location_id, city, country, lat, lon (synthetic coordinates from the key)."""
        n = self.table("nation")
        r = self.table("region").select("r_regionkey", F.col("r_name").alias("country"))
        k = F.col("n_nationkey")
        a = k % 5
        b = (k - a) / 5
        return (n.join(fixed_broadcast(r), n["n_regionkey"] == r["r_regionkey"])
                .select(k.alias("location_id"), F.col("n_name").alias("city"), "country",
                        (F.lit(10.0) + F.lit(8.0) * a + b).alias("lat"),
                        (F.lit(-50.0) + F.lit(25.0) * a + F.lit(1.1) * b).alias("lon")))

    def gazetteer(self) -> DataFrame:
        return self.locations().select("country", "city", "lat", "lon")

    # -- people ------------------------------------------------------------
    def persons(self) -> DataFrame:
        """person_id, person_name, site_id, home_location_id, job_function, birth_date."""
        c = self.table("customer")
        n = fixed_broadcast(self.table("nation").select("n_nationkey", F.col("n_regionkey").alias("site_id")))
        birth = F.date_add(F.lit(fixed.BIRTH_EPOCH).cast("date"),
                           ((F.col("c_custkey") * fixed.BIRTH_MULT) % fixed.BIRTH_SPAN_DAYS).cast("int"))
        return (c.join(n, c["c_nationkey"] == n["n_nationkey"])
                .select(F.col("c_custkey").alias("person_id"), F.col("c_name").alias("person_name"), "site_id",
                        F.col("c_nationkey").alias("home_location_id"),
                        translate_expr("c_mktsegment", fixed.SEGMENT_JOB).alias("job_function"),
                        birth.alias("birth_date")))

    # -- missions ----------------------------------------------------------
    def missions(self, window: Window = None, people: DataFrame | None = None, places: bool = True) -> DataFrame:
        """One row per trip leg (lineitem), dated by its order; without dst_location_id unless ``places``.

        mission_key, leg, person_id, mission_ts, mission_date, mission_type,
        transport, is_return, dst_location_id (+ the columns of ``people``).

        With ``people`` the orders are joined to the travellers *before* the
        line items: orders are about a quarter of the line items, so the
        line-item-sized stream is shuffled twice (order key, supplier key)
        instead of three times, and a site filter on ``people`` shrinks the
        orders before they meet the line items.
        """
        o = self.table("orders")
        if window:
            o = o.filter(day_range("o_orderdate", *window))
        o = o.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
        extra: list[str] = []
        if people is not None:
            o = o.join(people, o["o_custkey"] == people["person_id"]).drop("person_id")
            extra = [c for c in people.columns if c != "person_id"]
        li = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
        j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
        if places:
            s = self.table("supplier").select("s_suppkey", "s_nationkey")
            j = j.join(s, F.col("l_suppkey") == s["s_suppkey"])
        return j.select(
            F.col("l_orderkey").alias("mission_key"), F.col("l_linenumber").alias("leg"),
            F.col("o_custkey").alias("person_id"), F.col("o_orderdate").alias("mission_ts"),
            F.to_date("o_orderdate").alias("mission_date"),
            translate_expr("l_returnflag", fixed.RETURNFLAG_TYPE).alias("mission_type"),
            _map_or("substr(o_orderpriority, 1, 1)", fixed.PRIORITY_TRANSPORT, fixed.OTHER).alias("transport"),
            (F.col("o_orderstatus") == "F").alias("is_return"),
            *([F.col("s_nationkey").alias("dst_location_id")] if places else []), *extra)

    def transports(self) -> DataFrame:
        """Transport of every order that has a trip (line items are only probed for existence)."""
        li = self.table("lineitem").select("l_orderkey")
        o = self.table("orders").select("o_orderkey", "o_orderpriority")
        return o.join(li, o["o_orderkey"] == li["l_orderkey"], "left_semi").select(
            _map_or("substr(o_orderpriority, 1, 1)", fixed.PRIORITY_TRANSPORT, fixed.OTHER).alias("transport"))

    def mission_types(self) -> DataFrame:
        """Trip types, from the line items alone."""
        return self.table("lineitem").select(
            translate_expr("l_returnflag", fixed.RETURNFLAG_TYPE).alias("mission_type"))

    def equipment_labels(self) -> DataFrame:
        """(equip_type, equip_model) of the parts that were bought: distinct part keys first, then the parts."""
        bought = self.table("lineitem").select("l_partkey").distinct()
        part = self.table("part").select("p_partkey", "p_type", "p_brand")
        return part.join(bought, part["p_partkey"] == bought["l_partkey"], "left_semi").select(
            translate_expr("p_type", fixed.PTYPE_EQUIPMENT).alias("equip_type"), F.col("p_brand").alias("equip_model"))

    def enriched_missions(self, window: Window = None, sites: Sequence[int] | None = None) -> DataFrame:
        """Missions with the traveller, both places, the one-way km and the set-A emission (kg)."""
        p = self.persons()
        if sites is not None:
            p = p.filter(F.col("site_id").isin(list(sites)))
        m = self.missions(window, people=p.drop("person_name"))
        # One location table serves both roles: the two join sides are the same
        # plan, so ReuseExchange ships it once.  An unknown place keeps its trip:
        # the distance is null, and so is the emission of a known mode.
        loc = self.small(self.locations())
        site = self.small(self.sites())
        d, a = loc.alias("d"), loc.alias("a")
        j = (m.join(site, "site_id", "left")
             .join(d, F.col("home_location_id") == F.col("d.location_id"), "left")
             .join(a, F.col("dst_location_id") == F.col("a.location_id"), "left")
             .select(m["*"], F.col("site"), F.col("d.city").alias("dep_city"), F.col("d.country").alias("dep_country"),
                     F.col("d.lat").alias("__dlat"), F.col("d.lon").alias("__dlon"), F.col("a.city").alias("dst_city"),
                     F.col("a.country").alias("dst_country"), F.col("a.lat").alias("__alat"),
                     F.col("a.lon").alias("__alon")))
        j = with_geodesic_km(j, "__dlat", "__dlon", "__alat", "__alon", out="km_one_way")
        total = "(km_one_way * CASE WHEN is_return THEN 2.0e0 ELSE 1.0e0 END)"
        return j.select(
            "mission_key", "leg", "person_id", "site_id", "site", "job_function", "birth_date", "mission_ts",
            "mission_date", "mission_type", "transport", "is_return", "dep_city", "dep_country", "dst_city",
            "dst_country", "km_one_way",
            F.expr(emission_sql("transport", "km_one_way", total, "A")).alias("carbon_kg"))

    def routes(self, window: Window = None, trips: DataFrame | None = None) -> DataFrame:
        """Distinct (departure, destination) location ids actually travelled.

        The distinct runs as a partial aggregate inside each task, so at most
        (#locations)^2 rows per task cross the shuffle, however many trips.
        ``trips`` (person_id, dst_location_id): trips already materialised; their
        distinct pairs meet the travellers.
        """
        p = self.persons().select("person_id", "home_location_id")
        if trips is not None:
            m = trips.select("person_id", "dst_location_id").distinct().join(p, "person_id")
        else:
            m = self.missions(window, people=p)
        return m.select(F.col("home_location_id").alias("dep_id"), F.col("dst_location_id").alias("dst_id")).distinct()

    def route_distances(self, window: Window = None) -> DataFrame:
        """dep/dst city and country with the one-way km, one row per travelled route.

        Names and coordinates are attached after the distinct, so the
        trigonometry runs once per route, not once per trip.
        """
        r = self.named_routes(self.routes(window))
        return with_geodesic_km(r, "__dlat", "__dlon", "__alat", "__alon", out="km_one_way") \
            .drop("__dlat", "__dlon", "__alat", "__alon")

    def named_routes(self, routes: DataFrame) -> DataFrame:
        """Names and coordinates of both ends of ``routes``; a route with an unknown end is left out."""
        loc = self.small(self.locations())
        d, a = loc.alias("d"), loc.alias("a")
        return (routes
             .join(d, F.col("dep_id") == F.col("d.location_id"))
             .join(a, F.col("dst_id") == F.col("a.location_id"))
             .select(F.col("d.city").alias("dep_city"), F.col("d.country").alias("dep_country"),
                     F.col("a.city").alias("dst_city"), F.col("a.country").alias("dst_country"),
                     F.col("d.lat").alias("__dlat"), F.col("d.lon").alias("__dlon"),
                     F.col("a.lat").alias("__alat"), F.col("a.lon").alias("__alon")))

    # -- equipment ---------------------------------------------------------
    def equipment(self, window: Window = None, people: DataFrame | None = None, buyers: bool = True) -> DataFrame:
        """One purchase per lineitem: equipment_key, leg, person_id, site_id, job_function,
        purchase_ts, purchase_date, equip_type, equip_model; without the three buyer columns unless ``buyers``
        (then only line items and parts are read).

        As for trips, orders meet the buyers before the line items, so the
        line-item-sized stream is shuffled twice (order key, part key); a filter
        on ``people`` (site, job function) shrinks the orders first.
        """
        li = self.table("lineitem")
        if window:
            li = li.filter(day_range("l_shipdate", *window))
        li = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
        part = self.table("part").select("p_partkey", "p_type", "p_brand")
        j, who = li, []
        if buyers:
            p = (people if people is not None else self.persons()).select("person_id", "site_id", "job_function")
            o = self.table("orders").select("o_orderkey", "o_custkey")
            o = o.join(p, o["o_custkey"] == p["person_id"]).drop("o_custkey")
            j, who = li.join(o, li["l_orderkey"] == o["o_orderkey"]), ["person_id", "site_id", "job_function"]
        j = j.join(part, F.col("l_partkey") == part["p_partkey"])
        return j.select(
            F.col("l_orderkey").alias("equipment_key"), F.col("l_linenumber").alias("leg"), *who, F.col("l_shipdate").alias("purchase_ts"), F.to_date("l_shipdate").alias("purchase_date"),
            translate_expr("p_type", fixed.PTYPE_EQUIPMENT).alias("equip_type"),
            F.col("p_brand").alias("equip_model"))

    def purchases(self, window: Window = None) -> DataFrame:
        """Purchases without the buyer's attributes (person_id from the order):
        equipment_key, leg, person_id, purchase_date, equip_type, equip_model."""
        li = self.table("lineitem")
        if window:
            li = li.filter(day_range("l_shipdate", *window))
        li = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
        o = self.table("orders").select("o_orderkey", "o_custkey")
        part = self.table("part").select("p_partkey", "p_type", "p_brand")
        j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(part, F.col("l_partkey") == part["p_partkey"])
        return j.select(F.col("l_orderkey").alias("equipment_key"), F.col("l_linenumber").alias("leg"),
                        F.col("o_custkey").alias("person_id"), F.to_date("l_shipdate").alias("purchase_date"),
                        translate_expr("p_type", fixed.PTYPE_EQUIPMENT).alias("equip_type"),
                        F.col("p_brand").alias("equip_model"))

    def impacts(self) -> DataFrame:
        """Impact factor per (type, model): average list price of the catalogue's parts, kg CO2e."""
        part = self.table("part")
        return (part.groupBy("p_type", "p_brand").agg(F.avg("p_retailprice").alias("impact_kg"))
                .select(translate_expr("p_type", fixed.PTYPE_EQUIPMENT).alias("imp_type"),
                        F.col("p_brand").alias("imp_model"), "impact_kg"))

    def equipment_with_impact(self, window: Window = None, buyers: bool = True) -> DataFrame:
        """Purchases inner-joined to their impact on canonicalised (type, model).

        The impact table has one row per catalogue (type, model); AQE broadcasts
        it by its measured size.
        """
        e = self.equipment(window, buyers=buyers)
        imp = self.impacts().select(canonical_label("imp_type").alias("__t"), canonical_label("imp_model").alias("__m"),
                                    "impact_kg")
        return (e.join(imp, (canonical_label("equip_type") == F.col("__t")) &
                       (canonical_label("equip_model") == F.col("__m")))
                .drop("__t", "__m"))


class ModelSQL:
    """The same entities as SQL text (DuckDB dialect; ANSI where possible), with factors and labels written by hand."""

    @staticmethod
    def _map_sql(col: str, mapping: dict, default: str) -> str:
        whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
        return f"(CASE {col} {whens} ELSE '{default}' END)"

    @classmethod
    def sites(cls) -> str:
        return "SELECT r_regionkey AS site_id, r_name AS site FROM region"

    @classmethod
    def locations(cls) -> str:
        a = "(n.n_nationkey % 5)"
        b = f"((n.n_nationkey - {a}) / 5)"
        return (f"SELECT n.n_nationkey AS location_id, n.n_name AS city, r.r_name AS country, "
                f"(10.0e0 + 8.0e0 * {a} + {b}) AS lat, (-50.0e0 + 25.0e0 * {a} + 1.1e0 * {b}) AS lon "
                f"FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")

    @classmethod
    def persons(cls) -> str:
        return (f"SELECT c.c_custkey AS person_id, c.c_name AS person_name, n.n_regionkey AS site_id, "
                f"c.c_nationkey AS home_location_id, {text.JOB_FUNCTION.format(col='c.c_mktsegment')} AS job_function, "
                f"CAST(DATE '{fixed.BIRTH_EPOCH}' + CAST((c.c_custkey * {fixed.BIRTH_MULT}) % {fixed.BIRTH_SPAN_DAYS} AS INTEGER) AS DATE) AS birth_date "
                f"FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey")

    @classmethod
    def missions(cls, window: Window = None) -> str:
        where = f"WHERE {day_range_sql('o.o_orderdate', *window)}" if window else ""
        return (f"SELECT l.l_orderkey AS mission_key, l.l_linenumber AS leg, o.o_custkey AS person_id, "
                f"o.o_orderdate AS mission_ts, CAST(o.o_orderdate AS DATE) AS mission_date, "
                f"{text.MISSION_TYPE.format(col='l.l_returnflag')} AS mission_type, "
                f"{text.TRANSPORT.format(col='o.o_orderpriority')} AS transport, "
                f"(o.o_orderstatus = 'F') AS is_return, s.s_nationkey AS dst_location_id "
                f"FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
                f"JOIN supplier s ON l.l_suppkey = s.s_suppkey {where}")

    @classmethod
    def enriched_ctes(cls, window: Window = None, sites: Sequence[int] | None = None) -> str:
        """CTEs ``loc, st, per, mis, em`` ending with ``em`` = enriched missions."""
        site_filter = f"WHERE site_id IN ({', '.join(str(int(s)) for s in sites)})" if sites is not None else ""
        total = "(g.km_one_way * CASE WHEN g.is_return THEN 2.0e0 ELSE 1.0e0 END)"
        return (
            f"loc AS ({cls.locations()}), st AS ({cls.sites()}), "
            f"per AS (SELECT * FROM ({cls.persons()}) pp {site_filter}), "
            f"mis AS ({cls.missions(window)}), "
            f"geo AS (SELECT m.mission_key, m.leg, m.person_id, p.site_id, st.site, p.job_function, p.birth_date, "
            f"m.mission_ts, m.mission_date, m.mission_type, m.transport, m.is_return, d.city AS dep_city, "
            f"d.country AS dep_country, a.city AS dst_city, a.country AS dst_country, "
            f"{geodesic_sql('d.lat', 'd.lon', 'a.lat', 'a.lon')} AS km_one_way "
            f"FROM mis m JOIN per p ON m.person_id = p.person_id LEFT JOIN st ON p.site_id = st.site_id "
            f"LEFT JOIN loc d ON p.home_location_id = d.location_id "
            f"LEFT JOIN loc a ON m.dst_location_id = a.location_id), "
            f"em AS (SELECT g.*, {text.EMISSION_A.format(mode='g.transport', km='g.km_one_way', total=total)} AS carbon_kg FROM geo g)"
        )

    @classmethod
    def equipment_ctes(cls, window: Window = None) -> str:
        """CTEs ``eper, eq, imp, eqi`` ending with ``eqi`` = purchases with impact."""
        where = f"WHERE {day_range_sql('l.l_shipdate', *window)}" if window else ""
        return (
            f"eper AS ({cls.persons()}), "
            f"eq AS (SELECT l.l_orderkey AS equipment_key, l.l_linenumber AS leg, p.person_id, p.site_id, "
            f"p.job_function, l.l_shipdate AS purchase_ts, CAST(l.l_shipdate AS DATE) AS purchase_date, "
            f"{text.EQUIPMENT_TYPE.format(col='pa.p_type')} AS equip_type, pa.p_brand AS equip_model "
            f"FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part pa ON l.l_partkey = pa.p_partkey "
            f"JOIN eper p ON o.o_custkey = p.person_id {where}), "
            f"imp AS (SELECT {text.EQUIPMENT_TYPE.format(col='p_type')} AS imp_type, p_brand AS imp_model, "
            f"avg(p_retailprice) AS impact_kg FROM part GROUP BY p_type, p_brand), "
            f"eqi AS (SELECT eq.*, imp.impact_kg FROM eq JOIN imp ON lower(trim(eq.equip_type)) = lower(trim(imp.imp_type)) "
            f"AND lower(trim(eq.equip_model)) = lower(trim(imp.imp_model)))"
        )


__all__ = ["DriverModel", "ModelSQL"]
