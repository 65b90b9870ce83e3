"""The carbon model over the raw daily drops (the notebook's own input format).

``RawModel`` offers the same entities as ``DriverModel`` -- persons, missions,
enriched missions, equipment with impact, sites -- so every function of
``plans.questions`` runs unchanged on the raw ``;`` drops:

ingest (one multi-site scan per kind) -> blank/trim cleaning -> label
harmonisation (French/German -> English) -> categorical imputation of
equipment type and model (Spark ML) -> gazetteer join on (city, country) ->
native geodesic distance and emissions.

Inputs the checkout lacks (personnel files, impact factors, coordinates) are
parameters: ``personnel`` (ID_PERSONNEL, FONCTION_PERSONNEL, DT_NAISS, site),
``impacts`` (Type, Modèle, Impact) and ``gazetteer`` (city, country, lat, lon).
Without ``personnel`` the travellers come from the drops with unknown job
function and birth date.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from .. import fixed
from ..functions.dates import day_range
from ..functions.emissions import canonical_transport, emission
from ..functions.text import canonical_label
from ..operators.columns import site_dimension
from ..operators.harmonise import translate_expr
from ..operators.impute import impute_pair
from ..operators.places import with_route_distance
from ..session import reliable_checkpoint
from ..sources.raw import read_drops
from .model import Window

SITE_KEYS = {name: key for key, name in fixed.SITES.items()}
# Sites whose drops are written in another language than English.
SITE_LANGUAGE = {"paris": "fr", "berlin": "de"}


def _by_language(column: str, domain: str):
    """``column`` translated with its site's language; labels of other sites stay as they are."""
    out = F.col(column)
    for site, lang in SITE_LANGUAGE.items():
        translated = translate_expr(column, fixed.TRANSLATIONS[(domain, lang)])
        out = F.when(F.lower(F.col("site")) == site, translated).otherwise(out)
    return out


@dataclass
class RawModel:
    spark: SparkSession
    root: str
    gazetteer: DataFrame | None = None
    impacts_df: DataFrame | None = None
    personnel: DataFrame | None = None
    impute: bool = True
    _cache: dict = field(default_factory=dict, repr=False)

    # -- sources -------------------------------------------------------------
    def raw_missions(self) -> DataFrame:
        if "m" not in self._cache:
            self._cache["m"] = read_drops(self.spark, self.root, "mission")
        return self._cache["m"]

    def raw_equipment_drops(self) -> DataFrame:
        if "d" not in self._cache:
            self._cache["d"] = read_drops(self.spark, self.root, "equipment")
        return self._cache["d"]

    def raw_equipment(self) -> DataFrame:
        """The purchases; blank types and models are predicted from each other (materialised once)."""
        if "e" not in self._cache:
            e = self.raw_equipment_drops()
            if self.impute:
                e = reliable_checkpoint(impute_pair(e, "MODELE", "TYPE"))
            self._cache["e"] = e
        return self._cache["e"]

    def forget(self) -> None:
        """Drop the frames read so far (their materialised tables may be released then)."""
        self._cache.clear()

    # -- entities ------------------------------------------------------------
    def sites(self) -> DataFrame:
        """(site_id, site): the known sites keep their keys, further sites found in the paths follow by name."""
        if "sites" not in self._cache:
            found = (self.raw_missions().select("site").unionByName(self.raw_equipment_drops().select("site"))
                     .filter("site is not null and site <> ''").distinct())
            known = site_dimension(self.spark)
            new = found.join(known.select("site"), "site", "left_anti")
            # One row per site: numbered by a window over the distinct names.
            number = (F.row_number().over(W.orderBy("site")) + max(fixed.SITES)).cast("int")
            self._cache["sites"] = known.unionByName(new.select(number.alias("site_id"), "site"))
        return self._cache["sites"]

    def _with_site_id(self, df: DataFrame) -> DataFrame:
        """Add ``site_id`` by the lower-case ``site`` name."""
        s = self.sites().select("site_id", F.col("site").alias("__site"))
        return df.join(s, F.lower(df["site"]) == F.col("__site"), "left").drop("__site")

    def persons(self) -> DataFrame:
        if self.personnel is not None:
            p = self.personnel
            job = _by_language("FONCTION_PERSONNEL", "job_function")
            p = p.select(F.col("ID_PERSONNEL").alias("person_id"), F.lower("site").alias("site"),
                         job.alias("job_function"), F.col("DT_NAISS").alias("birth_date"))
            # A person in several site files: the row of the first site in order, the same on every run.
            first = F.min(F.struct("site", "job_function", "birth_date")).alias("x")
            return self._with_site_id(p.groupBy("person_id").agg(first).select("person_id", "x.*")).select(
                "person_id", "site_id", "job_function", "birth_date")
        m = self.raw_missions().select("ID_PERSONNEL", "site")
        e = self.raw_equipment().select("ID_PERSONNEL", "site")
        people = m.unionByName(e).groupBy("ID_PERSONNEL").agg(F.min("site").alias("site"))
        people = self._with_site_id(people)
        return people.select(F.col("ID_PERSONNEL").alias("person_id"), "site_id",
                             F.lit(None).cast("string").alias("job_function"),
                             F.lit(None).cast("date").alias("birth_date"))

    def missions(self, window: Window = None, people: DataFrame | None = None, places: bool = True) -> DataFrame:
        m = self.raw_missions()
        if window:
            m = m.filter(day_range("DATE_MISSION", *window))
        mt = _by_language("TYPE_MISSION", "mission_type")
        out = self._with_site_id(m).select(
            F.col("ID_MISSION").alias("mission_key"), F.lit(1).alias("leg"), F.col("ID_PERSONNEL").alias("person_id"),
            F.col("site_id").alias("home_site_id"),
            F.col("DATE_MISSION").alias("mission_ts"), F.to_date("DATE_MISSION").alias("mission_date"),
            mt.alias("mission_type"), canonical_transport("TRANSPORT").alias("transport"),
            (F.col("ALLER_RETOUR") == "oui").alias("is_return"),
            F.col("VILLE_DEPART").alias("dep_city"), F.col("PAYS_DEPART").alias("dep_country"),
            F.col("VILLE_DESTINATION").alias("dst_city"), F.col("PAYS_DESTINATION").alias("dst_country"))
        if people is not None:
            out = out.join(people.drop("site_id") if "site_id" in people.columns else people, "person_id", "left")
        return out

    def enriched_missions(self, window: Window = None, sites: Sequence[int] | None = None) -> DataFrame:
        p = self.persons().drop("site_id")
        m = self.missions(window).withColumnRenamed("home_site_id", "site_id")
        if sites is not None:
            m = m.filter(F.col("site_id").isin(list(sites)))
        m = m.join(p, "person_id", "left").join(self.sites(), "site_id", "left")
        if self.gazetteer is None:
            raise ValueError("a gazetteer (city, country, lat, lon) is needed for distances")
        m = with_route_distance(m, self.gazetteer)
        total = F.col("km_one_way") * F.when(F.col("is_return"), F.lit(2.0)).otherwise(F.lit(1.0))
        return m.select(
            "mission_key", "leg", "person_id", "site_id", "site", "job_function", "birth_date", "mission_ts",
            "mission_date", "mission_type", "transport", "is_return", "dep_city", "dep_country", "dst_city",
            "dst_country", "km_one_way", emission("transport", "km_one_way", total, "A").alias("carbon_kg"))

    def small(self, df: DataFrame) -> DataFrame:
        return df

    def equipment(self, window: Window = None, buyers: bool = True) -> DataFrame:
        e = self.raw_equipment()
        if window:
            e = e.filter(day_range("DATE_ACHAT", *window))
        p = self.persons().select("person_id", "job_function")
        out = self._with_site_id(e).select(
                       F.col("ID_MATERIELINFO").alias("equipment_key"), F.lit(1).alias("leg"),
                       F.col("ID_PERSONNEL").alias("person_id"), "site_id",
                       F.col("DATE_ACHAT").alias("purchase_ts"), F.to_date("DATE_ACHAT").alias("purchase_date"),
                       F.col("TYPE").alias("equip_type"), F.col("MODELE").alias("equip_model"))
        return out.join(p, "person_id", "left")

    def impacts(self) -> DataFrame:
        if self.impacts_df is None:
            raise ValueError("impact factors (Type, Modèle, Impact) are needed")
        return self.impacts_df.select(F.col("Type").alias("imp_type"), F.col("Modèle").alias("imp_model"),
                                      F.col("Impact").alias("impact_kg"))

    def equipment_with_impact(self, window: Window = None, buyers: bool = True) -> DataFrame:
        imp = self.impacts()
        imp = (imp.groupBy(canonical_label("imp_type").alias("__t"), canonical_label("imp_model").alias("__m"))
               .agg(F.max("impact_kg").alias("impact_kg")))  # one factor per canonical key: no fan-out
        e = self.equipment(window, buyers)
        return (e.join(imp, (canonical_label("equip_type") == F.col("__t")) &
                       (canonical_label("equip_model") == F.col("__m")))
                .drop("__t", "__m"))
