"""The questions over a materialised star schema (``star.write_star_schema``).

``StarModel`` reads the written dimensions and the facts partitioned by
``site_id`` and ``year_month``.  It inherits the enrichment (distance,
emissions) from ``DriverModel`` and replaces only the entity readers, so every
question runs unchanged.  What changes is the physical plan:

* a period window becomes a ``year_month`` range on the partition column
  (``PartitionFilters``: only the months' directories are listed and read) plus
  the exact day range on ``mission_date``;
* trips are joined to travellers on (person, site); a site filter on the
  travellers is propagated by Catalyst to the fact's ``site_id`` partition
  column, so other sites' directories are never read;
* no line-item / order / supplier joins remain: the fact already holds the keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .model import DriverModel, Window


def _months(window: Window):
    s, e = window
    return F.col("year_month").between(str(s)[:7], str(e)[:7])


@dataclass
class StarModel(DriverModel):
    """``sf_dir`` is the directory the star schema was written to."""

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}"

    def small(self, df: DataFrame) -> DataFrame:
        """No hint: a written dimension may have any size; the planner knows its bytes."""
        return df

    def sites(self) -> DataFrame:
        return self.table("dimension_site")

    def locations(self) -> DataFrame:
        return self.table("dimension_location")

    def persons(self) -> DataFrame:
        return self.table("dimension_person")

    def impacts(self) -> DataFrame:
        return self.table("it_impacts")

    def _fact(self, name: str, key: str, date_col: str, window: Window) -> DataFrame:
        f = self.table(name).filter(F.col(key).isNotNull())
        if window:
            f = f.filter(_months(window) & F.col(date_col).between(F.lit(window[0]).cast("date"),
                                                                   F.lit(window[1]).cast("date")))
        return f

    def missions(self, window: Window = None, people: DataFrame | None = None, places: bool = True) -> DataFrame:
        f = self._fact("fact_mission", "mission_key", "mission_date", window)
        tr = self.table("dimension_transport")
        ty = self.table("dimension_mission_type")
        j = f.join(tr, "transport_id").join(ty, "type_id")
        extra: list[str] = []
        if people is not None:
            keys = ["person_id", "site_id"] if "site_id" in people.columns else ["person_id"]
            j = j.drop("dep_location_id").join(people, keys)
            extra = [c for c in people.columns if c != "person_id"]
        cols = ["mission_key", "leg", "person_id", F.col("mission_date").cast("timestamp_ntz").alias("mission_ts"),
                "mission_date", "mission_type", "transport", "is_return", F.col("dst_natural_id").alias("dst_location_id")]
        return j.select(*cols, *extra)

    def equipment(self, window: Window = None, people: DataFrame | None = None, buyers: bool = True) -> DataFrame:
        f = self._fact("fact_equipment", "equipment_key", "purchase_date", window)
        if not buyers:
            return f.select("equipment_key", "leg", F.col("purchase_date").cast("timestamp_ntz").alias("purchase_ts"),
                            "purchase_date", "equip_type", "equip_model")
        p = (people if people is not None else self.persons()).select("person_id", "site_id", "job_function")
        return (f.join(p, ["person_id", "site_id"])
                .select("equipment_key", "leg", "person_id", "site_id", "job_function",
                        F.col("purchase_date").cast("timestamp_ntz").alias("purchase_ts"), "purchase_date",
                        "equip_type", "equip_model"))
