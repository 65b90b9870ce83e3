"""Incremental refresh of the trips by site and month, and of their totals.

``TripStore`` keeps two tables under a durable folder, both partitioned by
(site_id, year_month): the trips with their kilometres and emissions, and totals
per transport as exact decimals.  A delivery of trips rewrites only the partitions
it touches, by dynamic partition overwrite:

* the touched partitions of the trips are read, missions that are delivered again
  are replaced with all their legs, and the partition is written again;
* the totals of these partitions are summed anew from the refreshed trips.

A repeated or interrupted delivery therefore ends in the same tables as one whole
one, and any sequence of deliveries equals a rebuild.  Totals over sites or
periods (``totals``, ``monthly_with_global``) are merged from the stored sums;
decimals make the merged sums equal to those over all rows.

Defined cases: trips without a site or date go to a partition of nulls; an empty
delivery changes nothing; a delivery holds whole missions, and its repeated rows
count.  A mission whose site or date was corrected is found under its old partition
when that is named in ``also``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import year_month
from ..operators.rollup import totals_with_label
from ..session import delete_folder, reliable_checkpoint, table_scope
from ..sources.sinks import path_exists

KEY = ("mission_key",)
PARTS = ("site_id", "year_month")
SUM = "decimal(38,6)"
_NONE = "__HIVE_DEFAULT_PARTITION__"


class TripStore:
    """Trips and totals under ``path``; ``last`` lists the partitions that the last refresh wrote."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.last = spark, path.rstrip("/"), []

    def _folder(self, table: str, site, month) -> str:
        site, month = (_NONE if x is None else x for x in (site, month))
        return f"{self.path}/{table}/site_id={site}/year_month={month}"

    def _partitions(self, table: str, touched: Sequence[tuple]) -> DataFrame | None:
        there = [f for p in touched if path_exists(self.spark, f := self._folder(table, *p))]
        return self.spark.read.option("basePath", f"{self.path}/{table}").parquet(*there) if there else None

    def _write(self, df: DataFrame, table: str) -> None:
        (df.hint("rebalance", *PARTS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*PARTS).parquet(f"{self.path}/{table}"))

    def refresh(self, trips: DataFrame, also: Sequence[tuple] = ()) -> list[tuple]:
        """Take over ``trips`` (enriched missions); returns the (site_id, year_month) partitions written.

        ``also``: former partitions of trips that moved; the trips leave them.
        """
        with table_scope(self.spark):
            new = trips.withColumn("year_month", year_month("mission_date"))
            new = reliable_checkpoint(new.select(*[c for c in new.columns if c not in PARTS], *PARTS))
            own = {tuple(r) for r in new.select(*PARTS).distinct().collect()}  # the delivery's sites and months
            touched = sorted(own | set(also), key=str)
            old = self._partitions("trips", touched)
            whole = new
            if old is not None:
                kept = old.select(*[F.col(f.name).cast(f.dataType) for f in new.schema.fields]).join(
                    new.select(*KEY).distinct(), list(KEY), "left_anti")
                whole = reliable_checkpoint(kept.select(*new.columns).unionByName(new))
            emptied = [p for p in also if p not in own]
            if touched:
                self._write(whole, "trips")
                self._write(self._sums(whole), "totals")
                for p in emptied:
                    self._drop_if_left(whole, p)
        self.last = touched
        return touched

    def _drop_if_left(self, whole: DataFrame, p: tuple) -> None:
        """Delete a partition whose last trip has moved away (dynamic overwrite leaves it as it was)."""
        here = F.col("site_id").eqNullSafe(F.lit(p[0])) & F.col("year_month").eqNullSafe(F.lit(p[1]))
        if whole.filter(here).isEmpty():
            for table in ("trips", "totals"):
                delete_folder(self.spark, self._folder(table, *p))

    @staticmethod
    def _sums(trips: DataFrame) -> DataFrame:
        def exact(c):
            return F.sum(F.col(c).cast("decimal(28,6)")).cast(SUM).alias(c)

        return trips.groupBy("transport", *PARTS).agg(
            F.count(F.lit(1)).alias("n_missions"), F.count("km_one_way").alias("n_located"), exact("km_one_way"),
            exact("carbon_kg")).select("transport", "n_missions", "n_located", "km_one_way", "carbon_kg", *PARTS)

    def trips(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/trips")

    def totals(self, by: Sequence[str] = PARTS) -> DataFrame:
        """Totals per ``by`` (any of site_id, year_month, transport), merged from the stored sums."""
        t = self.spark.read.parquet(f"{self.path}/totals")
        return t.groupBy(*by).agg(F.sum("n_missions").alias("n_missions"), F.sum("n_located").alias("n_located"),
                                  F.sum("km_one_way").alias("km_one_way"), F.sum("carbon_kg").alias("carbon_kg"))

    def monthly_with_global(self) -> DataFrame:
        """(site_id as text or 'Global Total', year_month, n_missions, total_km) from the stored sums."""
        t = self.totals().withColumn("site", F.col("site_id").cast("string"))
        return totals_with_label(t, ["site", "year_month"], ["year_month"], "site", "Global Total", [
            F.sum("n_missions").alias("n_missions"), F.round(F.sum("km_one_way"), 2).cast("double").alias("total_km")])
