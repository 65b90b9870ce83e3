"""Label harmonisation with a translation table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import TRANSLATIONS

TRANSLATION_SCHEMA = T.StructType([
    T.StructField("domain", T.StringType(), False),
    T.StructField("lang", T.StringType(), False),
    T.StructField("src", T.StringType(), False),
    T.StructField("dst", T.StringType(), False),
])


def translation_table(spark: SparkSession, pairs: Mapping | None = None) -> DataFrame:
    pairs = TRANSLATIONS if pairs is None else pairs
    rows = [(d, lang, s, t) for (d, lang), m in pairs.items() for s, t in m.items()]
    return spark.createDataFrame(rows, TRANSLATION_SCHEMA)


def translate_expr(col, mapping: Mapping[str, str]) -> Column:
    """``mapping[col]`` if present, else ``col`` (``DataFrame.replace`` semantics).

    For a column name the expression is parsed from SQL text (one call to the
    JVM); for a Column it is a literal-map lookup.
    """
    if not mapping:
        return F.col(col) if isinstance(col, str) else col
    if isinstance(col, str):
        return F.expr(translate_sql(f"`{col}`", mapping))
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[col], col)


def translate_sql(col: str, mapping: Mapping[str, str]) -> str:
    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {col} {whens} ELSE {col} END)"


def harmonise(df: DataFrame, columns: Mapping[str, str], table: DataFrame) -> DataFrame:
    """Translate each ``column`` through ``table`` rows of its ``domain`` (any language).

    ``columns`` maps column name -> domain.  The table is reduced to one target
    per (domain, src) before the join, so duplicated pairs cannot fan rows out;
    it has no hint: AQE broadcasts it by its measured size.  Unmapped values are kept.
    """
    out = df
    for col, domain in columns.items():
        t = (table.filter(F.col("domain") == domain)
             .groupBy("src").agg(F.min("dst").alias("__dst"))
             .withColumnRenamed("src", "__src"))
        out = (out.join(t, out[col] == t["__src"], "left")
               .withColumn(col, F.coalesce(F.col("__dst"), F.col(col))).drop("__src", "__dst"))
    return out


def unmapped(df: DataFrame, column: str, domain: str, table: DataFrame, targets: Sequence[str] | None = None
             ) -> DataFrame:
    """Distinct values of ``column`` that are neither a known source nor a known target label."""
    t = table.filter(F.col("domain") == domain)
    known = t.select(F.col("src").alias("v")).unionByName(t.select(F.col("dst").alias("v"))).distinct()
    vals = df.select(F.col(column).alias("v")).filter(F.col("v").isNotNull()).distinct()
    return vals.join(known, "v", "left_anti").withColumnRenamed("v", column)
