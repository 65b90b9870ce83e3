"""Emission factors as data, emissions as one native CASE expression.

A factor set (``fixed.SET_A`` / ``fixed.SET_B``) is compiled to a single
``CASE WHEN`` column: no Python UDF, so predicates and projections on the result
stay inside whole-stage codegen and Catalyst can push filters below it.  For a
large, data-supplied factor table ``factor_table`` + ``emissions_by_join`` look the
band up in an interval index per mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import FACTOR_SETS, FactorBand, FactorSet


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _band_condition(km: Column, band: FactorBand) -> Column:
    cond = F.lit(True)
    if band.lo is not None:
        cond = cond & ((km >= band.lo) if band.lo_closed else (km > band.lo))
    if band.hi is not None:
        cond = cond & ((km <= band.hi) if band.hi_closed else (km < band.hi))
    return cond


def _value(km: Column, band: FactorBand) -> Column:
    return F.lit(band.factor) * ((km + F.lit(band.add_km)) * F.lit(band.mul))


def emission(mode, tier_km, value_km=None, factors: FactorSet | str = "A") -> Column:
    """Emission of one trip.

    ``mode`` is a canonical transport mode, ``tier_km`` the distance that selects
    the band, ``value_km`` the distance the factor applies to (defaults to
    ``tier_km``).  A known mode with a null distance gives null; a mode without
    a band gives the set's default (0.0 for set A, null for set B).
    """
    fs = FACTOR_SETS[factors] if isinstance(factors, str) else factors
    mode, tier = _c(mode), _c(tier_km)
    value = tier if value_km is None else _c(value_km)
    known = sorted({b.mode for b in fs.bands})
    expr = F.when(mode.isin(known) & (tier.isNull() | value.isNull()), F.lit(None).cast("double"))
    for band in fs.bands:
        expr = expr.when((mode == band.mode) & _band_condition(tier, band), _value(value, band))
    default = F.lit(fs.default).cast("double")
    return expr.otherwise(default)


def dbl(x: float) -> str:
    """A double literal that neither Spark nor DuckDB reads as a decimal."""
    r = repr(float(x))
    return r if "e" in r or "inf" in r or "nan" in r else r + "e0"


def emission_sql(mode: str, tier_km: str, value_km: str | None = None, factors: FactorSet | str = "A") -> str:
    """The same expression as SQL text, generated from the same factor table."""
    fs = FACTOR_SETS[factors] if isinstance(factors, str) else factors
    value = value_km or tier_km
    known = ", ".join(f"'{m}'" for m in sorted({b.mode for b in fs.bands}))
    parts = [f"CASE WHEN {mode} IN ({known}) AND ({tier_km} IS NULL OR {value} IS NULL) THEN CAST(NULL AS DOUBLE)"]
    for b in fs.bands:
        cond = [f"{mode} = '{b.mode}'"]
        if b.lo is not None:
            cond.append(f"{tier_km} {'>=' if b.lo_closed else '>'} {dbl(b.lo)}")
        if b.hi is not None:
            cond.append(f"{tier_km} {'<=' if b.hi_closed else '<'} {dbl(b.hi)}")
        parts.append(f"WHEN {' AND '.join(cond)} THEN {dbl(b.factor)} * (({value} + {dbl(b.add_km)}) * {dbl(b.mul)})")
    default = "CAST(NULL AS DOUBLE)" if fs.default is None else dbl(fs.default)
    return " ".join(parts) + f" ELSE {default} END"


FACTOR_SCHEMA = T.StructType([
    T.StructField("factor_set", T.StringType(), False),
    T.StructField("mode", T.StringType(), False),
    T.StructField("km_lo", T.DoubleType(), True),
    T.StructField("km_hi", T.DoubleType(), True),
    T.StructField("lo_closed", T.BooleanType(), False),
    T.StructField("hi_closed", T.BooleanType(), False),
    T.StructField("add_km", T.DoubleType(), False),
    T.StructField("mul", T.DoubleType(), False),
    T.StructField("factor", T.DoubleType(), False),
])


def factor_table(spark: SparkSession, *sets: str) -> DataFrame:
    """The factor sets as a DataFrame ``emission_factor(set, mode, lo, hi, ...)``."""
    rows = []
    for name in sets or tuple(FACTOR_SETS):
        for b in FACTOR_SETS[name].bands:
            rows.append((name, b.mode, b.lo, b.hi, b.lo_closed, b.hi_closed, b.add_km, b.mul, b.factor))
    return spark.createDataFrame(rows, FACTOR_SCHEMA)


MANY_BANDS = 100_000  # broadcast up to so many (a band is some 50 bytes)


def _edges(factors: DataFrame) -> DataFrame:
    """Bands as half-open ranges of (km, 0 at the value or 1 just above it), whatever their ends include."""
    low = F.struct(F.coalesce("km_lo", F.lit(float("-inf"))).alias("km"),
                   F.when(F.col("lo_closed") | F.col("km_lo").isNull(), 0).otherwise(1).alias("above"))
    high = F.struct(F.coalesce("km_hi", F.lit(float("inf"))).alias("km"),
                    F.when(F.col("hi_closed") | F.col("km_hi").isNull(), 1).otherwise(0).alias("above"))
    return factors.select("mode", low.alias("low"), high.alias("high"), "add_km", "mul", "factor")


def band_problems(factors: DataFrame) -> DataFrame:
    """(mode, problem, km): overlaps, gaps and empty bands of one factor set; a gap only between two bands."""
    e = _edges(factors)
    w = Window.partitionBy("mode").orderBy("low", "high")
    reached = F.max("high").over(w.rowsBetween(Window.unboundedPreceding, -1))
    p = e.withColumn("before", reached)
    kind = (F.when(F.col("high") <= F.col("low"), "empty").when(F.col("low") < F.col("before"), "overlap")
            .when(F.col("low") > F.col("before"), "gap"))
    return p.select("mode", kind.alias("problem"), F.col("low.km").alias("km")).filter("problem IS NOT NULL")


FAN_OUT = 64  # entries of an index page


def band_index(factors: DataFrame, levels: int) -> list[DataFrame]:
    """Pages (mode, page, lows, entries) of a search tree over each mode's bands, from the root to the leaves.

    A page holds at most ``FAN_OUT`` entries in order; entries of a leaf are
    bands, those above stand for the pages below by their lowest edge.
    """
    w = Window.partitionBy("mode").orderBy("low", "high")
    rows = _edges(factors).withColumn("at", F.row_number().over(w) - 1)
    entry, pages = F.struct("low", "high", "add_km", "mul", "factor"), []
    for _ in range(levels):
        page = (rows.groupBy("mode", F.floor(F.col("at") / FAN_OUT).alias("page"))
                .agg(F.array_sort(F.collect_list(entry)).alias("entries")))
        pages.append(page.select("mode", "page", F.col("entries.low").alias("lows"), "entries"))
        rows = page.select("mode", F.col("page").alias("at"), F.col("entries")[0]["low"].alias("low"))
        entry = F.struct("low")
    return pages[::-1]


def _last_not_above(lows: str, at: Column) -> Column:
    """Number of the ordered edges that are not above ``at``, by halving."""
    def halve(range_: Column, _) -> Column:
        middle = F.floor((range_["first"] + range_["last"] + 1) / 2).cast("int")
        right = F.get(lows, middle - 1) <= at
        return F.when(range_["first"] >= range_["last"], range_).when(
            right, F.struct(middle.alias("first"), range_["last"].alias("last"))).otherwise(
            F.struct(range_["first"].alias("first"), (middle - 1).alias("last")))

    start = F.struct(F.lit(0).alias("first"), F.size(lows).alias("last"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(FAN_OUT.bit_length())), start, halve)["first"]


def emissions_by_join(df: DataFrame, factors: DataFrame, mode: str, tier_km: str, value_km: str | None = None,
                      out: str = "emission", default: float | None = None) -> DataFrame:
    """Join form for factor tables of any number of bands; a left join keeps unmatched rows.

    ``factors`` holds one factor set.  It is checked first: bands that overlap
    would give a trip two factors, so they are an error (``band_problems`` names
    them; gaps are allowed and give the default).  A trip walks down its mode's
    index, a page per level, and finds its place in each by binary search: its
    cost grows with the logarithm of the number of bands, and it never carries
    more than a page.
    """
    bad = band_problems(factors).filter("problem = 'overlap'").limit(3).collect()
    if bad:
        raise ValueError("overlapping bands: " + ", ".join(f"{r.mode} at {r.km} km" for r in bad))
    value_km = value_km or tier_km
    n = factors.count()
    levels = 1
    while FAN_OUT ** levels < n:
        levels += 1
    at = F.struct(F.col(tier_km).cast("double").alias("km"), F.lit(0).alias("above"))
    found = df.withColumn("__at", F.when(F.col(tier_km).isNotNull(), at)).withColumn("__node", F.lit(0).cast("long"))
    for level, pages in enumerate(band_index(factors, levels)):
        pages = pages.select(F.col("mode").alias("__mode"), F.col("page").alias("__page"), F.col("lows").alias("__lows"),
                             F.col("entries").alias("__entries"))
        pages = F.broadcast(pages) if n <= MANY_BANDS else pages
        found = found.join(pages, (F.col(mode) == F.col("__mode")) & (F.col("__node") == F.col("__page")), "left")
        place = F.when(F.col("__at").isNotNull(), _last_not_above("__lows", F.col("__at")) - 1)
        if level < levels - 1:  # below the first edge: no page
            found = (found.withColumn("__place", place)
                     .withColumn("__node", F.when(F.col("__place") >= 0, F.col("__node") * FAN_OUT + F.col("__place")))
                     .drop("__mode", "__page", "__lows", "__entries", "__place"))
        else:
            found = found.withColumn("__place", place).withColumn("__band", F.get("__entries", F.col("__place"))).drop(
                "__mode", "__page", "__lows", "__entries", "__place")
    inside = F.col("__at") < F.col("__band.high")
    val = F.col("__band.factor") * ((F.col(value_km) + F.col("__band.add_km")) * F.col("__band.mul"))
    result = F.when(inside, val).otherwise(F.lit(default).cast("double"))
    return found.withColumn(out, result).drop("__at", "__node", "__band")


def canonical_transport(col) -> Column:
    """Map either label generation (``Avion`` / ``Plane`` ...) onto the canonical modes; others -> ``other``."""
    from ..fixed import OTHER, TRANSPORT_LABELS_EN, TRANSPORT_LABELS_FR, TRANSPORT_MODES
    pairs = {**TRANSPORT_LABELS_FR, **TRANSPORT_LABELS_EN, **{m: m for m in TRANSPORT_MODES}}
    m = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    c = F.trim(_c(col))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(m[c], F.lit(OTHER)))
