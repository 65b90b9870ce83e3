import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from carbonledger.operators.dimensions import build_dimension
from carbonledger.operators.fill import fill_nulls_by_key, new_rows
from carbonledger.operators.harmonise import harmonise, translation_table, unmapped
from carbonledger.operators.keys import sequential_index
from carbonledger.operators.places import gazetteer_match
from carbonledger.operators.quality import has_atypicals, max_by_condition, profile, unique_values
from carbonledger.operators.rollup import totals_with_label


def test_sequential_index_matches_row_number_with_hot_group(spark):
    # One group holds most rows: it must be spread over many range partitions.
    rows = [("hot" if i % 4 else f"g{i % 7}", i, i % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k int, t int")
    got = sequential_index(df, ["k", "t"], partition_cols=["g"], out="idx", num_partitions=16)
    w = Window.partitionBy("g").orderBy("k", "t")
    want = df.withColumn("rn", F.row_number().over(w))
    j = got.join(want, ["g", "k", "t"])
    assert j.count() == 3000
    assert j.filter(F.col("idx") != F.col("rn")).count() == 0


def test_sequential_index_global_dense(spark):
    df = spark.createDataFrame([(x,) for x in [5, 3, 9, 1, 7]], "v int")
    out = sequential_index(df, ["v"], out="id", num_partitions=3).orderBy("v").collect()
    assert [(r.id, r.v) for r in out] == [(1, 1), (2, 3), (3, 5), (4, 7), (5, 9)]


def test_build_dimension_blank_policies(spark):
    df = spark.createDataFrame([("b",), (" ",), ("a",), (None,), ("a",)], "m string")
    drop = build_dimension(df, "id", "drop").orderBy("id").collect()
    assert [(r.id, r.m) for r in drop] == [(1, "a"), (2, "b")]
    sent = build_dimension(df, "id", "sentinel").orderBy("id").collect()
    assert [r.m for r in sent] == ["NULL", "a", "b"]


def test_profile_counts_and_applicability(spark):
    df = spark.createDataFrame([(1, " ", float("nan")), (None, "x", 1.0), (3, None, None)], "a int, s string, d double")
    p = {(r.column_name, r.kind): r for r in profile(df).collect()}
    assert p[("a", "null")].n_affected == 1 and p[("a", "null")].pct == pytest.approx(33.3333)
    assert p[("s", "empty")].n_affected == 1 and p[("s", "null")].n_affected == 1
    assert p[("d", "nan")].n_affected == 1 and p[("d", "nan")].applicable
    assert not p[("a", "nan")].applicable and p[("a", "nan")].n_affected == 0
    empty = spark.createDataFrame([], "a int, s string")
    assert all(r.n_affected == 0 for r in profile(empty).collect())
    assert has_atypicals(empty, "null").first().has_atypicals is False


def test_unique_values_and_missing_columns(spark):
    a = spark.createDataFrame([("x",), ("y",)], "c string")
    b = spark.createDataFrame([("y",), ("z",), (None,)], "c string")
    out = sorted(r.v for r in unique_values([a, b], ["c"], "v").collect())
    assert out == ["x", "y", "z"]
    assert unique_values([a, b], ["nope"], "v") is None


def test_max_by_condition_missing_tuple_is_null(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 7.0), ("b", 2, 1.0)], "k string, j int, v double")
    out = {(r.k, r.j): r.max_value for r in max_by_condition(df, "v", ["k", "j"], [("a", 1), ("b", 2), ("c", 3)]).collect()}
    assert out == {("a", 1): 7.0, ("b", 2): 1.0, ("c", 3): None}
    assert max_by_condition(df, "v").first().max_value == 7.0


def test_fill_nulls_by_key_no_fanout(spark):
    dst = spark.createDataFrame([(1, "fr", None), (2, "fr", 0), (3, "de", None)], "id int, lang string, q int")
    src = spark.createDataFrame([("fr", 1), ("fr", 1), ("fr", 0), ("de", None)], "lang string, q int")
    out = {r.id: r.q for r in fill_nulls_by_key(dst, src, "lang", "q", "q").collect()}
    assert out == {1: 1, 2: 0, 3: None}


def test_new_rows_anti_chain_keeps_null_keys(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    src = spark.createDataFrame([("z", 1), ("b", 3), ("c", 4), ("d", None)], "name string, id int")
    out = new_rows(src, tgt, [["id"], ["name"]])
    assert out.columns == ["name", "id"]  # source order
    assert sorted((r.id or -1, r.name) for r in out.collect()) == [(-1, "d"), (4, "c")]
    assert new_rows(src, src, [["id", "name"]]).count() == 0  # nulls match nulls
    assert new_rows(src, src).count() == 4  # no key: everything is new


def test_totals_with_label(spark):
    df = spark.createDataFrame([("p", "01", 1.0), ("p", "02", 2.0), ("b", "01", 4.0)], "site string, m string, v double")
    out = {(r.site, r.m): r.t for r in totals_with_label(df, ["site", "m"], ["m"], "site", "Global Total",
                                                          [F.sum("v").alias("t")]).collect()}
    assert out[("Global Total", "01")] == 5.0 and out[("p", "02")] == 2.0 and len(out) == 5


def test_harmonise_reference_labels(spark):
    t = translation_table(spark)
    df = spark.createDataFrame([("Formation",), ("Schulung",), ("Conference",), ("Other",)], "TYPE_MISSION string")
    out = [r.TYPE_MISSION for r in harmonise(df, {"TYPE_MISSION": "mission_type"}, t).collect()]
    assert sorted(out) == ["Conference", "Other", "Vocational Training", "Vocational Training"]
    assert [r.TYPE_MISSION for r in unmapped(df, "TYPE_MISSION", "mission_type", t).collect()] == ["Other"]


def test_gazetteer_match_best_allowed(spark):
    cand = spark.createDataFrame([
        ("Paris", "France", "Paris (city)", "city", 48.85, 2.35, 10.0),
        ("Paris", "France", "Paris (county)", "county", 1.0, 1.0, 99.0),
        ("Paris", "USA", "Paris TX", "town", 33.66, -95.55, 5.0),
        ("Nowhere", "X", "Nowhere", "hamlet", 0.0, 0.0, 1.0),
    ], "city string, country string, display_name string, place_type string, lat double, lon double, score double")
    places = spark.createDataFrame([("Paris", "France"), ("Paris", "USA"), ("Nowhere", "X")], "city string, country string")
    found, missing = gazetteer_match(places, cand, ["city", "town"])
    f = {(r.city, r.country): (r.lat, r.lon) for r in found.collect()}
    assert f == {("Paris", "France"): (48.85, 2.35), ("Paris", "USA"): (33.66, -95.55)}
    assert [(r.city, r.country) for r in missing.collect()] == [("Nowhere", "X")]


def test_write_star_schema_partitions_facts(spark, tmp_path):
    from carbonledger.plans.model import DriverModel
    from carbonledger.plans.star import write_star_schema
    m = DriverModel(spark, "/root/testdata/sf0.001")
    out = str(tmp_path / "star")
    names = write_star_schema(m, out, window=("1998-05-01", "1998-10-31"))
    assert "fact_mission" in names
    fm = spark.read.parquet(f"{out}/fact_mission")
    assert {"site_id", "year_month"} <= set(fm.columns)
    persons = spark.read.parquet(f"{out}/dimension_person").count()
    # every person appears (left join), ids are dense per site
    assert fm.select("person_id").distinct().count() == persons
    per_site = fm.groupBy("site_id").agg(F.count("*").alias("n"), F.max("fact_id").alias("mx"),
                                         F.countDistinct("fact_id").alias("d")).collect()
    assert all(r.n == r.mx == r.d for r in per_site)


def test_sequential_index_splits_a_group_of_copies(spark):
    # A third of the rows are exact copies of one key: they must still spread over partitions.
    rows = [("hot", 1)] * 1000 + [("g", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, k int")
    got = sequential_index(df, ["k"], partition_cols=["g"], out="idx", num_partitions=8)
    hot = got.filter(F.col("g") == "hot")
    assert sorted(r.idx for r in hot.collect()) == list(range(1, 1001))
    ranged = df.withColumn("__t", F.monotonically_increasing_id()).repartitionByRange(8, "g", "k", "__t")
    sizes = ranged.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) < 1000


def test_left_join_dimension_equals_left_join_with_hot_key(spark):
    from carbonledger.operators.joins import left_join_dimension
    dim = spark.createDataFrame([(i, f"p{i}") for i in range(50)], "k int, name string")
    facts = spark.createDataFrame([(0, float(i)) for i in range(300)] + [(i, 1.0) for i in range(1, 30)] +
                                  [(99, 5.0)], "k int, v double")
    got = left_join_dimension(dim, facts, ["k"])
    want = dim.join(facts, "k", "left")
    key = lambda r: (r.k, r.name, r.v if r.v is not None else -1.0)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.select(*got.columns).collect()))
    assert got.filter(F.col("v").isNull()).count() == 20
