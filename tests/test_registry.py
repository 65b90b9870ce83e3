"""Keys over several builds: old ones stay, new ones follow without gaps."""

import random

from pyspark.sql import functions as F

from carbonledger.operators.registry import register_keys
from carbonledger.plans import questions as q
from carbonledger.plans import star
from carbonledger.plans.model import DriverModel
from carbonledger.plans.star_model import StarModel

from .conftest import SF_SMALL


def test_old_keys_stay_and_new_ones_are_dense(spark, tmp_path):
    path, rnd, seen = str(tmp_path / "r"), random.Random(1), {}
    values = [(rnd.choice("abc"), rnd.choice([None, *range(300)])) for _ in range(1200)]
    for n in (300, 300, 700, 1200, 10):
        df = spark.createDataFrame(values[:n], "a string, b int").repartition(6)
        got = {(r.a, r.b): r.key for r in register_keys(df, path, "key").collect()}
        assert all(got[v] == k for v, k in seen.items())
        assert sorted(got.values()) == list(range(1, len(got) + 1))
        added = [v for v in got if v not in seen]
        order = sorted(added, key=lambda v: (v[0], v[1] is None, v[1] or 0))
        assert [got[v] for v in order] == list(range(len(seen) + 1, len(got) + 1))
        seen = got
    assert set(seen) == set(values)
    empty = spark.createDataFrame([], "a string, b int")
    assert register_keys(empty, path, "key").count() == len(seen)
    assert register_keys(empty, str(tmp_path / "none"), "key").count() == 0


def test_star_schema_keeps_its_keys_when_data_is_added(spark, tmp_path):
    m, registry = DriverModel(spark, SF_SMALL), str(tmp_path / "registry")
    early = ("1990-01-01", "1996-12-31")
    keys = {}
    for k, window in enumerate((early, None)):
        out = str(tmp_path / f"star{k}")
        star.write_star_schema(m, out, window, registry=registry)
        for table, key in (("dimension_place", "location_id"), ("dimension_date", "date_id"),
                           ("dimension_transport", "transport_id"), ("dimension_mission_type", "type_id")):
            rows = spark.read.parquet(f"{out}/{table}")
            got = {tuple(r[c] for c in rows.columns if c != key): r[key] for r in rows.collect()}
            assert sorted(got.values()) == list(range(1, len(got) + 1))
            assert all(got[v] == i for v, i in keys.get(table, {}).items())
            keys[table] = got
    built = StarModel(spark, str(tmp_path / "star1"))
    a, b = (sorted(map(str, q.monthly_distance(x).collect())) for x in (m, built))
    assert a == b
    fact = spark.read.parquet(str(tmp_path / "star1" / "fact_mission")).filter(F.col("mission_key").isNotNull())
    days = spark.read.parquet(str(tmp_path / "star1" / "dimension_date"))
    assert fact.join(days, "date_id").filter("date <> mission_date").count() == 0
