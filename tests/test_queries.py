"""Every registered query against its DuckDB twin on sf0.001, plus plan assertions."""

import pytest

from __spark_entry__ import entry
from carbonledger.plans.catalog import ORACLE, QUERIES

from .conftest import SF_MID, SF_SMALL
from .oracle_diff import compare


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["n_purchases", "carbon_t"]
    assert df.count() == 1


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and len(QUERIES) >= 55


def test_all_queries_match_oracle_small(spark):
    res = compare(spark, SF_SMALL, sorted(QUERIES), verbose=False)
    assert {k: v for k, v in res.items() if v[0] is not True} == {}


@pytest.mark.parametrize("name", ["gazetteer_unmatched", "unlocated_places", "people_without_trips_july"])
def test_checks_have_something_to_find(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_profile_finds_nan(spark):
    found = {r.kind: r.has_atypicals for r in QUERIES["has_atypicals"](spark, SF_SMALL).collect()}
    assert found["nan"] and found["null"]


def test_one_changed_factor_shows(spark, monkeypatch):
    """The oracles do not share the library's factors: a wrong one turns the query red."""
    from dataclasses import replace
    from carbonledger.functions import emissions
    a = emissions.FACTOR_SETS["A"]
    bands = tuple(replace(b, factor=b.factor * 1.1) if b.mode == "taxi" else b for b in a.bands)
    monkeypatch.setitem(emissions.FACTOR_SETS, "A", replace(a, bands=bands))
    assert compare(spark, SF_SMALL, ["mission_emissions_a"], verbose=False)["mission_emissions_a"][0] is False


SCANS = {
    "purchase_count_window": {"lineitem", "part"}, "purchase_carbon": {"lineitem", "part"},
    "average_age": {"lineitem", "orders", "customer", "nation"}, "dim_mission_type": {"lineitem"},
    "dim_transport": {"lineitem", "orders"}, "dim_equipment_type": {"lineitem", "part"},
    "headcount_by_function": {"customer", "nation"},
}


@pytest.mark.parametrize("name", sorted(SCANS))
def test_only_needed_tables_are_read(spark, name):
    import re
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    files = QUERIES[name](spark, SF_SMALL).inputFiles()
    read = {re.search(r"/(\w+)\.parquet", f)[1] for f in files if "/testdata/" in f}
    assert read == SCANS[name], plan


@pytest.mark.parametrize("name", ["fact_mission", "fact_equipment"])
def test_facts_leave_only_what_their_result_reads(spark, name):
    from carbonledger.session import checkpoints_written, release_checkpoints
    before = checkpoints_written()
    df = QUERIES[name](spark, SF_SMALL)
    # the numbered rows and their offsets (a few rows); the trips or purchases are gone
    assert checkpoints_written() - before == 2
    assert df.count() == 6000
    release_checkpoints(spark, before)
    assert checkpoints_written() == before


@pytest.mark.parametrize("name", ["fact_mission", "star"])
def test_trips_are_joined_once(spark, name, tmp_path, monkeypatch):
    """The line items of a mission fact or a star build are read for trips once (purchases and days apart)."""
    from carbonledger.plans import star
    from carbonledger.plans.model import DriverModel
    seen, missions = [], DriverModel.missions
    monkeypatch.setattr(DriverModel, "missions", lambda self, *a, **k: seen.append(a) or missions(self, *a, **k))
    if name == "star":
        star.write_star_schema(DriverModel(spark, SF_SMALL), str(tmp_path / "star"))
    else:
        star.fact_mission(DriverModel(spark, SF_SMALL))
    assert len(seen) == 1


def test_building_a_question_runs_no_job(spark):
    sc = spark.sparkContext
    sc.setJobGroup("build", "plan building")
    QUERIES["emissions_by_site_combined"](spark, SF_SMALL)
    QUERIES["purchase_carbon"](spark, SF_SMALL)
    # reading a table's footer is one job each; nothing else may run
    jobs = sc.statusTracker().getJobIdsForGroup("build")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 10


def test_rewritten_table_is_read_with_its_new_schema(spark, tmp_path):
    from carbonledger.plans.model import DriverModel
    path = f"{tmp_path}/region.parquet"
    spark.createDataFrame([(1,)], "a int").write.parquet(path)
    assert DriverModel(spark, str(tmp_path)).table("region").columns == ["a"]
    spark.createDataFrame([(1, 2)], "b int, c int").write.mode("overwrite").parquet(path)
    assert DriverModel(spark, str(tmp_path)).table("region").columns == ["b", "c"]


def test_site_ranking_is_ordered(spark):
    rows = QUERIES["emissions_by_site_combined"](spark, SF_SMALL).collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    assert [r.total_t for r in rows] == sorted((r.total_t for r in rows), reverse=True)


@pytest.mark.parametrize("name", ["purchase_carbon", "top_emission_days", "monthly_with_global_total",
                                  "fact_mission"])
def test_flagship_queries_match_oracle_mid(spark, name):
    res = compare(spark, SF_MID, [name], verbose=False)
    assert res[name][0] is True, res


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_query_plans(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_date_window_reaches_parquet_scan(spark):
    df = QUERIES["site_period_emissions"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1998-07-01" in plan


def test_small_dimensions_are_broadcast(spark):
    df = QUERIES["monthly_distance"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan
