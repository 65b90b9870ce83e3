import os

from pyspark.sql import functions as F

from carbonledger.sources.sinks import append_new_rows, path_exists, save_csv, save_parquet
from carbonledger.operators.columns import drop_prefixed, site_dimension

from .conftest import SF_MID


def test_parquet_conditional_and_csv_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    p = str(tmp_path / "t")
    save_parquet(df, p)
    save_parquet(df.limit(1), p)  # present and not overwrite: kept as is
    assert spark.read.parquet(p).count() == 2
    save_parquet(df.limit(1), p, overwrite=True)
    assert spark.read.parquet(p).count() == 1
    c = str(tmp_path / "c")
    save_csv(df, c, delimiter="|", single_file=True)
    parts = [f for f in os.listdir(c) if f.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(c, parts[0]), encoding="utf-8") as fh:
        assert fh.readline().strip() == "id|v"


def test_append_new_rows_idempotent(spark, tmp_path):
    p = str(tmp_path / "a")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    append_new_rows(df, p, key_specs=[["id"]])
    assert path_exists(spark, p)
    more = spark.createDataFrame([(2, "z"), (3, "c")], "id int, v string")
    append_new_rows(more, p, key_specs=[["id"]])
    append_new_rows(more, p, key_specs=[["id"]])
    rows = sorted((r.id, r.v) for r in spark.read.parquet(p).collect())
    assert rows == [(1, "a"), (2, "b"), (3, "c")]


def test_append_aligns_csv_by_header(spark, tmp_path):
    p = str(tmp_path / "c")
    spark.createDataFrame([(2, "b")], "id int, v string").coalesce(1).write.option("header", True).option(
        "sep", ";").csv(p)
    src = spark.createDataFrame([("again", 2), ("new", 3)], "v string, id int")  # other column order
    append_new_rows(src, p, fmt="csv", key_specs=[["id"]])
    rows = sorted((r.id, r.v) for r in spark.read.option("header", True).option("sep", ";").csv(p).collect())
    assert rows == [("2", "b"), ("3", "new")]


def test_append_null_keys_and_key_chain(spark, tmp_path):
    p = str(tmp_path / "n")
    df = spark.createDataFrame([(1, "a"), (None, "x"), (None, "y")], "id int, v string")
    append_new_rows(df, p, key_specs=[["id", "v"]])
    append_new_rows(df, p, key_specs=[["id", "v"]])
    assert spark.read.parquet(p).count() == 3
    more = spark.createDataFrame([(9, "a"), (1, "z"), (9, "z"), (None, "q")], "id int, v string")
    append_new_rows(more, p, key_specs=[["id"], ["v"]])  # known under any key of the chain: skipped
    assert {(r.id, r.v) for r in spark.read.parquet(p).collect()} == {(1, "a"), (None, "x"), (None, "y"), (9, "z")}


def test_append_without_keys_appends_all(spark, tmp_path):
    p = str(tmp_path / "all")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    append_new_rows(df, p)
    append_new_rows(df, p)
    assert spark.read.parquet(p).count() == 2


def test_single_file_export_checks_its_size(spark, tmp_path):
    import pytest as _pytest
    with _pytest.raises(ValueError):
        save_csv(spark.range(10), str(tmp_path / "big"), single_file=True, max_single_mb=0)


def test_release_keeps_what_a_frame_still_reads(spark):
    from carbonledger.session import checkpoints_written, release_checkpoints, reliable_checkpoint
    before = checkpoints_written()
    a, b = reliable_checkpoint(spark.range(5)), reliable_checkpoint(spark.range(7))
    gone = a.inputFiles()[0].rpartition("/")[0]
    release_checkpoints(spark, before, keep=b)
    assert b.count() == 7 and not path_exists(spark, gone) and checkpoints_written() == before + 1
    release_checkpoints(spark, before)
    assert checkpoints_written() == before


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "ID_SITE int, ID_PERSONNEL int, key_x int, v int")
    assert drop_prefixed(df, ("ID_", "key_"), keep=["ID_PERSONNEL"]).columns == ["ID_PERSONNEL", "v"]
    assert [r.site for r in site_dimension(spark).orderBy("site_id").collect()][:2] == ["paris", "shanghai"]


def test_imputation_recovers_hidden_languages(spark):
    from carbonledger.plans.catalog import QUERIES
    out = QUERIES["impute_category"](spark, SF_MID)
    truth = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    j = out.filter("lang_imputed").join(truth, "doc_id")
    n, ok = j.count(), j.filter(F.col("lang") == F.col("truth")).count()
    assert n > 0 and ok / n > 0.95
    assert out.count() == spark.read.parquet(f"{SF_MID}/documents.parquet").count()


def test_register_views_and_sql(spark):
    from carbonledger.operators.columns import register_views
    register_views({"cl_sites": site_dimension(spark)})
    assert spark.sql("SELECT count(*) AS n FROM cl_sites").first().n == 6


def test_combined_full_outer_keeps_one_sided_groups(spark):
    from carbonledger.plans import questions as q
    from carbonledger.plans.model import DriverModel
    m = DriverModel(spark, "/root/testdata/sf0.001")
    inner = {r.site_id: r.total_t for r in q.combined_emissions(m, "site_id").collect()}
    outer = {r.site_id: r.total_t for r in q.combined_emissions(m, "site_id", how="full_outer").collect()}
    assert set(inner) <= set(outer)
    assert all(abs(outer[k] - v) < 1e-9 for k, v in inner.items())


def test_side_file_readers(spark, tmp_path):
    from carbonledger.sources.raw import read_impacts, read_personnel, read_tsv
    from pyspark.sql import types as T
    imp = tmp_path / "impacts.csv"
    imp.write_text("Type,Modèle,Impact\nPC portable,Latitude 5xxx ,250.5\nEcran, ,30\n", encoding="utf-8")
    rows = {(r.Type, r["Modèle"]): r.Impact for r in read_impacts(spark, str(imp)).collect()}
    assert rows == {("PC portable", "Latitude 5xxx"): 250.5, ("Ecran", None): 30.0}
    per = tmp_path / "PERSONNEL_PARIS.txt"
    per.write_text("ID_PERSONNEL;NOM_PERSONNEL;PRENOM_PERSONNEL;FONCTION_PERSONNEL;DT_NAISS\n"
                   "K1;N;P;Cadre;1970-02-03\nK2;N;P; ;not-a-date\n", encoding="utf-8")
    p = read_personnel(spark, str(per)).collect()
    assert p[0].FONCTION_PERSONNEL == "Cadre" and str(p[0].DT_NAISS) == "1970-02-03" and p[0].site == "paris"
    assert p[1].FONCTION_PERSONNEL is None and p[1].DT_NAISS is None and p[1]._corrupt_record is not None
    tsv = tmp_path / "f.tsv"
    tsv.write_text("mode\tfactor\nTrain\t0.018\n", encoding="utf-8")
    schema = T.StructType([T.StructField("mode", T.StringType()), T.StructField("factor", T.DoubleType())])
    assert read_tsv(spark, str(tsv), schema).first().factor == 0.018


def test_rule_table_join_matches_expression(spark):
    from carbonledger.functions.rules import apply_conditional_operations, apply_rules_by_join
    df = spark.createDataFrame([("plane", 100.0), ("taxi", 10.0), ("boat", 5.0), ("train", 50.0)], "t string, d double")
    rules = [("plane", "add", 95.0), ("taxi", "mul", 2.0), ("taxi", "mul", 9.0), ("train", "div", 2.0)]
    table = spark.createDataFrame([(v, op, x, i) for i, (v, op, x) in enumerate(rules)],
                                  "value string, op string, operand double, priority int")
    a = {r.t: r.adjusted_value for r in apply_conditional_operations(df, "t", "d", rules).collect()}
    b = {r.t: r.adjusted_value for r in apply_rules_by_join(df, table, "t", "d").collect()}
    assert a == b == {"plane": 195.0, "taxi": 20.0, "boat": 5.0, "train": 25.0}


def test_command_line(spark, tmp_path, capsys):
    from carbonledger.__main__ import main
    assert main(["list"]) == 0
    assert "purchase_carbon" in capsys.readouterr().out
    out = str(tmp_path / "q5")
    assert main(["run", "purchase_carbon", "--data", "/root/testdata/sf0.001", "--out", out]) == 0
    assert spark.read.parquet(out).count() == 1
    assert main(["run", "nope", "--data", "/root/testdata/sf0.001"]) == 2


def test_checkpoint_dir_rules():
    import pytest as _pytest

    from carbonledger.session import ensure_checkpoint_dir

    class Conf(dict):
        def get(self, k, d=None):
            return super().get(k, d)

    class SC:
        def __init__(self, master, conf):
            self.master, self._conf, self.dir = master, Conf(conf), None

        def getCheckpointDir(self):
            return self.dir

        def getConf(self):
            return self._conf

        def setCheckpointDir(self, d):
            self.dir = d

    class RuntimeConf:
        def get(self, k):
            raise KeyError(k)

    class Spark:
        def __init__(self, master, conf):
            self.sparkContext, self.conf = SC(master, conf), RuntimeConf()

    assert ensure_checkpoint_dir(Spark("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ck"})) == "hdfs:///shared/ck"
    with _pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Spark("yarn", {}))
    assert ensure_checkpoint_dir(Spark("local[8]", {})).startswith("/")
