"""Raw daily drops (written by the fixture): counts per site, blanks, malformed lines, headers."""

import collections

from pyspark.sql import functions as F

from carbonledger.functions.emissions import canonical_transport
from carbonledger.operators.quality import has_atypicals, profile
from carbonledger.sources import schemas
from carbonledger.sources.headers import batch_lines
from carbonledger.sources.raw import drops_glob, drops_report, parse_drops, read_delimited, read_drops
from carbonledger.streaming import ingest_drops

from .conftest import write_drops


def test_equipment_counts(spark, drops):
    root, _, items = drops
    e = read_drops(spark, root, "equipment", keep_raw=True)
    per_site = {r.site: r["count"] for r in e.groupBy("site").count().collect()}
    assert per_site == dict(collections.Counter(x["site"] for x in items)) and len(per_site) == 7
    rows = {r.ID_MATERIELINFO: r for r in e.collect()}
    for x in items:  # blanks become null, other cells are trimmed, the raw cell stays
        r = rows[x["ID_MATERIELINFO"]]
        assert (r.TYPE, r.MODELE) == (x["TYPE"].strip() or None, x["MODELE"].strip() or None)
        assert r.MODELE_raw == x["MODELE"] and str(r.DATE_ACHAT) == x["DATE_ACHAT"] and r._corrupt_record is None


def test_mission_counts(spark, drops):
    root, trips, _ = drops
    m = read_drops(spark, root, "mission")
    assert m.count() == len(trips)
    t = {r.t: r["count"] for r in m.groupBy(canonical_transport("TRANSPORT").alias("t")).count().collect()}
    names = {"Avion": "plane", "Train": "train", "Taxi": "taxi", "Transports en commun": "public_transport"}
    assert t == dict(collections.Counter(names.get(x["TRANSPORT"], "other") for x in trips))
    assert {str(r.drop_date) for r in m.select("drop_date").distinct().collect()} == {
        "2024-05-03", "2024-07-04", "2024-09-05"}


def test_profile_on_raw_cells(spark, drops):
    root, _, items = drops
    raw = read_delimited(spark, drops_glob(root, "equipment"), schemas.EQUIPMENT).drop(schemas.CORRUPT)
    p = {(r.column_name, r.kind): r for r in profile(raw).collect()}
    assert p[("TYPE", "empty")].n_affected == sum(not x["TYPE"].strip() for x in items) > 0
    assert p[("TYPE", "null")].n_affected == 0 and p[("TYPE", "empty")].n_rows == len(items)
    assert {r.kind: r.has_atypicals for r in has_atypicals(raw).collect()} == {"null": False, "nan": False,
                                                                              "empty": True}


def test_malformed_line(spark, tmp_path):
    write_drops(str(tmp_path))
    folder = tmp_path / "DROP_OSLO" / "DROP_OSLO_INFORMATIQUE"
    with open(folder / "MATERIEL_INFORMATIQUE_20240503.txt", "a", encoding="utf-8") as f:
        f.write("M_BAD;P;N;P;not a date;Ecran;x\n")
    bad = read_drops(spark, str(tmp_path), "equipment").filter(F.col("_corrupt_record").isNotNull()).collect()
    assert [r._corrupt_record for r in bad] == ["M_BAD;P;N;P;not a date;Ecran;x"]


HEADERS = {  # file of a site -> (header, lines, expected ids with type and model)
    "20240601": ("ID_PERSONNEL;ID_MATERIELINFO;NOM_PERSONNEL;PRENOM_PERSONNEL;DATE_ACHAT;TYPE;MODELE",
                 ["P;M1;N;P;2024-06-01 00:00:00;Ecran;x"], [("M1", "Ecran", "x", "P")]),
    "20240602": ("\ufeffmodele; Type ;Note;ID_MATERIELINFO;DATE_ACHAT;ID_PERSONNEL;Note",  # order, extra, BOM, case
                 ['"a;b";Ecran;free;M2;2024-06-02 10:00:00;Q;again', ";;;M3;;;"],
                 [("M2", "Ecran", "a;b", "Q"), ("M3", None, None, None)]),
    "20240603": ("ID_MATERIELINFO;MODELE", ["M4;x", "M5;x;too;many", "M6"],
                 [("M4", None, "x", None), ("M5", None, "x", None), ("M6", None, None, None)]),
    "20240604": ("NOM;MODELE", ["a;b", "c;d"], []),  # no key column: rejected
    "20240605": ("ID_MATERIELINFO;KIND", ["M7;Ecran"], [("M7", None, None, None)]),
    "20240606": ("ID_MATERIELINFO;TYPE", [], []),
}


def write_headers(root):
    folder = root / "DROP_OSLO" / "DROP_OSLO_INFORMATIQUE"
    folder.mkdir(parents=True)
    for day, (header, lines, _) in HEADERS.items():
        (folder / f"MATERIEL_INFORMATIQUE_{day}.txt").write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    (folder / "MATERIEL_INFORMATIQUE_20240607.txt").write_text("", encoding="utf-8")
    return sorted(x for _, _, rows in HEADERS.values() for x in rows)


def got(df):
    return sorted((r.ID_MATERIELINFO, r.TYPE, r.MODELE, r.ID_PERSONNEL) for r in df.collect())


def test_each_file_is_read_by_its_header(spark, tmp_path):
    want = write_headers(tmp_path)
    df = read_drops(spark, str(tmp_path), "equipment")
    assert got(df) == want
    rows = {r.ID_MATERIELINFO: r for r in df.collect()}
    assert str(rows["M2"].DATE_ACHAT) == "2024-06-02 10:00:00" and rows["M3"].DATE_ACHAT is None
    assert {k for k, r in rows.items() if r._corrupt_record is not None} == {"M5", "M6"}
    assert {r.site for r in rows.values()} == {"oslo"} and str(rows["M4"].drop_date) == "2024-06-03"
    assert got(read_drops(spark, str(tmp_path), "equipment", aliases={"kind": "TYPE"}).filter(
        "ID_MATERIELINFO = 'M7'")) == [("M7", "Ecran", None, None)]


def test_report_of_headers(spark, tmp_path):
    write_headers(tmp_path)
    r = {x.file[-12:-4]: x for x in drops_report(spark, str(tmp_path), "equipment").collect()}
    assert {k: (x.status, x.n_rows, x.n_malformed, x.n_rejected) for k, x in r.items()} == {
        "20240601": ("mapped", 1, 0, 0), "20240602": ("mapped", 2, 0, 0), "20240603": ("mapped", 3, 2, 0),
        "20240604": ("rejected", 0, 0, 2), "20240605": ("mapped", 1, 0, 0), "20240606": ("mapped", 0, 0, 0)}
    assert r["20240602"].unknown == ["NOTE"] == r["20240602"].repeated
    assert r["20240602"].missing == ["NOM_PERSONNEL", "PRENOM_PERSONNEL"] and r["20240605"].unknown == ["KIND"]


def test_header_of_a_file_in_many_blocks(spark, tmp_path):
    """A file read in many splits has one header: it holds for every block."""
    folder = tmp_path / "DROP_OSLO" / "DROP_OSLO_INFORMATIQUE"
    folder.mkdir(parents=True)
    lines = [f"x{k};{'y' * 50};M{k}" for k in range(5000)]
    (folder / "MATERIEL_INFORMATIQUE_20240601.txt").write_text(
        "\n".join(["MODELE;NOTE;ID_MATERIELINFO", *lines]) + "\n", encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_drops(spark, str(tmp_path), "equipment")
        assert df.rdd.getNumPartitions() > 5
        assert got(df) == sorted((f"M{k}", None, f"x{k}", None) for k in range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_lines_are_parsed_once(spark, tmp_path):
    """Rows, rejects and report read the parsed lines: no filter of theirs parses a line again, once for each use."""
    write_headers(tmp_path)
    read = parse_drops(batch_lines(spark, drops_glob(str(tmp_path), "equipment")), "equipment")
    for df in (read.rows, read.rejects, read.report()):
        assert "from_csv" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.value for r in read.rejects.collect()) == ["a;b", "c;d"]
    assert {r._corrupt_record for r in read.rows.collect()} == {None, "M5;x;too;many", "M6"}


def test_stream_reads_like_batch(spark, tmp_path):
    want = write_headers(tmp_path / "drops")
    target, report = str(tmp_path / "equipment"), str(tmp_path / "report")
    for ck in ("ck", "ck2"):  # the second run delivers every file again
        ingest_drops(spark, str(tmp_path / "drops"), "equipment", target, str(tmp_path / ck), report=report,
                     max_files_per_trigger=2).awaitTermination(300)
        assert got(spark.read.parquet(target)) == want
        assert spark.read.parquet(report).count() == len(HEADERS)
    batch = read_drops(spark, str(tmp_path / "drops"), "equipment")
    assert sorted(map(str, spark.read.parquet(target).select(*batch.columns).collect())) == sorted(
        map(str, batch.collect()))
