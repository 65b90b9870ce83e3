"""The questions on the raw drops, checked against a brute-force Python computation
(csv module, iterative Vincenty distances, factor table evaluated in Python)."""

import collections
import csv
import math
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from carbonledger.fixed import SET_A, TRANSPORT_LABELS_EN, TRANSPORT_LABELS_FR
from carbonledger.plans import questions as q
from carbonledger.plans.raw_model import RawModel

from .conftest import PLACES as FIX, SF_MID

SITE_KEYS = {"paris": 1, "shanghai": 2, "berlin": 3, "london": 4, "losangeles": 5, "newyork": 6, "oslo": 7}
COORDS = "city string, country string, lat double, lon double"


def _vincenty_km(lat1, lon1, lat2, lon2):
    """Iterative inverse solution on WGS-84 (independent of the library's closed form)."""
    a, f = 6378.137, 1 / 298.257223563
    b = (1 - f) * a
    if (lat1, lon1) == (lat2, lon2):
        return 0.0
    L = math.radians(lon2 - lon1)
    U1, U2 = math.atan((1 - f) * math.tan(math.radians(lat1))), math.atan((1 - f) * math.tan(math.radians(lat2)))
    lam = L
    for _ in range(200):
        sl, cl = math.sin(lam), math.cos(lam)
        ss = math.hypot(math.cos(U2) * sl, math.cos(U1) * math.sin(U2) - math.sin(U1) * math.cos(U2) * cl)
        cs = math.sin(U1) * math.sin(U2) + math.cos(U1) * math.cos(U2) * cl
        sig = math.atan2(ss, cs)
        sa = math.cos(U1) * math.cos(U2) * sl / ss
        c2a = 1 - sa * sa
        c2m = cs - 2 * math.sin(U1) * math.sin(U2) / c2a if c2a else 0.0
        C = f / 16 * c2a * (4 + f * (4 - 3 * c2a))
        prev = lam
        lam = L + (1 - C) * f * sa * (sig + C * ss * (c2m + C * cs * (-1 + 2 * c2m * c2m)))
        if abs(lam - prev) < 1e-12:
            break
    u2 = c2a * (a * a - b * b) / (b * b)
    A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    ds = B * ss * (c2m + B / 4 * (cs * (-1 + 2 * c2m * c2m) - B / 6 * c2m * (-3 + 4 * ss * ss) * (-3 + 4 * c2m * c2m)))
    return b * A * (sig - ds)


def _python_emission(label, is_return, d0):
    """Plain-Python evaluation of factor set A (no Spark): pick the band on the one-way km,
    apply it to the trip km.  The set itself is pinned by the golden values in test_functions."""
    mode = {**TRANSPORT_LABELS_FR, **TRANSPORT_LABELS_EN}.get(label)
    trip = d0 * (2 if is_return else 1)
    for band in SET_A.bands:
        lo_ok = band.lo is None or (d0 >= band.lo if band.lo_closed else d0 > band.lo)
        hi_ok = band.hi is None or (d0 <= band.hi if band.hi_closed else d0 < band.hi)
        if band.mode == mode and lo_ok and hi_ok:
            return band.factor * ((trip + band.add_km) * band.mul)
    return SET_A.default


@pytest.fixture(scope="module")
def brute(drops):
    coords = {}
    with open(FIX, encoding="utf-8") as fh:
        for r in csv.DictReader(fh, delimiter=";"):
            coords[r["city"]] = (float(r["lat"]), float(r["lon"]))
    rows = []
    for r in drops[1]:
        d = _vincenty_km(*coords[r["VILLE_DEPART"]], *coords[r["VILLE_DESTINATION"]])
        rows.append(dict(site=r["site"], site_id=SITE_KEYS[r["site"]], km=d, r=r,
                         ts=datetime.strptime(r["DATE_MISSION"], "%Y-%m-%d %H:%M:%S"),
                         kg=_python_emission(r["TRANSPORT"], r["ALLER_RETOUR"] == "oui", d)))
    return rows


@pytest.fixture(scope="module")
def gazetteer(spark, drops):
    """The sample's coordinates under the (city, country) spelling of the drops."""
    places = {(r["VILLE_DEPART"], r["PAYS_DEPART"]) for r in drops[1]}
    with open(FIX, encoding="utf-8") as fh:
        at = {r["city"]: (float(r["lat"]), float(r["lon"])) for r in csv.DictReader(fh, delimiter=";")}
    return spark.createDataFrame([(c, k, *at[c]) for c, k in sorted(places)], COORDS)


@pytest.fixture(scope="module")
def model(spark, drops, gazetteer):
    return RawModel(spark, drops[0], gazetteer=gazetteer, impute=False)


def test_european_july_emissions(model, brute):
    got = q.period_emissions(model, ("2024-07-01", "2024-07-31"), [1, 3, 4]).first()
    want = [x for x in brute if x["site_id"] in (1, 3, 4) and x["ts"].month == 7]
    assert got.n_missions == len(want) == 24 and got.n_unlocated == 0
    assert got.carbon_t == pytest.approx(sum(x["kg"] for x in want) / 1000, abs=0.011)


def test_monthly_distance_matches(model, brute):
    got = {(r.site, r.year_month): r.total_km for r in q.monthly_distance(model).collect()}
    want = defaultdict(float)
    for x in brute:
        want[(x["site"], x["ts"].strftime("%Y-%m"))] += x["km"]
    assert set(got) == set(want) and {s for s, _ in got} == set(SITE_KEYS)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-4, abs=0.5)


def test_top_days_plane(model, brute):
    got = [(str(r.mission_date), r.carbon_t) for r in q.top_emission_days(model, 5, "plane").collect()]
    per = defaultdict(float)
    for x in brute:
        if x["r"]["TRANSPORT"] == "Avion":
            per[x["ts"].date().isoformat()] += x["kg"]
    want = sorted(per.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert [d for d, _ in got] == [d for d, _ in want]
    for (_, a), (_, b) in zip(got, want):
        assert a == pytest.approx(b / 1000, abs=0.011)


def test_labels_are_translated_by_the_site_s_language(model, brute):
    got = {(r.site, r.mission_type): r["count"] for r in
           model.enriched_missions().groupBy("site", "mission_type").count().collect()}
    words = {"paris": {"Formation": "Vocational Training", "Conférence": "Conference"},
             "berlin": {"Schulung": "Vocational Training", "Konferenz": "Conference", "Meeting": "Team Meeting"}}
    want = collections.Counter((x["site"], words.get(x["site"], {}).get(x["r"]["TYPE_MISSION"], x["r"]["TYPE_MISSION"]))
                               for x in brute)
    assert got == dict(want)
    assert any(k[1] == "Meeting" for k in got) and any(k == ("berlin", "Team Meeting") for k in got)


def test_sites_come_from_the_paths(model):
    assert {r.site: r.site_id for r in model.sites().collect()} == SITE_KEYS


def test_intersite_city_list(model, brute):
    cities = ["Paris", "Berlin", "London", "Los Angeles"]
    got = sum(r.n_missions for r in q.intersite_emissions(model, ("2024-05-01", "2024-05-31"), cities).collect())
    want = sum(x["ts"].month == 5 and x["r"]["VILLE_DEPART"] in cities and x["r"]["VILLE_DESTINATION"] in cities
               for x in brute)
    assert got == want > 0


def _naive_bayes(rows, text, label):
    """Predictions for blank labels by a plain computation on the labelled rows."""
    import re
    tok = lambda s: re.findall(r"\w{2,}", (s or "").lower())
    known = [(r[text], r[label]) for r in rows if r[label]]
    labels = sorted({y for _, y in known})
    count = {y: collections.Counter(t for x, z in known if z == y for t in tok(x)) for y in labels}
    vocab = set().union(*count.values())

    def best(x):
        def score(y):
            total = sum(count[y].values()) + len(vocab)
            prior = math.log(sum(z == y for _, z in known) / len(known))
            return round(prior + sum(math.log((count[y][t] + 1) / total) for t in tok(x) if t in vocab), 6)
        return min(labels, key=lambda y: (-score(y), y))
    return best


def test_purchases_with_impacts_and_imputation(spark, drops):
    raw = RawModel(spark, drops[0], impute=True)
    rows = [{k: v.strip() for k, v in x.items()} for x in drops[2]]
    to_type, to_model = _naive_bayes(rows, "MODELE", "TYPE"), _naive_bayes(rows, "TYPE", "MODELE")
    want = {}
    for x in rows:
        kind = x["TYPE"] or to_type(x["MODELE"])
        want[x["ID_MATERIELINFO"]] = (kind, x["MODELE"] or to_model(kind))
    e = raw.raw_equipment()
    assert {r.ID_MATERIELINFO: (r.TYPE, r.MODELE) for r in e.collect()} == want
    raw.impacts_df = e.select(F.col("TYPE").alias("Type"), F.col("MODELE").alias("Modèle")).distinct().withColumn(
        "Impact", F.length("Modèle").cast("double") * 10.0)
    got = q.purchase_carbon(raw, "PC portable", ("2024-05-01", "2024-08-31")).first()
    days = {x["ID_MATERIELINFO"]: x["DATE_ACHAT"] for x in rows}
    laptops = [m for k, (t, m) in want.items() if t == "PC portable" and days[k] < "2024-09"]
    assert got.n_purchases == len(laptops) > 0
    assert got.carbon_t == pytest.approx(sum(len(m) * 10 for m in laptops) / 1000, abs=0.006)


def test_imputation_edges(spark):
    from carbonledger.operators.impute import impute_category
    none = spark.createDataFrame([("a b", None), ("c", " ")], "t string, y string")
    assert {(r.y, r.y_imputed) for r in impute_category(none, "t", "y").collect()} == {(None, False)}
    full = spark.createDataFrame([("aa", "x "), ("bb", "y")], "t string, y string")
    assert {(r.t, r.y, r.y_imputed) for r in impute_category(full, "t", "y").collect()} == {
        ("aa", "x", False), ("bb", "y", False)}
    some = spark.createDataFrame([("aa", "x"), ("aa", "x"), ("bb", "y"), ("zz", None), ("bb", None), (None, None)],
                                 "t string, y string")
    got = sorted((r.t or "", r.y) for r in impute_category(some, "t", "y").filter("y_imputed").collect())
    assert got == [("", "x"), ("bb", "y"), ("zz", "x")]  # unknown words fall back to the commonest label
    small = impute_category(some, "t", "y", block=1)  # every label a block of its own: the same answers
    assert sorted((r.t or "", r.y) for r in small.filter("y_imputed").collect()) == got


def test_raw_star_schema(spark, drops, tmp_path):
    from carbonledger.plans.star import raw_star_tables, write_raw_star_schema
    root, trips, items = drops
    raw = RawModel(spark, root, impute=False)
    t = raw_star_tables(raw)
    assert t["dimension_date"].count() == 3
    assert t["dimension_location"].count() == 7
    assert t["dimension_transport"].count() == 5
    assert t["dimension_model"].filter(F.col("model") == "NULL").count() == 1
    # every mission lands in the fact with all its keys; people without a mission keep one null row
    fm = t["fact_mission"]
    keyed = fm.filter(F.col("mission_key").isNotNull())
    assert keyed.count() == len(trips)
    assert keyed.filter(F.col("dep_location_id").isNull() | F.col("dst_location_id").isNull()
                        | F.col("date_id").isNull() | F.col("transport_id").isNull()).count() == 0
    people = {x["ID_PERSONNEL"] for x in trips + items}
    assert {r.person_id for r in fm.select("person_id").distinct().collect()} == people
    assert t["fact_equipment"].filter(F.col("equipment_key").isNotNull()).count() == len(items)
    per_site = fm.groupBy("site_id").agg(F.count("*").alias("n"), F.max("fact_id").alias("mx")).collect()
    assert all(r.n == r.mx for r in per_site) and len(per_site) == 7
    n = fm.count()
    names = write_raw_star_schema(RawModel(spark, root, impute=False), str(tmp_path / "star"))
    assert spark.read.parquet(str(tmp_path / "star" / "fact_mission")).count() == n
    assert len(names) == 10


def test_star_model_answers_equal_driver_model(spark, tmp_path):
    from carbonledger.plans.model import DriverModel
    from carbonledger.plans.star import write_star_schema
    from carbonledger.plans.star_model import StarModel
    sf = SF_MID
    d = DriverModel(spark, sf)
    out = str(tmp_path / "star")
    write_star_schema(d, out)
    s = StarModel(spark, out)
    july, eu = ("1998-07-01", "1998-07-31"), [1, 3, 4]
    pairs = [
        (q.period_emissions(d, july, eu), q.period_emissions(s, july, eu)),
        (q.top_emission_days(d), q.top_emission_days(s)),
        (q.monthly_distance(d), q.monthly_distance(s)),
        (q.purchase_carbon(d), q.purchase_carbon(s)),
        (q.emissions_by(d, "job_function", ("1998-05-01", "1998-10-31"), mission_type="Business Meeting"),
         q.emissions_by(s, "job_function", ("1998-05-01", "1998-10-31"), mission_type="Business Meeting")),
        (q.average_age(d), q.average_age(s)),
        (q.headcount_by_function(d), q.headcount_by_function(s)),
    ]
    for a, b in pairs:
        key = lambda t: tuple((x is None, str(x)) for x in t)
        ra = sorted((tuple(r) for r in a.collect()), key=key)
        rb = sorted((tuple(r) for r in b.collect()), key=key)
        assert ra == rb
    plan = q.period_emissions(s, july, eu)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan or "year_month" in plan.split("PartitionFilters")[1]
    assert "site_id" in plan.split("PartitionFilters")[1].split("]")[0] or "dynamicpruning" in plan


def test_unknown_places_are_reported_not_zeroed(spark, drops, gazetteer):
    from carbonledger.operators.places import unlocated_places
    gaz = gazetteer.filter(F.col("city") != "Oslo")
    raw = RawModel(spark, drops[0], gazetteer=gaz, impute=False)
    e = raw.enriched_missions()
    rep = {(r.role, r.city): r.n_trips for r in unlocated_places(e, gaz).collect()}
    want = collections.Counter([("departure", x["VILLE_DEPART"]) for x in drops[1] if x["VILLE_DEPART"] == "Oslo"]
                               + [("destination", "Oslo") for x in drops[1] if x["VILLE_DESTINATION"] == "Oslo"])
    assert rep == dict(want)
    lost = [x for x in drops[1] if "Oslo" in (x["VILLE_DEPART"], x["VILLE_DESTINATION"])]
    assert e.filter(F.col("km_one_way").isNull()).count() == len(lost) > 0
    got = q.period_emissions(raw, ("2024-01-01", "2024-12-31")).first()
    assert (got.n_missions, got.n_unlocated) == (len(drops[1]), len(lost))


def test_raw_model_with_personnel_files(spark, drops, tmp_path):
    from carbonledger.sources.raw import read_personnel
    root, trips, items = drops
    jobs = {"paris": "Cadre", "berlin": "Dateningenieur"}
    people = sorted({(x["ID_PERSONNEL"], x["site"]) for x in trips + items})
    for site in SITE_KEYS:
        lines = ["ID_PERSONNEL;NOM_PERSONNEL;PRENOM_PERSONNEL;FONCTION_PERSONNEL;DT_NAISS"]
        lines += [f"{p};N;P;{jobs.get(site, 'Cadre')};1970-01-15" for p, s in people if s == site]
        if site == "shanghai":  # a person of another site's file: the first site in order keeps them
            lines.append(f"{people[0][0]};N;P;Pilot;1980-01-15")
        (tmp_path / f"PERSONNEL_{site.upper()}.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    per = read_personnel(spark, str(tmp_path / "PERSONNEL_*.txt"))
    raw = RawModel(spark, root, personnel=per, impute=False)
    hc = {(r.site_id, r.job_function): r.headcount for r in q.headcount_by_function(raw).collect()}
    # French and German labels are harmonised in their own sites only
    assert {j for s, j in hc if s == 1} == {"Business Executive"} and {j for s, j in hc if s == 3} == {"Data Engineer"}
    assert {j for s, j in hc if s == 4} == {"Cadre"}
    assert sum(v for (s, _), v in hc.items() if s is None) == len(people)
    age = q.average_age(raw, "Vocational Training", ("2024-07-01", "2024-09-30"), "2024-09-30").first()
    assert age.n_rows > 0 and age.average_age == 54


def test_reference_dedup_never_adds_trips(spark):
    from carbonledger.plans.model import DriverModel
    d = DriverModel(spark, SF_MID)
    a = {r.site: r.n_missions for r in q.monthly_distance(d).collect() if r.year_month == "1998-07"}
    b = {r.site: r.n_missions for r in q.monthly_distance(d, dedup="reference").collect() if r.year_month == "1998-07"}
    assert set(a) == set(b) and all(b[k] <= a[k] for k in a) and sum(b.values()) < sum(a.values())
    w = {r.dst_city: r.n_missions for r in q.worst_destination(d, dedup="reference").collect()}
    assert sum(w.values()) <= q.period_emissions(d, ("1998-05-01", "1998-10-31")).first().n_missions
    with pytest.raises(ValueError):
        q.top_emission_days(d, dedup="nope")
