"""Approximate name matching against all pairs."""

import random

from pyspark.sql import functions as F

from carbonledger.operators.places import gazetteer_match_similar
from carbonledger.operators.similar import harmonise_similar, match_names, normal_name, similar_pairs


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def names(seed, n):
    rnd = random.Random(seed)
    out = ["", "a", "b", "ab", "ba", "abc", "xyz", "aaaa", "aaaaaa", "abababab", "é", "éa"]
    base = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 12))) for _ in range(n)]
    for name in base:
        chars = list(name)
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(chars) + 1)
            chars[at:at + rnd.randint(0, 1)] = rnd.choice(["", "a", "z"])
        out += [name, "".join(chars)]
    return out


def test_pairs_are_all_pairs_within_the_distance(spark):
    a, b = names(1, 60), names(2, 60)
    left, right = (spark.createDataFrame([(k % 2, n) for k, n in enumerate(x)] + [(0, None)], "c int, name string")
                   for x in (a, b))
    for d in (0, 1, 2):
        got = sorted(map(tuple, similar_pairs(left, right, ["c"], d).collect()))
        want = sorted({(k, x, y, edits(x, y)) for k in (0, 1) for x in a[k::2] for y in b[k::2]
                       if x and y and edits(x, y) <= d})
        assert got == want


def test_labels_and_places_under_other_spellings(spark):
    known = spark.createDataFrame([("Los Angeles", "USA", 1.0), ("Paris", "France", 2.0), ("Modèle par défaut", "x", 0.0),
                                   ("Pari", "France", 5.0)], "label string, country string, score double")
    seen = spark.createDataFrame([("Losangeles",), ("los-angelas",), ("modele  par defaut",), ("Pariss",), ("Oslo",),
                                  (None,), (" ",), ("Parix",)], "v string")
    found, missing = match_names(seen.filter("v is not null"), known, "v", "label")
    assert {r.v: (r.label, r.distance) for r in found.collect()} == {
        "Losangeles": ("Los Angeles", 0), "los-angelas": ("Los Angeles", 1), "modele  par defaut": ("Modèle par défaut", 0),
        "Pariss": ("Paris", 1), "Parix": ("Pari", 1)}
    assert {r.v for r in missing.collect()} == {"Oslo", " "}
    by_score, _ = match_names(seen, known, "v", "label", score="score")
    assert {r.v: r.label for r in by_score.collect()}["Parix"] == "Pari"  # both one edit away: the higher score
    done = harmonise_similar(seen, "v", known, "label")
    assert sorted(str(r.v) for r in done.collect()) == sorted(
        ["Los Angeles", "Los Angeles", "Modèle par défaut", "Paris", "Pari", "Oslo", "None", " "])
    places = spark.createDataFrame([("Losangeles", "USA"), ("Paris", "France"), ("Losangeles", "France")],
                                   "city string, country string")
    cand = known.select(F.col("label").alias("city"), "country", F.col("label").alias("display_name"),
                        F.lit("city").alias("place_type"), F.col("score").alias("lat"), F.lit(1.0).alias("lon"), "score")
    hit, lost = gazetteer_match_similar(places, cand, ["city"])
    assert {(r.city, r.country, r.matched_city, r.distance) for r in hit.collect()} == {
        ("Losangeles", "USA", "Los Angeles", 0), ("Paris", "France", "Paris", 0)}
    assert [tuple(r) for r in lost.select("city", "country").collect()] == [("Losangeles", "France")]


def test_normal_names(spark):
    df = spark.createDataFrame([("Los-Ángeles ",), ("STRAßE 1",), ("中文",), (None,)], "n string")
    assert [r[0] for r in df.select(normal_name("n")).collect()] == ["losangeles", "strase1", "中文", None]
