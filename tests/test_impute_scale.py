"""Imputation with many labels: the envelope, the pruned scores, and whole answers against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from carbonledger.operators import impute

from .conftest import SF_MID

TOKEN = re.compile(r"\w{2,}")


def brute(rows, fill):
    """(text, label) rows -> label of every text in ``fill`` by the full score of every label."""
    counts, prior = defaultdict(Counter), Counter(label for _, label in rows)
    for text, label in rows:
        counts[label].update(TOKEN.findall(text.lower()))
    names = sorted(prior)
    vocabulary = sorted({t for c in counts.values() for t in c})
    size = np.log(np.array([sum(counts[n].values()) + len(vocabulary) for n in names], float))
    base = np.log(np.array([prior[n] / len(rows) for n in names]))
    where = defaultdict(list)
    for i, n in enumerate(names):
        for t, c in counts[n].items():
            where[t].append((i, c))
    out = []
    for text in fill:
        bag = Counter(t for t in TOKEN.findall(text.lower()) if t in where)
        score = base - sum(bag.values()) * size
        for t, c in bag.items():
            for i, n in where[t]:
                score[i] += c * math.log(n + 1)
        score = np.round(score, 6)
        out.append(names[int(np.argmax(score))])
    return out


def corpus(seed, labels, n):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        label = f"L{k % labels if k < labels else int(rnd.paretovariate(0.6)) % labels:06d}"
        words = ["the"] + [f"w{int(rnd.paretovariate(0.5)) % 3000}" for _ in range(rnd.randint(0, 4))]
        rows.append((" ".join(words + [f"own{label}"] * rnd.randint(0, 2)), label))
    fill = [" ".join(["the"] * rnd.randint(0, 3) + [f"w{int(rnd.paretovariate(0.4)) % 3500}"
                                                    for _ in range(rnd.randint(0, 6))]) for _ in range(60)]
    fill += ["", "nothing known here", "the " * 40, "the ownL000007 ownL000009"]
    return rows, fill


@pytest.mark.parametrize("labels, n", [(3, 40), (700, 2_000), (50_000, 60_000)])
def test_labels_of_any_number_match_brute_force(spark, labels, n):
    rows, fill = corpus(labels, labels, n)
    df = spark.createDataFrame([(k, t, x) for k, (t, x) in enumerate(rows)] +
                               [(len(rows) + k, t, None) for k, t in enumerate(fill)], "id long, t string, l string")
    got = impute.impute_category(df, "t", "l")
    filled = {r.id: r.l for r in got.filter("l_imputed").collect()}
    assert [filled[len(rows) + k] for k in range(len(fill))] == brute(rows, fill)


def test_common_tokens_at_the_rows_give_the_same(spark):
    """Whatever share of the tokens is broadcast, the answers are those of brute force; the rest is shuffled once."""
    rows, fill = corpus(5, 5, 400)
    df = spark.createDataFrame([(k, t, x) for k, (t, x) in enumerate(rows)] + [(len(rows), None, None)] +
                               [(len(rows) + 1 + k, t, " ") for k, t in enumerate(fill)], "id long, t string, l string")
    for heavy in (0, 60, impute.HEAVY):
        got = impute.impute_category(df, "t", "l", heavy=heavy)
        filled = {r.id: r.l for r in got.filter("l_imputed").collect()}
        assert [filled[len(rows) + k] for k in range(len(fill) + 1)] == brute(rows, ["", *fill])
    tokens = df.select(F.col("id").alias("__row"), F.explode(impute._tokens("t")).alias("token"))
    counts = impute.fit(df, "t", "l")[1]
    known = tokens.join(counts.select("token").distinct(), "token").groupBy("__row").count()
    want = {(r[0], r[1]) for r in known.collect()}
    for heavy in (0, 60, impute.HEAVY):
        gains = impute.all_gains(tokens, counts, heavy)
        assert {(r[0], r[1]) for r in gains.filter("label IS NULL").select("__row", "c").collect()} == want


def test_envelope_is_the_highest_line():
    rnd = np.random.default_rng(2)
    for _ in range(200):
        n = rnd.integers(1, 30)
        prior = np.round(rnd.normal(size=n), rnd.integers(0, 3))
        size = np.round(rnd.uniform(1, 3, size=n), rnd.integers(0, 3))
        hull = impute.envelope(prior, size)
        k = np.arange(41.0)
        best = (prior[:, None] - np.outer(size, k)).max(axis=0)
        assert np.allclose(impute._highest(*hull, k), best, atol=1e-9)
        lo, hi = impute.near_envelope(prior, size, hull, 40)
        for i in range(n):
            want = [int(x) for x in k if prior[i] - x * size[i] >= best[int(x)] - impute.NEAR]
            assert list(range(int(lo[i]), int(hi[i]) + 1)) == want


def test_dyadic_intervals_cover_exactly():
    for first in range(0, 40):
        for last in range(first - 1, 70):
            got = [x for level, number in impute.dyadic(first, last)
                   for x in range(number << level, (number + 1) << level)]
            assert got == list(range(first, last + 1))


def test_no_product_in_the_plans(spark):
    """No plan of an imputation holds a cross or nested loop join."""
    from carbonledger.plans.catalog import QUERIES
    plan = QUERIES["impute_category"](spark, SF_MID)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    with open(impute.__file__, encoding="utf-8") as f:
        assert "crossJoin" not in f.read()
