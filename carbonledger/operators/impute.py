"""Categorical imputation: multinomial naive Bayes as sparse aggregates.

Tokens are runs of two or more letters, digits or underscores of the lower-cased
text.  A fitted model is three tables made by grouped sums over the labelled
rows (no vocabulary, no label list and no matrix on the driver):

* (label, token, n): how often the token occurs under the label;
* (label, log_prior, log_size): the label's share of the rows, and its tokens T;
* (known, label): the best label by prior and length alone, per number of known tokens.

With smoothing 1 a label's score for a row is

    log prior + sum over the row's known tokens of count x log((n + 1) / (T + V))
  = log prior - known tokens x log(T + V) + sum over tokens seen under the label of count x log(n + 1)

(V: distinct tokens)

so rows meet the model by an equi-join on the token, only for the pairs that
exist, and tokens outside the vocabulary do not count.  The highest score wins,
ties go to the first label in order.  With one block of labels, the commonest
tokens (a bounded number) are broadcast and a row's sums over them are made in
its own task, so that only rare tokens are shuffled, once (``all_gains``).

The sum is never negative, so a label without a token of the row competes only by
the first two terms: per label a line over the number k of known tokens.  The
best of all lines for every k is their upper envelope, made by a monotone chain
in every partition and once more over the parts' envelopes; the labels within
the rounding of it are found by binary search, and meet the numbers k by equal
dyadic intervals (``plain_best``).  No row meets a label without a reason.

Labels that share tokens with a row are pruned by upper bounds.  Labels lie in
blocks of ``BLOCK`` neighbours by size; a block's best prior, smallest size and
largest count per token bound the score of its labels.  A row scores the block
of its highest bound first, and then only the blocks whose bound is not below
the best score found (``pruned_scores``), so a token that all labels share costs
a row one line per block, not one per label.

Defined cases: no labelled row leaves nulls; nothing to fill changes nothing; a
row without known tokens takes the label with the highest prior; any number of
labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..session import reliable_checkpoint
from .keys import sequential_index

TOKEN = r"[\\p{L}\\p{N}_]{2,}"
BLOCK = 256
HEAVY = 1 << 18  # pairs of token and label that are broadcast
NEAR = 2e-6  # scores are compared rounded to six decimals


def _tokens(text: str):
    return F.expr(f"regexp_extract_all(lower(`{text}`), '{TOKEN}', 0)")


def fit(df: DataFrame, text_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(per label: label, log_prior, log_size; per label and token: label, token, n) of the labelled rows."""
    known = df.filter(~is_blank(F.col(label_col))).select(
        F.trim(F.col(label_col)).alias("label"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = reliable_checkpoint(known.select("label", F.explode(_tokens("text")).alias("token"))
                                 .groupBy("label", "token").agg(F.count(F.lit(1)).alias("n")))
    rows = known.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.groupBy("label").agg(F.sum("n").alias("total"))
    v = counts.select(F.countDistinct("token")).first()[0]
    all_rows = known.count()
    labels = rows.join(totals, "label", "left").select(
        "label", F.log(F.col("rows") / F.lit(float(max(all_rows, 1)))).alias("log_prior"),
        F.log(F.greatest(F.coalesce("total", F.lit(0)) + F.lit(v), F.lit(1)).cast("double")).alias("log_size"))
    return reliable_checkpoint(labels), counts


# --- labels without a token of the row --------------------------------------------------------------------------

def envelope(prior: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines prior - k * size that are the highest for some k >= 0, from small to large k."""
    hull: list[tuple[float, float]] = []
    for i in np.lexsort((-prior, -size)):  # steepest first; of equal sizes the higher
        p, s = prior[i], size[i]
        if hull and hull[-1][1] == s:
            continue
        while hull and (hull[-1][0] <= p or len(hull) > 1 and
                        (p - hull[-2][0]) * (hull[-2][1] - hull[-1][1]) >=
                        (hull[-1][0] - hull[-2][0]) * (hull[-2][1] - s)):
            hull.pop()
        hull.append((p, s))
    return np.array([h[0] for h in hull]), np.array([h[1] for h in hull])


def _highest(prior: np.ndarray, size: np.ndarray, k: np.ndarray) -> np.ndarray:
    cross = np.diff(prior) / np.diff(size) if len(prior) > 1 else np.zeros(0)
    at = np.searchsorted(cross, k, side="right")
    return prior[at] - k * size[at]


def near_envelope(prior: np.ndarray, size: np.ndarray, hull: tuple[np.ndarray, np.ndarray], most: int
                  ) -> tuple[np.ndarray, np.ndarray]:
    """First and last whole k in 0..most for which each line is within ``NEAR`` of the envelope (last < first: never).

    Line minus envelope is concave in k: it is highest where the envelope stops
    being steeper than the line, and falls to both sides.
    """
    hp, hs = hull
    cross = np.append(np.diff(hp) / np.diff(hs) if len(hp) > 1 else np.zeros(0), np.inf)
    steeper = np.searchsorted(-hs, -size, side="left")  # envelope pieces steeper than the line
    x = np.where(steeper > 0, cross[np.maximum(steeper, 1) - 1], 0.0)
    x = np.clip(np.nan_to_num(x, posinf=float(most)), 0, most)

    def close(k):
        return prior - k * size >= _highest(hp, hs, k) - NEAR

    top = np.where(close(np.floor(x)), np.floor(x), np.ceil(x))
    never = ~close(top)
    lo, hi, step = top.copy(), top.copy(), 1 << max(int(most), 1).bit_length()
    while step:
        back, on = np.maximum(lo - step, 0), np.minimum(hi + step, most)
        lo, hi = np.where(close(back), back, lo), np.where(close(on), on, hi)
        step >>= 1
    return lo, np.where(never, lo - 1, hi)


def dyadic(first: int, last: int) -> Iterator[tuple[int, int]]:
    """(level, number) of the aligned intervals of length 2**level that make up first..last."""
    while first <= last:
        level = (first & -first).bit_length() - 1 if first else last.bit_length()
        level = min(level, (last - first + 1).bit_length() - 1)
        yield level, first >> level
        first += 1 << level


def plain_best(labels: DataFrame, known: DataFrame) -> DataFrame:
    """(known, label, score) of the best label by prior and size alone, for each number in ``known``.

    The envelope is shipped to the tasks: it has at most one line per whole k up
    to the largest text's number of tokens.
    """
    lines = reliable_checkpoint(labels.groupBy("log_prior", "log_size").agg(F.min("label").alias("label")))
    most = known.agg(F.max("known")).first()[0] or 0

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p, s = np.zeros(0), np.zeros(0)
        for pdf in batches:
            p, s = envelope(np.append(p, pdf["log_prior"]), np.append(s, pdf["log_size"]))
        yield pd.DataFrame({"log_prior": p, "log_size": s})

    parts = lines.select("log_prior", "log_size").mapInPandas(chain, "log_prior double, log_size double")
    found = parts.toPandas()  # envelopes of the parts
    hull = envelope(found["log_prior"].to_numpy(float), found["log_size"].to_numpy(float))

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lo, hi = near_envelope(pdf["log_prior"].to_numpy(float), pdf["log_size"].to_numpy(float), hull, most)
            out = [(int(level), int(number), *line) for line, a, b in zip(
                pdf[["label", "log_prior", "log_size"]].itertuples(index=False, name=None), lo, hi)
                for level, number in dyadic(int(a), int(b))]
            yield pd.DataFrame(out, columns=["level", "number", "label", "log_prior", "log_size"])

    close = lines.mapInPandas(near, "level int, number long, label string, log_prior double, log_size double")
    levels = F.explode(F.sequence(F.lit(0), F.lit(int(most).bit_length())))
    asked = known.select("known", levels.alias("level")).withColumn(
        "number", F.floor(F.col("known") / F.pow(F.lit(2.0), F.col("level"))))
    score = F.round(F.col("log_prior") - F.col("known") * F.col("log_size"), 6)
    return (asked.join(reliable_checkpoint(close), ["level", "number"])
            .groupBy("known").agg(F.min_by(F.struct("label", score.alias("score")), F.struct(-score, "label")).alias("x"))
            .select("known", "x.label", "x.score"))


# --- labels with tokens of the row ------------------------------------------------------------------------------

def _scores(hits: DataFrame, length: DataFrame, labels: DataFrame) -> DataFrame:
    """(__row, label, score) from (__row, label, gain)."""
    base = F.col("log_prior") - F.col("known") * F.col("log_size")
    return (hits.join(length, "__row").join(labels.select("label", "log_prior", "log_size"), "label")
            .select("__row", "label", F.round(base + F.col("gain"), 6).alias("score")))


def _gain(count: str):
    return F.sum(F.col("c") * F.log(F.col(count) + 1.0))


def pruned_scores(bag: DataFrame, length: DataFrame, plain: DataFrame, labels: DataFrame, counts: DataFrame,
                  block: int = BLOCK) -> DataFrame:
    """(__row, label, score) of every label with a token of the row that can be its best.

    ``plain``: (__row, label, score) of the best label by prior and size.
    """
    numbered = sequential_index(labels, ["log_size", "label"], out="idx", split_ties=False)
    labels = reliable_checkpoint(numbered.withColumn("block", F.floor((F.col("idx") - 1) / block).cast("int")))
    placed = reliable_checkpoint(counts.join(labels.select("label", "block"), "label"))
    tops = reliable_checkpoint(placed.groupBy("token", "block").agg(F.max("n").alias("most")))
    limits = reliable_checkpoint(labels.groupBy("block").agg(F.max("log_prior").alias("p"),
                                                             F.min("log_size").alias("s")))
    bound = F.col("p") - F.col("known") * F.col("s") + F.col("gain")
    least = plain.select("__row", F.col("score").alias("least"))
    pairs = reliable_checkpoint(
        bag.join(tops, "token").groupBy("__row", "block").agg(_gain("most").alias("gain"))
        .join(limits, "block").join(length, "__row").join(least, "__row")
        .select("__row", "block", bound.alias("bound"), "least").filter(F.col("bound") >= F.col("least") - NEAR))

    def score(chosen: DataFrame) -> DataFrame:
        hits = (chosen.join(bag, "__row").join(placed, ["block", "token"]).groupBy("__row", "label")
                .agg(_gain("n").alias("gain")))
        return _scores(hits, length, labels)

    first = reliable_checkpoint(pairs.groupBy("__row").agg(F.max_by("block", F.struct("bound", "block")).alias("block")))
    tried = reliable_checkpoint(score(first))
    reached = tried.groupBy("__row").agg(F.max("score").alias("reached"))
    rest = (pairs.join(first.withColumnRenamed("block", "first"), "__row").join(reached, "__row", "left")
            .filter((F.col("block") != F.col("first"))
                    & (F.col("bound") >= F.coalesce("reached", "least") - NEAR)).select("__row", "block"))
    return tried.unionByName(score(rest))


def all_gains(tokens: DataFrame, counts: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(__row, label, c, gain) of the row's known tokens seen under each label; of a null label, ``c`` has all of them.

    ``tokens``: (__row, token) per occurrence, a row's together.  The commonest tokens, ``heavy`` pairs of token and
    label at most, are broadcast, so that a row's sums over them are made where the row is read.
    """
    seen = F.collect_list(F.struct("label", "n")).alias("seen")
    model = reliable_checkpoint(counts.groupBy("token").agg(F.floor(8 * F.log2(F.sum("n"))).cast("int").alias("level"),
                                                            seen))
    least, total = None, 0
    for r in sorted(model.groupBy("level").agg(F.sum(F.size("seen")).alias("n")).collect(),
                    key=lambda r: -r["level"]):  # some hundred levels
        total += r["n"]
        if total > heavy:
            break
        least = r["level"]
    common = F.lit(False) if least is None else F.col("level") >= least

    def summed(found: DataFrame) -> DataFrame:
        every = F.struct(F.lit(None).cast("string").alias("label"), F.lit(0).cast("long").alias("n"))
        return (found.select("__row", "c", F.explode(F.concat(F.array(every), "seen")).alias("x"))
                .select("__row", "c", "x.label", "x.n").groupBy("__row", "label")
                .agg(F.sum("c").alias("c"), _gain("n").alias("gain")))

    near = F.broadcast(model.filter(common).select("token", "seen"))
    first = summed(tokens.join(near, "token").withColumn("c", F.lit(1).cast("long")))
    others = (tokens.join(near.select("token"), "token", "left_anti")
              .groupBy("__row", "token").agg(F.count(F.lit(1)).alias("c")))
    rest = summed(others.join(model.filter(~common).select("token", "seen"), "token"))
    return first.unionByName(rest).groupBy("__row", "label").agg(F.sum("c").alias("c"), F.sum("gain").alias("gain"))


def predict(rows: DataFrame, text_col: str, model: tuple[DataFrame, DataFrame], out: str,
            block: int = BLOCK, heavy: int = HEAVY) -> DataFrame:
    """``rows`` with ``out``: the label of the highest score (null if the model has no label)."""
    labels, counts = model
    own = reliable_checkpoint(rows.withColumn("__row", F.monotonically_increasing_id()))
    tokens = own.select("__row", F.explode(_tokens(text_col)).alias("token"))
    many = labels.count() > block
    if many:
        bag = tokens.groupBy("__row", "token").agg(F.count(F.lit(1)).alias("c"))
        bag = reliable_checkpoint(bag.join(counts.select("token").distinct(), "token", "left_semi"))
        some = bag.groupBy("__row").agg(F.sum("c").alias("known"))  # other tokens count for no label
    else:
        gains = reliable_checkpoint(all_gains(tokens, counts, heavy))
        some = gains.filter("label IS NULL").select("__row", F.col("c").alias("known"))
    length = reliable_checkpoint(own.select("__row").join(some, "__row", "left")
                                 .select("__row", F.coalesce("known", F.lit(0)).alias("known")))
    plain = length.join(reliable_checkpoint(plain_best(labels, length.select("known").distinct())), "known").select(
        "__row", "label", "score")
    if many:
        scored = pruned_scores(bag, length, plain, labels, counts, block)
    else:  # one block: all its labels are scored
        scored = _scores(gains.filter("label IS NOT NULL").select("__row", "label", "gain"), length, labels)
    best = (scored.unionByName(plain).groupBy("__row")
            .agg(F.min_by("label", F.struct(-F.col("score"), "label")).alias("__best")))
    return own.join(best, "__row", "left").withColumn(out, F.col("__best")).drop("__row", "__best")


def impute_category(df: DataFrame, text_col: str, label_col: str, out: str | None = None, **kw) -> DataFrame:
    """Fill blank/null ``label_col`` values from ``text_col``; known labels are kept (trimmed).

    Returns ``df`` with ``out`` (default: ``label_col``) filled and a boolean
    ``<out>_imputed`` flag.
    """
    out = out or label_col
    return _fill(df, text_col, label_col, out, fit(df, text_col, label_col), **kw)


def impute_pair(df: DataFrame, first: str, second: str, **kw) -> DataFrame:
    """Fill ``second`` from ``first``, then ``first`` from the filled ``second``.

    Both models are fitted on the given cells, before anything is filled, so no
    guess is ever trained on.
    """
    to_second, to_first = fit(df, first, second), fit(df, second, first)
    df = _fill(df, first, second, second, to_second, **kw).drop(f"{second}_imputed")
    return _fill(df, second, first, first, to_first, **kw).drop(f"{first}_imputed")


def _fill(df: DataFrame, text_col: str, label_col: str, out: str, model, **kw) -> DataFrame:
    blank = is_blank(F.col(label_col))
    missing, flag = df.filter(blank), f"{out}_imputed"
    cols = list(dict.fromkeys([*df.columns, out, flag]))
    kept = df.filter(~blank).withColumn(out, F.trim(F.col(label_col))).withColumn(flag, F.lit(False))
    filled = predict(missing, text_col, model, "__label", **kw)
    filled = filled.withColumn(out, F.col("__label")).withColumn(flag, F.col(out).isNotNull())
    return kept.select(*cols).unionByName(filled.select(*cols))
