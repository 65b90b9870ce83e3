"""Ranked lexical search by dense blocked matrix products.

Every document is scored against every query item by integer BM25-like impacts:
a term's weight is w = floor(1000 ln((2N+2) / (2df+1))), its impact in a
document (10^9 tf) div (1000 tf + 20 m) with m = 50 + (50 n N) div L, and the
score is the sum of w * impact over the item's distinct terms.

Steps, for each block of items (``item_blocks``):

1. One pass over the texts keeps, of each document, its number of terms and the
   (term number, tf) pairs of the block's vocabulary, as a written table; N, L
   and the document frequencies are aggregates of that table.
2. Each task takes tiles of documents, compacts the vocabulary to the terms that
   occur in the tile, lays them out as a dense float64 impact matrix and
   multiplies it (BLAS) by the dense weight matrix of the items, one vocabulary
   tile at a time.  A tile's width is bounded so that every partial sum of
   products stays below 2^53 and is exact; tiles are added as 64-bit integers.
3. Tie-safe top-k: a task keeps, per item, the k best by (score descending,
   doc_id ascending); a document as good as the k-th is never cut before its id
   is compared.  The tasks' lists meet first in salted groups, then per item.

The blocks are bounded by a number of items and of (item, term) pairs, measured
before; a block's vocabulary and weights are what goes to the tasks.  Any number
of items is worked through block by block, each against all documents.

Defined cases: null or empty text has no term (in documents: neither counted in
N nor found; in items: no rows); ``doc_id`` null comes last among equal scores;
repeated document rows are documents of their own; repeated items each give
their rows; fewer than k hits give fewer rows; empty tables give an empty result;
extra columns are ignored.  A text is worked through in pieces cut between terms,
so a very long one takes bounded memory beyond its own bytes.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Terms in UTF-8 bytes: digits, letters and everything beyond ASCII.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
PIECE = 1 << 20
ITEMS, PAIRS = 512, 200_000  # of a block, on average
DOC_TILE, TERM_TILE = 256, 2048
EXACT = 1 << 53
IMPACT = 1_000_000  # no impact reaches this
SALTS = 32


def term_counts(text: str | None) -> Counter:
    """Occurrences of every term of a text, A-Z lower-cased."""
    raw, found, at = (text or "").encode("utf-8", "surrogatepass").lower(), Counter(), 0
    while at < len(raw):
        cut_at = _GAP.search(raw, at + PIECE)  # a piece ends between two terms
        stop = cut_at.start() if cut_at else len(raw)
        found.update(TERM.findall(raw, at, stop))
        at = stop
    return found


# --- items ------------------------------------------------------------------------------------------------------

def item_terms(items: DataFrame) -> DataFrame:
    """(item number, item_id, distinct terms) of the items that have a term."""
    @F.pandas_udf("array<binary>")
    def terms(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(term_counts(t)) for t in texts])

    own = items.select(F.monotonically_increasing_id().alias("item"), "item_id", terms("text").alias("terms"))
    return cut(own.filter(F.size("terms") > 0))


def item_blocks(own: DataFrame) -> Iterator[list]:
    """The items in blocks of about ``ITEMS`` items and ``PAIRS`` terms, dealt by hash; one block at a time is on
    the driver."""
    n, pairs = own.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    blocks = max(-(-n // ITEMS), -(-pairs // PAIRS))
    for b in range(blocks):
        rows = own.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        if rows:
            yield rows


# --- documents --------------------------------------------------------------------------------------------------

def block_terms(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n terms, numbers of the vocabulary's terms, their counts) of every document with a term."""
    number = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(vocabulary)})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = number.value
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                n, term, tf = [], [], []
                for text in pdf["text"].iloc[at:at + 512]:
                    found = term_counts(text)
                    n.append(sum(found.values()))
                    hits = found.keys() & known.keys()
                    term.append([known[t] for t in hits])
                    tf.append([found[t] for t in hits])
                part = pdf.iloc[at:at + 512]
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "no_id": part["no_id"].to_numpy(), "n": n,
                                    "term": term, "tf": tf})

    # A null id would turn the column into floats; it travels beside the id.
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
                      F.col("doc_id").isNull().alias("no_id"), "text")
    found = own.mapInPandas(count, "doc_id long, no_id boolean, n long, term array<int>, tf array<long>")
    return cut(found.filter("n > 0"))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """Integer impact of each (tf, terms of its document)."""
    m = 50 + (50 * n * n_docs) // length
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def tile_scores(tile: pd.DataFrame, n_docs: int, length: int, by_term: dict) -> np.ndarray:
    """Scores (documents of the tile x items) as int64; ``by_term``: starts, items and weights sorted by term."""
    sizes = tile["term"].str.len().to_numpy(np.int64)
    out = np.zeros((len(tile), by_term["items"]), np.int64)
    if not sizes.sum():
        return out
    doc = np.repeat(np.arange(len(tile)), sizes)
    term = np.concatenate([np.asarray(t, np.int64) for t in tile["term"]])
    tf = np.concatenate([np.asarray(t, np.int64) for t in tile["tf"]])
    impact = impacts(tf, tile["n"].to_numpy(np.int64)[doc], n_docs, length)
    used, column = np.unique(term, return_inverse=True)  # the compact vocabulary of this tile
    for first in range(0, len(used), by_term["width"]):
        part = used[first:first + by_term["width"]]
        here = (column >= first) & (column < first + len(part))
        d = np.zeros((len(tile), len(part)))
        d[doc[here], column[here] - first] = impact[here]
        q = np.zeros((len(part), by_term["items"]))
        starts, ends = by_term["starts"][part], by_term["starts"][part + 1]
        row = np.repeat(np.arange(len(part)), ends - starts)
        at = np.repeat(starts - np.concatenate([[0], np.cumsum(ends - starts)[:-1]]), ends - starts) + np.arange(len(row))
        q[row, by_term["item"][at]] = by_term["weight"][part][row]
        out += (d @ q).astype(np.int64)
    return out


def tile_top(scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray, best: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best (item, doc_id, score) of ``best`` and the tile's scores; equal scores by doc_id, null last."""
    least = np.ones(scores.shape[1], np.int64)
    if len(best):
        size = best.groupby("item")["score"].agg(["size", "min"])
        full = size[size["size"] >= k]
        least[full.index.to_numpy()] = full["min"].to_numpy()  # an equal score may still win by its id
    doc, item = np.nonzero(scores >= least)
    found = pd.DataFrame({"item": item, "doc_id": ids[doc], "no_id": no_id[doc], "score": scores[doc, item]})
    both = pd.concat([best, found], ignore_index=True) if len(best) else found
    both = both.sort_values(["item", "score", "no_id", "doc_id"], ascending=[True, False, True, True])
    return both[both.groupby("item").cumcount() < k].reset_index(drop=True)


def block_search(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """(item number, doc_id, score): the k best of every task for every item of one block."""
    spark = docs.sparkSession
    vocabulary = sorted({bytes(t) for r in rows for t in r["terms"]})
    number = {t: j for j, t in enumerate(vocabulary)}
    found = block_terms(docs, vocabulary)
    n_docs, length = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in found.select(F.explode("term").alias("t")).groupBy("t").count().collect():  # one row a vocabulary term
        df[r[0]] = r[1]
    weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
    pairs = np.array([(number[bytes(t)], j) for j, r in enumerate(rows) for t in r["terms"]], np.int64)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    largest = int(weights.max()) * IMPACT
    shared = spark.sparkContext.broadcast({
        "items": len(rows), "names": np.array([r["item"] for r in rows], np.int64), "item": pairs[:, 1], "weight": weights,
        "starts": np.searchsorted(pairs[:, 0], np.arange(len(vocabulary) + 1)),
        "width": max(1, min(TERM_TILE, (EXACT - 1) // max(largest, 1)))})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame({"item": np.zeros(0, np.int64)})
        for pdf in batches:
            for at in range(0, len(pdf), DOC_TILE):
                tile = pdf.iloc[at:at + DOC_TILE]
                best = tile_top(tile_scores(tile, n_docs, length, shared.value), tile["doc_id"].to_numpy(np.int64),
                                tile["no_id"].to_numpy(bool), best, k)
        if len(best):
            best["item"] = shared.value["names"][best["item"].to_numpy(np.int64)]
            yield best[["item", "doc_id", "no_id", "score"]]

    hits = found.mapInPandas(search, "item long, doc_id long, no_id boolean, score long")
    return hits.select("item", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """Per item: item_id, rank (from 1), doc_id, score of its ``k`` best documents with a score above 0."""
    own = item_terms(items)
    hits = None
    for rows in item_blocks(own):
        # Written block by block, so the next block's pass does not repeat this one's.
        found = cut(block_search(docs, rows, k))
        hits = found if hits is None else hits.unionAll(found)
    item_id = F.col("item_id")
    if hits is None:
        return own.limit(0).select(item_id, F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                                   F.lit(0).cast("long").alias("score"))
    order = F.col("score").desc(), F.col("doc_id").asc_nulls_last()
    salted = Window.partitionBy("item", "salt").orderBy(*order)
    some = (hits.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
            .withColumn("r", F.row_number().over(salted)).filter(F.col("r") <= k).drop("r", "salt"))
    top = (some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
           .filter(F.col("rank") <= k))
    return top.join(own.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int"), "doc_id",
                                                                  "score")
