"""Line dedup by winnowing: find runs of lines that repeat an earlier run and delete them (DataFrame only).

Lines are split at ``\\n``; blank lines never count.  Every line starts the
smallest window of lines with at least ``MIN_WORDS`` words and ends another.

1. Winnowing: each window selects the line with its smallest hash.  Two equal
   runs of at least MIN_WORDS words hold a common window, hence select a common
   line: a fingerprint is guaranteed for each of them.
2. Positions: only windows whose selected hash is also selected elsewhere are
   joined further; a unique fingerprint ends the matter.
3. Matches: the windows around a repeated fingerprint are compared by content;
   the earliest occurrence, by (doc_id, text digest, line), stays.  A line at any
   place of a repeated run lies in a window that begins or ends inside the run,
   so the union of the matched windows is the match extended line by line both
   ways, as far as the run goes.
4. Later occurrences are deleted, with the blank lines inside matched windows.

Each key is reduced by a partial aggregation to its first occurrence, and every
window meets one row of its key; there are no pairs within a group, so a line
that a third of the documents share costs one row per task.  The reduced keys
are materialised before they are joined back: they are broadcast if small, else
AQE splits a hot key's windows.  Texts are shuffled once, for the deletion.

Defined cases: null text stays null and has no lines; rows that repeat another
row's doc_id and text are one document here and get the same result; a null
doc_id comes after all others; a document may lose all its lines (its text is
then empty); an empty table gives an empty result; extra columns are kept
(``mark_runs`` replaces columns of its outputs' names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut

MIN_WORDS = 50
_KEY = ("doc_id", "t1", "t2")


def _digests(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes; null has its own."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """(doc_id, t1, t2, gone): the line numbers (from 0) to delete, for every document that has any."""
    t1, t2 = _digests(F.col(text))
    per_line = F.transform(_lines(F.col(text)), lambda x: F.struct(
        F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2"), F.regexp_count(x, F.lit(WORD)).alias("w")))
    own = docs.select("doc_id", t1.alias("t1"), t2.alias("t2"), per_line.alias("lines")).filter("lines is not null")
    own = own.groupBy(*_KEY).agg(F.first("lines").alias("lines"))
    rows = (own.select(*_KEY, F.posexplode("lines").alias("i", "x")).select(*_KEY, "i", "x.*").filter("w > 0"))

    doc = Window.partitionBy(*_KEY)
    end = F.sum("w").over(doc.orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("e", end).withColumn("s", F.col("e") - F.col("w"))
    ahead = doc.orderBy("s").rangeBetween(0, min_words - 1)
    back = doc.orderBy("e").rangeBetween(-(min_words - 1), 0)

    def window(w, full: Column) -> Column:
        return F.when(full, F.struct(
            F.min("h1").over(w).alias("fp"), F.min_by("i", "h1").over(w).alias("at"),
            F.min("i").over(w).alias("a"), F.max("i").over(w).alias("b"),
            F.xxhash64(F.collect_list("h1").over(w)).alias("k1"),
            F.xxhash64(F.collect_list("h2").over(w)).alias("k2")))

    rows = rows.select(*_KEY, F.array_distinct(F.array(
        window(ahead, F.max("e").over(ahead) - F.col("s") >= min_words),
        window(back, F.col("e") - F.min("s").over(back) >= min_words))).alias("ws"))
    windows = cut(rows.select(*_KEY, F.explode("ws").alias("x")).filter("x is not null").select(*_KEY, "x.*")
                  .distinct())

    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "t1", "t2", "at")
    again = cut(windows.groupBy("fp").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
                .filter(F.col("lo") != F.col("hi")).select("fp"))
    found = cut(windows.join(again, "fp"))

    start = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "t1", "t2", "a")
    first = cut(found.groupBy("k1", "k2").agg(F.min(start).alias("first"), F.max(start).alias("last"))
                .filter(F.col("first") != F.col("last")).select("k1", "k2", "first"))
    later = found.join(first, ["k1", "k2"]).filter(start != F.col("first"))
    return (later.select(*_KEY, F.explode(F.sequence("a", "b")).alias("i"))
            .groupBy(*_KEY).agg(F.collect_set("i").alias("gone")))


def _marked(docs: DataFrame, min_words: int, text: str) -> DataFrame:
    """``docs`` with __ld_n, __ld_removed, __ld_words and __ld_text."""
    gone = repeated_lines(docs, min_words, text).select(*[F.col(c).alias(f"__ld_{c}") for c in (*_KEY, "gone")])
    t1, t2 = _digests(F.col(text))
    j = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__ld_doc_id")) & (t1 == F.col("__ld_t1"))
                  & (t2 == F.col("__ld_t2")), "left").withColumn("__ld_lines", _lines(F.col(text)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("__ld_lines") - 1), F.col("__ld_gone"))
    line = lambda k: F.get(F.col("__ld_lines"), k)
    some = F.col("__ld_gone").isNotNull()
    lost = F.aggregate(F.transform(F.col("__ld_gone"), lambda k: F.regexp_count(line(k), F.lit(WORD))),
                       F.lit(0), lambda a, x: a + x)
    return j.select(
        *docs.columns,
        F.when(F.col(text).isNull(), 0).otherwise(F.size("__ld_lines")).cast("long").alias("__ld_n"),
        F.when(some, F.size("__ld_gone")).otherwise(0).cast("long").alias("__ld_removed"),
        F.when(some, lost).otherwise(0).cast("long").alias("__ld_words"),
        F.when(some, F.array_join(F.transform(stay, line), "\n")).otherwise(F.col(text)).alias("__ld_text"))


def mark_runs(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """``docs`` with n_lines, n_removed, removed_words and kept_text (the text without its repeated runs); columns
    of these names are replaced."""
    new = {"n_lines": "__ld_n", "n_removed": "__ld_removed", "removed_words": "__ld_words", "kept_text": "__ld_text"}
    return (_marked(docs, min_words, text).withColumns({k: F.col(v) for k, v in new.items()})
            .drop(*new.values()))


def drop_repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """``docs`` with the repeated runs deleted from the text; a document that loses all its words is left out."""
    emptied = (F.col("__ld_removed") > 0) & ~F.coalesce(F.col("__ld_text").rlike(WORD), F.lit(False))
    return (_marked(docs, min_words, text).filter(~emptied).withColumn(text, F.col("__ld_text"))
            .select(*docs.columns))
