"""Delimited files read by the header of each file, alike in batch and in a stream.

Daily drops come from many sites, and a site may order, add or leave out columns
from one day to the next.  Both readers therefore take lines with their file
(``batch_lines``, ``stream_lines``) and hand them to ``read_by_header``:

1. The first line of every file is found by an aggregate (``min_by`` over the
   lines of the file's first block, which one task reads in order) and mapped to
   positions: one small row per file, written once (``layouts``).
2. Only files whose layout differs from the schema's own take part in a join, so
   the lines of ordinary files meet a table that is empty or tiny; the planner
   knows its bytes.
3. Lines are split by Spark's CSV parser, and the schema's columns are picked by
   the file's positions.  A column the header lacks is null; unknown columns are
   left out; header lines are recognised by their cells and dropped.
4. The lines with their kind are written once; rows, rejects and report read them,
   so every line is parsed once.

A file whose header lacks a required column is rejected as a whole: its lines are
kept apart with the reason, the other files are read.  A line with another number
of cells than its header, or with a cell that does not convert, keeps what could
be read and its text in ``_corrupt_record``.  ``report`` counts all of it per file.

Defined cases: names match without regard to case and outer blanks; ``aliases``
maps other names to the schema's; of a repeated name the first column counts; a
byte order mark and empty lines are ignored; a file of a header alone has no rows
and still appears in the report; an empty file has no header and does not appear.
A stream gives every file whole to one micro-batch, so the same steps run there.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint
from . import schemas

_MARK = r"^\uFEFF"  # byte order mark
_END = "\x01"  # appended as a last cell: its position is the number of cells


def _with_file(df: DataFrame) -> DataFrame:
    return df.select("value", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("start"))


def batch_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, start of its block) of every line under ``path`` (a glob)."""
    return _with_file(spark.read.text(path))


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same lines as a stream of files."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _with_file(reader.text(path))


@dataclass
class HeaderRead:
    """Rows (the schema's columns, ``_corrupt_record``, ``file``), rejected lines (value, file, reason), the layout
    of every file, and all lines with their kind for the report (with the text of malformed and rejected ones)."""

    rows: DataFrame
    rejects: DataFrame
    layouts: DataFrame
    marked: DataFrame

    def report(self) -> DataFrame:
        """Per file: status (standard, mapped, rejected), missing, unknown, repeated columns, n_rows, n_malformed,
        n_rejected."""
        kind = F.col("kind")
        counts = self.marked.groupBy("file").agg(
            *[F.count(F.when(kind.isin(*kinds), 1)).alias(name) for name, kinds in (
                ("n_rows", ("row", "malformed")), ("n_malformed", ("malformed",)), ("n_rejected", ("rejected",)))])
        zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_rows", "n_malformed", "n_rejected")]
        return (self.layouts.join(counts, "file", "left")
                .select("file", "status", "missing", "unknown", "repeated", *zero))


def _with_cells(df: DataFrame, value: Column, width: int, sep: str) -> DataFrame:
    """``df`` with the cells of a line: an array of ``width`` + 1 strings, closed by the end mark if it has room.

    The parsed line is a column of its own, so that a line is parsed once.
    """
    names = [f"c{i}" for i in range(width + 1)]
    parsed = F.from_csv(F.concat(value, F.lit(sep + _END)), ", ".join(f"{n} string" for n in names),
                        {"sep": sep, "mode": "PERMISSIVE"})
    return df.withColumn("__line", parsed).withColumn("cells", F.array(*[F.col(f"__line.{n}") for n in names])).drop(
        "__line")


def _name(cell: Column, aliases: Mapping[str, str]) -> Column:
    """A header cell as the schema writes names."""
    name = F.upper(F.trim(F.regexp_replace(cell, _MARK, "")))
    if not aliases:
        return name
    other = F.create_map(*[F.lit(x) for old, new in aliases.items() for x in (old.strip().upper(), new.upper())])
    return F.coalesce(other[name], name)


def find_layouts(lines: DataFrame, schema: T.StructType, required: Sequence[str], sep: str,
                 aliases: Mapping[str, str]) -> DataFrame:
    """Per file: head, cells of the header, positions of the schema's columns, missing, unknown, repeated, status."""
    wanted = [f.name.upper() for f in schema.fields]
    names = F.array(*[F.lit(w) for w in wanted])
    first = (lines.withColumn("n", F.monotonically_increasing_id())
             .filter((F.col("start") == 0) & (F.trim(F.regexp_replace("value", _MARK, "")) != ""))
             .groupBy("file").agg(F.min_by("value", "n").alias("head")))
    mark = re.escape(sep)
    cell = f'(?:^|{mark})("(?:[^"]|"")*"|[^{mark}]*)'
    cells = F.regexp_extract_all(F.regexp_replace("head", _MARK, ""), F.lit(cell), F.lit(1))
    split = first.withColumn("found", F.transform(cells, lambda c: _name(F.regexp_replace(c, '^"|"$', ""), aliases)))
    split = split.withColumn("cells", F.size("found"))
    positions = F.transform(names, lambda w: (F.array_position(F.col("found"), w) - 1).cast("int"))
    lacks = F.array_except(names, F.col("found"))
    needs = F.array(*[F.lit(r.upper()) for r in required]) if required else F.array().cast("array<string>")
    repeated = F.array_distinct(F.filter("found", lambda c: (c != "") & (F.size(F.filter(
        F.col("found"), lambda x: x == c)) > 1)))
    rejected = F.size(F.array_intersect(needs, lacks)) > 0
    standard = (F.col("cells") == len(wanted)) & (F.col("found") == names)
    return split.select(
        "file", "head", "cells", positions.alias("positions"), lacks.alias("missing"),
        F.array_except("found", names).alias("unknown"), repeated.alias("repeated"),
        F.when(rejected, "rejected").when(standard, "standard").otherwise("mapped").alias("status"))


def _typed(cell: Column, kind: T.DataType, timestamp_format: str) -> Column:
    if isinstance(kind, T.StringType):
        return cell
    text = F.trim(cell)
    if isinstance(kind, T.TimestampType):
        return F.try_to_timestamp(text, F.lit(timestamp_format))
    return text.try_cast(kind)


def read_by_header(lines: DataFrame, schema: T.StructType, required: Sequence[str] = (), sep: str = ";",
                   aliases: Mapping[str, str] | None = None, timestamp_format: str = "yyyy-MM-dd HH:mm:ss"
                   ) -> HeaderRead:
    """Rows of ``schema`` from ``lines`` (value, file, start), each file by its own header."""
    aliases = aliases or {}
    width = len(schema.fields)
    layouts = reliable_checkpoint(find_layouts(lines, schema, required, sep, aliases))
    # A layout unlike the schema's, with the widest header: the number of cells any line is split into.
    odd = layouts.filter("status <> 'standard'").select("file", F.col("positions").alias("at"),
                                                        F.col("cells").alias("n"), "status")
    most = max(width, layouts.agg(F.max("cells")).first()[0] or 0)
    own = F.array(*[F.lit(i) for i in range(width)])
    text = F.regexp_replace("value", _MARK, "")
    placed = (lines.filter(F.trim(text) != "").join(odd, "file", "left")
              .select("value", "file", F.coalesce("status", F.lit("standard")).alias("status"),
                      F.coalesce("at", own).alias("at"), F.coalesce("n", F.lit(width)).alias("n")))
    placed = _with_cells(placed, text, most, sep)
    placed = placed.withColumn("end", F.array_position("cells", _END) - 1)
    # The end mark is no cell: beyond the line's own cells everything is null.
    picked = placed.withColumn("own", F.transform("at", lambda i: F.when(i < F.col("end"), F.get("cells", i)))).drop(
        "cells", "at")
    names = F.array(*[F.lit(f.name.upper()) for f in schema.fields])
    same = F.zip_with("own", names, lambda c, n: c.isNull() | (_name(c, aliases) == n))
    is_head = F.forall(same, lambda x: x) & F.exists("own", lambda c: c.isNotNull())
    typed = picked.withColumn("head", is_head).select("*", *[
        _typed(F.col("own")[i], f.dataType, timestamp_format).alias(f.name) for i, f in enumerate(schema.fields)])
    unread = [F.col(f.name).isNull() & (F.trim(F.col("own")[i]) != "") for i, f in enumerate(schema.fields)
              if not isinstance(f.dataType, T.StringType)]
    bad = F.coalesce(reduce(lambda a, b: a | b, unread, F.col("end") != F.col("n")), F.lit(False))
    kind = (F.when(F.col("head"), "head").when(F.col("status") == "rejected", "rejected").when(bad, "malformed")
            .otherwise("row"))
    # Written once: a filter on the kind would pull the parsing of the line into its condition, once for each use.
    kept = F.when(F.col("kind").isin("rejected", "malformed"), F.col("value")).alias("value")
    marked = reliable_checkpoint(typed.withColumn("kind", kind).select(kept, "file", "kind",
                                                                       *[f.name for f in schema.fields]))
    rows = marked.filter(F.col("kind").isin("row", "malformed")).select(
        *[f.name for f in schema.fields], F.col("value").alias(schemas.CORRUPT), "file")
    rejects = marked.filter(F.col("kind") == "rejected").select(
        "value", "file", F.lit("header lacks a required column").alias("reason"))
    return HeaderRead(rows, rejects, layouts, marked)
