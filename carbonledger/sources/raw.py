"""Readers for the raw daily drops and side files.

One scan covers every site: the path glob matches all site directories and the
site comes from the file path, so there is no per-site read and no union fold.
Blank cells (a single space in the drops) become nulls and strings are
trimmed; the raw value stays available with ``keep_raw=True``.  Drops are read by
the header of each file (``sources.headers``), side files by a fixed schema.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null
from . import schemas
from .headers import HeaderRead, batch_lines, read_by_header

# Drop layout: <root>/<prefix>_<SITE>/<prefix>_<SITE>_<KIND>/<NAME>_<yyyyMMdd>.txt
SITE_FROM_PATH = r"([A-Z]+)_(?:MISSION|INFORMATIQUE)/[^/]+$"
DATE_FROM_FILE = r"_(\d{8})\.txt$"


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(schemas.CORRUPT, T.StringType())])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";", header: bool = True,
                   timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Delimited scan with an explicit schema; malformed lines land in ``_corrupt_record``."""
    return (spark.read.schema(with_corrupt(schema))
            .option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", schemas.CORRUPT)
            # A header that does not match the schema fails the read instead of shifting columns.
            .option("enforceSchema", not header)
            .option("timestampFormat", timestamp_format).option("encoding", "UTF-8")
            .csv(path))


def clean_strings(df: DataFrame, keep_raw: bool = False) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType) and f.name != schemas.CORRUPT:
            cols.append(blank_to_null(F.col(f.name)).alias(f.name))
            if keep_raw:
                cols.append(F.col(f.name).alias(f"{f.name}_raw"))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def drops_glob(root: str, kind: str) -> str:
    """Glob of every daily drop of ``kind`` ('mission' or 'equipment') under ``root``, all sites."""
    folder, _ = schemas.KINDS[kind]
    return f"{root}/*/*_{folder}/*.txt"


def parse_drops(lines: DataFrame, kind: str, aliases: Mapping[str, str] | None = None) -> HeaderRead:
    """Lines of drops (from a batch or a micro-batch) read by each file's own header.

    A file without the kind's key column is rejected; other columns may come in
    any order, be missing (null) or be unknown (left out).
    """
    return read_by_header(lines, schemas.KINDS[kind][1], [schemas.KEYS[kind]], aliases=aliases)


def drop_rows(read: HeaderRead, keep_raw: bool = False) -> DataFrame:
    """Cleaned rows of ``parse_drops`` with ``site`` (lower case, from the directory name) and ``drop_date`` (from
    the file name)."""
    src = F.col("file")
    df = (read.rows.withColumn("site", F.lower(F.regexp_extract(src, SITE_FROM_PATH, 1)))
          .withColumn("drop_date", F.to_date(F.regexp_extract(src, DATE_FROM_FILE, 1), "yyyyMMdd")).drop("file"))
    return clean_strings(df, keep_raw)


def read_drops(spark: SparkSession, root: str, kind: str, keep_raw: bool = False,
               aliases: Mapping[str, str] | None = None) -> DataFrame:
    """All daily drops of ``kind`` ('mission' or 'equipment') under ``root``, every site at once."""
    return drop_rows(parse_drops(batch_lines(spark, drops_glob(root, kind)), kind, aliases), keep_raw)


def drops_report(spark: SparkSession, root: str, kind: str, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Per drop file: header status, missing, unknown and repeated columns, rows, malformed and rejected lines."""
    return parse_drops(batch_lines(spark, drops_glob(root, kind)), kind, aliases).report()


PERSONNEL_SITE = r"PERSONNEL_([A-Za-z]+)\.txt$"


def read_personnel(spark: SparkSession, path: str, schema: T.StructType = schemas.PERSONNEL) -> DataFrame:
    """Personnel files (one per site, ``PERSONNEL_<SITE>.txt``); ``path`` may be a glob over all sites.

    Adds ``site`` (lower case) from the file name, so one scan serves every site.
    """
    df = read_delimited(spark, path, schema)
    df = df.withColumn("site", F.lower(F.regexp_extract(F.input_file_name(), PERSONNEL_SITE, 1)))
    return clean_strings(df)


def read_impacts(spark: SparkSession, path: str) -> DataFrame:
    """Impact factors, comma-separated: Type, Modèle, Impact (kg CO2e)."""
    return clean_strings(read_delimited(spark, path, schemas.IMPACTS, sep=","))


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return clean_strings(read_delimited(spark, path, schema, sep="\t"))
