"""Writers: Parquet (conditional), CSV export, append-if-new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fill import new_rows
from ..session import reliable_checkpoint, table_scope


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (works for HDFS / object stores)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def save_parquet(df: DataFrame, path: str, overwrite: bool = False, partition_by: Sequence[str] = ()) -> None:
    """Write Parquet; an existing target is kept unless ``overwrite`` (mode ignore / overwrite).

    Facts should be written ``partition_by=("site_id", "year_month")`` so that
    site and period filters prune directories.
    """
    if partition_by:
        # Without redistribution every task writes one file into every directory it
        # touches (tasks x directories small files).  REBALANCE groups rows by the
        # partition columns so each directory gets few, large files, and lets AQE
        # split a skewed one (a site-month holding a third of the rows) into several
        # tasks instead of one.
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite" if overwrite else "ignore")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_csv(df: DataFrame, path: str, delimiter: str = ";", overwrite: bool = True, single_file: bool = False,
             max_single_mb: int = 512) -> None:
    """CSV export with a header into directory ``path``.

    ``single_file`` gives one part file, for small exports: the rows are
    materialised first and their measured bytes checked against
    ``max_single_mb`` (ValueError above), so neither the work before it nor an
    unbounded result lands in one task.
    """
    if single_file:
        df = reliable_checkpoint(df)
        size = sum(path_bytes(df.sparkSession, f) for f in df.inputFiles())
        if size > max_single_mb << 20:
            raise ValueError(f"{size} bytes are too many for a single file (limit {max_single_mb} MB)")
        df = df.coalesce(1)
    (df.write.option("header", True).option("sep", delimiter)
     .mode("overwrite" if overwrite else "errorifexists").csv(path))


def path_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file through Hadoop's FileSystem."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).getLen()


def _load(spark: SparkSession, path: str, fmt: str, delimiter: str, like: DataFrame) -> DataFrame:
    """The table at ``path``; CSV columns are found by the header and take the types of ``like``."""
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    raw = spark.read.option("header", True).option("sep", delimiter).csv(path)  # all strings, header names
    types = dict(like.dtypes)
    return raw.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in raw.columns])


def append_new_rows(df: DataFrame, path: str, fmt: str = "parquet", key_specs: Sequence[Sequence[str]] | None = None,
                    create_if_missing: bool = True, delimiter: str = ";") -> None:
    """Append to the table at ``path`` only the rows of ``df`` it does not hold yet.

    Rows are aligned to the target by column name (for CSV by the header's
    names, in the header's order; target columns missing in ``df`` are null).  A
    row is skipped when any key spec already matches, null keys included, so a
    second append of the same rows adds nothing.  Without key specs all rows are
    appended.
    """
    spark = df.sparkSession
    writer_opts = {"header": "true", "sep": delimiter} if fmt == "csv" else {}
    if not path_exists(spark, path):
        if not create_if_missing:
            raise FileNotFoundError(path)
        df.write.format(fmt).options(**writer_opts).mode("errorifexists").save(path)
        return
    target = _load(spark, path, fmt, delimiter, df)
    fresh = new_rows(df, target, key_specs)
    types = dict(target.dtypes)
    fresh = fresh.select(*[F.col(c) if c in fresh.columns else F.lit(None).cast(types[c]).alias(c)
                           for c in target.columns])
    # Materialise the new rows in the shared checkpoint folder before appending,
    # so the append never reads files it is writing.
    with table_scope(spark):
        reliable_checkpoint(fresh).write.format(fmt).options(**writer_opts).mode("append").save(path)
