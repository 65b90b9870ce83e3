"""Append only new rows to a large Parquet table, at a cost near the batch's size.

Beside the table ``path`` lies ``path.keys``:

* ``digests/<spec>/part=p`` -- the SHA-256 of every key in the table, in parts by hash;
* ``filters/<spec>/part=p`` -- a blocked Bloom filter of the part's keys (a key sets
  ``PROBES`` bits of one 256-bit block), built by aggregation with ``bit_or``;
* ``files`` -- the names of the table's data files whose keys are in the index.

An append digests the batch's keys, reads the filters of the parts these keys
fall into, and then the digests of only those parts that the filters cannot rule
out; the table itself is not read.  A row is new when none of its key specs is
known and it is the first of its keys in the batch.

Failures: the data is written first, then digests, filters and at last the file
names.  An append begins by comparing the table's files with the registered ones
and indexes those it does not know, so rows whose indexing was interrupted (or
that something else appended) are known before the batch is compared; replaying
the batch adds nothing.  Repeated digests and filter rows are harmless.  One
writer at a time is assumed, as for any Parquet append.

``compact`` rewrites the small files of many appends as one per part and sizes
the filters anew.

Defined cases: null key columns compare as equal; without the table the first
append creates it; an empty batch adds nothing; columns are aligned by name, those
the table lacks are left out, those the batch lacks are null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_folder, reliable_checkpoint, table_scope
from .sinks import path_exists

PARTS, BLOCKS, PROBES = 64, 4096, 6
_WORDS = [f"w{i}" for i in range(4)]


def digest_of(columns: Sequence[str]) -> Column:
    """SHA-256 (binary) of a key: every column as length and text, nulls apart from any text."""
    text = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"),
                                F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.sha2(F.concat_ws("|", *text), 256))


def _slot(digest: Column, at: int, mod: int) -> Column:
    """Some bits of a digest as a number below ``mod`` (a power of two)."""
    return F.conv(F.hex(F.substring(digest, at, 4)), 16, 10).cast("long").bitwiseAND(mod - 1)


def _bits(digest: Column) -> list[Column]:
    """The four 64-bit words that a key sets in its block."""
    places = [_slot(digest, 9 + 4 * i, 256) for i in range(PROBES)]
    words = []
    for w in range(len(_WORDS)):
        one = [F.when(F.shiftright(p, 6) == w, F.call_function("shiftleft", F.lit(1).cast("long"),
                                                               p.bitwiseAND(63).cast("int"))).otherwise(F.lit(0).cast("long"))
               for p in places]
        words.append(reduce(lambda a, b: a.bitwiseOR(b), one))
    return words


class KeyIndex:
    """Appends to the Parquet table ``path`` through indexes of its keys.

    ``specs``: name -> key columns, or a Column of binary digests made from the
    table's columns.  ``last`` tells what the last append read and added.
    """

    def __init__(self, spark: SparkSession, path: str, specs: Mapping[str, Sequence[str] | Column],
                 parts: int = PARTS, blocks: int = BLOCKS):
        if parts & (parts - 1) or blocks & (blocks - 1):
            raise ValueError("parts and blocks must be powers of two")
        self.spark, self.path, self.keys = spark, path.rstrip("/"), f"{path.rstrip('/')}.keys"
        self.specs = {k: v if isinstance(v, Column) else digest_of(v) for k, v in specs.items()}
        self.parts, self.blocks, self.last = parts, blocks, {}
        kept = self._read(f"{self.keys}/meta")
        if kept is not None:
            self.parts, self.blocks = kept.first()

    # -- files -------------------------------------------------------------------
    def _folder(self, kind: str, spec: str) -> str:
        return f"{self.keys}/{kind}/{spec}"

    def _read(self, folder: str) -> DataFrame | None:
        return self.spark.read.parquet(folder) if path_exists(self.spark, folder) else None

    def _read_parts(self, kind: str, spec: str, keyed: DataFrame) -> DataFrame | None:
        """The parts of a table that the keys fall into, named to the reader one by one: no other is listed."""
        folder = self._folder(kind, spec)
        parts = [r[0] for r in keyed.select("part").distinct().collect()]  # at most ``parts`` numbers
        there = [p for k in sorted(parts) if path_exists(self.spark, p := f"{folder}/part={k}")]
        return self.spark.read.option("basePath", folder).parquet(*there) if there else None

    def _table_files(self) -> list[str]:
        """Names of the table's data files, as Spark's own listing gives them to the driver."""
        if not path_exists(self.spark, self.path):
            return []
        return self.spark.read.parquet(self.path).inputFiles()

    def _unknown_files(self) -> list[str]:
        files = self._table_files()
        known = self._read(f"{self.keys}/files")
        names = {r[0] for r in known.collect()} if known is not None else set()
        return [f for f in files if f.rpartition("/")[2] not in names]

    def _register(self, files: Sequence[str]) -> None:
        rows = [(f.rpartition("/")[2],) for f in files]
        if rows:
            self.spark.createDataFrame(rows, "name string").coalesce(1).write.mode("append").parquet(
                f"{self.keys}/files")

    # -- index -------------------------------------------------------------------
    def _keyed(self, rows: DataFrame, spec: str | None) -> DataFrame:
        d = F.col("digest")
        own = rows.select(self.specs[spec].alias("digest")) if spec is not None else rows.select("digest")
        return (own.distinct()
                .select("digest", _slot(d, 1, self.parts).cast("int").alias("part"),
                        _slot(d, 5, self.blocks).cast("int").alias("block")))

    def _filters(self, keyed: DataFrame) -> DataFrame:
        words = keyed.select("part", "block", *[b.alias(w) for w, b in zip(_WORDS, _bits(F.col("digest")))])
        return words.groupBy("part", "block").agg(*[F.bit_or(w).alias(w) for w in _WORDS])

    def _add(self, rows: DataFrame) -> None:
        """Index the keys of rows that are in the table."""
        for spec in self.specs:
            self._write(spec, self._keyed(rows, spec))

    def _write(self, spec: str, keyed: DataFrame) -> None:
        for kind, table in (("digests", keyed.drop("block")), ("filters", self._filters(keyed))):
            # One task per part that the rows hit, so that a small batch adds few files.
            table.repartition("part").write.mode("append").partitionBy("part").parquet(self._folder(kind, spec))

    def _keep_sizes(self) -> None:
        self.spark.createDataFrame([(self.parts, self.blocks)], "parts int, blocks int").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.keys}/meta")

    def catch_up(self) -> int:
        """Index the table's files that are not registered yet; returns their number."""
        if not path_exists(self.spark, f"{self.keys}/meta"):
            self._keep_sizes()
        files = self._unknown_files()
        if files:
            with_parts = self.spark.read.option("basePath", self.path).parquet(*files)
            with table_scope(self.spark):
                self._add(with_parts)
            self._register(files)
        return len(files)

    # -- append ------------------------------------------------------------------
    def _known(self, keyed: DataFrame, spec: str, read: dict) -> DataFrame | None:
        """Digests of ``keyed`` that the table holds; reads only the parts that they can be in."""
        filters = self._read_parts("filters", spec, keyed)
        if filters is None:
            return None
        read["filters"] += filters.inputFiles()
        probes = keyed.select("digest", "part", "block", *[b.alias(f"p{w}") for w, b in
                                                           zip(_WORDS, _bits(F.col("digest")))])
        # Appends add rows for a block: a key may be there if one row, or several together, have all its bits.
        seen = filters.groupBy("part", "block").agg(*[F.bit_or(w).alias(w) for w in _WORDS])
        all_set = reduce(lambda a, b: a & b, [F.col(f"p{w}").bitwiseAND(F.col(w)) == F.col(f"p{w}") for w in _WORDS])
        maybe = reliable_checkpoint(probes.join(seen, ["part", "block"]).filter(all_set).select("digest", "part"))
        digests = self._read_parts("digests", spec, maybe)
        if digests is None:
            return None
        read["digests"] += digests.inputFiles()
        return maybe.join(digests, ["part", "digest"], "left_semi").select("digest").distinct()

    def append(self, df: DataFrame) -> int:
        """Append the rows of ``df`` whose keys the table does not hold; returns their number."""
        read: dict = {"filters": [], "digests": []}
        caught_up = self.catch_up()
        exists = path_exists(self.spark, self.path)
        if exists:
            target = self.spark.read.parquet(self.path).schema
            df = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                             for f in target.fields])
        with table_scope(self.spark):
            rows = reliable_checkpoint(df.withColumn("__row", F.monotonically_increasing_id()))
            fresh = rows
            for spec, digest in self.specs.items():
                keyed = reliable_checkpoint(self._keyed(rows, spec))
                known = self._known(keyed, spec, read)
                named = fresh.withColumn("__digest", digest)
                if known is not None:
                    named = named.join(known, F.col("__digest") == F.col("digest"), "left_anti")
                # Of rows with one key the first stays: an aggregate, so a hot key is a row per task.
                first = named.groupBy("__digest").agg(F.min("__row").alias("__row")).select("__row")
                fresh = reliable_checkpoint(named.drop("__digest").join(first, "__row", "left_semi"))
            n = fresh.count()
            if n:
                before = set(self._table_files())
                fresh.drop("__row").write.mode("append").parquet(self.path)
                self._add(fresh.drop("__row"))
                self._register([f for f in self._table_files() if f not in before])
        self.last = {"appended": n, "caught_up_files": caught_up, **read}
        return n

    def compact(self, blocks: int | None = None) -> None:
        """Rewrite digests and filters as one file a part, with ``blocks`` filter blocks a part.

        The registered file names go first and come back last: if this is
        interrupted, the next append indexes the table's files again.
        """
        self.catch_up()
        files = self._table_files()
        delete_folder(self.spark, f"{self.keys}/files")
        for spec in self.specs:
            with table_scope(self.spark):
                digests = reliable_checkpoint(
                    self.spark.read.parquet(self._folder("digests", spec)).select("digest").distinct())
                for kind in ("digests", "filters"):
                    delete_folder(self.spark, self._folder(kind, spec))
                self.blocks = blocks or self.blocks
                self._keep_sizes()
                self._write(spec, self._keyed(digests, None))
        self._register(files)

    def drop(self) -> None:
        """Delete the index (the table stays)."""
        delete_folder(self.spark, self.keys)
