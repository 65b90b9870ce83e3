"""Incremental ingest of the daily drops with Structured Streaming.

The drops arrive as one ``;`` file per site, kind and day.  A file-source
stream over the same glob as the batch reader picks up only files it has not
seen (its checkpoint records them).  Each micro-batch is read by the headers of
its files, with the code of the batch reader, and appended through a key index
(``sources.key_index``): a re-delivered file never duplicates rows, and a batch
reads the index parts that its keys can hit, not the target.  Files with a
foreign header are kept out and appear in the report.  Run it with
``availableNow`` for scheduled catch-up or with a processing-time trigger.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_scope
from ..sources import schemas
from ..sources.headers import stream_lines
from ..sources.key_index import KeyIndex, digest_of
from ..sources.raw import drop_rows, drops_glob, parse_drops
from ..sources.sinks import append_new_rows


def drops_stream(spark: SparkSession, root: str, kind: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the drops with their file, for ``parse_drops`` in a micro-batch (a stream gives a file whole to one)."""
    return stream_lines(spark, drops_glob(root, kind), max_files_per_trigger)


def row_digest(kind: str, columns: list[str]):
    """Identity of a drop's row: its key; rows without one are told apart by all their columns."""
    key = schemas.KEYS[kind]
    return F.when(F.col(key).isNotNull(), digest_of([key])).otherwise(digest_of(columns))


def ingest_drops(spark: SparkSession, root: str, kind: str, target: str, checkpoint: str,
                 available_now: bool = True, processing_time: str | None = None, report: str | None = None,
                 aliases: Mapping[str, str] | None = None, max_files_per_trigger: int | None = None):
    """Start the ingest query; returns the ``StreamingQuery``.

    ``checkpoint`` must be a shared, durable folder (the query's offsets and
    the set of processed files live there), like ``target``.  ``report`` names a
    table that gets the per-file header report, one row per file.
    """
    index = None

    def _append(batch: DataFrame, _epoch: int) -> None:
        nonlocal index
        own = batch.sparkSession
        with table_scope(own):
            read = parse_drops(batch, kind, aliases)
            rows = drop_rows(read)
            if index is None:
                index = KeyIndex(own, target, {"row": row_digest(kind, rows.columns)})
            index.append(rows)
            if report:
                append_new_rows(read.report(), report, key_specs=[["file"]])

    w = (drops_stream(spark, root, kind, max_files_per_trigger).writeStream.foreachBatch(_append)
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
