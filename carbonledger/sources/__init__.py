"""Readers and writers."""

from .raw import read_delimited, read_drops, read_impacts, read_personnel, read_tsv
from .sinks import append_new_rows, path_exists, save_csv, save_parquet

__all__ = ["read_delimited", "read_drops", "read_impacts", "read_personnel", "read_tsv", "append_new_rows",
           "path_exists", "save_csv", "save_parquet"]
