"""Readers and writers by root URI, and the role mapping of the test tables."""

from ledgerline.sources.files import (
    copy_datasets,
    list_files,
    read_csv,
    write_csv,
    write_parquet,
    write_split_by_label,
)

__all__ = [
    "copy_datasets",
    "list_files",
    "read_csv",
    "write_csv",
    "write_parquet",
    "write_split_by_label",
]
