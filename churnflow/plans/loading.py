"""Full reload of raw tables from CSV files."""

from __future__ import annotations

from collections.abc import Mapping

from churnflow.schemas import RAW_TABLES
from churnflow.sources import Lake, load_csv


def load_raw_tables(lake: Lake, files: Mapping[str, str], *, multiline: bool = False) -> None:
    """Reload the named raw tables, each replacing what was there.

    A file is read in full before its table is touched, so a bad row fails the load and leaves the old
    rows. ``multiline`` is for files with line breaks inside quotes.
    """
    unknown = set(files) - set(RAW_TABLES)
    if unknown:
        raise ValueError(f"unknown raw tables: {sorted(unknown)}")
    for name, path in files.items():
        table = RAW_TABLES[name]
        lake.replace(load_csv(lake.spark, path, table.schema, multiline=multiline), table)
