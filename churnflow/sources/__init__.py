from churnflow.sources.csv import load_csv
from churnflow.sources.lake import Lake
from churnflow.sources.reads import literal_rows, param_query, read_snapshot, read_window, window_start
from churnflow.sources.scratch import stage, staged

__all__ = [
    "Lake",
    "literal_rows",
    "load_csv",
    "param_query",
    "read_snapshot",
    "read_window",
    "stage",
    "staged",
    "window_start",
]
