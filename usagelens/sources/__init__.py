from usagelens.sources.files import load_csv_typed, load_csv_untyped
from usagelens.sources.jdbc import JdbcSource
from usagelens.sources.tables import (
    read_source,
    scan_cdr,
    scan_predictions,
    scan_processed,
    scan_seed,
    scan_snapshots,
    scan_string_range,
    seed_rows,
    union_all,
)

__all__ = [
    "JdbcSource",
    "load_csv_typed",
    "load_csv_untyped",
    "read_source",
    "scan_cdr",
    "scan_predictions",
    "scan_processed",
    "scan_seed",
    "scan_snapshots",
    "scan_string_range",
    "seed_rows",
    "union_all",
]
