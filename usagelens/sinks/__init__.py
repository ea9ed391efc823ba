from usagelens.sinks.tables import (
    append_table,
    clear_dates,
    load_once,
    read_if_present,
    replace_dates,
    to_json_records,
    write_daily_summary,
    write_report,
    write_snapshot,
)

__all__ = [
    "append_table",
    "clear_dates",
    "load_once",
    "read_if_present",
    "replace_dates",
    "to_json_records",
    "write_daily_summary",
    "write_report",
    "write_snapshot",
]
