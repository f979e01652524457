from seasonlab.sources.files import (
    append_table,
    ingest_new,
    overwrite_table,
    read_by_suffix,
    read_csv,
    read_csv_years,
    read_tables,
    touched_partitions,
    write_csv,
)
from seasonlab.sources.html import page_links, page_tables, table_counts
from seasonlab.sources.ledger import complete, missing_ranges, rows_in_ranges
from seasonlab.sources.versions import CheckFailed, Conflict, kept_versions, publish, read_current, read_version

__all__ = [
    "CheckFailed",
    "Conflict",
    "append_table",
    "complete",
    "ingest_new",
    "kept_versions",
    "missing_ranges",
    "overwrite_table",
    "page_links",
    "page_tables",
    "publish",
    "read_by_suffix",
    "read_csv",
    "read_csv_years",
    "read_current",
    "read_tables",
    "read_version",
    "rows_in_ranges",
    "table_counts",
    "touched_partitions",
    "write_csv",
]
