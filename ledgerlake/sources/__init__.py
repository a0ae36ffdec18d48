"""Sources and sinks."""

from ledgerlake.sources.sinks import (
    append_table,
    deleted_rows,
    full_refresh,
    full_snapshot,
    incremental_slice,
    inline_relation,
    merge_batches,
    merge_partitions,
    kept_or_staged,
    next_bookmark,
    replace_rows,
    schema_for,
    staged,
    staged_by_key,
    upsert_by_key,
    write_table,
)
from ledgerlake.sources.snapshots import snapshot_changes, write_snapshot
from ledgerlake.sources.tables import (
    column_catalog,
    jdbc_options,
    drop_path,
    path_exists,
    read_files,
    read_files_checked,
    read_query,
    read_source,
    table_exists,
)

__all__ = [
    "append_table",
    "column_catalog",
    "deleted_rows",
    "full_refresh",
    "full_snapshot",
    "incremental_slice",
    "inline_relation",
    "merge_batches",
    "merge_partitions",
    "jdbc_options",
    "kept_or_staged",
    "next_bookmark",
    "drop_path",
    "path_exists",
    "replace_rows",
    "read_files",
    "read_files_checked",
    "read_query",
    "read_source",
    "schema_for",
    "snapshot_changes",
    "staged",
    "staged_by_key",
    "table_exists",
    "upsert_by_key",
    "write_snapshot",
    "write_table",
]
