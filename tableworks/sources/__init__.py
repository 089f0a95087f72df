"""Catalog tables as sources and sinks."""

from tableworks.sources.locks import TableLockedError, load_lock
from tableworks.sources.tables import (
    STAGE_SUFFIX,
    TableStateError,
    append_table,
    create_table,
    drop_partitions,
    overwrite_partitions,
    partition_columns,
    qualified_name,
    read_table,
    recover_interrupted_swap,
    replace_table,
    table_exists,
    write_bucketed,
)

__all__ = [
    "STAGE_SUFFIX",
    "TableLockedError",
    "TableStateError",
    "append_table",
    "create_table",
    "drop_partitions",
    "load_lock",
    "overwrite_partitions",
    "partition_columns",
    "qualified_name",
    "read_table",
    "recover_interrupted_swap",
    "replace_table",
    "table_exists",
    "write_bucketed",
]
