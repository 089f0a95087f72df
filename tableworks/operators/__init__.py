"""Joins and table-loading strategies as DataFrame functions."""

from tableworks.operators.change_feed import scd2_feed
from tableworks.operators.joins import (
    JOIN_STRATEGIES,
    broadcast_join,
    bucketed_join,
    coalesce_join,
    coalesce_many,
    conditional_join,
    equi_join,
    full_outer_join,
    inner_join,
    interval_join,
    join_data,
    left_anti_join,
    left_join,
    left_semi_join,
    multi_table_join,
    normalize_join_type,
    range_join,
    right_join,
)
from tableworks.operators.loads import (
    LOAD_STRATEGIES,
    SCD_COLUMNS,
    check_unique_keys,
    create_history_table,
    delete_insert,
    delete_insert_partitions,
    load_data,
    materialize,
    merge_upsert,
    merge_upsert_partitions,
    scd2_apply,
    scd2_apply_partitions,
    scd2_current,
    scd2_history,
    scd2_initial,
)
from tableworks.operators.overlaps import band_join, disjunctive_join, overlap_join
from tableworks.operators.hot_keys import hot_keys
from tableworks.operators.sizing import fits_broadcast, measured_size

__all__ = [
    "JOIN_STRATEGIES",
    "LOAD_STRATEGIES",
    "SCD_COLUMNS",
    "band_join",
    "broadcast_join",
    "bucketed_join",
    "check_unique_keys",
    "coalesce_join",
    "coalesce_many",
    "conditional_join",
    "create_history_table",
    "delete_insert",
    "delete_insert_partitions",
    "disjunctive_join",
    "equi_join",
    "fits_broadcast",
    "full_outer_join",
    "hot_keys",
    "inner_join",
    "interval_join",
    "join_data",
    "left_anti_join",
    "left_join",
    "left_semi_join",
    "load_data",
    "materialize",
    "measured_size",
    "merge_upsert",
    "merge_upsert_partitions",
    "multi_table_join",
    "normalize_join_type",
    "overlap_join",
    "range_join",
    "right_join",
    "scd2_apply",
    "scd2_apply_partitions",
    "scd2_current",
    "scd2_feed",
    "scd2_history",
    "scd2_initial",
]
