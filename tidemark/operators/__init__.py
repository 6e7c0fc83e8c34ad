"""DataFrame -> DataFrame operators: checks, dedupe, snapshot diff, SCD 0/1/2."""

from .checks import (count_check, count_value, duplicate_check, duplicate_groups,
                     filtered_rows, inverted_intervals, row_count)
from .dedupe import dedupe
from .scd import new_keys, scd0, scd1, scd2
from .snapshot_diff import (Stamps, classify, close_history, deleted, diff_flags,
                            full_table, initial_load, new_versions, next_state,
                            prepare_snapshot, rebuild_current, split_rejected)

__all__ = [
    "count_check", "count_value", "duplicate_check", "duplicate_groups", "filtered_rows",
    "inverted_intervals", "row_count", "dedupe", "new_keys", "scd0", "scd1", "scd2",
    "Stamps", "classify", "close_history", "deleted", "diff_flags", "full_table",
    "initial_load", "new_versions", "next_state", "prepare_snapshot", "rebuild_current",
    "split_rejected",
]
