"""tidemark: slowly-changing-dimension and snapshot-diff CDC on Spark.

Subpackages:
  functions  column expressions (match keys, null-safe compare, clean-up, casts)
  operators  DataFrame -> DataFrame operators (checks, dedupe, diff, SCD 0/1/2)
  sources    Parquet / catalog / JDBC readers and writers, derived snapshot pairs
  plans      jobs with I/O (CDC publish protocol, SCD loads), registered queries

The names below are the public API.
"""

from .functions import (cast_to_date, cast_to_string, normalize_column_name,
                        normalize_column_names, normalize_strings)
from .operators import (Stamps, classify, close_history, count_check, count_value, dedupe,
                        deleted, diff_flags, duplicate_check, duplicate_groups,
                        filtered_rows, full_table, initial_load, inverted_intervals,
                        new_versions, next_state, prepare_snapshot, rebuild_current,
                        row_count, scd0, scd1, scd2, split_rejected)
from .plans.cdc_job import republish, run_cdc
from .operators.digest_diff import digest_next_state
from .plans.cow_job import read_cow, run_scd1_cow
from .plans.manifest_backup import backup_version, damaged_files, restore_version
from .plans.publish import reconcile
from .plans.scd_job import run_scd, run_scd_jdbc, run_scd_parquet
from .plans.versioned_job import rollback, run_cdc_versioned

__version__ = "0.1.0"

__all__ = [
    "cast_to_date", "cast_to_string", "normalize_column_name", "normalize_column_names",
    "normalize_strings", "Stamps", "classify", "close_history", "count_check", "count_value",
    "dedupe", "deleted", "diff_flags", "duplicate_check", "duplicate_groups", "filtered_rows",
    "full_table", "initial_load", "inverted_intervals", "new_versions", "next_state",
    "prepare_snapshot", "rebuild_current", "row_count", "scd0", "scd1", "scd2",
    "split_rejected", "republish", "run_cdc", "run_scd", "run_scd_jdbc",
    "run_scd_parquet", "digest_next_state", "read_cow", "run_scd1_cow", "reconcile", "rollback",
    "run_cdc_versioned", "backup_version", "damaged_files", "restore_version",
]
