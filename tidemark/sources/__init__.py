"""Sources and sinks: Parquet folders, catalog tables, JDBC databases."""

from .files import (partition_dir, partition_filter, path_exists, read_current,
                    read_partition, read_snapshot, read_table, read_target)
from .jdbc import jdbc_bounds, read_jdbc, write_jdbc

__all__ = [
    "partition_dir", "partition_filter", "path_exists", "read_partition", "read_current", "read_snapshot", "read_table",
    "read_target", "jdbc_bounds", "read_jdbc", "write_jdbc",
]
