"""Jobs with I/O (CDC into partitioned Parquet, SCD into JDBC or Parquet),
the publish protocol, and the registered queries with their SQL twins."""
