"""Parquet and catalog sources of the CDC layout.

``read_current`` filters on the partition column only, so Spark prunes every
history partition at planning time (``PartitionFilters`` in the plan) and
reads just the open one.
"""

from __future__ import annotations

import datetime as _dt

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.keys import column


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and ``path`` as it names it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists (one metadata call on the driver)."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of ``folder``; none if it doesn't exist."""
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole (a few lines, such as a record)."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write or replace a small file."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False if it exists. Of several callers one gets
    True: HDFS creates exclusively, and for local files the operating system
    does (the Hadoop client would look first and create then)."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    jvm = spark.sparkContext._jvm
    try:
        if fs.getUri().getScheme() == "file":
            nio = jvm.java.nio.file
            options = spark.sparkContext._gateway.new_array(nio.OpenOption, 2)
            options[0], options[1] = nio.StandardOpenOption.CREATE_NEW, nio.StandardOpenOption.WRITE
            nio.Files.write(jvm.java.io.File(p.toUri().getPath()).toPath(), bytearray(text.encode()), options)
            return True
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def modified_at(spark: SparkSession, path: str) -> int:
    """When ``path`` was last written, in ms of the storage's clock."""
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def delete_file(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, False)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A full extract; an incoming ``audit_inserted_ts`` column is dropped."""
    df = spark.read.parquet(path)
    drop = [c for c in df.columns if c.lower() == "audit_inserted_ts"]
    return df.drop(*drop) if drop else df


def read_target(spark: SparkSession, path: str) -> DataFrame | None:
    """The effective-dated table, or None when it does not exist yet.

    Only a missing folder or a folder without data files counts as "no
    table"; any other failure propagates (a broken read must never turn
    into an initial load that overwrites history)."""
    if not path_exists(spark, path):
        return None
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e) or "PATH_NOT_FOUND" in str(e):
            return None
        raise
    end = [c for c in df.columns if c.lower() == C.PARTITION_COLUMN]
    if not end:
        raise ValueError(f"{path} has no {C.PARTITION_COLUMN} partition column")
    if dict(df.dtypes)[end[0]] != "date":
        df = df.withColumn(end[0], column(end[0]).cast("date"))
    return df


def partition_filter(end_dt: _dt.date | str):
    return F.col(C.PARTITION_COLUMN) == F.lit(str(end_dt)).cast("date")


def partition_dir(path: str, end_dt: _dt.date | str) -> str:
    return f"{path.rstrip('/')}/{C.PARTITION_COLUMN}={end_dt}"


def read_partition(spark: SparkSession, path: str, end_dt: _dt.date | str) -> DataFrame | None:
    """One ``end_dt`` partition of the table, listing only that folder (the
    rest of the history is never listed); None when it does not exist.
    ``basePath`` keeps ``end_dt`` as a column."""
    part = partition_dir(path, end_dt)
    if not path_exists(spark, part):
        return None
    try:
        df = spark.read.option("basePath", path).parquet(part)
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e) or "PATH_NOT_FOUND" in str(e):
            return None
        raise
    end = [c for c in df.columns if c.lower() == C.PARTITION_COLUMN][0]
    if dict(df.dtypes)[end] != "date":
        df = df.withColumn(end, column(end).cast("date"))
    return df


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of the open partition ``end_dt = 9999-12-31`` (only that folder
    is listed and read)."""
    return read_partition(spark, path, C.OPEN_END.isoformat())


def read_table(spark: SparkSession, name: str, condition=None) -> DataFrame:
    """A catalog table or view by name, optionally filtered."""
    df = spark.table(name)
    return df.where(condition) if condition is not None else df
