"""Sinks: delimited files, Parquet in one or two places, tables replaced by a load."""

from __future__ import annotations

import re
import time
import uuid
import warnings
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.operators.schema import nan_to_null
from wardlake.sources.storage import FREE_SHUFFLES, settings

#: Files that a task writes at once where its rows are not sorted by the partition column; the
#: rows of further values are sorted.
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "32"}


def write_delimited(
    df: DataFrame, path: str, sep: str = ";", encoding: str = "UTF-8", partition_by: str | None = None
) -> None:
    """Text with a header; quotes are doubled, blanks around values kept."""
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.mode("overwrite").csv(
        path, header=True, sep=sep, encoding=encoding, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def write_parquet(
    df: DataFrame, path: str, partition_by: str | None = None, copy_to: str | None = None,
    dealt: bool = False, codec: str | None = None,
) -> None:
    """Replace the Parquet table at ``path``; optionally write the same rows elsewhere too.

    Partitioned writes are rebalanced on the partition column first: a third of the rows in
    one year is split over several tasks and files, and small years get one file, not one
    per task. ``dealt`` says that the rows already lie so, as those read from such a table do:
    then none are shuffled or sorted. The copy is made from what was written, so the frame is
    computed once; a copy that fails is a warning, a failing first write is an error.
    """
    spark = df.sparkSession

    def write(rows: DataFrame, to: str, kept: Mapping[str, str]) -> None:
        writer = rows.write.partitionBy(partition_by) if partition_by else rows.write
        with settings(spark, kept):
            writer.mode("overwrite").parquet(to, compression=codec)

    if partition_by and not dealt:
        write(df.hint("rebalance", F.col(partition_by)), path, FREE_SHUFFLES)
    else:
        write(df, path, FREE_SHUFFLES | OPEN_FILES)
    if copy_to:
        written = spark.read.schema(df.schema).parquet(path)
        try:
            write(written, copy_to, OPEN_FILES)
        except Exception as error:  # the second place is best effort by definition
            warnings.warn(f"no copy at {copy_to}: {error}", stacklevel=2)


def load_table(df: DataFrame, table: str, columns: Mapping[str, str], path: str | None = None) -> DataFrame:
    """Replace the contents of a table by the named columns, cast to the named types, at once.

    The rows are written aside, as a new version below ``path`` (by default a folder of the
    warehouse), and then the table is pointed to them. Whoever reads the table meanwhile goes on
    with the version they started with; the last one before this load is kept for them, older
    ones are deleted. A load that fails leaves the table as it was. Later loads write by column
    name, whatever the order of ``columns``; one that names other columns than the table has
    is an error. NaN is stored as null.
    """
    spark = df.sparkSession
    typed = nan_to_null(df).select(*[F.col(name).cast(kind).alias(name) for name, kind in columns.items()])
    exists = spark.catalog.tableExists(table)
    if exists:
        known = spark.table(table).columns
        if set(known) != set(typed.columns):
            raise ValueError(f"{table} has the columns {sorted(known)}, the load {sorted(typed.columns)}")
        typed = typed.select(*known)
    current = table_location(spark, table) if exists else None
    base = path or (current.rsplit("/", 1)[0] if current else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}.versions")
    version = f"{base.rstrip('/')}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    try:
        typed.write.parquet(version)
    except BaseException:
        _delete(spark, version)
        raise
    if exists:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=version, source="parquet", schema=typed.schema)
    for old in _versions(spark, base):
        if old not in (_name(version), _name(current or "")):
            _delete(spark, f"{base.rstrip('/')}/{old}")
    return spark.table(table)


def table_location(spark: SparkSession, table: str) -> str:
    """Where the rows of a table lie now."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0].data_type.rstrip("/")


def _name(address: str) -> str:
    return address.rstrip("/").rsplit("/", 1)[-1]


def _folder(spark: SparkSession, address: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path(address)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def _versions(spark: SparkSession, base: str) -> list[str]:
    files, path = _folder(spark, base)
    return sorted(n for n in (s.getPath().getName() for s in files.listStatus(path)) if re.fullmatch(r"v\d{20}-[0-9a-f]{8}", n))


def _delete(spark: SparkSession, address: str) -> None:
    files, path = _folder(spark, address)
    files.delete(path, True)
