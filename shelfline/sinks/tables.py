"""Loads of catalog tables that readers never see half done.

New rows are written to a folder of their own, checked there, and then become the
table, or a day of it, by one change of a location in the catalog
(``ALTER TABLE ... SET LOCATION``). Until that change all readers see the old rows; a
load that fails or is stopped before it leaves the table as it was. Tables are plain
external Parquet tables. The folders that a load replaced stay for readers that have
begun on them; :func:`drop_old` removes them later.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.dates import Window
from shelfline.sinks.audit import LoadResult
from shelfline.sinks.guards import GuardError, apply_transform, require_at_most, require_columns, require_rows
from shelfline.sinks.loads import Transform, lay_out, remove, write_counted

_PARTITIONS_IN_CATALOG = "spark.sql.hive.manageFilesourcePartitions"


def _new_version(df: DataFrame, base: str, day: str | None, sort_keys: Sequence[str], *, transform: Transform,
                 schema: T.StructType | None, max_rows: int | None, outside=None) -> tuple[str, int, T.StructType]:
    """Write and check rows as a folder below ``base``; nothing else is touched."""
    df = apply_transform(df, transform)
    if schema is not None:
        require_columns(df, schema)
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    if day is not None:  # the catalog wants partition columns last
        df = df.select(*[c for c in df.columns if c != day], day)
    folder = f"{base.rstrip('/')}/v-{uuid.uuid4().hex}"
    try:
        rows, strays = write_counted(lay_out(df, day, sort_keys), folder, outside, *([day] if day else []))
        require_rows(rows)
        require_at_most(rows, max_rows)
        if strays:
            raise GuardError(f"{strays} rows lie outside the slice")
    except Exception:
        remove(df.sparkSession, folder)
        raise
    return folder, rows, df.schema


def _create(spark: SparkSession, table: str, schema: T.StructType, folder: str, day: str | None, *, days_in_catalog: bool) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f" partitioned by (`{day}`)" if day else ""
    before = spark.conf.get(_PARTITIONS_IN_CATALOG)
    spark.conf.set(_PARTITIONS_IN_CATALOG, str(days_in_catalog).lower())
    try:
        spark.sql(f"create table {table} ({columns}) using parquet{by} location '{folder}'")
    finally:
        spark.conf.set(_PARTITIONS_IN_CATALOG, before)


def _same_columns(spark: SparkSession, table: str, schema: T.StructType) -> None:
    have, want = ({f.name: f.dataType.simpleString() for f in s} for s in (schema, spark.table(table).schema))
    if have != want:
        raise GuardError(f"the table's columns differ in {sorted(set(have.items()) ^ set(want.items()))}")


def refresh_table(df: DataFrame, table: str, base: str, *, day: str | None = None, sort_keys: Sequence[str] = (),
                  transform: Transform = None, schema: T.StructType | None = None, max_rows: int | None = None) -> LoadResult:
    """Replace a whole table at once.

    Its days are found below its location, so that one change replaces all of them.
    """
    spark = df.sparkSession
    folder, rows, kind = _new_version(df, base, day, sort_keys, transform=transform, schema=schema, max_rows=max_rows)
    if spark.catalog.tableExists(table):
        try:
            _same_columns(spark, table, kind)
        except GuardError:
            remove(spark, folder)
            raise
        spark.sql(f"alter table {table} set location '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        _create(spark, table, kind, folder, day, days_in_catalog=False)
    return LoadResult(table, rows, True)


def reload_days(df: DataFrame, table: str, base: str, day: str, window: Window, *, sort_keys: Sequence[str] = (),
                transform: Transform = None, schema: T.StructType | None = None, max_rows: int | None = None) -> LoadResult:
    """Replace the days of ``window`` in a table whose catalog entry names every day's folder.

    Each day changes at once, from all of its old rows to all of its new ones, and a
    day of the window without new rows leaves the table. A load stopped between two
    days leaves both whole; repeated, it changes the rest. The statements are as many
    as the window has days.
    """
    spark = df.sparkSession
    outside = ~F.col(day).between(F.lit(window.first), F.lit(window.last)) | F.col(day).isNull()
    folder, rows, kind = _new_version(df, base, day, sort_keys, transform=transform, schema=schema, max_rows=max_rows, outside=outside)
    if spark.catalog.tableExists(table):
        try:
            _same_columns(spark, table, kind)
        except GuardError:
            remove(spark, folder)
            raise
    else:
        _create(spark, table, kind, f"{base.rstrip('/')}/first", day, days_in_catalog=True)
    filled = {r[0].isoformat() for r in spark.read.schema(kind).parquet(folder).select(day).distinct().collect()}
    stored = {r[0].split("=", 1)[1] for r in spark.sql(f"show partitions {table}").collect()}
    for value in sorted(filled):
        spec, at = f"partition (`{day}` = date '{value}')", f"location '{folder}/{day}={value}'"
        spark.sql(f"alter table {table} {spec} set {at}" if value in stored else f"alter table {table} add {spec} {at}")
    for value in sorted(stored - filled):
        if window.first.isoformat() <= value <= window.last.isoformat():
            spark.sql(f"alter table {table} drop partition (`{day}` = date '{value}')")
    spark.catalog.refreshTable(table)
    return LoadResult(table, rows, False, window.first, window.last)


def drop_old(spark: SparkSession, table: str, base: str) -> int:
    """Remove the version folders below ``base`` that the table no longer reads; run it when no reader is left on them."""
    used = {name.split("/v-")[1].split("/")[0] for name in spark.table(table).inputFiles() if "/v-" in name}
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    folders = [f.getPath().toString() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    old = [f for f in folders if "/v-" in f and f.rsplit("/v-", 1)[1] not in used]
    for folder in old:
        remove(spark, folder)
    return len(old)
