"""Scans: whole tables, projections, slices, parameterised SQL, CSV files.

Filters and column lists are plain ``where``/``select`` so that Parquet and JDBC
scans receive them; slices filter the partition column and prune partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.dates import Window
from shelfline.operators.rows import distinct_rows, first_rows
from shelfline.sinks.guards import GuardError


def read_source(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    *,
    columns: Sequence[str] | None = None,
    rename: Mapping[str, str] | None = None,
    distinct: bool = False,
    **options: str,
) -> DataFrame:
    """Scan a table, keeping ``columns`` and renaming by ``rename`` (old to new).

    ``distinct`` removes copies; see :func:`distinct_rows`.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path if isinstance(path, str) else list(path))
    names = rename or {}
    if columns is not None or names:
        df = df.select(*[F.col(c).alias(names.get(c, c)) for c in (columns or df.columns)])
    return distinct_rows(df) if distinct else df


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
    **properties: str,
) -> DataFrame:
    """Scan an external SQL table; with bounds the scan runs as parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column and bounds and partitions:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", bounds[0]).option("upperBound", bounds[1])
                  .option("numPartitions", partitions))
    return reader.load()


def query_scan(spark: SparkSession, text: str, params: Mapping[str, object] | None = None,
               **tables: DataFrame) -> DataFrame:
    """Run SQL text with ``:named`` parameters over the given frames as ``{tables}``.

    Readers cannot write: a text that is anything but a query is refused. Spark
    runs a command while it plans it, so the text is tried as a subquery first,
    where its grammar allows queries only.
    """
    body = text.strip().rstrip(";")
    try:
        return spark.sql(f"select * from (\n{body}\n) as _query", args=dict(params or {}), **tables)
    except ParseException as error:
        raise GuardError("only a query may be read") from error


def slice_days(df: DataFrame, column: str, window: Window) -> DataFrame:
    """Rows of an inclusive day range."""
    return df.where(F.col(column).between(F.lit(window.first), F.lit(window.last)))


def slice_day(df: DataFrame, column: str, day: dt.date) -> DataFrame:
    return df.where(F.col(column) == F.lit(day))


def slice_month(df: DataFrame, column: str, month: str) -> DataFrame:
    """Rows of one month, given in the text form the column holds."""
    return df.where(F.col(column) == month)


def changed_since(df: DataFrame, column: str, moment: dt.datetime) -> DataFrame:
    """Rows later than ``moment``, which is read in the column's own type and zone."""
    kind = df.schema[column].dataType
    return df.where(F.col(column) > F.lit(moment.isoformat(sep=" ")).cast(kind))


# Employment states of people who have not left.
ACTIVE_STATES = ("1987", "1991", "1996")


def active_jobs(df: DataFrame, column: str = "emplStatus") -> DataFrame:
    return df.where(F.col(column).isin(*ACTIVE_STATES))


def sample(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows of a stated order; see :func:`first_rows`."""
    return first_rows(df, n, order_by)


def read_csv_files(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                   *, header: bool = False, **options: str) -> DataFrame:
    """Numbered CSV files as one scan: a glob or list of paths, no loop, no union.

    Empty cells are null. With ``header`` the first line of every file is dropped.
    A line that does not fit the schema fails the job; :func:`judged_csv_files` sets
    such lines apart instead.
    """
    settings = {"nullValue": "", "emptyValue": "", "mode": "FAILFAST", **options}
    reader = spark.read.schema(schema).option("header", header).option("enforceSchema", True)
    return reader.options(**settings).csv(paths if isinstance(paths, str) else list(paths))


#: Columns of judged rows: what is wrong with a row (null: nothing), and its line as it came.
REASON, LINE = "reason", "line"


def judged_csv_files(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                     *, header: bool = False, **options: str) -> DataFrame:
    """CSV files with broken lines set apart: the columns of ``schema``, ``reason`` and ``line``.

    A line with too few or too many values, or with a value that is not of its type,
    has the reason ``line`` and its text in ``line``; both are null for all others.
    """
    judged = T.StructType([*schema.fields, T.StructField(LINE, T.StringType())])
    rows = read_csv_files(spark, paths, judged, header=header, **{"mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE, **options})
    return rows.withColumn(REASON, F.when(F.col(LINE).isNotNull(), F.lit("line"))).select(*schema.names, REASON, LINE)
