"""Load patterns over partitioned Parquet tables.

Every load first writes its input to a staging folder beside the target and
counts it there. Only a checked input reaches the target, so a
refused or failed extract leaves the old rows in place, the input plan runs once,
and a plan that reads the target can also replace it. All loads but the append
are idempotent: a rerun gives the same table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.dates import Window
from shelfline.sinks.audit import LoadResult
from shelfline.sinks.guards import (
    GuardError, apply_transform, require_at_most, require_columns, require_rows,
)

Transform = Callable[[DataFrame], DataFrame] | None


#: How tables and staged rows are written: many measures of a row are alike, which snappy leaves large.
STORED = {"compression": "zstd"}
#: How loads write them: most columns have nearly as many values as rows; the dictionary that Parquet tries for each first
#: costs as much as all else of the write, and zstd finds repeated text without it.
PLAIN = STORED | {"parquet.enable.dictionary": "false"}


def _stage(df: DataFrame, target: str, *, transform: Transform, schema: T.StructType | None,
           max_rows: int | None, outside: Column | None = None) -> tuple[DataFrame, int, str]:
    """Write the input beside the target, check it, and hand back the written rows.

    Every run has a staging folder of its own, so that two runs on one target do
    not meet; it goes after the load, refused, failed or not.
    """
    df = apply_transform(df, transform)
    if schema is not None:
        require_columns(df, schema)
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    staging = f"{target.rstrip('/')}__staging/{uuid.uuid4().hex}"
    try:
        rows, stray_rows = write_counted(df, staging, outside)
        require_rows(rows)
        require_at_most(rows, max_rows)
        if stray_rows:
            raise GuardError(f"{stray_rows} rows lie outside the slice")
    except Exception:
        remove(df.sparkSession, staging)
        raise
    return df.sparkSession.read.schema(df.schema).parquet(staging), rows, staging


def write_counted(df: DataFrame, path: str, outside: Column | None = None, *by: str) -> tuple[int, int]:
    """Write rows, and how many they were in all and ``outside``, counted by the tasks that write them."""
    seen = Observation()
    strays = F.lit(False) if outside is None else outside
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(strays).alias("strays")).write.mode("overwrite").options(**PLAIN)
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return seen.get["rows"], seen.get["strays"]


#: Kinds that a task may write side by side, and the size of a row group then, as each open file holds one.
OPEN_KINDS, SMALL_GROUPS = 32, {"parquet.block.size": str(8 << 20)}
_OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """Tasks keep a file open for each kind and so need not sort all rows by kind before they write them."""
    before = spark.conf.get(_OPEN_WRITERS)
    spark.conf.set(_OPEN_WRITERS, str(OPEN_KINDS))
    try:
        yield
    finally:
        spark.conf.set(_OPEN_WRITERS, before)


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder, by the file system it lies in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of a file where a load of sorted rows is cut into key ranges.
FILE_BYTES = 256 << 20


def stored_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of the files below a folder, from the file system's own listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def lay_out(df: DataFrame, day: str | None, sort_keys: Sequence[str], size: int = 0) -> DataFrame:
    """Rows grouped by day and sorted inside each file.

    ``rebalance`` lets AQE cut a day with many rows into several files and merge
    small ones, where a plain ``repartition(day)`` would put a hot day in one task.

    Sorted rows of a written table of more than ``FILE_BYTES`` (``size``) are dealt by
    ranges of day and keys instead, so that the files of a split day hold key ranges that
    meet at most at their ends, and a reader of one key opens few of them. The place of a
    row in the written table is the last range column: a key of many rows spans several files,
    and a repeated task deals its rows as before.
    """
    by = [day, *sort_keys] if day is not None else [*sort_keys]
    if sort_keys and size > FILE_BYTES:
        at = "_".join(["place", *df.columns])  # a free name
        ranged = df.withColumn(at, F.monotonically_increasing_id()).repartitionByRange(-(-size // FILE_BYTES), *by, at)
        return ranged.drop(at).sortWithinPartitions(*by)
    if day is not None:
        df = df.hint("rebalance", F.col(day))
    return df.sortWithinPartitions(*by) if by else df


def _write(df: DataFrame, target: str, mode: str, day: str | None, sort_keys: Sequence[str],
           dynamic: bool = False, staging: str | None = None) -> None:
    size = stored_bytes(df.sparkSession, staging) if staging and sort_keys else 0
    writer = lay_out(df, day, sort_keys, size).write.mode(mode).options(**PLAIN)
    if day is not None:
        writer = writer.partitionBy(day)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(target)


def full_refresh(df: DataFrame, target: str, *, day: str | None = None, sort_keys: Sequence[str] = (),
                 transform: Transform = None, schema: T.StructType | None = None,
                 max_rows: int | None = None) -> LoadResult:
    """Replace the whole table.

    Spark deletes the old files before it writes the new ones: a failure of that
    last write leaves the staged rows, from which the load can be repeated.
    """
    staged, rows, staging = _stage(df, target, transform=transform, schema=schema, max_rows=max_rows)
    _write(staged, target, "overwrite", day, sort_keys, staging=staging)
    remove(df.sparkSession, staging)
    return LoadResult(target, rows, True)


def append(df: DataFrame, target: str, *, day: str | None = None, sort_keys: Sequence[str] = (),
           transform: Transform = None, schema: T.StructType | None = None,
           max_rows: int | None = None) -> LoadResult:
    """Add rows; a rerun adds them again."""
    staged, rows, staging = _stage(df, target, transform=transform, schema=schema, max_rows=max_rows)
    _write(staged, target, "append", day, sort_keys, staging=staging)
    remove(df.sparkSession, staging)
    return LoadResult(target, rows, False)


def reload_range(df: DataFrame, target: str, day: str, window: Window, *, sort_keys: Sequence[str] = (),
                 transform: Transform = None, schema: T.StructType | None = None,
                 max_rows: int | None = None) -> LoadResult:
    """Replace the days of ``window`` and leave every other day alone.

    Days with new rows are replaced by dynamic partition overwrite. Days of the
    window without new rows are overwritten with no rows, so their old rows go
    too; there are at most as many of those as the window has days.
    """
    outside = ~F.col(day).between(F.lit(window.first), F.lit(window.last)) | F.col(day).isNull()
    staged, rows, staging = _stage(df, target, transform=transform, schema=schema, max_rows=max_rows, outside=outside)
    filled = {r[0] for r in staged.select(day).distinct().collect()}
    _write(staged, target, "overwrite", day, sort_keys, dynamic=True, staging=staging)
    nothing = staged.drop(day).limit(0)
    for stale in sorted(_stored_days(staged.sparkSession, target, day, window) - filled):
        nothing.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{day}={stale.isoformat()}")
    remove(df.sparkSession, staging)
    return LoadResult(target, rows, False, window.first, window.last)


def _stored_days(spark: SparkSession, target: str, day: str, window: Window) -> set:
    """Days of the window the target holds rows for; reads partition values only."""
    stored = spark.read.parquet(target).select(F.col(day).cast("date").alias(day))
    wanted = stored.where(F.col(day).between(F.lit(window.first), F.lit(window.last)))
    return {r[0] for r in wanted.distinct().collect()}


def replace_slices(df: DataFrame, target: str, by: Sequence[str], *, transform: Transform = None,
                   max_rows: int | None = None) -> LoadResult:
    """Replace the slices (partitions of ``by``) that the input has rows for; a repeated pull changes nothing."""
    staged, rows, staging = _stage(df, target, transform=transform, schema=None, max_rows=max_rows)
    (staged.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").options(**STORED)
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(target))
    remove(df.sparkSession, staging)
    return LoadResult(target, rows, False)


def load_accepted(judged: DataFrame, target: str, rejects: str, run: str, *, reason: str = "reason", aside: Sequence[str] = ("line",),
                  max_rejects: int = 0, day: str | None = None, sort_keys: Sequence[str] = ()) -> LoadResult:
    """Load the rows without a ``reason`` and keep the others in a reject table, under the name of the run.

    Both kinds are staged in one write that counts them. More rejects than
    ``max_rejects`` refuse the load, and neither table changes. The target gets the
    rows without ``reason`` and the ``aside`` columns; the reject table gets all columns,
    and a repeated run replaces its own rejects.
    """
    spark, staging = judged.sparkSession, f"{target.rstrip('/')}__staging/{uuid.uuid4().hex}"
    parts = judged.withColumn("_accepted", F.col(reason).isNull())
    try:
        rows, bad = write_counted(parts, staging, ~F.col("_accepted"), "_accepted")
        if bad > max_rejects:
            raise GuardError(f"{bad} rows were rejected, more than the cap of {max_rejects}")
        require_rows(rows - bad)
        staged = spark.read.schema(parts.schema).parquet(staging)
        good = staged.where("_accepted").select(*[c for c in judged.columns if c not in (reason, *aside)])
        _write(good, target, "overwrite", day, sort_keys, staging=staging)
        if bad:
            (staged.where("not _accepted").drop("_accepted").withColumn("run", F.lit(run)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(rejects))
    finally:
        remove(spark, staging)
    return LoadResult(target, rows - bad, True)


def slice_copy(source: DataFrame, target: str, day: str, window: Window, *,
               sort_keys: Sequence[str] = ()) -> LoadResult:
    """Copy a day slice of one table to another, replacing it there."""
    rows = source.where(F.col(day).between(F.lit(window.first), F.lit(window.last)))
    spark = source.sparkSession
    try:
        spark.read.parquet(target)
    except AnalysisException:  # no table yet
        result = full_refresh(rows, target, day=day, sort_keys=sort_keys)
        return LoadResult(target, result.row_count, False, window.first, window.last)
    return reload_range(rows, target, day, window, sort_keys=sort_keys)


def many_targets(parts: DataFrame, kind: str, staging: str, *,
                 builders: Mapping[str, Callable[[DataFrame], DataFrame]],
                 reads: Mapping[str, str], paths: Mapping[str, str],
                 days: Mapping[str, str], max_rows: int | None = None) -> dict[str, LoadResult]:
    """One input, several tables, one pass over the input.

    ``parts`` is written once, partitioned by ``kind``. Each target is then built
    from the one partition ``reads`` names for it. Nothing is cached, so losing
    an executor costs only its running tasks. Emptiness and row caps are checked
    for all targets before the first is written. Every target replaces the days it
    gets rows for, so a retry after a failure between two targets repeats nothing.
    """
    spark = parts.sparkSession
    staging = f"{staging.rstrip('/')}/{uuid.uuid4().hex}"
    layout = T.StructType([f for f in parts.schema.fields if f.name != kind] + [T.StructField(kind, T.StringType())])
    with open_writers(spark):
        parts.write.mode("overwrite").options(**PLAIN, **SMALL_GROUPS).partitionBy(kind).parquet(staging)
    landed = spark.read.schema(layout).parquet(staging)
    built = {n: build(landed.where(F.col(kind) == reads[n]).drop(kind)) for n, build in builders.items()}
    one = reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("name")) for n, df in built.items()])
    try:
        found = dict(one.groupBy("name").count().collect())  # one row for each target
        counts = {n: found.get(n, 0) for n in built}
        require_rows(sum(counts.values()))
        for count in counts.values():
            require_at_most(count, max_rows)
        for name, df in built.items():
            _write(df, paths[name], "overwrite", days[name], (), dynamic=True)
    finally:
        remove(spark, staging)
    return {n: LoadResult(paths[n], counts[n], False) for n in built}


def shard(df: DataFrame, n: int) -> DataFrame:
    """Rows dealt evenly over ``n`` partitions, whatever their keys."""
    return df.repartition(n)
