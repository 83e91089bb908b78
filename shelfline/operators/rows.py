"""Row-level operators: dense row numbers, slices, keep-first, appends."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.session import discard, materialise


#: Bytes of stored input whose rows one task groups.
PIECE_BYTES = 8 << 20


def pieces_of(df: DataFrame, piece: int = PIECE_BYTES) -> int:
    """How many pieces of so many bytes the stored input of ``df`` has, from the file listing; nothing is read."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return -(-sum(s for s in sizes if s < 1 << 60) // piece)  # beyond that, Spark means an unknown size


def spread(df: DataFrame, *by: str, piece: int = PIECE_BYTES) -> DataFrame:
    """Rows dealt by columns, over more partitions than the session states where the input is large.

    A group-by on these columns (and others) then needs no further shuffle, and what a task
    holds does not grow with the table. Meant for keys that no large part of the rows share.
    """
    pieces = pieces_of(df, piece)
    # Without a number AQE merges small partitions.
    return df.repartition(pieces, *by) if pieces > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(*by)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows without copies, where a task holds a bounded part of the table.

    A plain ``distinct`` keeps all rows that a task reads in its hash map, and a small file
    of a wide table is read by one task. Rows are dealt by a hash first; ``rebalance`` cuts
    a part with many copies, each of which is reduced before copies meet.
    """
    at = "_".join(["dealt", *df.columns])  # a free name
    return df.withColumn(at, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).hint("rebalance", at).drop(at).distinct()


def _repeatable(df: DataFrame) -> bool:
    """Whether a repeated task yields the same rows in the same order: no shuffle and no changing value before it."""
    execution = df._jdf.queryExecution()
    return execution.optimizedPlan().deterministic() and "Exchange hash" not in (text := execution.executedPlan().toString()) and not any(
        k in text for k in ("Exchange range", "Exchange Round", "Exchange Single", "Exchange Rebalance", "REBALANCE", "REPARTITION"))


def with_row_number(df: DataFrame, order_by: Sequence[str], name: str = "row_number") -> DataFrame:
    """Dense row numbers from 0 in a global order, without a one-task window.

    Rows are range-sorted and written once, with the task number and the position in
    the task as values. The row count per task then gives each task its offset;
    that table has one row per task. An arrival number breaks ties, so even a
    large group of copies spreads over several ranges. A task repeated after the loss
    of an executor has to send every row to the same range again: rows that come
    straight from a scan do, others are written before the sort.
    """
    arrival = df.withColumn("_arrival", F.monotonically_increasing_id())
    written = not _repeatable(df)
    if written:
        arrival = materialise(arrival, "arrival")
    ranged = arrival.orderBy(*order_by, "_arrival").withColumn("_place", F.monotonically_increasing_id())
    placed = materialise(
        ranged.select(*df.columns, F.shiftrightunsigned("_place", 33).alias("_task"),
                      F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos")),
        "numbered",
    )
    if written:
        discard(arrival)
    counts = placed.groupBy("_task").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.join(F.broadcast(offsets), "_task")  # one row per task: bounded
    return numbered.select(*df.columns, (F.col("_offset") + F.col("_pos")).alias(name))


#: Keys below the wanted place that a sample of the keys should hold, and rows that one task may sort outright.
PLACES, ONE_TASK = 100, 50_000


def first_rows(df: DataFrame, n: int, order_by: Sequence[str], *, seed: int = 7) -> DataFrame:
    """The first ``n`` rows of a stated order (nulls first), without sorting or writing the table.

    A thin sample of the keys gives a bound just above the ``n``-th; one pass of the
    keys counts what lies below and at it, and the bound moves up until that is
    enough. Only rows up to the bound, few more than ``n``, meet in the last sort. Its
    first column is a plain filter, which prunes the scan. Of rows that tie with the
    bound only as many as are missing go on, so a key of many rows does no harm; rows
    of equal keys are interchangeable.
    """
    if n <= 0:
        return df.limit(0)
    total = df.count()
    if total <= max(n, ONE_TASK):
        return df.orderBy(*order_by).limit(n)
    keys = df.select(*order_by)
    share = min(1.0, PLACES / n)
    sampled = keys.sample(share, seed).orderBy(*order_by)
    place = math.ceil(n * share + 5 * math.sqrt(n * share) + 10)
    while place < total * share:
        found = sampled.limit(place).orderBy(*[F.desc(c) for c in order_by]).first()
        if found is None:
            break
        below, upto = _at_bound(df, order_by, found)
        less, same = keys.where(upto).agg(F.count_if(below), F.count_if(~below)).first()
        if less + same >= n:
            rows = df.where(upto)
            if less >= n:
                return rows.where(below).orderBy(*order_by).limit(n)
            return rows.where(below).unionByName(rows.where(~below).limit(n - less))
        place *= 2
    return df.orderBy(*order_by).limit(n)


def _at_bound(df: DataFrame, order_by: Sequence[str], bound) -> tuple[Column, Column]:
    """Whether a row's key lies below the bound, and whether it lies below or at it."""
    kinds = df.select(*order_by).schema
    key, at = F.struct(*order_by), F.struct(*[F.lit(bound[f.name]).cast(f.dataType).alias(f.name) for f in kinds])
    first, value = F.col(order_by[0]), F.lit(bound[order_by[0]]).cast(kinds[order_by[0]].dataType)
    prune = first.isNull() if bound[order_by[0]] is None else first.isNull() | (first <= value)
    return key < at, prune & (key <= at)


def row_slices(df: DataFrame, order_by: Sequence[str], slices: Sequence[tuple[int, int | None]]) -> DataFrame:
    """Rows whose number falls in one of the ``[start, end)`` slices, appended."""
    numbered = with_row_number(df, order_by)
    parts = []
    for start, end in slices:
        rule = F.col("row_number") >= start
        parts.append(numbered.where(rule if end is None else rule & (F.col("row_number") < end)))
    return append_frames(*parts)


def keep_first(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by ``order_by``; rows with a null key form one group.

    An aggregate instead of a window: every task reduces its own rows first, so
    a key holding a large part of the table never meets in one task. All other
    columns follow as further tie-breaks.
    """
    rest = [c for c in df.columns if c != key and c not in order_by]
    names = [*order_by, *rest]
    # Null sorts first inside structs; a flag in front of each field moves it last.
    fields = [f for n in names for f in (F.col(n).isNull().alias(f"_null_{n}"), F.col(n))]
    best = df.groupBy(key).agg(F.min(F.struct(*fields)).alias("_first"))
    return best.select(*[F.col(c) if c == key else F.col(f"_first.{c}") for c in df.columns])


def append_frames(*frames: DataFrame) -> DataFrame:
    """Frames below each other by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
