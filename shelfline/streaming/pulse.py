"""Incremental refresh of the business pulse."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline.plans.sales import PULSE_SUMS, TOTAL, business_pulse, on_days
from shelfline.sinks.loads import STORED, remove

#: The columns by which detail rows are summed; both masters hang on the last two.
KEYS = ("calday", "zjcustbrg", "zjmatrial")
_SUMS = f"zjcustbrg string, zjmatrial string, {', '.join(f'{m} {TOTAL}' for m in PULSE_SUMS)}, batch bigint, calday date"


#: Rows that one task sums, or sorts and writes.
TASK_ROWS = 1 << 17


def _summed(rows: DataFrame, sizes: Mapping) -> DataFrame:
    """Sums by key, by the tasks that go on to write them."""
    sums = _by_day(rows, sizes, *KEYS[1:]).groupBy(*KEYS, "_piece").agg(*[F.sum(m).cast(TOTAL).alias(m) for m in PULSE_SUMS])
    return sums.drop("_piece")


def _by_day(rows: DataFrame, sizes: Mapping, *keys: str) -> DataFrame:
    """Rows dealt by day, a day of many rows over several tasks by its keys (``_piece``).

    ``sizes`` holds the rows of each day, so tasks keep a bounded part however large the batch
    or one of its days, and rows of equal keys meet.
    """
    pieces, of = F.lit(1), {d: 1 << math.ceil(math.log2(n / TASK_ROWS)) for d, n in sizes.items() if n > TASK_ROWS}
    for number in sorted(set(of.values())):
        pieces = F.when(on_days("calday", [d for d, n in of.items() if n == number]), F.lit(number)).otherwise(pieces)
    tasks = -(-sum(sizes.values()) // TASK_ROWS)
    return rows.withColumn("_piece", F.pmod(F.hash(*keys), pieces)).repartition(tasks, "calday", "_piece")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _versions(versions: dict) -> Column:
    """The stored sums of each day as of one batch; prunes partitions."""
    rules = [(F.col("batch") == number) & on_days("calday", [d for d, v in versions.items() if v == number])
             for number in sorted(set(versions.values()))]
    return reduce(lambda a, b: a | b, rules, F.lit(False))


def add_batch(batch: DataFrame, number: int, customers: DataFrame, materials: DataFrame, target: str, sums: str) -> None:
    """Add the rows of one batch to the running sums and replace the pulse of the days it touches.

    ``sums`` holds, for a day and the number of a batch, the day's sums by key up to and
    with that batch: the ledger of what has been counted. A batch reads the last
    sums below its own number, adds its rows and writes its own partition, so a
    repeated batch adds nothing, whatever of it was written before. Neither old detail
    rows nor other days are read; a hot day costs its keys, not its rows. The sums a
    day had two batches ago go. Rows, and later the rows of the pulse, move once by day, to the
    tasks that sum, sort and write them.
    """
    spark = batch.sparkSession
    sizes = _sizes(batch)
    if not sizes:
        return
    days = list(sizes)
    stored = spark.read.schema(_SUMS)
    found: dict[tuple, int] = {}
    rows = batch.select(*KEYS, *PULSE_SUMS)
    if _exists(spark, sums):
        known = stored.parquet(sums).where(on_days("calday", days) & (F.col("batch") < number))
        found = {(r[0], r[1]): r[2] for r in known.groupBy("calday", "batch").count().collect()}
    last = {day: max(v for d, v in found if d == day) for day, _ in found}
    if last:
        rows = rows.unionByName(stored.parquet(sums).where(_versions(last)).select(*rows.columns))
        sizes = {day: n + found.get((day, last.get(day)), 0) for day, n in sizes.items()}
    _replace(_summed(rows, sizes).withColumn("batch", F.lit(number)), sums, ("batch", "calday"), KEYS[1:])
    counted = stored.parquet(sums).where((F.col("batch") == number) & on_days("calday", days))
    attributed = _by_day(business_pulse(counted, customers, materials), _sizes(counted), "customer_id", "product_code").drop("_piece")
    _replace(attributed, target, ("calday",), ("customer_id", "product_code"))
    for day, version in found:
        if version < last[day]:
            name = "__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat()
            remove(spark, f"{sums.rstrip('/')}/batch={version}/calday={name}")


def _sizes(rows: DataFrame) -> dict:
    """Rows of each day."""
    return dict(rows.groupBy("calday").count().collect())


def _replace(rows: DataFrame, path: str, by: Sequence[str], sort_keys: Sequence[str]) -> None:
    (rows.sortWithinPartitions("calday", *sort_keys).write.mode("overwrite").options(**STORED)
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


def pulse_incremental(new_rows: DataFrame, customers: DataFrame, materials: DataFrame, target: str,
                      checkpoint: str, sums: str | None = None) -> StreamingQuery:
    """Follow a stream of new detail rows; each batch adds to the days it touches.

    The sums belong to the checkpoint, whose batch numbers they carry, and lie beside it.
    """
    sums = sums or f"{checkpoint.rstrip('/')}-sums"
    return (
        new_rows.writeStream.foreachBatch(lambda batch, number: add_batch(batch, number, customers, materials, target, sums))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
