import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfline.functions.dates import Window
from shelfline.sinks import guards, loads, tables

D1, D2, D3 = (dt.date(2021, 1, d) for d in (1, 2, 3))
KIND = "v int, calday date"


def frame(spark, *rows):
    return spark.createDataFrame([(v, d) for d, v in rows], KIND)


def stored(spark, name):
    return Counter((r.calday, r.v) for r in spark.table(name).collect())


@pytest.fixture
def name(spark):
    yield "loaded"
    spark.sql("drop table if exists loaded")


def halted(*_):
    raise RuntimeError("stopped here")


def test_readers_see_all_old_rows_while_a_refresh_is_stopped(spark, folder, name, monkeypatch):
    base = folder("t")
    tables.refresh_table(frame(spark, (D1, 1), (D2, 2)), name, base, day="calday")
    old = Counter([(D1, 1), (D2, 2)])
    # Tasks fail in the middle of the write.
    bad = spark.range(100).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).cast("int").alias("v"), F.lit(D1).alias("calday"))
    with pytest.raises(Exception, match="lost"):
        tables.refresh_table(bad, name, base, day="calday")
    assert stored(spark, name) == old
    # The driver ends after the write and before the switch.
    with monkeypatch.context() as m:
        m.setattr(tables, "require_rows", lambda n: stored(spark, name) == old and halted())
        with pytest.raises(RuntimeError, match="stopped here"):
            tables.refresh_table(frame(spark, (D3, 3)), name, base, day="calday")
    assert stored(spark, name) == old
    for refused in (frame(spark), frame(spark, (D3, 3)).withColumn("more", F.lit(1))):
        with pytest.raises(guards.GuardError):
            tables.refresh_table(refused, name, base, day="calday")
    assert stored(spark, name) == old and len(os.listdir(base)) == 1
    tables.refresh_table(frame(spark, (D3, 3)), name, base, day="calday")
    assert stored(spark, name) == Counter([(D3, 3)])
    assert tables.drop_old(spark, name, base) == 1 and stored(spark, name) == Counter([(D3, 3)])


def test_days_change_one_by_one_and_whole(spark, folder, name, monkeypatch):
    base, every = folder("t"), Window(D1, D3)
    tables.reload_days(frame(spark, (D1, 1), (D2, 2), (D2, 2), (D3, 3)), name, base, "calday", every)
    tail = Window(D2, D3)
    for _ in range(2):
        tables.reload_days(frame(spark, (D2, 20), (D2, 21)), name, base, "calday", tail)
        assert stored(spark, name) == Counter([(D1, 1), (D2, 20), (D2, 21)])
    with pytest.raises(guards.GuardError):
        tables.reload_days(frame(spark, (D1, 9), (D2, 9)), name, base, "calday", tail)
    with pytest.raises(guards.GuardError):
        tables.reload_days(frame(spark), name, base, "calday", every)
    # Stopped between two days: each has all of its old or all of its new rows.
    real, calls = type(spark).sql, []

    def sql(self, text, *args, **more):
        if " partition (" in text:
            calls.append(text)
            if len(calls) == 2:
                halted()
        return real(self, text, *args, **more)

    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", sql)
        with pytest.raises(RuntimeError):
            tables.reload_days(frame(spark, (D1, 7), (D2, 8), (D2, 8)), name, base, "calday", every)
    assert stored(spark, name) == Counter([(D1, 7), (D2, 20), (D2, 21)])
    tables.reload_days(frame(spark, (D1, 7), (D2, 8), (D2, 8)), name, base, "calday", every)
    assert stored(spark, name) == Counter({(D1, 7): 1, (D2, 8): 2})


def test_staging_counts_while_it_writes(spark, folder, monkeypatch):
    """No second pass over the staged rows, and no staging left behind by a failure."""
    seen = []
    monkeypatch.setattr(loads, "write_counted", lambda *a, keep=loads.write_counted: seen.append(keep(*a)) or seen[-1])
    loads.full_refresh(spark.range(7), folder("t"))
    assert seen == [(7, 0)]
    bad = spark.range(9).select(F.raise_error(F.lit("lost")).cast("int").alias("v"))
    with pytest.raises(Exception, match="lost"):
        loads.full_refresh(bad, folder("t"))
    assert os.listdir(folder("t__staging")) == [] and spark.read.parquet(folder("t")).count() == 7


def test_sales_table_keeps_one_version_in_small_files(spark):
    import os

    from shelfline.catalog.queries import QUERIES

    files = QUERIES["sales_table_refresh"](spark, "/root/testdata/sf0.001").inputFiles()
    base = os.path.dirname(os.path.dirname(files[0].removeprefix("file://")))
    assert all(".zstd." in f for f in files)
    assert [d for d in os.listdir(base) if d.startswith("v-")] == [os.path.basename(os.path.dirname(files[0]))]


def test_tables_are_written_without_a_dictionary(spark):
    import duckdb

    from shelfline.catalog.queries import QUERIES

    files = [f.removeprefix("file://") for f in QUERIES["sales_table_refresh"](spark, "/root/testdata/sf0.001").inputFiles()]
    found = duckdb.sql(f"select distinct encodings from parquet_metadata({files!r})").fetchall()
    assert found and not any("DICTIONARY" in r[0] for r in found)


def test_a_task_joins_a_bounded_part_of_the_lines(spark, monkeypatch):
    from shelfline.catalog import standins

    monkeypatch.setattr(standins, "LINE_BYTES", 10_000)
    df = standins.table(spark, "/root/testdata/sf0.001", "sales_extract")
    counts = [n for _, n in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(counts) > spark.sparkContext.defaultParallelism and max(counts) < 1500 and sum(counts) == 6000
