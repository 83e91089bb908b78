import datetime as dt
import json
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.plans import sales
from shelfline.streaming import activity, pulse


def write_events(folder, name, *ids):
    folder.mkdir(exist_ok=True)
    rows = [{"CreationTime": f"2024-01-01T00:0{i}:00", "Id": str(n), "Operation": "o", "Workload": "w", "UserId": "u"}
            for i, n in enumerate(ids)]
    (folder / name).write_text(json.dumps({"root": rows}))


def ingest(spark, source, target, checkpoint, **options):
    docs = activity.read_documents(spark, str(source), schemas.ACTIVITY_DOCUMENT, multiLine="true")
    activity.activity_ingest(docs, target, checkpoint, **options).awaitTermination()
    return Counter(r.Id for r in spark.read.parquet(target).select("Id").collect())


def test_restart_reads_only_new_files(spark, tmp_path, folder):
    source = tmp_path / "docs"
    write_events(source, "a.json", 1, 2, 2)
    assert ingest(spark, source, folder("t"), folder("c")) == {"1": 1, "2": 2}
    write_events(source, "b.json", 2, 3)
    assert ingest(spark, source, folder("t"), folder("c")) == {"1": 1, "2": 3, "3": 1}
    assert ingest(spark, source, folder("t"), folder("c")) == {"1": 1, "2": 3, "3": 1}


def test_dedupe_within_delay(spark, tmp_path, folder):
    source = tmp_path / "docs"
    write_events(source, "a.json", 1, 2, 2, 1)
    assert ingest(spark, source, folder("t"), folder("c"), dedupe_within="1 hour") == {"1": 1, "2": 1}


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "docs"
    write_events(source, "a.json", 1, 2)
    docs = spark.read.schema(schemas.ACTIVITY_DOCUMENT).option("multiLine", True).json(str(source))
    assert activity.event_stream(docs).count() == 2


def test_only_touched_days_are_replaced(spark, folder):
    measures = [f"cm_{y}_{m}" for m in ("bapc", "nsr", "cogs", "gp") for y in ("cy", "ly")]
    kinds = "calday date, zjcustbrg string, zjmatrial string, " + ", ".join(f"{m} decimal(18,6)" for m in measures)

    def rows(day, *amounts):
        return spark.createDataFrame([(day, "c", "m", *[Decimal(a)] * 8) for a in amounts], kinds)

    customers = spark.createDataFrame([("c",)], "zjcust string")
    for name in schemas.CUSTOMER_MASTER.names[:1] + schemas.CUSTOMER_MASTER.names[2:]:
        customers = customers.withColumn(name, F.lit("x"))
    materials = spark.createDataFrame([("m",)], "zjmate string")
    for name in schemas.MATERIAL_MASTER.names:
        if name != "zjmate":
            materials = materials.withColumn(name, F.lit("x"))
    d1, d2 = dt.date(2021, 1, 1), dt.date(2021, 1, 2)
    detail = folder("detail")

    def run():
        stream = spark.readStream.schema(kinds).parquet(detail)
        pulse.pulse_incremental(stream, customers, materials,
                                folder("pulse"), folder("cp")).awaitTermination()
        got = spark.read.parquet(folder("pulse"))
        assert set(got.columns) == {*sales.PULSE_KEYS, *sales.PULSE_MEASURES}
        return {(r.calday, r.bapc_cy) for r in got.collect()}

    rows(d1, 1, 2).union(rows(d2, 5)).write.parquet(detail)
    assert run() == {(d1, 3), (d2, 5)}

    def files(day):
        rows_of_day = spark.read.parquet(folder("pulse")).where(F.col("calday") == day)
        return {r[0] for r in rows_of_day.select(F.input_file_name()).collect()}

    untouched = files(d1)
    rows(d2, 6).write.mode("append").parquet(detail)
    assert run() == {(d1, 3), (d2, 11)}
    assert untouched == files(d1)


def test_a_repeated_batch_adds_nothing_and_old_rows_are_not_read(spark, folder):
    kinds = "calday date, zjcustbrg string, zjmatrial string, " + ", ".join(f"{m} decimal(18,6)" for m in sales.PULSE_SUMS)
    customers = spark.createDataFrame([tuple("k" if n == "zjcust" else "x" for n in schemas.CUSTOMER_MASTER.names)], schemas.CUSTOMER_MASTER)
    materials = spark.createDataFrame([tuple("m" if n == "zjmate" else "x" for n in schemas.MATERIAL_MASTER.names)], schemas.MATERIAL_MASTER)
    d1, d2 = dt.date(2021, 1, 1), dt.date(2021, 1, 2)

    def add(number, *rows):
        batch = spark.createDataFrame([(day, "k", "m", *[Decimal(a)] * 8) for day, a in rows], kinds)
        pulse.add_batch(batch, number, customers, materials, folder("pulse"), folder("sums"))
        return {(r.calday, r.bapc_cy) for r in spark.read.parquet(folder("pulse")).select("calday", "bapc_cy").collect()}

    assert add(0, (d1, 1), (d1, 2), (None, 4)) == {(d1, 3), (None, 4)}
    assert add(1, (d1, 10), (d2, 5)) == {(d1, 13), (d2, 5), (None, 4)}
    assert add(1, (d1, 10), (d2, 5)) == {(d1, 13), (d2, 5), (None, 4)}  # the same batch once more
    assert add(2, (d1, 100), (None, 1)) == {(d1, 113), (d2, 5), (None, 5)}
    assert add(2, (d1, 100), (None, 1)) == {(d1, 113), (d2, 5), (None, 5)}
    assert add(3) == {(d1, 113), (d2, 5), (None, 5)}
    left = spark.read.parquet(folder("sums")).select("calday", "batch").distinct().collect()
    assert {tuple(r) for r in left} == {(d1, 1), (d1, 2), (d2, 1), (None, 0), (None, 2)}  # one step back for a repeat


def test_a_hot_day_spreads_over_tasks_and_equal_keys_meet(spark, folder, monkeypatch):
    monkeypatch.setattr(pulse, "TASK_ROWS", 4, raising=False)
    kinds = "calday date, zjcustbrg string, zjmatrial string, " + ", ".join(f"{m} decimal(18,6)" for m in sales.PULSE_SUMS)
    customers = spark.createDataFrame([tuple(f"k{i}" if n == "zjcust" else "x" for n in schemas.CUSTOMER_MASTER.names) for i in range(20)], schemas.CUSTOMER_MASTER)
    materials = spark.createDataFrame([tuple("m" if n == "zjmate" else "x" for n in schemas.MATERIAL_MASTER.names)], schemas.MATERIAL_MASTER)
    day = dt.date(2021, 1, 1)
    # Customers k20 to k23 are unknown: their sums meet in one row.
    rows = [(d, f"k{i}", "m", *[Decimal(i)] * 8) for i in range(24) for d in (None, None, day)]
    for number in (0, 1):
        pulse.add_batch(spark.createDataFrame(rows, kinds).repartition(5), number, customers, materials, folder("pulse"), folder("sums"))
        kept = spark.read.parquet(folder("sums")).where(F.col("batch") == number)
        assert Counter(map(tuple, kept.select("calday", "zjcustbrg", "cm_cy_bapc").collect())) == Counter(
            [(None, f"k{i}", 2 * i * (number + 1)) for i in range(24)] + [(day, f"k{i}", i * (number + 1)) for i in range(24)])
        got = spark.read.parquet(folder("pulse"))
        assert Counter(map(tuple, got.select("calday", "customer_id", "bapc_cy").collect())) == Counter(
            [(None, f"k{i}", 2 * i * (number + 1)) for i in range(20)] + [(day, f"k{i}", i * (number + 1)) for i in range(20)]
            + [(None, None, 172 * (number + 1)), (day, None, 86 * (number + 1))])
    for table in (got, kept):  # no task got a hot day whole
        files = table.groupBy("calday", F.input_file_name().alias("file")).count().collect()
        assert all(r[2] <= 16 for r in files) and all(n > 1 for n in Counter(r.calday for r in files).values())
