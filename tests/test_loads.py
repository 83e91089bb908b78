import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfline.functions.dates import Window
from shelfline.plans import jobs
from shelfline.sinks import audit, export, guards, loads
from shelfline.sources import readers

D1, D2, D3 = (dt.date(2021, 1, d) for d in (1, 2, 3))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "calday date, v int")


def table(spark, path):
    return Counter((r.calday, r.v) for r in spark.read.parquet(path).select("calday", "v").collect())


def test_full_refresh_is_idempotent_and_guarded(spark, folder):
    path = folder("t")
    for _ in range(2):
        result = loads.full_refresh(frame(spark, (D1, 1), (D2, 2)), path, day="calday")
    assert (result.row_count, result.truncated) == (2, True)
    with pytest.raises(guards.GuardError):
        loads.full_refresh(frame(spark), path, day="calday")
    with pytest.raises(guards.GuardError):
        loads.full_refresh(frame(spark, (D1, 9), (D2, 9)), path, day="calday", max_rows=1)
    assert table(spark, path) == Counter([(D1, 1), (D2, 2)])


def test_reload_range(spark, folder):
    path = folder("t")
    loads.full_refresh(frame(spark, (D1, 1), (D2, 2), (D3, 3)), path, day="calday")
    for _ in range(2):
        loads.reload_range(frame(spark, (D2, 20), (D2, 21)), path, "calday", Window(D2, D3))
        assert table(spark, path) == Counter([(D1, 1), (D2, 20), (D2, 21)])
    with pytest.raises(guards.GuardError):
        loads.reload_range(frame(spark), path, "calday", Window(D1, D3))
    with pytest.raises(guards.GuardError):
        loads.reload_range(frame(spark, (D1, 5)), path, "calday", Window(D2, D3))
    assert table(spark, path) == Counter([(D1, 1), (D2, 20), (D2, 21)])


def test_a_table_can_be_rewritten_from_itself(spark, folder):
    path = folder("t")
    loads.full_refresh(frame(spark, (D1, 1), (D2, 2)), path, day="calday")
    doubled = spark.read.parquet(path).select(F.col("calday"), (F.col("v") * 2).alias("v"))
    loads.full_refresh(doubled, path, day="calday")
    assert table(spark, path) == Counter([(D1, 2), (D2, 4)])


def test_append_repeats(spark, folder):
    path = folder("t")
    for _ in range(2):
        loads.append(frame(spark, (D1, 1)), path, day="calday")
    assert table(spark, path) == Counter({(D1, 1): 2})


def test_transform_and_schema(spark, folder):
    path = folder("t")
    loads.full_refresh(frame(spark, (D1, 1)), path, transform=lambda df: df.withColumn("v", F.col("v") + 1))
    assert table(spark, path) == Counter([(D1, 2)])
    with pytest.raises(TypeError):
        loads.full_refresh(frame(spark, (D1, 1)), path, transform="no function")
    with pytest.raises(guards.GuardError):
        loads.full_refresh(frame(spark, (D1, 1)).withColumn("w", F.lit(1)), path, schema=frame(spark).schema)
    by_name = frame(spark, (D1, 7)).select("v", "calday")
    loads.full_refresh(by_name, path, schema=frame(spark).schema)
    assert spark.read.parquet(path).columns == ["calday", "v"]


def test_slice_copy(spark, folder):
    source = frame(spark, (D1, 1), (D2, 2), (D3, 3))
    for _ in range(2):
        loads.slice_copy(source, folder("copy"), "calday", Window(D2, D2))
    loads.slice_copy(source, folder("copy"), "calday", Window(D3, D3))
    assert table(spark, folder("copy")) == Counter([(D2, 2), (D3, 3)])


def test_job_runs(spark, folder):
    ticks = iter(dt.datetime(2021, 1, 1, 9, 0, s, tzinfo=dt.timezone.utc) for s in range(10))
    runs = audit.JobRuns(spark, folder("runs"), clock=lambda: next(ticks))
    runs.run("ok", lambda: loads.full_refresh(frame(spark, (D1, 1)), folder("t")), processed=D1)
    with pytest.raises(guards.GuardError):
        runs.run("bad", lambda: loads.full_refresh(frame(spark), folder("t")))
    got = {r.job: r for r in runs.table().collect()}
    assert (got["ok"].status, got["ok"].row_count, got["ok"].elapsed_seconds) == ("SUCCESS", 1, 1.0)
    assert (got["bad"].status, got["bad"].message) == ("FAILURE", "the extract holds no rows")


def test_reconcile(spark):
    lines = [("a", "x INPUT_RECORDS: 5"), ("a", "OUTPUT_RECORDS: 5"), ("a", "OUTPUT_RECORDS_FAILED: 0"),
             ("b", "OUTPUT_RECORDS_FAILED: 2"), ("c", "nothing")]
    out = audit.reconcile(spark.createDataFrame(lines, "run string, line string"), "run", "line")
    got = {r.run: r for r in out.collect()}
    assert (got["a"].input_records, got["a"].output_records, got["a"].complete) == (5, 5, True)
    assert not got["b"].complete and not got["c"].complete
    with pytest.raises(RuntimeError):
        audit.require_complete(out)
    audit.require_complete(out.where("run = 'a'"))


def test_json_batches_directories(spark, folder):
    df = spark.range(45).withColumn("v", F.lit("x"))
    export.write_json_batches(df, folder("j"), "sales", ["id"], batch=10, per_dir=2)
    docs = spark.read.json(folder("j"))
    assert sorted((r.part, len(r.sales)) for r in docs.collect()) == [(0, 10), (0, 10), (1, 10), (1, 10), (2, 5)]


def test_csv_headers_and_blanks(spark, folder):
    df = spark.createDataFrame([("  a ", None), ("b", "x,\"y\"")], "p string, q string")
    export.write_csv(df, folder("c"))
    back = readers.read_csv_files(spark, folder("c"), df.schema, header=True,
                                  ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


RAW = "calmonth string, calday string, year_ind string, comp_code string, zjcustbrg string, zjmatrial string, v int"


def test_sales_jobs(spark, folder):
    def raw(*cells):
        return spark.createDataFrame([(m, d, "CY", "1", "c", "m", v) for m, d, v in cells], RAW)

    path = folder("sales")
    first = raw(("202101", "20210101", 1), ("202101", "20210102", 2), ("202102", "20210201", 3))
    jobs.load_sales_month(first, path, D1)
    jobs.load_sales_month(first, path, D1)
    assert table(spark, path) == Counter([(D1, 1), (D2, 2)])
    later = raw(("202101", "20210102", 22), ("202101", "20210103", 33), ("202101", "20210101", 99))
    jobs.load_sales_detail(later, path, D3)
    assert table(spark, path) == Counter([(D1, 1), (D2, 22), (D3, 33)])


def test_usage_and_master_jobs(spark, folder):
    wide = spark.createDataFrame([("a", 1, 2)], "Time string, `2021-01-01` int, `2021-01-02` int")
    totals, days = jobs.load_usage(wide, folder("totals"), folder("days"))
    assert (totals.row_count, days.row_count) == (1, 2)
    copies = spark.createDataFrame([("k", "x")] * 3, "zjcust string, name string")
    assert jobs.load_master(copies, folder("m"), distinct=True).row_count == 1


def test_equipment_jobs(spark, folder):
    placed = spark.createDataFrame([("20200904", "00000000", None), ("20200905", "20200906", "x")],
                                   "addat string, idat2 string, item string")
    jobs.load_equipment_placement(placed, folder("e"), dt.date(2020, 9, 4))
    row = spark.read.parquet(folder("e")).first()
    assert (row.idat2, row.item) == (dt.date(2099, 1, 1), "")


def test_pos_weekly_job(spark, folder):
    lines = ["c,,j,2021-09-06,1,2,3,4,5,6,7,8,9,10,2021/09/07", "c,,j,2021-09-13,1,2,,4,5,6,7,8,9,10.5,2021/09/14"]
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(2).write.text(folder("csv"))
    assert jobs.load_pos_weekly(spark, folder("csv"), folder("pos")).row_count == 2
    rows = spark.read.parquet(folder("pos")).orderBy("period").collect()
    assert [r.gross_profit for r in rows] == [3, None]
    assert rows[0].store_code is None and rows[0].load_date == dt.date(2021, 9, 7)


def test_broken_lines_go_to_the_reject_table(spark, tmp_path, folder):
    (tmp_path / "a.csv").write_text("a,1,2021-01-01\nb,x,2021-01-01\nc,3\nd,4,2021-01-02,more\ne,,2021-01-03\n")
    kinds = readers.T.StructType.fromDDL("name string, n int, day date")
    judged = readers.judged_csv_files(spark, str(tmp_path / "a.csv"), kinds)
    with pytest.raises(guards.GuardError, match="3 rows were rejected, more than the cap of 2"):
        loads.load_accepted(judged, folder("t"), folder("r"), "one", max_rejects=2)
    assert not (tmp_path / "t").exists() and not (tmp_path / "r").exists()
    for _ in range(2):
        loads.load_accepted(judged, folder("t"), folder("r"), "one", max_rejects=3)
        assert sorted(tuple(r) for r in spark.read.parquet(folder("t")).collect()) == [("a", 1, D1), ("e", None, D3)]
        assert sorted(tuple(r) for r in spark.read.parquet(folder("r")).select("line", "reason", "run").collect()) == [
            ("b,x,2021-01-01", "line", "one"), ("c,3", "line", "one"), ("d,4,2021-01-02,more", "line", "one")]
    with pytest.raises(guards.GuardError):
        loads.load_accepted(judged.where("reason is not null"), folder("t"), folder("r"), "two", max_rejects=9)


def test_files_of_a_split_day_hold_key_ranges(spark, folder, monkeypatch):
    path = folder("t")
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 10 == 0, F.lit(D2)).otherwise(F.lit(D1)).alias("calday"),
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") * 7919 % 1000).cast("int").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("body"))
    monkeypatch.setattr(loads, "FILE_BYTES", 200_000)
    for _ in range(2):
        result = loads.full_refresh(rows, path, day="calday", sort_keys=("v",))
    stored = spark.read.parquet(path)
    assert result.row_count == 40_000
    assert stored.exceptAll(rows.select(stored.columns)).isEmpty() and stored.count() == 40_000
    files = sorted((r.low, r.high) for r in stored.where(F.col("calday") == D1).groupBy(F.input_file_name().alias("f")).agg(
        F.min("v").alias("low"), F.max("v").alias("high")).collect())
    assert len(files) > 6
    assert all(a[1] <= b[0] for a, b in zip(files, files[1:], strict=False))
    # One key opens a fraction of the day's files; a key of a third of all rows spans several, none of which holds them all.
    assert sum(low <= 123 <= high for low, high in files) <= 2
    assert 1 < sum(low <= 500 <= high for low, high in files) < len(files)


def test_a_load_reads_its_size_below_which_days_are_not_cut(spark, folder):
    path = folder("t")
    loads.full_refresh(frame(spark, (D1, 2), (D1, 1), (D2, 3), (None, 4)), path, day="calday", sort_keys=("v",))
    assert table(spark, path) == Counter([(D1, 2), (D1, 1), (D2, 3), (None, 4)])
    assert loads.stored_bytes(spark, path) > 0


def test_json_batches_are_compressed_and_leave_no_work_table(spark, folder):
    from shelfline import session

    made = list(session._MADE)
    df = spark.range(3000).withColumn("v", F.lit("x")).repartition(3)
    export.write_json_batches(df, folder("z"), "sales", ["id"], batch=10, per_dir=100)
    files = spark.read.json(folder("z")).inputFiles()
    assert len(files) == 3 and all(f.endswith(".json.gz") for f in files)  # one file for each directory
    assert session._MADE == made
    assert spark.read.json(folder("z")).selectExpr("explode(sales.id)").distinct().count() == 3000


def test_kinds_are_written_side_by_side(spark, folder, monkeypatch):
    """The staged write keeps a file open for each kind, so that rows are not sorted by kind; the setting goes back."""
    seen, name = [], "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    rows = spark.createDataFrame([("a", D1, 1), ("b", D1, 2), ("a", D2, 3)], "kind string, calday date, v int")
    watched = rows.withColumn("kind", F.col("kind"))
    keep = loads.open_writers
    monkeypatch.setattr(loads, "open_writers", lambda s: seen.append(s) or keep(s))
    loads.many_targets(watched, "kind", folder("staging"), builders={"a": lambda d: d, "b": lambda d: d}, reads={"a": "a", "b": "b"},
                       paths={"a": folder("ta"), "b": folder("tb")}, days={"a": "calday", "b": "calday"})
    assert len(seen) == 1 and spark.conf.get(name) == before
    assert table(spark, folder("ta")) == Counter([(D1, 1), (D2, 3)])
    with keep(spark):
        assert int(spark.conf.get(name)) >= 9
