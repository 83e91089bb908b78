"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from shelfline import schemas
from shelfline.catalog.standins import table
from shelfline.operators import rows
from shelfline.plans import sales
from shelfline.session import build_session, shared_folder
from shelfline.sinks.loads import lay_out
from shelfline.sources import readers
from shelfline.functions.dates import month_of
import datetime as dt

SF_DIR = "/root/testdata/sf0.001"
PURE = ["business_pulse_full", "sales_filtered_union", "alcohol_sales_detail", "daily_sales", "sales_rollup_12key",
        "pos_weekly_report", "customer_route_report", "visit_sovi_store", "person_email_outer"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_no_pairwise_joins_no_python(spark, name):
    text = plan(entry_point.queries()[name](spark, SF_DIR))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|SinglePartition", text)


def test_pulse_moves_the_detail_once_on_three_keys(spark):
    star = [table(spark, SF_DIR, n) for n in ("detail", "customers", "materials")]
    text = plan(sales.business_pulse(*star))
    assert len(re.findall(r"Exchange hashpartitioning\(calday#\d+, _c#\d+, _m#\d+, \d+\)", text)) == 1


def test_union_of_branches_scans_the_detail_once(spark):
    text = plan(entry_point.queries()["sales_filtered_union"](spark, SF_DIR))
    assert text.count("lineitem.parquet") == 1


def test_slices_prune_partitions(spark, folder):
    df = spark.createDataFrame([(dt.date(2021, m, 1), m, "x") for m in (1, 2, 3)], "calday date, v int, wide string")
    lay_out(df, "calday", ("v",)).write.partitionBy("calday").parquet(folder("t"))
    cut = readers.slice_days(spark.read.parquet(folder("t")), "calday", month_of(dt.date(2021, 2, 5))).select("v")
    text = plan(cut)
    assert "PartitionFilters: [isnotnull(calday" in text and "ReadSchema: struct<v:int>" in text
    assert [r.v for r in cut.collect()] == [2]


def test_report_days_prune_partitions(spark, folder):
    detail, customers, materials = (table(spark, SF_DIR, n) for n in ("detail", "customers", "materials"))
    detail.where("calmonth in ('1998-05', '1998-06')").repartition("calday").write.partitionBy("calday").parquet(folder("d"))
    stored = spark.read.parquet(folder("d"))
    day = dt.date(1998, 6, 17)
    text = plan(sales.daily_sales(stored, customers, materials, first=day, last=day, ordered=False))
    assert re.search(r"PartitionFilters: \[[^]]*calday#\d+ >= 1998-06-01", text) and re.search(r"calday#\d+ <= 1998-06-30", text)
    days = [r[0] for r in stored.select("calday").distinct().orderBy("calday").limit(2).collect()]
    text = plan(stored.where(sales.on_days("calday", days)))
    assert re.search(rf"PartitionFilters: \[[^]]*calday#\d+ IN \({days[0]},{days[1]}\)", text) or re.search(rf"PartitionFilters: \[[^]]*>= {days[0]}", text)
    text = plan(sales.business_pulse(stored, customers, materials, limit=3))
    assert re.search(r"PartitionFilters: \[[^]]*calday#\d+ >= \d", text)


def test_a_sample_sorts_only_rows_below_its_bound(spark, monkeypatch):
    stored = table(spark, SF_DIR, "detail").select("calday", "zjcustbrg")
    monkeypatch.setattr(rows, "ONE_TASK", 0)  # tables of fewer rows are sorted in one task
    picked = readers.sample(stored, 100, ["calday", "zjcustbrg"])
    text = plan(picked)
    assert "RoundRobin" not in text and text.count("TakeOrdered") <= 1
    assert re.search(r"Filter .*< \d{4}-\d\d-\d\d.*<= \[\d+,", text)
    assert sorted(map(tuple, picked.collect())) == sorted(map(tuple, stored.orderBy("calday", "zjcustbrg").limit(100).collect()))


def test_readers_refuse_commands(spark, folder):
    from shelfline.sinks.guards import GuardError

    for text in ("drop table x", "create table y as select 1", f"insert overwrite directory '{folder('z')}' using parquet select 1", "select 1) as _q; drop table x"):
        with pytest.raises(GuardError):
            readers.query_scan(spark, text)
    assert readers.query_scan(spark, "with a as (select :n as n) select n from a;", {"n": 3}).first().n == 3


def test_filters_reach_the_scan(spark):
    lines = readers.read_source(spark, f"{SF_DIR}/lineitem.parquet", columns=["l_suppkey"])
    text = plan(lines.where(F.col("l_suppkey") == 3))
    assert "EqualTo(l_suppkey,3)" in text and "ReadSchema: struct<l_suppkey:bigint>" in text


def test_schemas():
    assert (len(schemas.SALES_DETAIL), len(schemas.SALES_DOCUMENT)) == (93, 81)
    assert schemas.SALES_DETAIL["absmg_cy"].dataType.simpleString() == "decimal(18,5)"
    wide = schemas.string_master(["zjmate", "zjgalcv"], schemas.MATERIAL_DECIMALS)
    assert wide["zjgalcv"].dataType.simpleString() == "decimal(38,3)"
    assert len(schemas.POS_GOODS) == 37 and len(schemas.DAILY_SALES_BY_SKU) == 24


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert build_session().conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_a_hot_key_is_split_where_the_master_is_too_large(spark, folder, monkeypatch):
    """A third of the rows share one customer; the join is by shuffle and AQE cuts that partition."""
    from shelfline.operators import joins
    from shelfline.sources.report import ReportBranch, branch_rows

    n = 300_000
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    spark.range(n).select(
        key.alias("zjcustbrg"), F.lit("m").alias("zjmatrial"), F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.lit("7828").alias("comp_code")).repartition(8).write.parquet(folder("fact"))
    spark.range(n).select(F.col("id").cast("string").alias("zjcust")).unionByName(
        spark.createDataFrame([("hot",)], "zjcust string")).select(
        "zjcust", F.lit("0:n").alias("zjdfflg"), F.lit("13").alias("zjdivold2"),
        F.lit("x").alias("zjddexfl___t")).write.parquet(folder("customers"))
    materials = spark.createDataFrame([("m", "X:x")], "zjmate string, zjbudtf string")
    monkeypatch.setattr(joins.measured, "__kwdefaults__", {"limit": 0})
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = branch_rows(spark.read.parquet(folder("fact")), spark.read.parquet(folder("customers")), materials,
                          [ReportBranch("b", ("X:x",), ("0:n",))]).select("zjcustbrg", "text")
        assert len(out.collect()) == n
        assert "skew=true" in plan(out)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_facts_are_not_sorted_for_large_masters(spark, monkeypatch):
    from shelfline.operators import joins

    monkeypatch.setattr(joins.fit, "__kwdefaults__", {"limit": 0})
    monkeypatch.setattr(joins.measured, "__kwdefaults__", {"limit": 0})
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("sales_branch_fv", "sales_filtered_union", "alcohol_sales_detail", "daily_sales", "sales_detail_rows"):
            df = table(spark, SF_DIR, "detail") if name == "sales_detail_rows" else entry_point.queries()[name](spark, SF_DIR)
            fact = [line for line in plan(df).splitlines() if re.search(r"(SortMerge|ShuffledHash)Join.*(l_orderkey|zjcustbrg|zjmatrial)", line)]
            assert fact and all("ShuffledHashJoin" in line for line in fact), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_masters_of_branches_bring_only_their_key_and_one_number(spark, monkeypatch):
    from shelfline.sources import report

    seen = []
    keep = report.measured
    monkeypatch.setattr(report, "measured", lambda *sides: seen.append([s.columns for s in sides]) or keep(*sides))
    star = [table(spark, SF_DIR, n) for n in ("detail", "customers", "materials")]
    sales.sales_union(*star)
    assert seen == [[["zjcust", "_customer_fits"], ["zjmate", "_material_fits"]]]


def test_rollup_deals_rows_before_it_sums_them(spark):
    text = plan(sales.sales_rollup(table(spark, SF_DIR, "detail")))
    assert text.index("REPARTITION_BY_COL") > text.rindex("HashAggregate") if "REPARTITION_BY_COL" in text else text.index("REPARTITION_BY_NUM") > text.rindex("HashAggregate")
