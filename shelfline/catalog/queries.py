"""The registered queries: stand-in tables in, one operator or job each."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.catalog import standins
from shelfline.catalog.standins import table
from shelfline.functions import clean, dates
from shelfline.operators import org, reshape, rows, visits
from shelfline.plans import equipment, hr, jobs, pos, sales
from shelfline.session import work_path
from shelfline.sinks import audit, export, loads, tables
from shelfline.sources import landed, readers, report
from shelfline.streaming import activity as activity_stream
from shelfline.streaming import pulse as pulse_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

YEAR_FIRST, YEAR_LAST = dt.date(1999, 10, 1), dt.date(2000, 10, 1)
TARGET_DAY = dt.date(1998, 6, 17)
ACTIVITY_RUN = dt.datetime(2024, 1, 15)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _star(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(table(spark, sf, n) for n in ("detail", "customers", "materials"))


# Marts over sales detail.

@query
def business_pulse(spark, sf):
    return sales.business_pulse(*_star(spark, sf), limit=50)


@query
def business_pulse_full(spark, sf):
    return sales.business_pulse(*_star(spark, sf))


@query
def sales_branch_ej(spark, sf):
    return sales.sales_branch(*_star(spark, sf), "ej")


@query
def sales_branch_wj(spark, sf):
    return sales.sales_branch(*_star(spark, sf), "wj")


@query
def sales_branch_fv(spark, sf):
    return sales.sales_branch(*_star(spark, sf), "fv")


@query
def sales_filtered_union(spark, sf):
    return sales.sales_union(*_star(spark, sf))


@query
def general_report(spark, sf):
    detail, customers, materials = _star(spark, sf)
    return report.general_report(
        detail, customers, materials, month="1998-06", budget_flags=(report.BUDGET_DRINKS, report.BUDGET_OTHER),
        data_flags=(report.DATA_USUAL, report.DATA_VENDING), sending=report.SENDING)


@query
def alcohol_sales_detail(spark, sf):
    return sales.alcohol_detail(*_star(spark, sf), version=1)


@query
def alcohol_sales_detail_v2(spark, sf):
    return sales.alcohol_detail(*_star(spark, sf), version=2)


@query
def sales_rollup_12key(spark, sf):
    return sales.sales_rollup(table(spark, sf, "detail"))


@query
def business_plan_rollup(spark, sf):
    return sales.business_plan(table(spark, sf, "plan"))


@query
def daily_sales(spark, sf):
    return sales.daily_sales(*_star(spark, sf))


@query
def daily_sales_by_sku(spark, sf):
    return sales.daily_sales_by_sku(*_star(spark, sf))


@query
def daily_sales_mtd(spark, sf):
    window = dates.month_to_date(TARGET_DAY)
    return sales.daily_sales(*_star(spark, sf), first=window.first, last=window.last)


# Scans.

@query
def param_query_scan(spark, sf):
    text = """
select calday, zjcustbrg, sum(cm_cy_nsr) as nsr_cy from {detail}
where calday between :calday_first and :calday and calmonth = :calmonth group by calday, zjcustbrg
"""
    params = {"calday_first": dt.date(1998, 6, 1), "calday": TARGET_DAY, "calmonth": "1998-06"}
    return readers.query_scan(spark, text, params, detail=table(spark, sf, "detail"))


@query
def day_range_scan(spark, sf):
    df = table(spark, sf, "detail").select("calday", "zjcustbrg", "zjmatrial", "cm_cy_bapc")
    return readers.slice_days(df, "calday", dates.two_days(TARGET_DAY))


@query
def month_scan(spark, sf):
    df = table(spark, sf, "detail").select("calday", "calmonth", "zjcustbrg", "zjmatrial", "cm_ly_gp")
    return readers.slice_month(df, "calmonth", "1998-06")


@query
def material_scan(spark, sf):
    return readers.read_source(spark, f"{sf}/part.parquet")


@query
def customer_distinct(spark, sf):
    return rows.distinct_rows(table(spark, sf, "customers"))


@query
def material_projection(spark, sf):
    return table(spark, sf, "materials").select(*schemas.MATERIAL_MASTER.names)


@query
def sample_scan(spark, sf):
    df = table(spark, sf, "detail").select("calday", "zjcustbrg", "zjmatrial", "comp_code", "cm_cy_nsr")
    return readers.sample(df, 15000, df.columns)


# Point of sale.

def _pos(spark, sf):
    return tuple(table(spark, sf, n) for n in ("pos_weekly", "pos_periods", "pos_goods", "pos_companies"))


@query
def pos_weekly_with_periods(spark, sf):
    weekly, periods, _, _ = _pos(spark, sf)
    return pos.weekly_with_periods(weekly, periods)


@query
def pos_weekly_report(spark, sf):
    return pos.weekly_report(*_pos(spark, sf))


@query
def pos_store_daily_1y(spark, sf):
    return pos.store_daily_range(table(spark, sf, "pos_store_daily"), YEAR_FIRST, YEAR_LAST)


@query
def pos_week_texts(spark, sf):
    days = table(spark, sf, "pos_periods").select("period").distinct()
    year, week = clean.year_week_text("period")
    return days.select("period", year.alias("str_year"), week.alias("str_weekdate"))


@query
def pos_csv_files(spark, sf):
    path = work_path(spark, "pos-csv")
    weekly = table(spark, sf, "pos_periods").select(*schemas.POS_PERIOD_LIST.names)
    weekly.write.option("header", False).option("nullValue", "").csv(path)
    return readers.read_csv_files(spark, f"{path}/*.csv", schemas.POS_PERIOD_LIST)


@query
def pos_cast(spark, sf):
    raw = table(spark, sf, "raw_pos")
    typed = clean.cast_columns(raw, schemas.POS_MASTER_CASTS, dirty=True)
    return typed.withColumn("duration", clean.loose_date("duration"))


# Equipment and routes.

@query
def clean_equipment(spark, sf):
    return clean.clean_equipment(table(spark, sf, "placement"))


@query
def equipment_recode(spark, sf):
    return equipment.equipment_recode(clean.clean_equipment(table(spark, sf, "placement")))


@query
def equipment_customers(spark, sf):
    return equipment.equipment_customers(table(spark, sf, "customers"))


@query
def customer_route_report(spark, sf):
    return equipment.customer_route_report(
        table(spark, sf, "routes"), table(spark, sf, "route_customers"), table(spark, sf, "divisions"))


# Cleaning.

@query
def clean_transactions(spark, sf):
    return clean.apply_transaction_rules(table(spark, sf, "raw_transactions"))


@query
def clean_transactions_far_blank(spark, sf):
    return clean.apply_transaction_rules(
        table(spark, sf, "raw_transactions"), blank=clean.FAR_DAY, null_text="")


@query
def export_values(spark, sf):
    return export.export_ready(table(spark, sf, "raw_transactions"))


@query
def wholesaler_clean(spark, sf):
    raw = table(spark, sf, "raw_wholesaler")
    typed = clean.cast_columns(raw, {"can_quantity": "decimal(16,8)"})
    return typed.withColumns({
        "delivery_date": clean.short_year_day("delivery_date"),
        "jan_code": F.substring("jan_code", 1, 13),
    })


@query
def name_normalise(spark, sf):
    part = readers.read_source(spark, f"{sf}/part.parquet", columns=["p_partkey", "p_name"])
    named = part.withColumn("name", clean.normalise_name("p_name"))
    return named.withColumn("sql", clean.select_line("p_name", "name"))


@query
def column_profile(spark, sf):
    lines = readers.read_source(spark, f"{sf}/lineitem.parquet")
    empty = lines.withColumns({"never": F.lit(None).cast("double"), "zero": F.lit(0), "blank": F.lit("")})
    return clean.populated_profile(empty)


# Store visits.

def _visit_query(fact: str) -> None:
    def run(spark, sf):
        return visits.visit_fact(standins.visits(spark, sf), fact)

    QUERIES[f"visit_{fact}"] = run


for _fact in visits.KPI_FACTS:
    _visit_query(_fact)


@query
def visit_photo(spark, sf):
    return visits.visit_photos(standins.visits(spark, sf))


@query
def visit_documents(spark, sf):
    """The same documents through their JSON text and the stated schema."""
    texts = standins.visits(spark, sf).select(F.to_json(F.struct("*")).alias("doc"))
    return visits.visit_fact(landed.parse_json(texts, "doc", schemas.VISIT), "sovi_category")


@query
def visit_load(spark, sf):
    """All nine tables loaded in one pass and read back, a visit on the first of its month; columns of other tables are null."""
    base = work_path(spark, "visit-load")
    names = (*visits.KPI_FACTS, visits.PHOTO)
    results = visits.load_visit_facts(standins.visits(spark, sf, month_days=True), {n: f"{base}/{n}" for n in names}, f"{base}/staging")
    loaded = [spark.read.parquet(r.target).select(F.lit(n).alias("fact"), "*") for n, r in results.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), loaded)


@query
def store_flat(spark, sf):
    return visits.flatten_store(landed.stores(standins.store_pages(spark, sf)))


@query
def store_flat_small(spark, sf):
    return visits.flatten_store_small(landed.stores(standins.store_pages(spark, sf)))


@query
def product_flat(spark, sf):
    return visits.flatten_product(landed.products(standins.product_pages(spark, sf)))


# Usage, people, activity.

@query
def usage_long(spark, sf):
    return reshape.usage_long(standins.usage_wide(spark, sf, with_total=True))


@query
def usage_totals(spark, sf):
    return reshape.usage_totals(standins.usage_wide(spark, sf, with_total=False))


def _departments(spark, sf):
    return hr.departments(table(spark, sf, "departments"))


@query
def org_chain(spark, sf):
    return org.climb(_departments(spark, sf), "SectionCD", "ParentSectionCD", ["LCD"]).chain


@query
def hr_org_levels(spark, sf):
    return hr.levels(_departments(spark, sf))[0]


@query
def hr_unplaced(spark, sf):
    """Sections of a cycle or leading into one."""
    return hr.unplaced(_departments(spark, sf)).select("SectionCD", "ParentSectionCD", "LCD", "SectionNameEN")


@query
def hr_master(spark, sf):
    jobs = readers.active_jobs(table(spark, sf, "jobs")).drop("emplStatus")
    return hr.hr_master(table(spark, sf, "persons"), table(spark, sf, "emails"), jobs, _departments(spark, sf))


@query
def people_pages(spark, sf):
    """Persons through landed pages of JSON text."""
    page = F.struct(F.struct(F.array(F.struct("*")).alias("results")).alias("d"))
    pages = table(spark, sf, "persons").select(F.to_json(page).alias("doc"))
    return landed.people(landed.parse_json(pages, "doc", schemas.hr_page(schemas.HR_PERSON)))


@query
def person_email_outer(spark, sf):
    from shelfline.operators.joins import full_outer

    persons = table(spark, sf, "persons").select("personIdExternal", "nationality", "lastName")
    return full_outer(persons, table(spark, sf, "emails"), "personIdExternal")


@query
def activity_events(spark, sf):
    docs = landed.parse_json(standins.activity_texts(spark, sf), "doc", schemas.ACTIVITY_DOCUMENT)
    return landed.activity_events(docs)


@query
def activity_window(spark, sf):
    """Events of one daily pull."""
    events = table(spark, sf, "activity")
    since = readers.changed_since(events, "ts", ACTIVITY_RUN - dt.timedelta(days=1))
    upto = F.lit(ACTIVITY_RUN.isoformat(sep=" ")).cast("timestamp_ntz")
    return since.where(F.col("ts") <= upto).select(*schemas.ACTIVITY_EVENT.names, "scope")


# Loads. The tables live below the shared work folder.

LOAD_DAY = dt.date(2024, 2, 5)


def _load_rows(spark, sf):
    return table(spark, sf, "ledger")


def _corrected(df: DataFrame) -> DataFrame:
    """What a later extract of the same days holds: one department's amounts doubled."""
    amount = F.when(F.col("department_code") == "view", F.col("sales_amount") * 2).otherwise(F.col("sales_amount"))
    return df.withColumn("sales_amount", amount.cast("decimal(18,6)"))


def _loaded(spark, sf) -> str:
    target = work_path(spark, "table")
    loads.full_refresh(_load_rows(spark, sf), target, day="calday", sort_keys=("compared_date", "department_code"))
    return target


def _read(spark, target: str) -> DataFrame:
    return spark.read.parquet(target).select(
        F.col("calday").cast("date").alias("calday"), "compared_date", "department_code", "district_code",
        "sales_amount")


@query
def full_refresh(spark, sf):
    target = _loaded(spark, sf)
    loads.full_refresh(_load_rows(spark, sf), target, day="calday", transform=_corrected)
    return _read(spark, target)


@query
def append_load(spark, sf):
    target = work_path(spark, "table")
    loads.full_refresh(_load_rows(spark, sf), target)
    loads.append(_load_rows(spark, sf), target, transform=_corrected)
    return _read(spark, target)


def _reload(spark, sf, window: dates.Window, new: DataFrame) -> DataFrame:
    target = _loaded(spark, sf)
    for _ in range(2):  # a rerun changes nothing
        loads.reload_range(new, target, "calday", window)
    return _read(spark, target)


@query
def two_day_reload(spark, sf):
    window = dates.two_days(LOAD_DAY)
    new = readers.slice_days(_corrected(_load_rows(spark, sf)), "calday", window)
    return _reload(spark, sf, window, new)


@query
def month_reload(spark, sf):
    """The window reaches past the target day; days without new rows are emptied."""
    window = dates.current_month(LOAD_DAY, dt.date(2024, 2, 29))
    new = readers.slice_days(_corrected(_load_rows(spark, sf)), "calday", dates.month_to_date(LOAD_DAY))
    return _reload(spark, sf, window, new)


@query
def month_refresh(spark, sf):
    window = dates.month_of(LOAD_DAY)
    new = readers.slice_days(_corrected(_load_rows(spark, sf)), "calday", window)
    return _reload(spark, sf, window, new)


@query
def slice_copy(spark, sf):
    target = work_path(spark, "copy")
    window = dates.month_of(LOAD_DAY)
    source = _load_rows(spark, sf)
    for _ in range(2):
        loads.slice_copy(source, target, "calday", window)
    return _read(spark, target)


@query
def sharded_copy(spark, sf):
    target = work_path(spark, "sharded")
    loads.full_refresh(loads.shard(_load_rows(spark, sf), 16), target)
    return _read(spark, target)


def _doubled(df: DataFrame) -> DataFrame:
    """A later extract: one company's sales doubled."""
    amount = F.when(F.col("comp_code") == "7828", F.col("cm_cy_bapc") * 2).otherwise(F.col("cm_cy_bapc"))
    return df.withColumn("cm_cy_bapc", amount.cast("decimal(18,6)"))


@query
def sales_detail_load(spark, sf):
    """A month of the raw extract, loaded twice to the 93 target columns; then two of its days anew."""
    target, extract = work_path(spark, "sales-detail"), table(spark, sf, "sales_extract")
    for _ in range(2):
        jobs.load_sales_month(extract, target, TARGET_DAY, schema=schemas.SALES_DETAIL)
    jobs.load_sales_detail(extract, target, TARGET_DAY, transform=_doubled, schema=schemas.SALES_DETAIL)
    return spark.read.schema(schemas.SALES_DETAIL).parquet(target)


@query
def sales_table_refresh(spark, sf):
    """Sales detail as a catalog table, replaced by a later extract; an empty one is refused."""
    name, base = f"sales_{uuid.uuid4().hex}", work_path(spark, "sales-table")
    typed = clean.apply_transaction_rules(table(spark, sf, "sales_extract"), strict=True)
    for transform in (None, _doubled):
        tables.refresh_table(typed, name, base, transform=transform, schema=schemas.SALES_DETAIL, sort_keys=("calday", "zjcustbrg"))
    try:
        tables.refresh_table(typed.limit(0), name, base, schema=schemas.SALES_DETAIL)
    except loads.GuardError:
        pass
    tables.drop_old(spark, name, base)  # no reader is left on the first version
    return spark.table(name)


@query
def sales_documents(spark, sf):
    """Sales rows as JSON documents of ten, read back with their 81 typed columns."""
    path = work_path(spark, "sales-documents")
    extract = table(spark, sf, "sales_extract").select(*schemas.SALES_DOCUMENT.names)
    jobs.export_sales_documents(extract, path, order_by=["calday", "comp_code", "zjcustbrg", "zjmatrial"])
    return landed.sales_documents(landed.read_json(spark, path, landed.SALES_DOCUMENTS, multi_line=False))


@query
def row_slices(spark, sf):
    df = table(spark, sf, "pos_store_daily").select("company_code", "store_code", "jan_code", "period", "quantity")
    return rows.row_slices(df, df.columns, [(0, 10_000), (40_000, None)])


@query
def json_batches(spark, sf):
    """Batch documents written, read back and flattened; the batch shows in ``part``."""
    path = work_path(spark, "json")
    df = table(spark, sf, "pos_store_daily").select("company_code", "jan_code", "period", "quantity").withColumns(
        {"period": F.col("period").cast("string"), "quantity": F.col("quantity").cast("int")})
    export.write_json_batches(df, path, "sales", df.columns, batch=10, per_dir=1000)
    record = "array<struct<company_code:string, jan_code:string, period:string, quantity:int>>"
    docs = spark.read.schema(f"sales {record}, part bigint").json(path)
    return docs.select("part", F.size("sales").alias("batch_size"), F.explode("sales").alias("r")).select(
        "part", "batch_size", "r.*")


@query
def csv_round_trip(spark, sf):
    path = work_path(spark, "csv")
    df = table(spark, sf, "pos_goods").select(
        "sku", "large_manufacturer", "middle_category", "large_pkg",
        F.col("quantity").cast("decimal(18,4)").alias("quantity"))
    export.write_csv(df, path)
    return readers.read_csv_files(spark, path, df.schema, header=True)


@query
def import_reconcile(spark, sf):
    return audit.reconcile(standins.import_logs(spark, sf), "run", "line")


@query
def usage_load(spark, sf):
    """One usage sheet with a total column, loaded to its two tables."""
    totals, days = work_path(spark, "usage-totals"), work_path(spark, "usage-days")
    jobs.load_usage(standins.usage_wide(spark, sf, with_total=True), totals, days)
    total = spark.read.parquet(totals).select("email", F.lit(None).cast("date").alias("day_of_usage"), F.col("usage_ar").cast("float"))
    return total.unionByName(spark.read.parquet(days).select("email", "day_of_usage", "usage_ar"))


@query
def rejected_rows(spark, sf):
    """Rows that can't be read: cut documents, days that are no days, and lines of CSV beside the lines that can."""
    texts = table(spark, sf, "activity").select(
        "Id", F.concat(F.lit('{"root": [{"Id": "'), "Id", F.when(F.col("Workload").isNull(), F.lit("")).otherwise(F.lit('"}]}'))).alias("doc"))
    _, documents = landed.split_json(texts, "doc", schemas.ACTIVITY_DOCUMENT)
    raw = table(spark, sf, "raw_transactions")
    raw = raw.withColumn("calday", F.when(F.col("line") == 7, F.lit("20211345")).otherwise(F.col("calday")))
    _, days = clean.split_unreadable(raw)
    accepted, rejects = _weekly_lines(spark, sf)
    return rows.append_frames(
        documents.select(F.lit("document").alias("kind"), F.col("Id").alias("key"), F.lit("doc").alias("reason")),
        days.select(F.lit("day").alias("kind"), F.concat_ws("-", "doc", F.col("line").cast("string")).alias("key"), "reason"),
        accepted.select(F.lit("accepted").alias("kind"), F.concat_ws(",", "company_code", F.coalesce("store_code", F.lit("")), "period").alias("key"), F.lit(None).cast("string").alias("reason")),
        rejects.select(F.lit("line").alias("kind"), F.col("line").alias("key"), "reason"))


def _weekly_lines(spark, sf) -> tuple[DataFrame, DataFrame]:
    """CSV lines, some cut short and some without a readable day, loaded to a table and a reject table."""
    base = work_path(spark, "lines")
    number = F.col("company_code").cast("bigint")
    day = F.when(number % 3 == 0, F.lit("no day")).otherwise(F.col("period").cast("string"))
    line = F.when(number % 7 == 0, F.col("company_code")).otherwise(F.concat_ws(",", "company_code", F.coalesce("store_code", F.lit("")), day))
    table(spark, sf, "pos_periods").select(line.alias("value")).write.text(f"{base}/csv")
    judged = readers.judged_csv_files(spark, f"{base}/csv", schemas.POS_PERIOD_LIST)
    loads.load_accepted(judged, f"{base}/weekly", f"{base}/rejects", "weekly", max_rejects=10**9)
    return spark.read.parquet(f"{base}/weekly"), spark.read.parquet(f"{base}/rejects")


@query
def guarded_loads(spark, sf):
    """What refused loads report; the table they aimed at keeps its rows."""
    runs = audit.JobRuns(spark, work_path(spark, "job-runs"))
    target = work_path(spark, "table")
    whole = _load_rows(spark, sf)
    loads.full_refresh(whole, target)
    wanted = whole.drop("district_code").schema
    refused = {
        "columns": lambda: loads.full_refresh(whole, target, schema=wanted),
        "cap": lambda: loads.full_refresh(whole.limit(3), target, max_rows=2),
        "transform": lambda: loads.full_refresh(whole, target, transform="no function"),
        "command": lambda: readers.query_scan(spark, "drop table nothing"),
    }
    for job, load in refused.items():
        try:
            runs.run(job, load)
        except (loads.GuardError, TypeError):
            pass
    left = spark.read.parquet(target).agg(F.count("*").alias("row_count"))
    return runs.table().select("job", "status", "message").crossJoin(left)  # one row


@query
def job_run_audit(spark, sf):
    """Reports of a refresh, a reload and a refused load, without their times."""
    runs = audit.JobRuns(spark, work_path(spark, "job-runs"))
    target = work_path(spark, "table")
    whole = _load_rows(spark, sf)
    window = dates.month_of(LOAD_DAY)
    month = readers.slice_days(whole, "calday", window)
    runs.run("refresh", lambda: loads.full_refresh(whole, target, day="calday"))
    runs.run("reload", lambda: loads.reload_range(month, target, "calday", window), processed=LOAD_DAY)
    try:
        runs.run("empty", lambda: loads.full_refresh(whole.where(F.lit(False)), target, day="calday"))
    except loads.GuardError:
        pass
    return runs.table().select("job", "processed_date", "row_count", "truncated", "target_first",
                               "target_last", "status", "message")


@query
def date_list(spark, sf):
    """All day keys between the first and last order of each priority."""
    orders = readers.read_source(spark, f"{sf}/orders.parquet", columns=["o_orderpriority", "o_orderdate"])
    spans = orders.groupBy("o_orderpriority").agg(
        F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last"))
    return dates.date_list(spans, "first", "last").select("o_orderpriority", "day_key")


@query
def date_windows(spark, sf):
    orders = readers.read_source(spark, f"{sf}/orders.parquet", columns=["o_orderdate"])
    days = orders.select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return days.select("day", *[c.alias(n) for n, c in dates.date_windows("day").items()])


@query
def epoch_wall_clock(spark, sf):
    rows_ = table(spark, sf, "visit_rows")
    return rows_.select("session_uid", "start_time", clean.epoch_to_wall("start_time").alias("wall"))


# Streams.

@query
def activity_ingest(spark, sf):
    docs_path, target = work_path(spark, "activity-docs"), work_path(spark, "activity")
    texts = standins.activity_texts(spark, sf)
    # Three landing files, read one per batch.
    texts.select("doc").repartition(3).write.text(docs_path)
    documents = activity_stream.read_documents(spark, docs_path, schemas.ACTIVITY_DOCUMENT, max_files=1)
    stream = activity_stream.activity_ingest(documents, target, work_path(spark, "activity-checkpoint"))
    stream.awaitTermination()
    return spark.read.schema(schemas.ACTIVITY_EVENT).parquet(target)


@query
def pulse_incremental(spark, sf):
    """Rows arrive in two batches; those of some customers have no day."""
    detail, customers, materials = _star(spark, sf)
    detail = detail.withColumn("calday", F.when(~F.col("zjcustbrg").endswith("7"), F.col("calday")))
    wanted = [*pulse_stream.KEYS, *sales.PULSE_SUMS]
    landing, target = work_path(spark, "detail"), work_path(spark, "pulse")
    detail.select(*wanted).repartitionByRange(2, "calday").write.options(**loads.STORED).parquet(landing)
    schema = spark.read.parquet(landing).schema
    stream = pulse_stream.pulse_incremental(
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing),
        customers, materials, target, work_path(spark, "pulse-checkpoint"))
    stream.awaitTermination()
    result = spark.read.parquet(target)
    return result.select(F.col("calday").cast("date").alias("calday"),
                         *[c for c in sales.PULSE_KEYS[1:]], *sales.PULSE_MEASURES)
