"""Nested visit documents and masters, read from landed JSON files."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from shelfline import schemas
from shelfline.operators import visits as V
from shelfline.plans import jobs
from shelfline.sinks.guards import GuardError
from shelfline.sources import landed

P = "ACME_"


def kpi(name, uids=(), results=(), **values):
    return {"name": P + name, "entities": [{"uid": u} for u in uids], "numerator": 2, "denominator": 4,
            "result": 0.5, "score": 0.25, "results": list(results), **values}


def visit(**changes):
    return {
        "session_uid": "s1", "visitor_identifier": "v@example.com", "session_date": "2021-05-01",
        "session_start_time": 1600000000, "session_end_time": "open", "visit_type_name": "t",
        "GPS_coordinates_latitude": 35.1, "GPS_coordinates_longitude": 139, "store_number": 77,
        "store_GPS_coordinates_latitude": None, "store_GPS_coordinates_longitude": None,
        "details": {
            "kpis": [
                kpi(V.POC_COUNT, ["p"]), kpi(V.POC_COUNT), kpi(V.RED), kpi(V.UNIQUE, ["m"]), kpi("UNKNOWN", ["q"]),
                kpi(V.MSL_STORE, ["x"], [kpi(V.MSL_PRODUCT, ["prod"], result="Must"), kpi("NOISE", ["n"])]),
                kpi(V.SOVI_STORE_OWN, [], [kpi(V.SOVI_STORE_ALL, ["maker"])]),
                kpi(V.SOVI_CATEGORY_OWN, [], [kpi(V.SOVI_STORE_ALL, ["wrong parent"])]),
            ],
            "images": [{"scene_id": 1, "scene_images": [
                {"image_uid": "i1", "capture_time": 1600000000, "image_urls": {"original": "o", "small": "s"}},
                {"image_uid": "i2", "capture_time": None, "image_urls": None}]}],
        }, **changes}


@pytest.fixture
def documents(spark, tmp_path):
    folder = tmp_path / "visits"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(visit(), indent=1))
    (folder / "b.json").write_text(json.dumps(visit(session_uid="s2", details={"kpis": [], "images": []})))
    return landed.visits(spark, str(folder))


def test_facts(documents):
    facts = {n: df.collect() for n, df in V.visit_facts(documents, prefix=P).items()}
    assert len(facts) == 9
    assert sorted((r.poc_type or "", r.location) for r in facts["poc"]) == [("", None), ("p", None)]
    first = facts["poc"][0]
    assert first.visit_date == dt.date(2021, 5, 1)
    assert first.start_time == dt.datetime(2020, 9, 13, 21, 26, 40) and first.end_time is None
    assert (first.customer_code, first.gps_latitude, first["count"]) == ("77", "35.1", 2)
    assert [(r.product_code, r.availability, r.msl_type) for r in facts["msl_product"]] == [("prod", 2, "Must")]
    assert [(r.manufacturer, r.sovi) for r in facts["sovi_store"]] == [("maker", Decimal("0.5"))]
    assert facts["sovi_category"] == [] and facts["poc_score"] == []
    assert [r.red_score for r in facts["red"]] == [Decimal("0.5")]
    assert [(r.image_uid, r.image_url_original, r.image_url_medium) for r in facts["photo"]] == [
        ("i1", "o", None), ("i2", None, None)]


def test_load_writes_what_the_facts_hold(spark, documents, folder):
    paths = {n: folder(n) for n in (*V.KPI_FACTS, V.PHOTO)}
    results = V.load_visit_facts(documents, paths, folder("staging"), prefix=P, max_rows=10)
    V.load_visit_facts(documents, paths, folder("staging"), prefix=P)  # a rerun changes nothing
    with pytest.raises(GuardError):
        V.load_visit_facts(documents.limit(0), paths, folder("staging"), prefix=P)
    for name, df in V.visit_facts(documents, prefix=P).items():
        assert results[name].row_count == df.count()
        stored = spark.read.schema(df.schema).parquet(paths[name]).select(*df.columns)
        assert sorted(map(str, stored.collect())) == sorted(map(str, df.collect()))


def test_row_cap_stops_all_targets(spark, documents, folder):
    paths = {n: folder(n) for n in (*V.KPI_FACTS, V.PHOTO)}
    with pytest.raises(GuardError):
        V.load_visit_facts(documents, paths, folder("staging"), prefix=P, max_rows=1)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(paths["red"])


def test_stores_and_products(spark, tmp_path, folder):
    store = {"store_number": "1", "city": "Tokyo", "district_name": "d", "store_display_name": "show",
             "store_additional_attributes": {"additional_attribute_4": "acc"}}
    other = {**store, "store_number": "2", "city": "Kyoto"}
    (tmp_path / "stores.json").write_text(json.dumps({"store": [store, other]}))
    pages = landed.read_json(spark, str(tmp_path / "stores.json"), schemas.STORE_PAGE)
    jobs.load_store_master(pages, folder("store"))
    row, = spark.read.parquet(folder("store")).collect()
    assert len(row) == 42
    assert (row.customer_code, row.account_code, row.channel, row.segment, row.prefecture) == (
        "1", "acc", "Null", "blank", "d")
    jobs.load_store_master(pages, folder("small"), small=True)
    small = spark.read.parquet(folder("small"))
    assert small.columns == schemas.STORE_MASTER_SMALL.names
    assert {(r.customer_code, r.channel) for r in small.collect()} == {("1", " "), ("2", " ")}

    page = {"product": [{"pk": "p", "images": [{"image_url": "u"}, {"image_url": "w"}]}, {"pk": "q"}, {"pk": "r", "images": []}]}
    (tmp_path / "products.json").write_text(json.dumps(page))
    pages = landed.read_json(spark, str(tmp_path / "products.json"), schemas.PRODUCT_PAGE)
    jobs.load_product_master(pages, folder("product"))
    stored = spark.read.parquet(folder("product"))
    assert len(stored.columns) == 21
    assert {(r.product_code, r.images) for r in stored.collect()} == {("p", "u"), ("q", None), ("r", None)}


def test_people_pages_and_hr_job(spark, tmp_path, folder):
    def page(name, schema, *rows):
        full = [{c: r.get(c) for c in schema.names} for r in rows]
        (tmp_path / f"{name}.json").write_text(json.dumps({"d": {"results": full}}))
        return landed.people(landed.read_json(spark, str(tmp_path / f"{name}.json"), schemas.hr_page(schema)))

    person = page("person", schemas.HR_PERSON, {"personIdExternal": "1", "lastName": "A"}, {"personIdExternal": "2"})
    email = page("email", schemas.HR_EMAIL, {"personIdExternal": "1", "emailAddress": "a@example.com"},
                 {"personIdExternal": None, "emailAddress": "n@example.com"})
    job = page("job", schemas.HR_JOB, {"userId": "1", "department": "0000000002", "jobCode": "J2", "emplStatus": "1991"},
               {"userId": "1", "department": "0000000001", "jobCode": "J1", "emplStatus": "1987"},
               {"userId": "1", "department": "0000000001", "jobCode": "J0", "emplStatus": "2000"},
               {"userId": "2", "department": "old", "emplStatus": "1996"})
    dept = page("dept", schemas.HR_DEPARTMENT,
                {"externalCode": "0000000001", "customString8": "L0", "name_localized": "本社1", "customString1": "HQ"},
                {"externalCode": "0000000002", "parent": "0000000001", "customString8": "L1", "name_localized": "営業"},
                {"externalCode": "old", "customString8": "L1"}, {"externalCode": "0000000003"})
    with pytest.raises(GuardError):
        jobs.load_hr_master(person, email, job.drop("emplStatus"), dept, folder("hr"))
    assert jobs.load_hr_master(person, email, job, dept, folder("hr")).row_count == 1
    row = spark.read.parquet(folder("hr")).first()
    assert (row.EmployeeCode, row.Email, row.DepartmentCode) == ("1", "a@example.com", "0000000001")
    # A name holding a digit is blanked, a null becomes one space.
    assert (row.L0Code, row.L0NameEN, row.L0NameJP, row.L1Code, row.MiddleNameEN) == ("0000000001", "HQ", " ", " ", " ")


def test_activity_documents(spark, tmp_path):
    day = tmp_path / "Audit.General" / "20240115"
    day.mkdir(parents=True)
    event = {"CreationTime": "t", "Id": "1", "Operation": "o", "Workload": "w", "UserId": "u", "Extra": 1}
    (day / "x.json").write_text(json.dumps({"root": [event, {**event, "Id": None}, {**event, "Id": "2"}]}))
    documents = landed.activity_documents(spark, str(tmp_path / "*" / "*"))
    for _ in range(2):
        assert jobs.load_activity(documents, str(tmp_path / "loaded")).row_count == 2
    assert spark.read.parquet(str(tmp_path / "loaded")).where("scope = 'Audit.General'").count() == 2
    events = landed.activity_events(documents)
    assert {(r.scope, r.day_key, r.Id) for r in events.collect()} == {
        ("Audit.General", "20240115", "1"), ("Audit.General", "20240115", "2")}


def test_sales_documents(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"sales": [{"calyear": "2020", "cm_cy_nsr": 7}, {"calyear": "2021"}]}))
    rows = landed.sales_documents(landed.read_json(spark, str(tmp_path / "s.json"), landed.SALES_DOCUMENTS))
    assert len(rows.columns) == 81
    assert sorted((r.calyear, r.cm_cy_nsr) for r in rows.select("calyear", "cm_cy_nsr").collect()) == [
        ("2020", Decimal(7)), ("2021", None)]


def test_a_text_is_computed_before_it_is_parsed(spark):
    rows = spark.range(4).selectExpr("if(id = 3, null, to_json(struct(id as store_number, 'v' as session_uid))) as doc", "id")
    got = landed.parse_json(rows, "doc", schemas.VISIT)
    assert got.columns == ["id", *schemas.VISIT.names]
    assert sorted((r.id, r.store_number, r.session_uid) for r in got.collect()) == [
        (0, "0", "v"), (1, "1", "v"), (2, "2", "v"), (3, None, None)]
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    parsed, = [line for line in plan if "from_json" in line]
    assert "StructsToJson" not in parsed and "to_json" not in parsed  # the parser reads a column
    assert any("StructsToJson" in line or "to_json" in line for line in plan)
    broken = spark.createDataFrame([('{"details": {"images": [{"scene_id": "1", "scene_images": 5}]}}',)], "doc string")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):  # also in a field that no fact reads
        V.visit_fact(landed.parse_json(broken, "doc", schemas.VISIT), "sovi_category").collect()


def test_a_visit_header_is_computed_once_for_all_its_parts(spark):
    from shelfline.catalog import standins

    visits = standins.visits(spark, "/root/testdata/sf0.001")
    for df in (V.visit_parts(visits), V.visit_fact(visits, "poc")):
        above, below = df._jdf.queryExecution().optimizedPlan().toString().split("Generate explode", 1)
        assert "convert_timezone" in below and "convert_timezone" not in above
