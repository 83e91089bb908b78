"""Star-join rules on hand-made tables, against the plain form of the same query."""

import datetime as dt
import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.operators import joins
from shelfline.plans import equipment, pos, sales
from shelfline.sources.report import BUDGET_DRINKS, BUDGET_OTHER, DATA_USUAL, DATA_VENDING, ReportBranch

D = dt.date(2021, 1, 1)
MEASURES = [f"cm_{y}_{m}" for m in ("bapc", "nsr", "cogs", "gp") for y in ("cy", "ly")]


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def master(spark, schema, rows):
    filled = [{n: r.get(n) for n in schema.names} for r in rows]
    return spark.createDataFrame([tuple(r.values()) for r in filled], schema)


@pytest.fixture
def star(spark):
    keys = [("c1", "m1"), ("c1", "m1"), ("c2", "m1"), ("gone", "m1"), ("lost", "m1"), (None, "m2"), ("c1", "gone")]
    rows = [(D, c, m, "7828", *[Decimal(i + 1)] * 8) for i, (c, m) in enumerate(keys)]
    detail = spark.createDataFrame(
        rows, "calday date, zjcustbrg string, zjmatrial string, comp_code string, "
        + ", ".join(f"{m} decimal(18,6)" for m in MEASURES))
    customers = master(spark, schemas.CUSTOMER_MASTER, [
        {"zjcust": "c1", "zero_region___t": "east", "zjdfflg": DATA_USUAL, "zjdivold2": "13", "zjddexfl___t": "送信対象"},
        {"zjcust": "c2", "zero_region___t": "west", "zjdfflg": DATA_VENDING, "zjdivold2": "35"},
        {"zjcust": "c2", "zero_region___t": "west", "zjdfflg": DATA_VENDING, "zjdivold2": "35"},
        {"zjcust": None, "zero_region___t": "nowhere"},
    ])
    materials = master(spark, schemas.MATERIAL_MASTER, [
        {"zjmate": "m1", "zjejbrand___t": "b1", "zjbudtf": BUDGET_DRINKS},
        {"zjmate": "m2", "zjejbrand___t": "b2", "zjbudtf": BUDGET_OTHER},
        {"zjmate": "m2", "zjejbrand___t": "b3", "zjbudtf": BUDGET_OTHER},
    ])
    return detail, customers, materials


def plain_pulse(detail, customers, materials):
    joined = (detail.join(customers, F.col("zjcustbrg") == F.col("zjcust"), "left")
              .join(materials, F.col("zjmatrial") == F.col("zjmate"), "left"))
    names = {**sales.PULSE_CUSTOMER, **sales.PULSE_MATERIAL}
    return joined.groupBy("calday", *[F.col(c).alias(n) for n, c in names.items()]).agg(
        *[F.sum("cm_{1}_{0}".format(*m.rsplit("_", 1))).cast("decimal(28,6)").alias(m)
          for m in sales.PULSE_MEASURES])


@pytest.mark.parametrize("limit", [joins.BROADCAST_LIMIT, 0])
def test_pulse_equals_the_plain_query(star, limit, monkeypatch):
    """Copies in a master multiply; keys without a master row share one null group."""
    monkeypatch.setattr(joins.fit, "__kwdefaults__", {"limit": limit})
    got = sales.business_pulse(*star)
    assert bag(got) == bag(plain_pulse(*star))
    assert bag(got.where(F.col("customer_id").isNull()).select("brand", "bapc_cy")) == Counter(
        [("b1", Decimal(9)), ("b2", Decimal(6)), ("b3", Decimal(6))])


def test_pulse_moves_the_fact_once_for_each_large_master(spark, star, monkeypatch):
    detail, customers, materials = star
    # A day and key of two rows, and variants of one key in the customer master.
    detail = detail.union(detail.where("zjcustbrg = 'gone' or zjmatrial = 'gone'").withColumn("calday", F.lit(None).cast("date"))).union(detail)
    customers = customers.union(customers.where("zjcust = 'c1'").withColumn("zero_region___t", F.lit("north")))
    expected = bag(plain_pulse(detail, customers, materials))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for small, moves in (([False, False], 2), ([False, True], 1), ([True, False], 2)):
            monkeypatch.setattr(sales, "fit", lambda *sides, small=small: small)
            got = sales.business_pulse(detail, customers, materials)
            assert bag(got) == expected
            final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            # Rows with unknown keys come from the same shuffles as the others.
            own = [line for line in final.splitlines() if "ReusedExchange" not in line]
            assert sum(bool(re.search(r"Exchange hashpartitioning\((zjcustbrg|zjmatrial)#", line)) for line in own) == moves
            assert sum("Exchange hashpartitioning(calday#" in line for line in own) == 1  # of rows with an unknown key
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pulse_limit_orders_nulls_last(star):
    regions = [r.region for r in sales.business_pulse(*star, limit=50).collect()]
    assert regions == sorted([r for r in regions if r]) + [None] * regions.count(None)


def test_branches_keep_repeats(star):
    detail, customers, materials = star
    both = (ReportBranch("one", (BUDGET_DRINKS,), (DATA_USUAL, DATA_VENDING)), ReportBranch("two", (BUDGET_DRINKS, BUDGET_OTHER), (DATA_VENDING,)))
    union = sales.sales_union(detail, customers, materials, both)
    assert union.columns == detail.columns
    # c1 fits one branch; c2 fits two branches and has two master rows.
    assert Counter(r.zjcustbrg for r in union.collect()) == {"c1": 2, "c2": 4}


def test_branch_company_and_sending(star):
    detail, customers, materials = star
    sending = (ReportBranch("s", (BUDGET_DRINKS,), (DATA_USUAL, DATA_VENDING), sending="送信対象"),)
    assert {r.zjcustbrg for r in sales.sales_union(detail, customers, materials, sending).collect()} == {"c1"}
    other = (ReportBranch("o", (BUDGET_DRINKS,), (DATA_USUAL, DATA_VENDING), company="1000"),)
    assert sales.sales_union(detail, customers, materials, other).isEmpty()


def test_rollup_skips_blank_weeks(spark):
    names = [*sales.ROLLUP_KEYS, *sales.ROLLUP_MEASURES]
    row = {n: "k" for n in sales.ROLLUP_KEYS} | {n: Decimal(1) for n in sales.ROLLUP_MEASURES}
    kinds = ", ".join(f"{n} {'string' if n in sales.ROLLUP_KEYS else 'decimal(18,6)'}" for n in names)
    df = spark.createDataFrame([tuple((row | {"bw_calday_week": w})[n] for n in names) for w in ("w", "w", "", None)], kinds)
    out = sales.sales_rollup(df).collect()
    assert [(r.bw_calday_week, r.num_transactions, r.cm_ly_mp) for r in out] == [("w", 2, Decimal(2))]


def test_weekly_report_trims_and_multiplies(spark):
    weekly = spark.createDataFrame([("c", "j", D, Decimal(3), Decimal(10))],
                                   "company_code string, jan_code string, period date, quantity decimal(34,4), "
                                   "amount_of_money decimal(34,4)")
    periods = spark.createDataFrame([("c", None, D), ("c", "S1", D), ("d", None, D)], schemas.POS_PERIOD_LIST)
    goods = spark.createDataFrame([("  j ", Decimal(24), "L", "M", "C")],
                                  "sku string, quantity decimal(34,4), large_pkg string, large_manufacturer string, "
                                  "middle_category string")
    company = spark.createDataFrame([("c", "n", "s", "h", "d", "ch", "l3", "en", Decimal("0.5"))], schemas.POS_COMPANY)
    row = pos.weekly_report(weekly, periods, goods, company).first()
    assert (row.sum_amount_of_money, row.sum_quantity, row.sum_quantity_converted) == (10, 3, 72)


def test_route_flags(spark):
    routes = spark.createDataFrame([("1", "W", "r", None), ("1", "W", "r", ""), ("1", "W", "r", "1"), ("1", "W", "r", "2")],
                                   "zkzkunnr string, zkzpdwerks string, zkzpdcroute string, zresalcod string")
    customers = spark.createDataFrame([("1", "one", None, None, "M3"), ("2", "two", None, None, "M9")],
                                      "kunnr string, name2 string, ccc_season_start1 string, ccc_season_end1 string, kdkg5 string")
    divisions = spark.createDataFrame([("W", "w", "d", "r", "35"), ("V", "v", "d", "r", "21")],
                                      "zkzpdwerks string, zkzpdwerksnm string, divisionnm string, regionnm string, oldbottler1cd string")
    out = equipment.customer_route_report(routes, customers, divisions)
    assert bag(out.select("representative_code", "representative_name", "representative_differs", "rs_fs")) == Counter(
        [(None, None, "", "RS"), ("", None, "", "RS"), ("1", "one", "", "RS"), ("2", "two", "X", "RS")])
