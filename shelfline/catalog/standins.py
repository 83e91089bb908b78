"""Stand-in tables derived from the star schema.

Each is SQL in the subset Spark and DuckDB share, with ``{table}`` for its
inputs, so that a query and its check start from the same rows. Measures are
cast to decimals before any product, so no sum depends on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.operators import visits as V
from shelfline.operators.rows import pieces_of
from shelfline.schemas import MARGIN_MEASURES

BASE = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Rates have few digits, so that a price times a rate still fits a compact decimal.
_CASTS = """cast(l_quantity as decimal(12,2)) as q, cast(l_extendedprice as decimal(12,2)) as e,
 cast(l_discount as decimal(4,2)) as d, cast(l_tax as decimal(4,2)) as t"""
#: Lines with their four amounts cast once.
_LINES = f"(select *, {_CASTS} from {{lineitem}})"
_Q, _E, _D, _T = "q", "e", "d", "t"
_MEASURE = {
    "bapc": _Q, "barasu": f"{_Q} * 24", "nsr": f"{_E} * (1 - {_D})", "cogs": f"{_E} * 0.6",
    "pc": f"{_E} * {_T}", "rb": f"{_E} * {_D}", "gp": f"{_E} * (1 - {_D}) - {_E} * 0.6",
    "fscom": f"{_E} * 0.01", "logistics_cst": f"{_E} * 0.02", "sal_del_cst": f"{_E} * 0.03",
    "cen_shp_cst": f"{_E} * 0.04", "cent_fee": f"{_E} * 0.05", "bs_en_fee": f"{_E} * 0.06",
    "trp_cst": f"{_E} * 0.07", "mp": f"{_E} * 0.08", "jr_opr_cst": f"{_E} * 0.09",
    "jr_tr_fee": f"{_Q} * 0.5",
}


def _year_case(measure: str, status: str) -> str:
    return (f"cast(case when l_linestatus = '{status}' then {_MEASURE[measure]} else 0 end"
            " as decimal(18,6))")


_CM = ",\n".join(
    f"{_year_case(m, s)} as cm_{y}_{m}" for m in MARGIN_MEASURES for y, s in (("cy", "O"), ("ly", "F")))


def _signed(measure: str, factor: str = "1") -> str:
    return (f"cast((case when l_linestatus = 'O' then {_MEASURE[measure]} else 0 - ({_MEASURE[measure]}) end)"
            f" * {factor} as decimal(18,6))")


_DAY = "cast(o_orderdate as date)"

SQL: dict[str, str] = {}

SQL["detail"] = f"""
select substring(cast({_DAY} as string), 1, 4) as calyear,
 substring(cast({_DAY} as string), 1, 7) as calmonth,
 {_DAY} as calday,
 cast(l_shipdate as date) as budat,
 cast({_DAY} + interval '2' day as date) as bw_calday_week,
 case when l_linestatus = 'O' then 'CY' else 'LY' end as year_ind,
 concat('78', lpad(cast(l_suppkey % 100 as string), 2, '0')) as comp_code,
 cast(o_custkey as string) as zjcustbrg,
 cast(l_partkey as string) as zjmatrial,
 concat('Q', cast(quarter({_DAY}) as string)) as zj445qatr,
 lpad(cast(weekofyear({_DAY}) as string), 2, '0') as zj445week,
 cast({_DAY} - interval '1' year as date) as calday_prevyear,
 cast({_DAY} - interval '364' day as date) as calday_week_prevyear,
 concat('P', cast(l_suppkey % 10 as string)) as werks,
 l_returnflag as ww202,
 concat('Plant ', cast(l_suppkey % 10 as string)) as plant_t,
 {_CM},
 {_signed("bapc")} as cm_bapc_vs_ly_diff_cl,
 {_signed("bapc", "0.01")} as cm_bapc_vs_ly_percent_cl,
 {_year_case("gp", "O")} as cm_cy_gp_bapc,
 {_signed("nsr")} as cm_nsr_vs_ly_diff_cl,
 {_signed("nsr", "0.01")} as cm_nsr_vs_ly_percent_cl
from {_LINES} l join {{orders}} o on l_orderkey = o_orderkey
"""



def _extract_column(name: str, kind: str, computed: str) -> str:
    """One column of the raw sales extract: days and months as plain text, the rest as ``detail`` has it or near it."""
    if kind == "date" or name == "calmonth":
        return f"replace(cast({name} as string), '-', '') as {name}"
    if f" as {name}" in computed:
        return name
    if name.endswith(("_cy", "_ly")) or name.startswith("cm_"):
        year = "ly" if "_ly" in name else "cy"
        return f"cast(cm_{year}_nsr as {kind}) as {name}"
    return "zjmatrial as zjmatagsp" if name == "zjmatagsp" else f"'{name[:1].upper()}' as {name}"


_EXTRACT = ", ".join(_extract_column(f.name, f.dataType.simpleString(), SQL["detail"]) for f in schemas.SALES_DETAIL)
SQL["sales_extract"] = f"select {_EXTRACT} from ({SQL['detail']}) d"

_BOTTLERS = ("13", "21", "22", "23", "24", "28", "32", "39", "35", "42")
_BOTTLER = "case c_nationkey % 10 " + " ".join(
    f"when {i} then '{b}'" for i, b in enumerate(_BOTTLERS)) + " end"

SQL["customers"] = f"""
select cast(c_custkey as string) as zjcust, r_name as zero_region___t,
 cast(r_regionkey as string) as _zero_region, r_name as _zero_region___t,
 concat(r_name, '県') as zjsreigp___t,
 'L1' as zjbjiclv1, 'All channels' as zjbjiclv1___t,
 substring(c_mktsegment, 1, 3) as zjbjiclv2, c_mktsegment as zjbjiclv2___t,
 concat('M', cast(c_custkey % 5 as string)) as zjbjicl_m,
 concat('Channel ', cast(c_custkey % 5 as string)) as zjbjicl_m___t,
 n_name as zjsreigce, {_BOTTLER} as zjdivold2,
 case when c_custkey % 13 = 0 then concat(cast(c_custkey % 3 as string), ': other label')
  else case c_custkey % 3 when 0 then '0:通常' when 1 then '2: Vending_OCS (223)' else '3: 営業本部外' end end as zjdfflg,
 case when c_custkey % 7 = 0 then '対象外' else '送信対象' end as zjddexfl___t,
 concat('G', cast(r_regionkey as string)) as zjdivgcd, r_name as zjdivgcd___t,
 concat('D', cast(n_nationkey as string)) as zjdivcd, n_name as zjdivcd___t,
 concat(n_name, ' (EN)') as zjregione,
 concat('B', cast(n_nationkey % 7 as string)) as zjrgncd,
 concat('Branch ', cast(n_nationkey % 7 as string)) as zjrgncd___t,
 concat('S', cast(c_custkey % 11 as string)) as zjslsctcd,
 concat('Center ', cast(c_custkey % 11 as string)) as zjslsctcd___t,
 concat('Center ', cast(c_custkey % 11 as string), ' (EN)') as zjresidne___t,
 concat('T', cast(c_custkey % 50 as string)) as zjsrtanto,
 concat('Seller ', cast(c_custkey % 50 as string)) as zjsrtanto___t,
 concat('K', cast(c_custkey % 4 as string)) as zjchncd,
 concat('Kind ', cast(c_custkey % 4 as string)) as zjchncd___t,
 cast(c_custkey as string) as zjdlrc, c_name as zjdlrc___t,
 concat('E', cast(c_custkey % 50 as string)) as zjcdsrecd,
 concat('Employee ', cast(c_custkey % 50 as string)) as zjcdsrecd___t,
 concat('A', cast(c_custkey % 200 as string)) as zjlocacd,
 concat('Location ', cast(c_custkey % 200 as string)) as zjlocacd___t,
 concat('W', cast(c_custkey % 10 as string)) as zjsmwerks,
 concat('R', cast(c_custkey % 20 as string)) as zjsmpdroc
from {{customer}} c join {{nation}} n on c_nationkey = n_nationkey
 join {{region}} r on n_regionkey = r_regionkey
"""

SQL["materials"] = """
select cast(p_partkey as string) as zjmate, p_name as zjmate___t,
 concat('49', lpad(cast(p_partkey as string), 11, '0')) as zjancd,
 concat('Maker ', cast(p_size % 5 as string)) as zjbevmnc___t,
 substring(p_type, 1, 2) as zjcatcd,
 case when p_type = 'PROMO' then 'ｱﾙｺｰﾙ' else p_type end as zjcatcd___t,
 cast(p_size as string) as zjddcscd, concat(cast(p_size as string), ' ml') as zjddcscd___t,
 cast(p_size % 3 as string) as zjddctcd,
 case p_size % 3 when 0 then 'CAN' when 1 then 'PET' else 'BIB' end as zjddctcd___t,
 cast(p_size % 6 as string) as zjddpkcd, concat('DPK ', cast(p_size % 6 as string)) as zjddpkcd___t,
 p_brand as zjejbrand, concat(p_brand, ' (JP)') as zjejbrand___t, concat(p_brand, ' (EN)') as zjdbrdcd___t,
 case when p_size > 25 then 'NEW' else null end as zjnewprdc___t,
 cast(p_size % 8 as string) as zjpackcd, concat('Pack ', cast(p_size % 8 as string)) as zjpackcd___t,
 concat('2020', lpad(cast(p_size % 12 + 1 as string), 2, '0'), '01') as zjreldt,
 concat('RPP ', cast(p_size % 4 as string)) as zjrpppkg___t,
 substring(p_type, 1, 1) as zjsbcatcd, concat(p_type, ' sub') as zjsbcatcd___t,
 concat(p_type, ' 小') as zjsubcatc___t,
 cast(p_partkey as string) as zjmatagsp, p_name as zjmatagg___t,
 case when p_size % 11 = 0 then 'X:other label'
  else case p_size % 4 when 0 then 'X:バジェット対象(飲料製品)' when 1 then 'Y:バジェット対象(飲料以外・KO-EAST/FV)'
   when 2 then 'Z:バジェット対象(飲料以外・FVのみ)' else 'N:対象外' end end as zjbudtf
from {part} p
"""

SQL["plan"] = f"""
select replace(substring(cast({_DAY} as string), 1, 7), '-', '') as `0calmonth`,
 {_DAY} as `0calday`, cast({_DAY} - interval '364' day as date) as zjdate__zjcpdate,
 concat('A', cast(o_custkey % 5 as string)) as zjbjiara1,
 concat('B', cast(o_custkey % 9 as string)) as zjbjiara2,
 concat('M', cast(o_custkey % 7 as string)) as zjbjicl_m,
 cast({_Q} as decimal(18,6)) as zjhansu_p, cast({_E} as decimal(18,6)) as zjbjinsrp,
 cast({_E} * {_D} as decimal(18,6)) as zjgross_p, cast({_E} * {_T} as decimal(18,6)) as zjbjimp_p
from {_LINES} l join {{orders}} o on l_orderkey = o_orderkey
"""

_WEEK = "cast(date_trunc('week', l_shipdate) as date)"
SQL["pos_weekly"] = f"""
select cast(l_suppkey as string) as company_code, 'ALL' as store_code,
 cast(l_partkey as string) as jan_code, {_WEEK} as period,
 cast(sum({_Q}) as decimal(34,4)) as quantity,
 cast(sum({_E}) as decimal(34,4)) as amount_of_money,
 cast(sum({_E} * {_D}) as decimal(34,4)) as gross_profit,
 cast(max({_E}) as decimal(34,4)) as selling_price,
 cast(sum({_E} * {_T}) as decimal(34,4)) as sale_amount,
 cast(count(*) as decimal(38,4)) as number_of_visitors,
 cast({_WEEK} + interval '7' day as date) as load_date
from {_LINES} l
group by l_suppkey, l_partkey, {_WEEK}
"""
SQL["pos_periods"] = f"""
select distinct cast(l_suppkey as string) as company_code,
 case when l_suppkey % 2 = 0 then null else 'S1' end as store_code, {_WEEK} as period
from {_LINES} l
"""
SQL["pos_goods"] = """
select concat('  ', cast(p_partkey as string), '   ') as sku, cast(p_size as decimal(34,4)) as quantity,
 p_brand as large_manufacturer, p_type as middle_category,
 case when p_size > 25 then 'LARGE' else 'SMALL' end as large_pkg
from {part} p
"""
SQL["pos_companies"] = """
select cast(s_suppkey as string) as company_code, s_name as company_name, n_name as hq,
 concat('DIV', cast(s_nationkey % 4 as string)) as div,
 concat('CH', cast(s_nationkey % 6 as string)) as channel,
 concat('L3-', cast(s_suppkey % 9 as string)) as customer_l3, concat(s_name, ' (EN)') as customer_en,
 cast(cast(s_suppkey % 100 as decimal(5,0)) * 0.01 as decimal(18,10)) as nsr_ratio
from {supplier} s join {nation} n on s_nationkey = n_nationkey
"""
SQL["pos_store_daily"] = f"""
select cast(l_suppkey as string) as company_code, concat('S', cast(l_linenumber as string)) as store_code,
 cast(l_partkey as string) as jan_code, cast(l_shipdate as date) as period,
 cast({_Q} as decimal(34,4)) as quantity, cast({_E} as decimal(34,4)) as amount_of_money,
 cast({_E} * {_D} as decimal(34,4)) as gross_profit,
 cast(cast(l_orderkey % 40 as decimal(38,0)) as decimal(38,0)) as number_of_visitors,
 cast(cast(l_shipdate as date) + interval '1' day as date) as load_date
from {_LINES} l
"""

# Order days move 20 years on, so that the recoded year lies inside the data.
_LATE = f"cast({_DAY} + interval '20' year as date)"
SQL["placement"] = f"""
select cast(o_orderkey as string) as wo_no, replace(cast({_LATE} as string), '-', '') as addat,
 case when o_orderstatus = 'P' then '00000000' else replace(cast({_LATE} as string), '-', '') end as idat2,
 replace(substring(cast({_LATE} as string), 1, 7), '-', '') as target_date,
 case o_orderpriority when '1-URGENT' then '新規設置' when '2-HIGH' then '交換' when '3-MEDIUM' then '玉突'
  when '5-LOW' then '単独撤収' else '点検' end as work_name,
 cast(c_custkey as string) as sold_to, c_name as sold_to_party,
 concat('I', cast(o_orderkey % 90 as string)) as item_code,
 case when o_orderkey % 5 = 0 then null else concat('Item ', cast(o_orderkey % 90 as string)) end as item_name,
 concat('L', cast(o_orderkey % 3 as string)) as cde_type_l_name,
 concat('M', cast(o_orderkey % 4 as string)) as cde_type_m_name,
 concat('S', cast(o_orderkey % 6 as string)) as cde_type_s_name,
 concat('Pref ', cast(c_nationkey as string)) as prefecture,
 case c_mktsegment when 'AUTOMOBILE' then '' when 'BUILDING' then 'Food' when 'FURNITURE' then 'Retail'
  when 'MACHINERY' then 'SMDD' else c_mktsegment end as zjbjiclv__t
from {{orders}} o join {{customer}} c on o_custkey = c_custkey
"""
SQL["routes"] = """
select cast(o_custkey as string) as zkzkunnr, concat('W', cast(c_nationkey as string)) as zkzpdwerks,
 concat('R', cast(o_orderkey % 30 as string)) as zkzpdcroute,
 case o_orderkey % 4 when 0 then null when 1 then '' when 2 then cast(o_custkey as string)
  else cast(cast(floor(o_orderkey / 7) as bigint) as string) end as zresalcod
from {orders} o join {customer} c on o_custkey = c_custkey
"""
SQL["route_customers"] = """
select cast(c_custkey as string) as kunnr, c_name as name2,
 case when c_custkey % 2 = 0 then '20200401' else null end as ccc_season_start1,
 case when c_custkey % 5 = 0 then '20210331' else '99991231' end as ccc_season_end1,
 case c_custkey % 3 when 0 then 'M3' when 1 then 'M4' else 'M9' end as kdkg5
from {customer} c
"""
SQL["divisions"] = """
select concat('W', cast(n_nationkey as string)) as zkzpdwerks, concat(n_name, ' base') as zkzpdwerksnm,
 r_name as divisionnm, n_name as regionnm,
 case when n_nationkey % 3 = 0 then '35' else '21' end as oldbottler1cd
from {nation} n join {region} r on n_regionkey = r_regionkey
"""

# Raw extracts: days and months as text, with the sentinels of the sources.
SQL["raw_transactions"] = f"""
select cast(l_orderkey as string) as doc, l_linenumber as line, l_partkey as part_key,
 replace(substring(cast({_DAY} as string), 1, 7), '-', '') as calmonth,
 replace(cast({_DAY} as string), '-', '') as calday,
 case when l_returnflag = 'A' then null else replace(cast(cast(l_shipdate as date) as string), '-', '') end as budat,
 case when substring(cast({_DAY} as string), 6, 5) = '02-29' then ''
  else replace(cast(cast({_DAY} - interval '1' year as date) as string), '-', '') end as calday_prevyear,
 case when l_linestatus = 'O' then l_returnflag else null end as note,
 cast({_E} as decimal(18,6)) as amount
from {_LINES} l join {{orders}} o on l_orderkey = o_orderkey
"""
SQL["raw_wholesaler"] = f"""
select cast(l_suppkey as string) as wholesaler_code, concat('W', cast(l_suppkey % 7 as string)) as wholesaler_name,
 cast(l_linenumber as string) as wholesaler_centre_code, cast(l_orderkey as string) as customer_branch_code,
 substring(replace(cast(cast(l_shipdate as date) as string), '-', ''), 3, 6) as delivery_date,
 concat('49', lpad(cast(l_partkey as string), 11, '0'), '-01') as jan_code,
 cast({_Q} as string) as can_quantity
from {_LINES} l
"""
SQL["raw_pos"] = """
select cast(o_custkey as string) as account_code, cast(o_orderkey as string) as customer_code,
 replace(cast(cast(o_orderdate as date) as string), '-', '/') as duration,
 cast(cast(floor(o_totalprice) as bigint) as string) as sales_amount,
 case when o_orderstatus = 'P' then 'n/a' else cast(o_orderkey % 1000 as string) end as sales_price,
 cast(o_custkey % 77 as string) as sales_revenue, '' as customer_engagement
from {orders} o
"""

SQL["usage_counts"] = """
select cast(user_id as string) as email, cast(ts as date) as day, count(*) as n
from {events} e group by user_id, cast(ts as date)
"""

# Organisation: a tree of eight children per node over the customer keys. Some
# sections have no level, some an old code; both are dropped before the climb. The
# nations add a chain deeper than any tree of levels, whose lower half has a level
# that is not listed, and the regions a cycle with three sections leading into it.
_LEVEL = "case {d} " + " ".join(
    f"when {i} then '{lv}'" for i, lv in enumerate(
        ("L0", "L1", "L2", "L2.5", "L3", "L4-1", "L4-2", "L4-3", "L4-4", "L5-1", "L5-2", "L6"))) + " end"
_DEPTH = "(" + " + ".join(f"case when c_custkey >= {8 ** k} then 1 else 0 end" for k in range(12)) + ")"
_CODE = "case when {k} > 0 and {k} % 89 = 0 then concat('X', lpad(cast({k} as string), 9, '0')) " \
        "else lpad(cast({k} as string), 10, '0') end"
_PARENT = "cast(floor(c_custkey / 8) as bigint)"
SQL["departments"] = f"""
select case when c_custkey % 2 = 0 then concat('部', c_mktsegment) else concat('課', cast(c_custkey as string)) end
  as name_localized,
 case when c_custkey = 0 then null else {_CODE.format(k=_PARENT)} end as parent,
 {_CODE.format(k='c_custkey')} as externalCode, 'x' as cust_string17, c_name as name,
 concat('Section ', cast(c_custkey as string)) as customString1,
 case when c_custkey > 0 and c_custkey % 97 = 0 then null else {_LEVEL.format(d=_DEPTH)} end as customString8
from {{customer}} c
union all
select concat('深', cast(n_nationkey as string)), case when n_nationkey = 0 then null
  else concat('90000000', lpad(cast(n_nationkey - 1 as string), 2, '0')) end,
 concat('90000000', lpad(cast(n_nationkey as string), 2, '0')), 'x', n_name, concat('Deep ', cast(n_nationkey as string)),
 case when n_nationkey = 0 then 'L0' when n_nationkey = 1 then 'L1' else 'L7' end from {{nation}} n
union all
select concat('輪', cast(r_regionkey as string)), concat('910000000', cast((r_regionkey + 1) % 5 as string)),
 concat('910000000', cast(r_regionkey as string)), 'x', r_name, concat('Loop ', cast(r_regionkey as string)), 'L3'
from {{region}} r
union all
select '端', case when n_nationkey = 0 then '9100000000' else concat('920000000', cast(n_nationkey - 1 as string)) end,
 concat('920000000', cast(n_nationkey as string)), 'x', n_name, concat('Tail ', cast(n_nationkey as string)), 'L4-1'
from {{nation}} n where n_nationkey < 3
union all
select '独', null, '9300000000', 'x', r_name, 'Alone', 'L7' from {{region}} r where r_regionkey = 0
"""
SQL["persons"] = """
select cast(c_custkey as string) as personIdExternal, '2020-01-01' as startDate, '9999-12-31' as endDate,
 n_name as nationality, case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
 concat('姓', cast(c_custkey % 100 as string)) as customString5,
 case when c_custkey % 3 = 0 then null else '中' end as customString6,
 concat('名', cast(c_custkey as string)) as customString4, concat('Last', cast(c_custkey % 100 as string)) as lastName,
 cast(null as string) as middleName, c_name as firstName, 'S' as maritalStatus, 'N' as challengeStatus
from {customer} c join {nation} n on c_nationkey = n_nationkey
"""
SQL["emails"] = """
select case when c_custkey % 6 = 1 then concat('ext', cast(c_custkey as string)) else cast(c_custkey as string) end
  as personIdExternal,
 concat('p', cast(c_custkey as string), '@example.com') as emailAddress
from {customer} c where c_mktsegment <> 'BUILDING'
"""
SQL["jobs"] = """
select cast(o_custkey as string) as userId, cast(cast(floor(o_custkey / 8) as bigint) as string) as managerId,
 'C1' as company, concat('J', cast(o_orderkey % 40 as string)) as jobCode,
 case when o_orderkey % 50 = 7 then concat('90000000', lpad(cast(o_orderkey % 25 as string), 2, '0'))
  when o_orderkey % 50 = 9 then concat('910000000', cast(o_orderkey % 5 as string))
  when o_orderkey % 50 = 11 then '9300000000'
  else lpad(cast(cast(floor(o_orderkey / 10) as bigint) as string), 10, '0') end as department,
 concat('Title ', cast(o_orderkey % 40 as string)) as jobTitle,
 concat('役', cast(o_orderkey % 40 as string)) as customString2,
 case when o_orderkey % 4 = 0 then null else 'Common' end as customString25, '共通' as customString24,
 case o_orderstatus when 'O' then '1987' when 'F' then '1991' else '2000' end as emplStatus
from {orders} o
"""

SQL["ledger"] = """
select cast(ts + interval '15' day as date) as calday, cast(ts as date) as compared_date,
 event_type as department_code, cast(user_id as string) as district_code,
 cast(cast(value as decimal(12,2)) as decimal(18,6)) as sales_amount
from {events} e
"""
SQL["activity"] = """
select cast(event_id as string) as Id, cast(ts as string) as CreationTime, event_type as Operation,
 case when event_type = 'error' then null else concat('k', substring(props, 7, 2)) end as Workload,
 cast(user_id as string) as UserId, concat('scope', cast(user_id % 3 as string)) as scope, ts
from {events} e
"""
SQL["import_lines"] = """
select concat(cast(cast(ts as date) as string), '/', event_type) as run, count(*) as n,
 sum(case when value > 90 then 1 else 0 end) as failed
from {events} e group by cast(ts as date), event_type
"""
SQL["store_rows"] = """
select cast(c_custkey as string) as store_number, c_name as store_name, c_mktsegment as store_type_name,
 case c_custkey % 3 when 0 then 'Tokyo' when 1 then 'Non_Tokyo' else 'Other' end as city,
 n_name as district_name, r_name as region_name, cast(n_nationkey as string) as branch_name,
 case when c_custkey % 4 = 0 then null else concat('acc', cast(c_custkey as string)) end as a4,
 case when c_custkey % 5 = 0 then null else 'CH' end as a10, cast(c_acctbal as string) as a12
from {customer} c join {nation} n on c_nationkey = n_nationkey join {region} r on n_regionkey = r_regionkey
"""
SQL["product_rows"] = """
select cast(p_partkey as string) as pk, p_name as product_name, p_type as product_type, p_brand as brand_name,
 case when p_size % 3 = 0 then null else cast(p_size as string) end as size,
 case when p_size % 4 = 0 then null else concat('http://img.example/', cast(p_partkey as string)) end as image
from {part} p
"""
SQL["visit_rows"] = f"""
select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string)) as session_uid,
 concat('v', cast(o_custkey as string), '@example.com') as visitor_identifier,
 cast({_DAY} as string) as session_date,
 case when l_linenumber = 7 then 'unknown' else cast(1600000000 + l_orderkey * 60 as string) end as start_time,
 cast(1600003600 + l_orderkey * 60 as string) as end_time,
 o_orderpriority as visit_type_name, cast(o_custkey as string) as store_number,
 l_linenumber as line, cast(l_partkey as string) as e0,
 case when l_linenumber % 3 = 0 then null else cast(l_suppkey as string) end as e1,
 l_quantity as numerator, l_quantity + l_linenumber as denominator,
 cast({_D} as string) as result, l_tax as score, l_returnflag as flag
from {_LINES} l join {{orders}} o on l_orderkey = o_orderkey
"""


#: Bytes of stored lines that one task joins with their orders. A line becomes a row some sixty times as wide, which a
#: task may go on to sort; by the size of the narrow lines alone AQE would merge more than its memory holds.
LINE_BYTES = 2 << 20


def read_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A star-schema table, read as it lies."""
    return spark.read.schema(BASE[name]).parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in table."""
    text = SQL[name]
    frames = {n: read_base(spark, sf_dir, n) for n in BASE if "{" + n + "}" in text}
    if {"lineitem", "orders"} <= frames.keys():
        # Orders become the hashed side: the lines, several to an order, need no sort, which would spill.
        frames["orders"] = frames["orders"].hint("shuffle_hash")
        pieces = pieces_of(frames["lineitem"], LINE_BYTES)
        if pieces > spark.sparkContext.defaultParallelism:  # a smaller table is cut by AQE for all cores
            frames["lineitem"] = frames["lineitem"].repartition(pieces, "l_orderkey")
    return spark.sql(text, **frames)


def cte(*names: str) -> str:
    """The same tables as a WITH clause for the check engine."""
    plain = {b: b for b in BASE}
    parts = [f"{n} as ({SQL[n].format(**plain).replace('`', chr(34))})" for n in names]
    return "with " + ",\n".join(parts) + "\n"


def visits(spark: SparkSession, sf_dir: str, *, month_days: bool = False) -> DataFrame:
    """Nested visit documents, one per ``visit_rows`` row.

    ``month_days`` dates all visits of a month on its first day.

    Every visit has the six parent KPIs, one KPI nobody asks for, and two scenes;
    children appear by the return flag. Nesting happens inside the row, so no
    group is collected.
    """
    rows = table(spark, sf_dir, "visit_rows")
    if month_days:
        rows = rows.withColumn("session_date", F.concat(F.substring("session_date", 1, 8), F.lit("01")))
    n, d, r, s = (F.col(c) for c in ("numerator", "denominator", "result", "score"))
    uid = lambda c: F.struct(c.alias("uid"))
    # Lines divisible by three carry one entity only.
    entities = F.when(F.col("e1").isNull(), F.array(uid(F.col("e0")))).otherwise(
        F.array(uid(F.col("e0")), uid(F.col("e1"))))

    def place(name: str) -> list:
        return [F.lit(name).alias("name"), entities.alias("entities"), n.alias("numerator"),
                d.alias("denominator"), r.alias("result"), s.alias("score")]

    child_kind = schemas.VISIT["details"].dataType["kpis"].dataType.elementType["results"].dataType

    def kpi(name: str, *children: str):
        inner = F.array(*[F.struct(*place(c)) for c in children]) if children else F.array()
        kept = F.when(F.col("flag") == "R", F.lit(None)).otherwise(inner) if children else inner
        return F.struct(*place(name), kept.cast(child_kind).alias("results"))

    kpis = F.array(
        kpi(V.POC_COUNT), kpi(V.POC_SCORE), kpi(V.MSL_STORE, V.MSL_PRODUCT, "OTHER_CHILD"),
        kpi(V.SOVI_CATEGORY_OWN, V.SOVI_CATEGORY_ALL), kpi(V.SOVI_STORE_OWN, V.SOVI_STORE_ALL, V.SOVI_STORE_ALL),
        kpi(V.UNIQUE), kpi(V.RED), kpi("OTHER_KPI"),
    )

    def scene(number: int):
        shot = lambda i: F.struct(
            F.concat("session_uid", F.lit(f"-{number}-{i}")).alias("image_uid"),
            F.col("start_time").alias("capture_time"),
            F.struct(*[F.concat(F.lit(f"http://img.example/{size}/"), "e0").alias(size)
                       for size in ("original", "medium", "small")]).alias("image_urls"))
        texts = {"scene_id": F.concat(F.lit(f"{number}-"), "e0"), "scene_uid": F.col("session_uid"),
                 "scene_status": F.col("flag")}
        fields = schemas.VISIT["details"].dataType["images"].dataType.elementType.names[:-1]
        return F.struct(*[texts.get(f, F.lit(None).cast("string")).alias(f) for f in fields],
                        F.array(shot(0), shot(1)).alias("scene_images"))

    header = {"session_start_time": "start_time", "session_end_time": "end_time"}
    columns = [
        (F.col(header.get(c, c)) if header.get(c, c) in rows.columns else F.lit("35.0")).alias(c)
        for c in schemas.VISIT.names if c != "details"
    ]
    details = F.struct(kpis.alias("kpis"), F.array(scene(1), scene(2)).alias("images"))
    return rows.select(*columns, details.alias("details"))


def usage_wide(spark: SparkSession, sf_dir: str, *, with_total: bool) -> DataFrame:
    """One row per user, one column per day seen, as a usage sheet arrives."""
    counts = table(spark, sf_dir, "usage_counts")
    days = [r[0] for r in counts.select(F.col("day").cast("string")).distinct().orderBy("day").collect()]
    wide = counts.groupBy(F.col("email").alias("Time")).pivot("day", days).agg(F.sum("n"))
    if not with_total:
        return wide
    total = counts.groupBy(F.col("email").alias("Time")).agg(F.sum("n").alias("Amount"))
    return wide.join(total, "Time")


def store_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store pages as landed: an array of stores, sparse attributes in a map."""
    rows = table(spark, sf_dir, "store_rows")
    attributes = F.map_from_entries(F.filter(
        F.array(*[F.struct(F.lit(f"additional_attribute_{n}").alias("key"), F.col(f"a{n}").alias("value"))
                  for n in (4, 10, 12)]),
        lambda e: e["value"].isNotNull()))
    fields = schemas.STORE_PAGE["store"].dataType.elementType.names[:-1]
    store = F.struct(*[(F.col(f) if f in rows.columns else F.lit(None).cast("string")).alias(f) for f in fields],
                     attributes.alias("store_additional_attributes"))
    return rows.select(F.array(store).alias("store"))


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "product_rows")
    fields = schemas.PRODUCT_PAGE["product"].dataType.elementType.names[:-1]
    images = F.when(F.col("image").isNotNull(), F.array(F.struct(F.col("image").alias("image_url"))))
    product = F.struct(*[(F.col(f) if f in rows.columns else F.lit(None).cast("string")).alias(f) for f in fields],
                       images.alias("images"))
    return rows.select(F.array(product).alias("product"))


def activity_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity documents as JSON text with their scope."""
    rows = table(spark, sf_dir, "activity")
    event = F.struct(*schemas.ACTIVITY_EVENT.names)
    return rows.select("scope", F.to_json(F.struct(F.array(event).alias("root"))).alias("doc"))


def import_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of one import per day and event type."""
    rows = table(spark, sf_dir, "import_lines")
    text = lambda label, c: F.concat(F.lit(label), F.lit(": "), c.cast("string"))
    lines = F.array(
        F.concat(F.lit("INFO contentpump: Total input paths to process : "), F.col("n").cast("string")),
        F.concat(F.lit("INFO mapreduce: "), text("INPUT_RECORDS", F.col("n"))),
        F.concat(F.lit("INFO mapreduce: "), text("OUTPUT_RECORDS", F.col("n"))),
        F.concat(F.lit("INFO mapreduce: "), text("OUTPUT_RECORDS_COMMITTED", F.col("n") - F.col("failed"))),
        F.concat(F.lit("INFO mapreduce: "), text("OUTPUT_RECORDS_FAILED", F.col("failed"))),
        F.lit("INFO done"),
    )
    return rows.select("run", F.explode(lines).alias("line"))
