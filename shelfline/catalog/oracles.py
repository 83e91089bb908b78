"""For each registered query, the SQL it must equal, written for DuckDB."""

from __future__ import annotations

from shelfline.catalog.standins import cte

ORACLES: dict[str, str] = {}

STAR = ("detail", "customers", "materials")
JOINED = """from detail d join customers c on d.zjcustbrg = c.zjcust
 join materials m on d.zjmatrial = m.zjmate"""


def _named(names: dict[str, str]) -> str:
    return ", ".join(f"{source} as {name}" for name, source in names.items())


def _totals(names: dict[str, str], coalesce: bool = False) -> str:
    one = "coalesce(sum({c}), 0)" if coalesce else "sum({c})"
    return ", ".join(f"cast({one.format(c=c)} as decimal(28,6)) as {n}" for n, c in names.items())


# Marts over sales detail: joins first, then one grouping, as plain SQL says it. All
# names stand here anew, so that a wrong mapping in the library does not pass.
_PULSE_NAMES = {
    "region": "c.zero_region___t", "channel_lv2": "c.zjbjiclv2___t", "sales_center": "c.zjsreigce", "customer_id": "c.zjcust",
    "maker": "m.zjbevmnc___t", "category": "m.zjcatcd___t", "subcategory_jp": "m.zjsubcatc___t", "subcategory_en": "m.zjsbcatcd___t",
    "product_type": "m.zjnewprdc___t", "brand": "m.zjejbrand___t", "jan_code": "m.zjancd", "product_code": "m.zjmate",
    "product_name_jp": "m.zjmate___t", "package": "m.zjpackcd___t", "package_type": "m.zjddctcd___t", "package_size": "m.zjddcscd___t",
    "rpp_package": "m.zjrpppkg___t", "release_date": "m.zjreldt",
}
_PULSE_SUMS = {
    "bapc_cy": "d.cm_cy_bapc", "bapc_ly": "d.cm_ly_bapc", "nsr_cy": "d.cm_cy_nsr", "nsr_ly": "d.cm_ly_nsr",
    "cogs_cy": "d.cm_cy_cogs", "cogs_ly": "d.cm_ly_cogs", "gp_cy": "d.cm_cy_gp", "gp_ly": "d.cm_ly_gp",
}
_PULSE = f"""select d.calday as calday, {_named(_PULSE_NAMES)}, {_totals(_PULSE_SUMS)}
from detail d left join customers c on d.zjcustbrg = c.zjcust left join materials m on d.zjmatrial = m.zjmate
group by d.calday, {', '.join(_PULSE_NAMES.values())}"""
ORACLES["business_pulse_full"] = cte(*STAR) + _PULSE
ORACLES["business_pulse"] = cte(*STAR) + _PULSE + " order by " + ", ".join(
    f"{k} nulls last" for k in ("calday", *_PULSE_NAMES)) + " limit 50"
ORACLES["pulse_incremental"] = cte(*STAR).rstrip() + """,
dated as (select * replace (case when zjcustbrg[-1:] = '7' then null else calday end as calday) from detail)
""" + _PULSE.replace("from detail d", "from dated d")

_X, _Y, _Z = "'X:バジェット対象(飲料製品)'", "'Y:バジェット対象(飲料以外・KO-EAST/FV)'", "'Z:バジェット対象(飲料以外・FVのみ)'"
_BRANCH = {
    "ej": f"""m.zjbudtf in ({_X}, {_Y}) and c.zjdfflg = '0:通常'
 and c.zjdivold2 in ('13', '21', '22', '23', '24', '28', '32', '39') and c.zjddexfl___t = '送信対象'""",
    "wj": f"""m.zjbudtf = {_X} and c.zjdfflg = '0:通常'
 and c.zjdivold2 in ('35', '42') and c.zjddexfl___t = '送信対象'""",
    "fv": f"m.zjbudtf in ({_X}, {_Y}, {_Z}) and c.zjdfflg in ('2: Vending_OCS (223)', '3: 営業本部外')",
}
_branch_sql = {b: f"select d.* {JOINED} where {rule}" for b, rule in _BRANCH.items()}
for _b, _sql in _branch_sql.items():
    ORACLES[f"sales_branch_{_b}"] = cte(*STAR) + _sql
ORACLES["sales_filtered_union"] = cte(*STAR) + " union all ".join(_branch_sql.values())

ORACLES["general_report"] = cte(*STAR) + f"""select d.*, c.*, m.* {JOINED}
where d.calmonth = '1998-06' and m.zjbudtf in ({_X}, {_Y})
 and c.zjdfflg in ('0:通常', '2: Vending_OCS (223)') and c.zjddexfl___t = '送信対象'"""

_ALCOHOL_MEASURES = """d.cm_cy_bapc as bapc_cy, d.cm_ly_bapc as bapc_ly, d.cm_cy_nsr as nsr_cy, d.cm_ly_nsr as nsr_ly,
 d.cm_cy_gp as gp_cy, d.cm_ly_gp as gp_ly, d.cm_cy_cogs as cogs_cy, d.cm_ly_cogs as cogs_ly,
 d.cm_cy_rb as rpp_rebate_cy, d.cm_ly_rb as rpp_rebate_ly, d.cm_cy_pc as purchase_price_cy, d.cm_ly_pc as purchase_price_ly"""
_ALCOHOL_WHERE = f"{JOINED} where m.zjcatcd___t = 'ｱﾙｺｰﾙ'"
ORACLES["alcohol_sales_detail"] = cte(*STAR) + f"""select d.calmonth as yearmonth, d.calday as date,
 c._zero_region as prefecture_code, c._zero_region___t as prefecture_name_en, c.zjsreigp___t as prefecture_name_jp,
 c.zjdivgcd as sales_region_code, c.zjdivgcd___t as sales_region_name, c.zjdivcd as sales_district_code,
 c.zjdivcd___t as sales_district_name, c.zjregione as sales_district_name_en, c.zjrgncd as sales_branch_code,
 c.zjrgncd___t as sales_branch_name, c.zjslsctcd as sales_center_code, c.zjslsctcd___t as sales_center_name,
 c.zjresidne___t as sales_center_name_english, c.zjsrtanto as sales_person_code, c.zjsrtanto___t as sales_person_name,
 c.zjchncd as bottler_channel_code, c.zjchncd___t as bottler_channel, c.zjbjiclv1 as channel_lv_1_code,
 c.zjbjiclv1___t as channel_lv_1, c.zjbjiclv2 as channel_lv_2_code, c.zjbjiclv2___t as channel_lv_2,
 c.zjbjicl_m as channel_lv_3_code, c.zjbjicl_m___t as channel_lv_3, c.zjdlrc as customer_code,
 c.zjdlrc___t as customer_name, m.zjejbrand as brand_code, m.zjejbrand___t as brand_name, m.zjdbrdcd___t as brand_name_en,
 m.zjancd as jan_code, m.zjmatagsp as product_code, m.zjmatagg___t as product_name,
 m.zjddctcd as ddis_container_type_code, m.zjddctcd___t as ddis_container_type_name,
 m.zjddcscd as ddid_container_size_code, m.zjddcscd___t as ddid_container_size_name,
 m.zjpackcd as bottler_package_code, m.zjpackcd___t as bottler_package_name,
 m.zjddpkcd as ddis_package_code, m.zjddpkcd___t as ddis_package_name, m.zjcatcd as category_code,
 m.zjcatcd___t as category_name, m.zjsbcatcd as sub_category_code, m.zjsbcatcd___t as sub_category_name,
 {_ALCOHOL_MEASURES} {_ALCOHOL_WHERE}"""
ORACLES["alcohol_sales_detail_v2"] = cte(*STAR) + f"""select d.calmonth as yearmonth, d.calday as date,
 c._zero_region as prefecture_code, c._zero_region___t as prefecture_name_en, c.zjsreigp___t as prefecture_name_jp,
 c.zjdivgcd as sales_region_code, c.zjdivgcd___t as sales_region_name, c.zjdivcd as sales_district_code,
 c.zjdivcd___t as sales_district_name, c.zjrgncd as sales_branch_code, c.zjrgncd___t as sales_branch_name,
 c.zjslsctcd as sales_center_code, c.zjslsctcd___t as sales_center_name, c.zjchncd as bottler_channel_code,
 c.zjchncd___t as bottler_channel_name, c.zjbjiclv1 as channel_lv_1_code, c.zjbjiclv1___t as channel_lv_1_name,
 c.zjbjiclv2 as channel_lv_2_code, c.zjbjiclv2___t as channel_lv_2_name, c.zjbjicl_m as channel_lv_3_code,
 c.zjbjicl_m___t as channel_lv_3_name, c.zjdlrc as customer_code, c.zjdlrc___t as customer_name, m.zjancd as jan_code,
 m.zjmatagsp as product_code, m.zjmatagg___t as product_name, m.zjejbrand as brand_code, m.zjejbrand___t as brand_name,
 m.zjcatcd as category_code, m.zjcatcd___t as category_name, m.zjsbcatcd as sub_category_code,
 m.zjsbcatcd___t as sub_category_name, {_ALCOHOL_MEASURES} {_ALCOHOL_WHERE}"""

_R = """calday, bw_calday_week, calday_prevyear, calday_week_prevyear, zjmatrial, comp_code, zjcustbrg, zj445qatr,
 zj445week, werks, ww202, plant_t"""
_ROLLUP_SUMS = {f"cm_{y}_{m}": f"cm_{y}_{m}" for y in ("cy", "ly") for m in (
    "bapc", "barasu", "nsr", "cogs", "pc", "rb", "gp", "fscom", "logistics_cst", "sal_del_cst", "cen_shp_cst", "cent_fee",
    "bs_en_fee", "trp_cst", "mp", "jr_opr_cst", "jr_tr_fee")}
ORACLES["sales_rollup_12key"] = cte("detail") + f"""select {_R}, count(zjmatrial) as num_transactions,
 {_totals(_ROLLUP_SUMS)} from detail where bw_calday_week is not null group by {_R}"""

ORACLES["business_plan_rollup"] = cte("plan") + """select "0calday" as calday, zjdate__zjcpdate as compared_date,
 zjbjiara1 as department_code, zjbjiara2 as district_code, zjbjicl_m as l3_code,
 cast(sum(zjhansu_p) as decimal(28,6)) as sales_amount, cast(sum(zjbjinsrp) as decimal(28,6)) as actual_sales_price,
 cast(sum(zjgross_p) as decimal(28,6)) as sales_revenue, cast(sum(zjbjimp_p) as decimal(28,6)) as revenue_limit
from plan group by "0calday", zjdate__zjcpdate, zjbjiara1, zjbjiara2, zjbjicl_m"""

_DAILY_RULES = (
    _BRANCH["ej"].replace("in ('13'", "in ('', '13'"),
    _BRANCH["wj"],
    _BRANCH["fv"] + " and c.zjddexfl___t = '送信対象' and d.comp_code = '7828'",
)
_DAILY_KEYS = {
    "calday": "bw_calday_week", "calday_prevyear": "calday_week_prevyear", "sales_region_code": "zjdivgcd",
    "sales_region_name": "zjdivgcd___t", "sales_district_code": "zjdivcd", "sales_district_name": "zjdivcd___t",
    "sales_branch_code": "zjrgncd", "sales_branch_name": "zjrgncd___t", "channel_l2_code": "zjbjiclv2",
    "channel_l2_name": "zjbjiclv2___t", "channel_l3_code": "zjbjicl_m", "channel_l3_name": "zjbjicl_m___t",
}
_DAILY_SUMS = {
    "bapc_cy": "cm_cy_bapc", "bapc_ly": "cm_ly_bapc", "bapc_vs_ly": "cm_bapc_vs_ly_diff_cl",
    "bapc_vs_ly_percentage": "cm_bapc_vs_ly_percent_cl", "gp_bapc": "cm_cy_gp_bapc", "nsr_cy": "cm_cy_nsr",
    "nsr_ly": "cm_ly_nsr", "nsr_vs_ly": "cm_nsr_vs_ly_diff_cl", "nsr_vs_ly_percentage": "cm_nsr_vs_ly_percent_cl",
    "gp": "cm_cy_gp", "gp_ly": "cm_ly_gp",
}


def _daily(extra: dict[str, str], days: str = "true") -> str:
    keys = _DAILY_KEYS | extra
    branch = "select " + _named(keys) + ", " + _totals(_DAILY_SUMS, coalesce=True) + (
        f" {JOINED} where {days} and d.calmonth = strftime(d.bw_calday_week, '%Y-%m') and {{rule}} group by " + ", ".join(keys.values()))
    return cte(*STAR) + " union all ".join(branch.format(rule=r) for r in _DAILY_RULES)


ORACLES["daily_sales"] = _daily({})
ORACLES["daily_sales_by_sku"] = _daily({"sku_code": "zjancd"})
ORACLES["daily_sales_mtd"] = _daily({}, "d.bw_calday_week between date '1998-06-01' and date '1998-06-17'")

# Scans.
ORACLES["param_query_scan"] = cte("detail") + """select calday, zjcustbrg, sum(cm_cy_nsr)::decimal(28,6) as nsr_cy
from detail where calday between date '1998-06-01' and date '1998-06-17' group by calday, zjcustbrg"""
ORACLES["day_range_scan"] = cte("detail") + """select calday, zjcustbrg, zjmatrial, cm_cy_bapc from detail
where calday between date '1998-06-16' and date '1998-06-17'"""
ORACLES["month_scan"] = cte("detail") + """select calday, calmonth, zjcustbrg, zjmatrial, cm_ly_gp from detail
where calday between date '1998-06-01' and date '1998-06-30'"""
ORACLES["material_scan"] = "select * from part"
ORACLES["customer_distinct"] = cte("customers") + "select distinct * from customers"
ORACLES["material_projection"] = cte("materials") + """select zjancd, zjbevmnc___t, zjcatcd___t, zjddcscd___t,
 zjddctcd___t, zjejbrand___t, zjmate, zjmate___t, zjnewprdc___t, zjpackcd___t, zjreldt, zjrpppkg___t,
 zjsbcatcd___t, zjsubcatc___t, zjbudtf from materials"""
ORACLES["sample_scan"] = cte("detail") + """select calday, zjcustbrg, zjmatrial, comp_code, cm_cy_nsr from detail
order by all limit 15000"""

# Point of sale.
_WEEKLY = """from pos_weekly w join (select company_code, period from pos_periods where store_code is null) p
 on w.company_code = p.company_code and w.period = p.period"""
ORACLES["pos_weekly_with_periods"] = cte("pos_weekly", "pos_periods") + f"select w.* {_WEEKLY}"
ORACLES["pos_weekly_report"] = cte("pos_weekly", "pos_periods", "pos_goods", "pos_companies") + f"""
select w.period, c.hq, c.channel, c.div, w.company_code, c.customer_en, c.customer_l3, g.large_manufacturer,
 g.middle_category, g.large_pkg, c.nsr_ratio,
 cast(sum(w.amount_of_money) as decimal(38,4)) as sum_amount_of_money,
 cast(sum(w.quantity) as decimal(38,4)) as sum_quantity,
 cast(sum(cast(w.quantity as decimal(18,4)) * cast(g.quantity as decimal(18,4))) as decimal(38,8))
  as sum_quantity_converted
{_WEEKLY} join pos_goods g on w.jan_code = trim(g.sku) join pos_companies c on w.company_code = c.company_code
group by all"""
ORACLES["pos_store_daily_1y"] = cte("pos_store_daily") + """select * from pos_store_daily
where period between date '1999-10-01' and date '2000-10-01'"""
ORACLES["pos_week_texts"] = cte("pos_periods") + """select distinct period, strftime(period, '%Y') as str_year,
 strftime(period, '%m%d') || cast((day(period) + 6) // 7 as varchar) as str_weekdate from pos_periods"""
ORACLES["pos_csv_files"] = cte("pos_periods") + "select company_code, store_code, period from pos_periods"
ORACLES["pos_cast"] = """select cast(o_custkey as varchar) as account_code, cast(o_orderkey as varchar) as customer_code,
 cast(o_orderdate as date) as duration, cast(floor(o_totalprice) as integer) as sales_amount,
 case when o_orderstatus = 'P' then null else cast(o_orderkey % 1000 as integer) end as sales_price,
 cast(o_custkey % 77 as integer) as sales_revenue, cast(null as integer) as customer_engagement from orders"""

# Equipment and routes.
_TEXTS = """sold_to, sold_to_party, item_code, coalesce(item_name, '') as item_name, cde_type_l_name,
 cde_type_m_name, cde_type_s_name, prefecture, zjbjiclv__t"""
_PLACED = f"""select wo_no, strptime(addat, '%Y%m%d')::date as addat,
 case when idat2 = '00000000' then date '2099-01-01' else strptime(idat2, '%Y%m%d')::date end as idat2,
 target_date, work_name, {_TEXTS} from placement"""
ORACLES["clean_equipment"] = cte("placement") + _PLACED
ORACLES["equipment_recode"] = cte("placement") + f"""select wo_no as order_id, addat as date_scheduled,
 idat2 as date_placement,
 case when target_date like '2020%' then cast(cast(target_date[5:6] as integer) as varchar) else target_date end
  as date_month,
 work_name as placement_type_jp,
 case work_name when '新規設置' then 'NewPlacement' when '交換' then 'Exchange' when '玉突' then 'PileUp'
  when '移動' then 'Move' when '単独撤収' then 'Replace' else work_name end as placement_type_en,
 sold_to as customer_code, sold_to_party as customer_name, item_code, item_name,
 cde_type_l_name as device_type_l, cde_type_m_name as device_type_m, cde_type_s_name as device_type_s,
 prefecture,
 case zjbjiclv__t when '' then 'Other' when 'Food' then 'RF' when 'Retail' then 'RF' when 'SMDD' then 'CS'
  else zjbjiclv__t end as channel,
 1 as amount from ({_PLACED})"""
ORACLES["equipment_customers"] = cte("customers") + """select distinct zjcdsrecd as employee_code,
 zjcdsrecd___t as employee_name, zjlocacd as customer_code, zjlocacd___t as customer_name,
 zjsmwerks as work_code, zjsmpdroc as route_code from customers"""
ORACLES["customer_route_report"] = cte("routes", "route_customers", "divisions") + """
select d.divisionnm as division, d.regionnm as region, r.zkzpdwerks as base_code, d.zkzpdwerksnm as base_name,
 r.zkzpdcroute as route, k.kunnr as customer_code, k.name2 as customer_name, r.zresalcod as representative_code,
 p.name2 as representative_name,
 case when r.zresalcod is null or r.zresalcod in ('', r.zkzkunnr) then '' else 'X' end as representative_differs,
 k.ccc_season_start1 as trading_start, k.ccc_season_end1 as trading_end,
 case k.kdkg5 when 'M3' then 'RS' when 'M4' then 'FS' end as rs_fs
from routes r join route_customers k on r.zkzkunnr = k.kunnr join divisions d on d.zkzpdwerks = r.zkzpdwerks
 left join route_customers p on r.zresalcod = p.kunnr where d.oldbottler1cd = '35'"""

# Cleaning.
_CLEAN = """select doc, line, part_key, calmonth[1:4] || '-' || calmonth[5:] as calmonth,
 strptime(calday, '%Y%m%d')::date as calday, strptime(budat, '%Y%m%d')::date as budat,
 case when calday_prevyear = '' then date '{blank}' else try_strptime(calday_prevyear, '%Y%m%d')::date end
  as calday_prevyear,
 {note} as note, amount from raw_transactions"""
ORACLES["clean_transactions"] = cte("raw_transactions") + _CLEAN.format(blank="2020-02-29", note="note")
ORACLES["clean_transactions_far_blank"] = cte("raw_transactions") + _CLEAN.format(
    blank="2199-01-01", note="coalesce(note, '')")


def _dashed(c: str) -> str:
    return f"coalesce({c}, '')[1:4] || '-' || coalesce({c}, '')[5:6] || '-' || coalesce({c}, '')[7:] as {c}"


ORACLES["export_values"] = cte("raw_transactions") + f"""select doc, line, part_key,
 calmonth[1:4] || '-' || calmonth[5:] as calmonth, {_dashed('calday')}, {_dashed('budat')},
 {_dashed('calday_prevyear')}, coalesce(note, '') as note, cast(trunc(amount) as bigint) as amount
from raw_transactions"""
ORACLES["wholesaler_clean"] = cte("raw_wholesaler") + """select wholesaler_code, wholesaler_name,
 wholesaler_centre_code, customer_branch_code, strptime('20' || delivery_date, '%Y%m%d')::date as delivery_date,
 jan_code[1:13] as jan_code, cast(can_quantity as decimal(16,8)) as can_quantity from raw_wholesaler"""
ORACLES["name_normalise"] = """select p_partkey, p_name, lower(replace(p_name, ' ', '_')) as name,
 p_name || ' as ' || lower(replace(p_name, ' ', '_')) || ',' as sql from part"""
ORACLES["column_profile"] = "select " + ", ".join(
    f"coalesce(bool_or({c} is not null and {c} <> {z}), false) as {c}" for c, z in (
        ("l_orderkey", "0"), ("l_partkey", "0"), ("l_suppkey", "0"), ("l_linenumber", "0"), ("l_quantity", "0"),
        ("l_extendedprice", "0"), ("l_discount", "0"), ("l_tax", "0"), ("l_returnflag", "''"),
        ("l_linestatus", "''"))
) + """, bool_or(l_shipdate is not null) as l_shipdate, false as never, false as zero, false as blank
from lineitem"""

# Store visits: straight from the flat rows.
_WALL = """case when {c} ~ '^[0-9]+$' then timestamp '1970-01-01 09:00:00' + to_seconds(try_cast({c} as bigint)) end"""
_HEADER = f"""session_uid as session_id_unique, visitor_identifier as email, cast(session_date as date) as visit_date,
 {_WALL.format(c='start_time')} as start_time, {_WALL.format(c='end_time')} as end_time,
 visit_type_name as visit_type, '35.0' as gps_latitude, '35.0' as gps_longitude, '35.0' as store_latitude,
 '35.0' as store_longitude, store_number as customer_code"""
_COUNT = "cast(cast(trunc({c}) as bigint) as decimal(18,5)) as {n}"
_RATIO = "cast({c} as decimal(18,5)) as {n}"


def _visit(columns: str, where: str = "true", source: str = "visit_rows") -> str:
    return cte("visit_rows") + f"select {_HEADER}, {columns} from {source} where {where}"


_num = lambda n: _COUNT.format(c="numerator", n=n)
_den = lambda n: _COUNT.format(c="denominator", n=n)
_res = lambda n: _RATIO.format(c="result", n=n)
_sco = lambda n: _RATIO.format(c="score", n=n)
ORACLES["visit_poc"] = _visit(f"e0 as poc_type, e1 as location, {_num('count')}")
ORACLES["visit_poc_score"] = _visit(
    "cast(trunc(numerator) as integer) as availability_count, cast(trunc(denominator) as integer) as target, "
    f"{_res('priority_poc_score')}, {_sco('priority_poc_score_weight')}")
ORACLES["visit_msl_store"] = _visit(
    f"{_num('actual_msl')}, {_den('expected_msl')}, {_res('msl')}, {_sco('msl_weight')}")
ORACLES["visit_msl_product"] = _visit(
    f"e0 as product_code, {_num('availability')}, result as msl_type", "flag <> 'R'")
_FACING = f"{_num('actual_facing')}, {_den('total_facing')}, {_res('sovi')}"
ORACLES["visit_sovi_category"] = _visit(f"e0 as manufacturer, e1 as category, {_FACING}", "flag <> 'R'")
ORACLES["visit_documents"] = ORACLES["visit_sovi_category"]
ORACLES["visit_sovi_store"] = _visit(
    f"e0 as manufacturer, {_FACING}", "flag <> 'R'", "visit_rows, (values (1), (2)) as twice(n)")
ORACLES["visit_unique"] = _visit(
    f"e0 as manufacturer, {_num('unique_product_count')}, {_den('total_product_count')}, {_res('unique_sovi')}")
ORACLES["visit_red"] = _visit(_res("red_score"))
_NULLS = ", ".join(f"cast(null as varchar) as {c}" for c in (
    "scene_closed_by_TTL", "store_area_code", "task_name", "task_display_name", "task_code", "task_uuid",
    "thumbnail_url", "preview_url"))
ORACLES["visit_photo"] = cte("visit_rows") + f"""select s || '-' || e0 as scene_id, session_uid as scene_uid,
 flag as scene_status, {_NULLS}, session_uid || '-' || s || '-' || i as image_uid,
 {_WALL.format(c='start_time')} as capture_time, store_number as customer_code,
 'http://img.example/original/' || e0 as image_url_original, 'http://img.example/medium/' || e0 as image_url_medium,
 'http://img.example/small/' || e0 as image_url_small
from visit_rows, (values ('1'), ('2')) as scenes(s), (values ('0'), ('1')) as shots(i)"""
_LOADED = ("poc", "poc_score", "msl_store", "msl_product", "sovi_category", "sovi_store", "unique", "red")
ORACLES["visit_load"] = " union all by name ".join(
    [f"select '{fact}' as fact, * replace (cast(date_trunc('month', visit_date) as date) as visit_date) from ({ORACLES['visit_' + fact]})" for fact in _LOADED]
    + [f"select 'photo' as fact, *, cast(capture_time as date) as capture_date from ({ORACLES['visit_photo']})"])

_STORE_NULL = ("store_display_name street address_line_2 postal_code latitude longitude manager_name manager_phone "
               "manager_email retailer_name state_code store_additional_attribute_1 account_name office_code "
               "office_name route_code person_in_charge person_in_charge_mail is_active").split() + [
                   f"additional_attribute_{n}" for n in (8, 11, 14, 15, 16, 17, 18, 19, 20, 21, 22)]
ORACLES["store_flat"] = cte("store_rows") + f"""select store_number as customer_code, store_name, store_type_name, city,
 region_name, district_name, branch_name, coalesce(a4, 'Null') as account_code, coalesce(a10, 'Null') as channel,
 'blank' as segment, district_name as prefecture, a12 as additional_attribute_12,
 {', '.join(f"'Null' as {c}" for c in _STORE_NULL)}
from store_rows where city in ('Tokyo', 'Non_Tokyo')"""
ORACLES["store_flat_small"] = cte("store_rows") + """select store_number as customer_code,
 cast(null as varchar) as store_name, branch_name as office_code, region_name as sales_center,
 branch_name as account_code, store_type_name as account_name, coalesce(a10, ' ') as channel, 'blank' as segment,
 cast(null as varchar) as city, district_name as prefecture from store_rows"""
_PRODUCT_NULL = ("product_uuid product_local_name product_short_name brand_local_name manufacturer_name "
                 "manufacturer_local_name is_deleted product_client_code container_type unit_measurement is_active "
                 "category_name category_local_name sub_category_name sub_category_local_name").split()
ORACLES["product_flat"] = cte("product_rows") + f"""select pk as product_code, product_name, product_type, brand_name,
 size, image as images, {', '.join(f'cast(null as varchar) as {c}' for c in _PRODUCT_NULL)} from product_rows"""

# Usage.
ORACLES["usage_long"] = cte("usage_counts") + """select email, day as day_of_usage, cast(n as float) as usage_ar
from (select * from (select distinct email from usage_counts), (select distinct day from usage_counts))
 left join usage_counts using (email, day)
union all select email, date '2099-01-01', cast(sum(n) as float) from usage_counts group by email"""
ORACLES["usage_totals"] = cte("usage_counts") + """select email, cast(sum(n) as integer) as usage_ar
from usage_counts group by email"""

# People.
_DEPT = """, dept as (select externalCode as code, parent, customString8 as lcd, customString1 as name_en,
 name_localized as name_jp from departments
 where customString8 is not null and regexp_matches(externalCode, '^[0-9]{10}')),
walk as (select code as leaf, 0 as depth, code, parent, lcd, [code] as seen from dept
 union all select c.leaf, c.depth + 1, d.code, d.parent, d.lcd, list_append(c.seen, d.code)
  from walk c join dept d on c.parent = d.code where not list_contains(c.seen, d.code)),
cyclic as (select distinct leaf from walk where list_contains(seen, parent)),
chain as (select leaf, depth, code, parent, lcd from walk where leaf not in (select leaf from cyclic))
"""


def _recursive(*names: str) -> str:
    return cte(*names).replace("with ", "with recursive ", 1).rstrip()


_LEVELS = ("L0", "L1", "L2", "L2.5", "L3", "L4-1", "L4-2", "L4-3", "L4-4", "L5-1", "L5-2", "L6")
_LEVEL_COLUMNS = []
for _lv in _LEVELS:
    _n = _lv.replace("-", "_").replace(".", "_")
    for _field, _suffix in (("code", "Code"), ("name_en", "NameEN"), ("name_jp", "NameJP")):
        _LEVEL_COLUMNS.append(
            f"min_by(d.{_field}, c.depth) filter (where c.lcd = '{_lv}') as {_n}{_suffix}")
_HIER = f"""select c.leaf as identifier, {', '.join(_LEVEL_COLUMNS)}
from chain c join dept d on c.code = d.code group by c.leaf"""
ORACLES["org_chain"] = _recursive("departments") + _DEPT + """select leaf, depth, code as SectionCD,
 parent as ParentSectionCD, lcd as LCD from chain"""
ORACLES["hr_org_levels"] = _recursive("departments") + _DEPT + _HIER
ORACLES["hr_unplaced"] = _recursive("departments") + _DEPT + """select code as SectionCD, parent as ParentSectionCD,
 lcd as LCD, name_en as SectionNameEN from dept where code in (select leaf from cyclic)"""

_OUTER = "coalesce(p.personIdExternal, e.personIdExternal)"
ORACLES["person_email_outer"] = cte("persons", "emails") + f"""select {_OUTER} as personIdExternal, p.nationality,
 p.lastName, e.emailAddress from persons p full outer join emails e on p.personIdExternal = e.personIdExternal"""


def _hr_column(name: str, source: str) -> str:
    return f"coalesce({source}, ' ') as {name}"


_PERSON = {
    "Nationality": "nationality", "Gender": "gender", "LastNameJP": "customString5",
    "MiddleNameJP": "customString6", "FirstNameJP": "customString4", "LastNameEN": "lastName",
    "MiddleNameEN": "middleName", "FirstNameEN": "firstName", "Status": "maritalStatus",
    "Email": "emailAddress", "EmployeeCode": "userId", "ManagerEmployeeCode": "managerId",
    "CompanyCode": "company", "JobCode": "jobCode", "DepartmentCode": "department",
    "JobTitleEN": "jobTitle", "JobTitleJP": "customString2", "JobTitleCommonEN": "customString25",
    "JobTitleCommonJP": "customString24", "SectionNameJP": "name_jp", "SectionCD": "code",
    "SectionNameEN": "name_en", "LCode": "lcd",
}
_LEVEL_OUT = []
for _lv in _LEVELS:
    _n = _lv.replace("-", "_").replace(".", "_")
    _LEVEL_OUT += [_hr_column(f"{_n}Code", f"h.{_n}Code"), _hr_column(f"{_n}NameEN", f"h.{_n}NameEN")]
    _jp = f"h.{_n}NameJP"
    if not _n.startswith(("L5", "L6")):
        _jp = f"case when not regexp_matches({_jp}, '[\\p{{L}}\\p{{N}}_]+[0-9]') then {_jp} end"
    _LEVEL_OUT.append(_hr_column(f"{_n}NameJP", _jp))
ORACLES["hr_master"] = _recursive("departments", "persons", "emails", "jobs") + _DEPT.rstrip() + f""",
hier as ({_HIER}),
people as (select {_OUTER} as pid, p.* exclude (personIdExternal), e.emailAddress
 from persons p full outer join emails e on p.personIdExternal = e.personIdExternal),
ranked as (select *, row_number() over (partition by pid order by emailAddress nulls last, department nulls last,
  jobCode nulls last, managerId nulls last, nationality nulls last, gender, customString5, customString6,
  customString4, lastName, middleName, firstName, maritalStatus, userId, company, jobTitle nulls last,
  customString2 nulls last, customString25 nulls last, customString24 nulls last) as rn
 from people join jobs on pid = userId join dept on department = code
 where emplStatus in ('1987', '1991', '1996'))
select {', '.join(_hr_column(n, 'r.' + c) for n, c in _PERSON.items())}, {', '.join(_LEVEL_OUT)}
from ranked r left join hier h on r.code = h.identifier where rn = 1"""

# Activity.
_EVENT = "CreationTime, Id, Operation, Workload, UserId"
ORACLES["activity_events"] = cte("activity") + f"select scope, {_EVENT} from activity where Workload is not null"
ORACLES["activity_ingest"] = cte("activity") + f"select {_EVENT} from activity where Workload is not null"
ORACLES["activity_window"] = cte("activity") + f"""select {_EVENT}, scope from activity
where ts > timestamp '2024-01-14 00:00:00' and ts <= timestamp '2024-01-15 00:00:00'"""

# Loads: the table each must leave behind.
_ROWS = """, corrected as (select calday, compared_date, department_code, district_code,
 cast(case when department_code = 'view' then sales_amount * 2 else sales_amount end as decimal(18,6)) as sales_amount
 from ledger)
"""
_PLAN_ROWS = cte("ledger").rstrip() + _ROWS
ORACLES["full_refresh"] = _PLAN_ROWS + "select * from corrected"
ORACLES["append_load"] = _PLAN_ROWS + "select * from ledger union all select * from corrected"


def _reloaded(first: str, last: str, new_last: str | None = None) -> str:
    gone = f"calday between date '{first}' and date '{last}'"
    new = f"calday between date '{first}' and date '{new_last or last}'"
    return _PLAN_ROWS + f"""select * from ledger where not ({gone})
union all select * from corrected where {new}"""


ORACLES["two_day_reload"] = _reloaded("2024-02-04", "2024-02-05")
ORACLES["month_reload"] = _reloaded("2024-02-01", "2024-02-29", "2024-02-05")
ORACLES["month_refresh"] = _reloaded("2024-02-01", "2024-02-29")
ORACLES["slice_copy"] = _PLAN_ROWS + """select * from ledger
where calday between date '2024-02-01' and date '2024-02-29'"""
_DAYS = ("calday", "budat", "bw_calday_week", "calday_prevyear", "calday_week_prevyear")
_TYPED = ", ".join(f"strptime({c}, '%Y%m%d')::date as {c}" for c in _DAYS) + ", calmonth[1:4] || '-' || calmonth[5:] as calmonth"
_TWICE = "cast(case when comp_code = '7828' {and_days} then cm_cy_bapc * 2 else cm_cy_bapc end as decimal(18,6)) as cm_cy_bapc"
ORACLES["sales_detail_load"] = cte("sales_extract") + f"""select * replace ({_TYPED},
 {_TWICE.format(and_days="and calday in ('19980616', '19980617')")}) from sales_extract where calmonth = '199806'"""
ORACLES["sales_table_refresh"] = cte("sales_extract") + f"select * replace ({_TYPED}, {_TWICE.format(and_days='')}) from sales_extract"
_WHOLE = [f"cm_{y}_{m}" for y in ("cy", "ly") for m in (
    "bapc", "barasu", "nsr", "cogs", "pc", "rb", "gp", "fscom", "logistics_cst", "sal_del_cst", "cen_shp_cst", "cent_fee",
    "bs_en_fee", "trp_cst", "mp", "jr_opr_cst", "jr_tr_fee")]
_CUT = ", ".join(f"cast(trunc({c}) as {k}) as {c}" for c, k in (
    *((c, "decimal(18,6)") for c in _WHOLE), *((f"absmg_{y}", "decimal(18,5)") for y in ("cy", "ly")),
    *((f"vv{n}_{y}", "decimal(15,2)") for n in (511, 512, 513, 517, 521, 522, 523, 524, 525, 526, 527, 528) for y in ("cy", "ly"))))
_DASHED = ", ".join(f"{c}[1:4] || '-' || {c}[5:6] || '-' || {c}[7:] as {c}" for c in _DAYS)
ORACLES["sales_documents"] = cte("sales_extract") + f"""select * exclude ({', '.join(
    f'cm_{y}_{m}' for m in ('net_ccr_prc', 'rpp_nsr', 'ccr_prc', 'off_inv_rb', 'otr_cst', 'otr_rb') for y in ('cy', 'ly'))})
 replace ({_DASHED}, calmonth[1:4] || '-' || calmonth[5:] as calmonth, {_CUT}) from sales_extract"""
ORACLES["sharded_copy"] = _PLAN_ROWS + "select * from ledger"

ORACLES["row_slices"] = cte("pos_store_daily") + """select company_code, store_code, jan_code, period, quantity,
 row_number from (select *, row_number() over
  (order by company_code, store_code, jan_code, period, quantity) - 1 as row_number from pos_store_daily)
where row_number < 10000 or row_number >= 40000"""
ORACLES["json_batches"] = cte("pos_store_daily") + """, numbered as (select company_code, jan_code,
 cast(period as varchar) as period, cast(quantity as integer) as quantity,
 row_number() over (order by company_code, jan_code, cast(period as varchar), cast(quantity as integer)) - 1 as n
 from pos_store_daily)
select cast(n // 10000 as bigint) as part, cast(count(*) over (partition by n // 10) as integer) as batch_size,
 company_code, jan_code, period, quantity from numbered"""
ORACLES["csv_round_trip"] = cte("pos_goods") + """select sku, large_manufacturer, middle_category, large_pkg,
 cast(quantity as decimal(18,4)) as quantity from pos_goods"""

ORACLES["people_pages"] = cte("persons") + "select * from persons"
ORACLES["usage_load"] = cte("usage_counts") + """select email, cast(null as date) as day_of_usage,
 cast(sum(n) as float) as usage_ar from usage_counts group by email
union all select email, day, cast(n as float)
 from (select * from (select distinct email from usage_counts), (select distinct day from usage_counts))
 left join usage_counts using (email, day)
union all select email, date '2099-01-01', cast(sum(n) as float) from usage_counts group by email"""
ORACLES["rejected_rows"] = cte("activity", "raw_transactions", "pos_periods") + """select 'document' as kind, Id as key, 'doc' as reason
from activity where Workload is null
union all select 'day', doc || '-' || cast(line as varchar), 'calday' from raw_transactions where line = 7
union all select 'accepted', company_code || ',' || coalesce(store_code, '') || ',' || cast(period as varchar), null
 from pos_periods where cast(company_code as bigint) % 7 <> 0 and cast(company_code as bigint) % 3 <> 0
union all select 'line', case when cast(company_code as bigint) % 7 = 0 then company_code
  else company_code || ',' || coalesce(store_code, '') || ',no day' end, 'line'
 from pos_periods where cast(company_code as bigint) % 7 = 0 or cast(company_code as bigint) % 3 = 0"""
ORACLES["guarded_loads"] = cte("ledger") + """select job, 'FAILURE' as status, message, (select count(*) from ledger) as row_count
from (values ('columns', 'missing columns [], unknown columns [''district_code'']'),
 ('cap', 'the extract holds 3 rows, more than the cap of 2'), ('transform', 'transform must be callable'),
 ('command', 'only a query may be read')) as t(job, message)"""

_RUN = "cast(cast(ts as date) as varchar) || '/' || event_type"
ORACLES["import_reconcile"] = f"""select {_RUN} as run, count(*) as total_paths, count(*) as input_records,
 count(*) as output_records, count(*) filter (where value <= 90) as output_records_committed,
 count(*) filter (where value > 90) as output_records_failed, count(*) filter (where value > 90) = 0 as complete
from events group by {_RUN}"""
ORACLES["job_run_audit"] = cte("ledger") + """select 'refresh' as job, cast(null as date) as processed_date,
 (select count(*) from ledger) as row_count, true as truncated, cast(null as date) as target_first,
 cast(null as date) as target_last, 'SUCCESS' as status, cast(null as varchar) as message
union all select 'reload', date '2024-02-05', (select count(*) from ledger where calday >= date '2024-02-01'), false,
 date '2024-02-01', date '2024-02-29', 'SUCCESS', null
union all select 'empty', null, null, null, null, null, 'FAILURE', 'the extract holds no rows'"""

ORACLES["date_list"] = """select o_orderpriority,
 strftime(unnest(generate_series(first, last, interval 1 day)), '%Y%m%d') as day_key
from (select o_orderpriority, min(o_orderdate) as first, max(o_orderdate) as last from orders
 group by o_orderpriority)"""
ORACLES["date_windows"] = """select day, (day - interval 1 day)::date as day_before, strftime(day, '%Y%m%d') as day_key,
 strftime(day - interval 1 day, '%Y%m%d') as day_before_key, strftime(day, '%Y%m') as month_key,
 date_trunc('month', day)::date as month_first, last_day(day) as month_last,
 strftime(date_trunc('month', day) - interval 1 day, '%Y-%m') as previous_month,
 strftime(date_trunc('month', day) - interval 1 day, '%Y%m') as previous_month_key
from (select distinct cast(o_orderdate as date) as day from orders)"""
ORACLES["epoch_wall_clock"] = cte("visit_rows") + f"""select session_uid, start_time,
 {_WALL.format(c='start_time')} as wall from visit_rows"""
