"""Table schemas.

Column lists below are fixed values of the source and target tables, kept as DDL
text in table order. Families of columns that follow a rule are built from it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import types as T


_ATOMIC = {
    "string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "int": T.IntegerType(), "bigint": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(),
}


def _kind(text: str) -> T.DataType:
    decimal = re.fullmatch(r"decimal\((\d+),(\d+)\)", text)
    return T.DecimalType(int(decimal[1]), int(decimal[2])) if decimal else _ATOMIC[text]


def _ddl(text: str) -> T.StructType:
    """``name kind, name kind`` as a schema; unlike ``fromDDL`` it needs no session."""
    pairs = (column.split() for column in re.split(r",(?!\d)", text))
    return T.StructType([T.StructField(name, _kind(kind)) for name, kind in pairs])


def _list(*fields: T.StructField) -> T.ArrayType:
    return T.ArrayType(T.StructType(list(fields)))


def _same(kind: str, names: str) -> str:
    return ", ".join(f"{n} {kind}" for n in names.split())


def string_master(names: Iterable[str], decimals: Mapping[str, str] | None = None) -> T.StructType:
    """Schema of a wide master: text throughout, but for the named decimals.

    The full customer (about 640 columns) and material (about 340) masters are
    read this way, with the names taken from the landed file itself.
    """
    special = decimals or {}
    return T.StructType([
        T.StructField(n, _kind(special.get(n, "string"))) for n in names
    ])


# Weights and measures of the full material master, DECIMAL(38,3).
MATERIAL_DECIMALS = {
    name: "decimal(38,3)"
    for name in (
        "_zero_gross_cont _zero_gross_wt _zero_height _zero_lenght _zero_net_cont _zero_net_weight "
        "_zero_volume _zero_width zjgalcv zjlapen1 zjlapen6 zjmaxla1 zjmaxla6 zjmdmfrti zjmdmprti "
        "zjmrpkf zjndpen1 zjndpen6 zjnumcs zjstkfctr"
    ).split()
}

# Measures of sales detail; each exists for this year and last year.
MARGIN_MEASURES = (
    "bapc barasu nsr cogs pc rb gp fscom logistics_cst sal_del_cst cen_shp_cst cent_fee "
    "bs_en_fee trp_cst mp jr_opr_cst jr_tr_fee"
).split()
VOLUME_MEASURES = "vv511 vv512 vv513 vv517 vv521 vv522 vv523 vv524 vv525 vv526 vv527 vv528".split()
TEXT_MEASURES = "off_inv_rb rpp_nsr ccr_prc otr_cst net_ccr_prc otr_rb".split()
YEARS = ("cy", "ly")

_SALES_HEAD = """
calyear string, calmonth string, calday date, budat date, bw_calday_week date, year_ind string,
comp_code string, zjcustbrg string, zjmatrial string, zj445qatr string, zj445week string,
calday_prevyear date, calday_week_prevyear date, werks string, ww202 string, zjmatagsp string,
absmg_me string, absmg_me_ly string, absmg_cy decimal(18,5), absmg_ly decimal(18,5)
"""
SALES_DETAIL = _ddl(", ".join([
    _SALES_HEAD,
    *[f"cm_{y}_{m} decimal(18,6)" for m in MARGIN_MEASURES for y in YEARS],
    *[f"{m}_{y} decimal(15,2)" for m in VOLUME_MEASURES for y in YEARS],
    _same("string", "mgr_data_type hana_view plant_t"),
    *[f"cm_{y}_{m} string" for m in TEXT_MEASURES for y in YEARS],
]))
#: The same table as exported to JSON documents: days as text, no text measures.
SALES_DOCUMENT = T.StructType([
    T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType)
    for f in SALES_DETAIL.fields[: -2 * len(TEXT_MEASURES)]
])

BUSINESS_PLAN = _ddl("""
calday date, compared_date date, department_code string, district_code string, l3_code string,
sales_amount decimal(18,6), actual_sales_price decimal(18,6), sales_revenue decimal(18,6),
revenue_limit decimal(18,6)
""")

_DAILY_KEYS = """
calday date, calday_prevyear date, sales_region_code string, sales_region_name string,
sales_district_code string, sales_district_name string, sales_branch_code string,
sales_branch_name string, channel_l2_code string, channel_l2_name string,
channel_l3_code string, channel_l3_name string
"""
_DAILY_MEASURES = _same(
    "decimal(18,6)",
    "bapc_cy bapc_ly bapc_vs_ly bapc_vs_ly_percentage gp_bapc nsr_cy nsr_ly nsr_vs_ly "
    "nsr_vs_ly_percentage gp gp_ly",
)
DAILY_SALES = _ddl(f"{_DAILY_KEYS}, {_DAILY_MEASURES}")
DAILY_SALES_MTD = DAILY_SALES
DAILY_SALES_BY_SKU = _ddl(f"{_DAILY_KEYS}, sku_code string, {_DAILY_MEASURES}")

CUSTOMER_MASTER = _ddl(_same("string", """
zero_region___t zjcust zjbjiclv2___t zjsreigce zjcdsrecd zjcdsrecd___t zjlocacd zjlocacd___t
zjsmwerks zjsmpdroc zjddexfl___t zjdfflg zjbjicl_m zjbtindgc zjchgrcd zjchncd zjschncd zjbtlaccd
zjaddress zjslctlbs zjdivold2 zjtorikec zjinoutcl zjdivgcd zjdivcd
"""))
MATERIAL_MASTER = _ddl(_same("string", """
zjancd zjbevmnc___t zjcatcd___t zjddcscd___t zjddctcd___t zjejbrand___t zjmate zjmate___t
zjnewprdc___t zjpackcd___t zjreldt zjrpppkg___t zjsbcatcd___t zjsubcatc___t zjbudtf
"""))


def _coded(*stems: str) -> str:
    return " ".join(f"{s}_code {s}_name" for s in stems)


#: Renamed customer master: one key, then mostly code and name pairs.
CUSTOMER_MASTER_RENAMED = _ddl(_same("string", " ".join([
    "delivery_location_code customer_name",
    _coded("location", "dealer", "company"),
    _coded(*[f"channel_lv{n}" for n in (1, 2, 3)]),
    _coded("bottler_business_type", "bottler_channel_group", "bottler_channel", "bottler_sub_channel"),
    _coded(*[f"bottler_account_lv{n}" for n in (1, 2, 3)]),
    _coded("bottler_account", "key_account", "ddis_actual_sending_exclusion_flag"),
    _coded(*[f"ddis_channel_lv{n}" for n in (1, 2, 3, 4)]),
    _coded("ddis_coverage_target"),
    _coded(*[f"kam_department_lv{n}" for n in (1, 2, 3, 4)]),
    _coded("kam_classification", "kam_contact_person", "old_bottler2", "sales_region",
           "district_headquarter", "branch", "sales_center", "sales_control_base",
           "sales_control_base_route", "commercial_distribution_base"),
    "commercial_distribution_sales_representative_route_code",
    _coded("commercial_distribution_sales_representative_employee"),
    "logistics_route_code",
    _coded("logistics_base", "logistics_route_person_in_charge", "order_type_indicator",
           "reg_fs_classification"),
    "transaction_start_date transaction_end_date",
    _coded("transaction_classification"),
    "data_filter_flag",
    _coded("prefecture"),
    "street_address address",
    _coded("face", "indoor_outdoor_classification"),
    "jr_vending_machine_classification jr_line_section jr_management_company jr_station_name",
    _coded("virtual_classification", "active_status"),
])))

# Point of sale.
_POS_MEASURES = _same("decimal(34,4)", """
quantity amount_of_money gross_profit selling_price sale_quantity sale_amount
bargain_gross_profit sale_price number_of_dealers
""")
_POS_HEAD = "company_code string, store_code string, jan_code string, period date"
POS_COMPANY_WEEKLY = _ddl(f"{_POS_HEAD}, {_POS_MEASURES}, number_of_visitors decimal(38,4), load_date date")
POS_STORE_DAILY = _ddl(f"{_POS_HEAD}, {_POS_MEASURES}, number_of_visitors decimal(38,0), load_date date")
POS_PERIOD_LIST = _ddl("company_code string, store_code string, period date")
POS_GOODS = _ddl(f"""
sku string, product_name_1 string, product_name_2 string, product_name_3 string,
quantity decimal(34,4), {_same("string", '''
large_category middle_category small_category detail_manufacturer
large_category_special_insurance_functional_gender
middle_category_special_insurance_functional_gender segment
segment_special_insurance_functional_gender container large_pkg large_pkg_2 large_manufacturer
middle_manufacturer special_insurance_functionality
special_insurance_functionality_with_efficacy coffeecluster pitch split_material_flg
multi_classification new_goods alcohol_degree size container_size brand js_code width height depth
product_release_date''')}, registration_date date, contents string, bottler_name string
""")
POS_COMPANY = _ddl(_same("string", """
company_code company_name sales_division hq div channel customer_l3 customer_en
""") + ", nsr_ratio decimal(18,10)")
POS_STORE = _ddl(", ".join([
    _same("string", """
company_code company_name house_code house_name dc_no j_scale_code shared_customer_code channel
prefecture_name bottler area sub_area corporate_name weekly_report_target pos_target
new_goods_target control_bottler l3_company_code l3_company_name
contract_disclosure_third_party_target contract_disclosure_principal"""),
    *[f"e_reserve_{n} string" for n in range(8, 21)],
    *[f"customer_attributes_{n} string" for n in range(1, 21)],
    "request_date date, request_details string",
]))
#: Headed point-of-sale file; every cell arrives as text and is cast later.
POS_MASTER_TEXT = _ddl(_same("string", """
account_code account_name customer_code customer_name jan_code product_name manufacturer_code
manufacturer_name scategory_l_code scategory_l_name scategory_m_code scategory_m_name
scategory_s_code scategory_s_name scategory_ss_code scategory_ss_name norm norm_scale duration
sales_amount sales_price sales_revenue customer_engagement
"""))
POS_MASTER_CASTS = {
    "sales_amount": "int", "sales_price": "int", "sales_revenue": "int", "customer_engagement": "int",
}

# Alcohol.
WHOLESALER_DELIVERY = _ddl(_same("string", """
wholesaler_code wholesaler_name wholesaler_centre_code wholesaler_centre_name
customer_branch_code customer_branch_name customer_branch_address customer_branch_phone
""") + ", delivery_date date, jan_code string, product_name string, can_quantity decimal(16,8)")
ALCOHOL_ACCOUNT_MANAGER = _ddl(_same("string", """
customer_code customer_name channel sales_team_name account_manager_name
"""))
ALCOHOL_BRIDGE = _ddl(_same("string", """
wholesaler_name customer_branch_code channel customer_code customer_name customer_code_lv3
customer_name_lv3 alcohol_code
"""))
ALCOHOL_SOFT_DRINK_CUSTOMER = _ddl(_same("string", "customer_code_lv3 customer_name_lv3 channel segment"))
ALCOHOL_PRODUCT = _ddl("product_name string, jan_code string, can_qty decimal(16,6)")

# Equipment, usage, plan, market data.
EQUIPMENT_PLACEMENT = _ddl(", ".join([
    "wo_no string, sagyosya string, in_out string, addat date, idat2 date",
    _same("string", """
target_date work_name sold_to sold_to_party shipto ship_to_party fs_reg serial_number startup_date
equipment_code item_code item_name new_old cde_type_l_name cde_type_m_name cde_type_s_name
cde_budget_category_name prefecture serial_number2 startup_date2 equipment_code2 item_code2
item_name2 cde_type_l_name2 cde_type_m_name2 cde_type_s_name2 cde_budget_category_name2 sold_to2
ship_to2 company_code vkbur bezei kpi_count system_status work_center_code kostl wbs auart
delete_flag zjdivgcd zjdivgcd__t zjdivcd zjdivcd__t zjbjiclv1 zjbjiclv__t zjbjiclv2 zjbjiclv2__t
zjbjicl_m zjbjicl_m__t zjejal3 zjejal3__t zjkamdpl1 zjkamdpl1__t cde_budget_category cde_type_l
cde_type_m cde_type_s sales_forcast sales_office_code"""),
]))
EQUIPMENT_CUSTOMER = _ddl(_same("string", """
zjcdsrecd zjcdsrecd___t zjlocacd zjlocacd___t zjsmwerks zjsmpdroc
"""))
USAGE_TOTAL = _ddl("email string, usage_ar int")
USAGE_DAY = _ddl("email string, day_of_usage date, usage_ar float")
SALES_PLAN = _ddl("""
jan_code string, case_jan_code string, js string, sku string, channel string, plan_type string,
week string, year string, value decimal(18,5)
""")
MARKET_DATA = _ddl(_same("string", """
channel category product_jp sku sku_code maker kubun package_size region week
""") + ", " + _same("int", """
values_liters values_unit_case values_jpy values_turn values_coverage values_bottles
"""))

# Store visits.
_KPI_VALUES = _ddl("numerator double, denominator double, result string, score double").fields
_ENTITIES = T.StructField("entities", T.ArrayType(_ddl("uid string")))
_KPI_RESULT = (T.StructField("name", T.StringType()), _ENTITIES, *_KPI_VALUES)
_SCENE_IMAGES = _list(
    *_ddl("image_uid string, capture_time string").fields,
    T.StructField("image_urls", _ddl(_same("string", "original medium small"))),
)
_IMAGES = _list(
    *_ddl(_same("string", """
scene_id scene_uid scene_status scene_closed_by_TTL store_area_code task_name task_display_name
task_code task_uuid thumbnail_url preview_url""")).fields,
    T.StructField("scene_images", _SCENE_IMAGES),
)
VISIT = T.StructType([
    *_ddl(_same("string", """
session_uid visitor_identifier session_date session_start_time session_end_time visit_type_name
GPS_coordinates_latitude GPS_coordinates_longitude store_GPS_coordinates_latitude
store_GPS_coordinates_longitude store_number""")).fields,
    T.StructField("details", T.StructType([
        T.StructField("kpis", _list(*_KPI_RESULT, T.StructField("results", _list(*_KPI_RESULT)))),
        T.StructField("images", _IMAGES),
    ])),
])
STORE_PAGE = T.StructType([T.StructField("store", _list(
    *_ddl(_same("string", """
store_number store_name store_display_name store_type_name street address_line_2 city postal_code
latitude longitude manager_name manager_phone manager_email region_name district_name branch_name
retailer_name state_code is_active""")).fields,
    T.StructField("store_additional_attributes", T.MapType(T.StringType(), T.StringType())),
))])
PRODUCT_PAGE = T.StructType([T.StructField("product", _list(
    *_ddl(_same("string", """
pk product_name product_type product_uuid product_local_name product_short_name brand_name
brand_local_name manufacturer_name manufacturer_local_name is_deleted product_client_code
container_type size unit_measurement is_active category_name category_local_name subcategory_name
subcategory_local_name""")).fields,
    T.StructField("images", T.ArrayType(_ddl("image_url string"))),
))])
STORE_MASTER_SMALL = _ddl(_same("string", """
customer_code store_name office_code sales_center account_code account_name channel segment city
prefecture
"""))

# People and activity.
HR_DEPARTMENT = _ddl(_same("string", """
name_localized parent externalCode cust_string17 name customString1 customString8
"""))
HR_PERSON = _ddl(_same("string", """
personIdExternal startDate endDate nationality gender customString5 customString6 customString4
lastName middleName firstName maritalStatus challengeStatus
"""))
HR_JOB = _ddl(_same("string", """
userId managerId company jobCode department jobTitle customString2 customString25 customString24 emplStatus
"""))
HR_EMAIL = _ddl("personIdExternal string, emailAddress string")
def hr_page(entity: T.StructType) -> T.StructType:
    """One landed page of a people entity: ``{"d": {"results": [...]}}``."""
    return T.StructType([T.StructField("d", T.StructType([
        T.StructField("results", T.ArrayType(entity))]))])


ACTIVITY_EVENT = _ddl(_same("string", "CreationTime Id Operation Workload UserId"))
ACTIVITY_DOCUMENT = T.StructType([T.StructField("root", T.ArrayType(ACTIVITY_EVENT))])

JOB_RUNS = _ddl("""
job string, run_id string, processed_date date, target_table string, row_count bigint,
truncated boolean, target_first date, target_last date, started timestamp, ended timestamp,
elapsed_seconds double, status string, message string
""")
