"""Equipment placement and customer route reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.clean import recode
from shelfline.operators.joins import measured

# Recodes of the placement report. Months are recoded for one year only.
RECODED_YEAR = 2020
MONTH_NUMBERS = {f"{RECODED_YEAR}{m:02d}": str(m) for m in range(1, 13)}
WORK_TYPES = {
    "新規設置": "NewPlacement", "交換": "Exchange", "玉突": "PileUp", "移動": "Move",
    "単独撤収": "Replace",
}
CHANNELS = {"": "Other", "Food": "RF", "Retail": "RF", "SMDD": "CS"}


def equipment_recode(placement: DataFrame) -> DataFrame:
    """Placement rows under report names with month, work type and channel recoded."""
    return placement.select(
        F.col("wo_no").alias("order_id"),
        F.col("addat").alias("date_scheduled"),
        F.col("idat2").alias("date_placement"),
        recode("target_date", MONTH_NUMBERS).alias("date_month"),
        F.col("work_name").alias("placement_type_jp"),
        recode("work_name", WORK_TYPES).alias("placement_type_en"),
        F.col("sold_to").alias("customer_code"),
        F.col("sold_to_party").alias("customer_name"),
        F.col("item_code").alias("item_code"),
        F.col("item_name").alias("item_name"),
        F.col("cde_type_l_name").alias("device_type_l"),
        F.col("cde_type_m_name").alias("device_type_m"),
        F.col("cde_type_s_name").alias("device_type_s"),
        F.col("prefecture").alias("prefecture"),
        recode("zjbjiclv__t", CHANNELS).alias("channel"),
        F.lit(1).alias("amount"),
    )


def equipment_customers(customers: DataFrame) -> DataFrame:
    """Distinct pairs of route employee and customer."""
    return customers.select(
        F.col("zjcdsrecd").alias("employee_code"),
        F.col("zjcdsrecd___t").alias("employee_name"),
        F.col("zjlocacd").alias("customer_code"),
        F.col("zjlocacd___t").alias("customer_name"),
        F.col("zjsmwerks").alias("work_code"),
        F.col("zjsmpdroc").alias("route_code"),
    ).distinct()


def customer_route_report(routes: DataFrame, customers: DataFrame, divisions: DataFrame,
                          bottlers: Sequence[str] = ("35",)) -> DataFrame:
    """Routes with their customer, division and representative customer."""
    division, customer, representative = measured(
        divisions.where(F.col("oldbottler1cd").isin(*bottlers))
        .select(F.col("zkzpdwerks").alias("_werks"), "divisionnm", "regionnm", "zkzpdwerksnm"),
        customers.select("kunnr", "name2", "ccc_season_start1", "ccc_season_end1", "kdkg5"),
        customers.select(F.col("kunnr").alias("_rep"), F.col("name2").alias("representative_name")),
    )
    joined = (
        routes.join(division, F.col("zkzpdwerks") == F.col("_werks"), "inner")
        .join(customer, F.col("zkzkunnr") == F.col("kunnr"), "inner")
        .join(representative, F.col("zresalcod") == F.col("_rep"), "left")
    )
    rep = F.col("zresalcod")
    differs = F.when(rep.isNull() | (rep == "") | (rep == F.col("zkzkunnr")), "").when(
        rep != F.col("zkzkunnr"), "X")
    store_type = F.when(F.col("kdkg5") == "M3", "RS").when(F.col("kdkg5") == "M4", "FS")
    return joined.select(
        F.col("divisionnm").alias("division"),
        F.col("regionnm").alias("region"),
        F.col("zkzpdwerks").alias("base_code"),
        F.col("zkzpdwerksnm").alias("base_name"),
        F.col("zkzpdcroute").alias("route"),
        F.col("kunnr").alias("customer_code"),
        F.col("name2").alias("customer_name"),
        rep.alias("representative_code"),
        F.col("representative_name"),
        differs.alias("representative_differs"),
        F.col("ccc_season_start1").alias("trading_start"),
        F.col("ccc_season_end1").alias("trading_end"),
        store_type.alias("rs_fs"),
    )
