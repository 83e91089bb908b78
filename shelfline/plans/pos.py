"""Point-of-sale marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.clean import year_week_text
from shelfline.operators.joins import measured
from shelfline.session import materialise


def weekly_with_periods(weekly: DataFrame, periods: DataFrame) -> DataFrame:
    """Weekly rows whose company and period are listed for the whole company.

    The list is written once: it may be derived from a fact, which would be read
    again to measure it and again to join it.
    """
    listed, = measured(materialise(periods.where(F.col("store_code").isNull()).select("company_code", "period"), "periods"))
    return weekly.join(listed, ["company_code", "period"], "inner").select(*weekly.columns)


REPORT_KEYS = ("period", "hq", "channel", "div", "company_code", "customer_en", "customer_l3",
               "large_manufacturer", "middle_category", "large_pkg", "nsr_ratio")


def weekly_rows(weekly: DataFrame, periods: DataFrame, goods: DataFrame, companies: DataFrame) -> DataFrame:
    """Listed weekly rows with goods and company columns, year and week text."""
    good, company = measured(
        goods.select(F.trim("sku").alias("_sku"), F.col("quantity").alias("mg_quantity"),
                     "large_pkg", "large_manufacturer", "middle_category"),
        companies.select(F.col("company_code").alias("_company"), "company_name", "hq", "div", "channel",
                         "customer_en", "customer_l3", "nsr_ratio"),
    )
    year, week = year_week_text("period")
    return (
        weekly_with_periods(weekly, periods)
        .join(good, F.col("jan_code") == F.col("_sku"), "inner")
        .join(company, F.col("company_code") == F.col("_company"), "inner")
        .withColumns({"str_year": year, "str_weekdate": week})
        .drop("_sku", "_company")
    )


def weekly_report(weekly: DataFrame, periods: DataFrame, goods: DataFrame, companies: DataFrame) -> DataFrame:
    """Money, quantity and pack-converted quantity by eleven keys.

    Factors are cut to ``decimal(18,4)`` first: Spark would otherwise shorten the
    scale of a product of two ``decimal(34,4)``.
    """
    rows = weekly_rows(weekly, periods, goods, companies)
    pieces = F.col("quantity").cast("decimal(18,4)") * F.col("mg_quantity").cast("decimal(18,4)")
    return rows.groupBy(*REPORT_KEYS).agg(
        F.sum("amount_of_money").cast("decimal(38,4)").alias("sum_amount_of_money"),
        F.sum("quantity").cast("decimal(38,4)").alias("sum_quantity"),
        F.sum(pieces).cast("decimal(38,8)").alias("sum_quantity_converted"),
    )


def store_daily_range(daily: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Store rows of an inclusive period range."""
    return daily.where(F.col("period").between(F.lit(first), F.lit(last)))
