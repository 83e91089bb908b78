"""Nested store visits to nine fact tables; store and product masters to flat rows.

Arrays are filtered before they are exploded, so only wanted KPIs become rows.
``get`` returns null past the end of an array, so a KPI with one entity keeps its row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.clean import epoch_to_wall, loose_date
from shelfline.sinks.audit import LoadResult
from shelfline.sinks.loads import many_targets

# KPI names, without the customer prefix the source puts before them.
POC_COUNT = "POC_COUNT_BY_TASK"
POC_SCORE = "POC_SCORE_BY_TARGET"
MSL_STORE = "Dst_Manufacturer_in_Whole_Store"
MSL_PRODUCT = "Product_Presence_in_Whole_Store"
SOVI_CATEGORY_OWN = "FSOS_Own_Manufacturer_By_Category"
SOVI_CATEGORY_ALL = "FSOS_All_Manufacturer_By_Category"
SOVI_STORE_OWN = "FSOS_Own_Manufacturer_In_Whole_Store"
SOVI_STORE_ALL = "FSOS_All_Manufacturer_In_Whole_Store"
UNIQUE = "UNIQUE_DIST_OWN_MANU"
RED = "RED_SCORE"


def _uid(place: Column, index: int) -> Column:
    return F.get(place["entities"], F.lit(index))["uid"]


def _count(value: Column) -> Column:
    """Counts are cut to whole numbers before they get their column type."""
    return value.cast("bigint").cast("decimal(18,5)")


def _whole(value: Column) -> Column:
    return value.cast("int")


def _ratio(value: Column) -> Column:
    return value.try_cast("decimal(18,5)")


Measures = Callable[[Column], Mapping[str, Column]]

_FACTS: dict[str, tuple[str, str | None, Measures]] = {
    "poc": (POC_COUNT, None, lambda k: {
        "poc_type": _uid(k, 0), "location": _uid(k, 1), "count": _count(k["numerator"])}),
    "poc_score": (POC_SCORE, None, lambda k: {
        "availability_count": _whole(k["numerator"]), "target": _whole(k["denominator"]),
        "priority_poc_score": _ratio(k["result"]), "priority_poc_score_weight": _ratio(k["score"])}),
    "msl_store": (MSL_STORE, None, lambda k: {
        "actual_msl": _count(k["numerator"]), "expected_msl": _count(k["denominator"]),
        "msl": _ratio(k["result"]), "msl_weight": _ratio(k["score"])}),
    "msl_product": (MSL_STORE, MSL_PRODUCT, lambda k: {
        "product_code": _uid(k, 0), "availability": _count(k["numerator"]), "msl_type": k["result"]}),
    "sovi_category": (SOVI_CATEGORY_OWN, SOVI_CATEGORY_ALL, lambda k: {
        "manufacturer": _uid(k, 0), "category": _uid(k, 1), "actual_facing": _count(k["numerator"]),
        "total_facing": _count(k["denominator"]), "sovi": _ratio(k["result"])}),
    "sovi_store": (SOVI_STORE_OWN, SOVI_STORE_ALL, lambda k: {
        "manufacturer": _uid(k, 0), "actual_facing": _count(k["numerator"]),
        "total_facing": _count(k["denominator"]), "sovi": _ratio(k["result"])}),
    "unique": (UNIQUE, None, lambda k: {
        "manufacturer": _uid(k, 0), "unique_product_count": _count(k["numerator"]),
        "total_product_count": _count(k["denominator"]), "unique_sovi": _ratio(k["result"])}),
    "red": (RED, None, lambda k: {"red_score": _ratio(k["result"])}),
}
KPI_FACTS = tuple(_FACTS)


def visit_header(tz: str = "Asia/Tokyo") -> list[Column]:
    """The eleven visit columns every KPI row carries."""
    return [
        F.col("session_uid").alias("session_id_unique"),
        F.col("visitor_identifier").alias("email"),
        loose_date("session_date").alias("visit_date"),
        epoch_to_wall("session_start_time", tz).alias("start_time"),
        epoch_to_wall("session_end_time", tz).alias("end_time"),
        F.col("visit_type_name").alias("visit_type"),
        F.col("GPS_coordinates_latitude").alias("gps_latitude"),
        F.col("GPS_coordinates_longitude").alias("gps_longitude"),
        F.col("store_GPS_coordinates_latitude").alias("store_latitude"),
        F.col("store_GPS_coordinates_longitude").alias("store_longitude"),
        F.col("store_number").alias("customer_code"),
    ]


HEADER = ("session_id_unique", "email", "visit_date", "start_time", "end_time", "visit_type",
          "gps_latitude", "gps_longitude", "store_latitude", "store_longitude", "customer_code")
PHOTO = "photo"


def kpi_rows(visits: DataFrame, names: Sequence[str], tz: str = "Asia/Tokyo") -> DataFrame:
    """Header and KPI struct, one row per KPI of the given names."""
    places = F.filter("details.kpis", lambda k: k["name"].isin(*names))
    return _headed(visits, tz).select(*HEADER, F.explode(places).alias("kpi"))


def _headed(visits: DataFrame, tz: str) -> DataFrame:
    """The header once for each visit, not for each of its parts. Arrays are filtered in the step that explodes them, on
    whole details: in this one, Spark would move the details' own expressions into the filter, which runs uncompiled."""
    return visits.select(*visit_header(tz), "details")


def fact_from_kpis(kpis: DataFrame, fact: str, *, prefix: str = "") -> DataFrame:
    """One fact table from KPI rows of its parent KPI."""
    _, child, measures = _FACTS[fact]
    rows = kpis
    if child is not None:
        children = F.filter("kpi.results", lambda k: k["name"] == prefix + child)
        rows = kpis.select(*HEADER, F.explode(children).alias("kpi"))
    return rows.select(*HEADER, *[c.alias(n) for n, c in measures(F.col("kpi")).items()])


def visit_fact(visits: DataFrame, fact: str, *, prefix: str = "", tz: str = "Asia/Tokyo") -> DataFrame:
    """One of the eight KPI fact tables."""
    return fact_from_kpis(kpi_rows(visits, [prefix + _FACTS[fact][0]], tz), fact, prefix=prefix)


def photos_from_scenes(scenes: DataFrame, tz: str = "Asia/Tokyo") -> DataFrame:
    """Photo rows from ``customer_code, scene`` rows."""
    shots = scenes.select("customer_code", "scene", F.explode("scene.scene_images").alias("shot"))
    fields = ("scene_id scene_uid scene_status scene_closed_by_TTL store_area_code task_name "
              "task_display_name task_code task_uuid thumbnail_url preview_url").split()
    return shots.select(
        *[F.col(f"scene.{n}").alias(n) for n in fields],
        F.col("shot.image_uid").alias("image_uid"),
        epoch_to_wall("shot.capture_time", tz).alias("capture_time"),
        "customer_code",
        *[F.col(f"shot.image_urls.{n}").alias(f"image_url_{n}") for n in ("original", "medium", "small")],
    )


def visit_photos(visits: DataFrame, *, tz: str = "Asia/Tokyo") -> DataFrame:
    """One row per photo of every scene."""
    scenes = visits.select(F.col("store_number").alias("customer_code"),
                           F.explode("details.images").alias("scene"))
    return photos_from_scenes(scenes, tz)


def visit_facts(visits: DataFrame, *, prefix: str = "", tz: str = "Asia/Tokyo") -> dict[str, DataFrame]:
    """All nine fact tables by name."""
    facts = {f: visit_fact(visits, f, prefix=prefix, tz=tz) for f in KPI_FACTS}
    return facts | {PHOTO: visit_photos(visits, tz=tz)}


def visit_parts(visits: DataFrame, *, prefix: str = "", tz: str = "Asia/Tokyo") -> DataFrame:
    """KPIs and scenes of all visits in one pass: ``kind``, header, ``kpi`` or ``scene``."""
    names = [prefix + n for n in dict.fromkeys(parent for parent, _, _ in _FACTS.values())]
    kpi = visits.schema["details"].dataType["kpis"].dataType.elementType
    scene = visits.schema["details"].dataType["images"].dataType.elementType
    kpis = F.transform(
        F.filter("details.kpis", lambda k: k["name"].isin(*names)),
        lambda k: F.struct(k["name"].alias("kind"), k.alias("kpi"), F.lit(None).cast(scene).alias("scene")))
    scenes = F.transform(
        "details.images",
        lambda s: F.struct(F.lit(PHOTO).alias("kind"), F.lit(None).cast(kpi).alias("kpi"), s.alias("scene")))
    parts = F.concat(F.coalesce(kpis, F.array()), F.coalesce(scenes, F.array()))
    return _headed(visits, tz).select(*HEADER, F.explode(parts).alias("part")).select(*HEADER, "part.*")


def load_visit_facts(visits: DataFrame, paths: Mapping[str, str], staging: str, *, prefix: str = "",
                     tz: str = "Asia/Tokyo", max_rows: int | None = None) -> dict[str, LoadResult]:
    """All nine tables from one pass over the visit documents."""
    builders = {f: partial(fact_from_kpis, fact=f, prefix=prefix) for f in KPI_FACTS}
    days = dict.fromkeys(KPI_FACTS, "visit_date")

    def photos(rows: DataFrame) -> DataFrame:
        return photos_from_scenes(rows, tz).withColumn("capture_date", F.to_date("capture_time"))

    return many_targets(
        visit_parts(visits, prefix=prefix, tz=tz), "kind", staging,
        builders=builders | {PHOTO: photos},
        reads={f: prefix + _FACTS[f][0] for f in KPI_FACTS} | {PHOTO: PHOTO},
        paths=paths, days=days | {PHOTO: "capture_date"}, max_rows=max_rows,
    )


# Numbered store attributes that have a name of their own.
_NAMED_ATTRIBUTES = {
    "account_code": 4, "account_name": 3, "office_code": 5, "office_name": 6, "route_code": 7,
    "person_in_charge": 9, "person_in_charge_mail": 13, "channel": 10,
}
_PLAIN_ATTRIBUTES = (8, 11, 12, 14, 15, 16, 17, 18, 19, 20, 21, 22)
SEGMENT = "blank"
CITIES = ("Tokyo", "Non_Tokyo")


def _attribute(number: int) -> Column:
    return F.col("store_additional_attributes")[f"additional_attribute_{number}"]


def flatten_store(stores: DataFrame, *, cities: tuple[str, ...] | None = CITIES,
                  null_text: str | None = "Null") -> DataFrame:
    """The 42 columns of a store; only stores of ``cities``, null text replaced."""
    plain = {
        "customer_code": "store_number", "store_name": "store_name",
        "store_display_name": "store_display_name", "store_type_name": "store_type_name",
        "street": "street", "address_line_2": "address_line_2", "city": "city",
        "postal_code": "postal_code", "latitude": "latitude", "longitude": "longitude",
        "manager_name": "manager_name", "manager_phone": "manager_phone",
        "manager_email": "manager_email", "region_name": "region_name",
        "district_name": "district_name", "branch_name": "branch_name",
        "retailer_name": "retailer_name", "state_code": "state_code",
    }
    flat = stores.select(
        *[F.col(source).alias(name) for name, source in plain.items()],
        _attribute(1).alias("store_additional_attribute_1"),
        *[_attribute(n).alias(name) for name, n in _NAMED_ATTRIBUTES.items()],
        F.lit(SEGMENT).alias("segment"),
        F.col("district_name").alias("prefecture"),
        F.col("is_active").alias("is_active"),
        *[_attribute(n).alias(f"additional_attribute_{n}") for n in _PLAIN_ATTRIBUTES],
    )
    if cities is not None:
        flat = flat.where(F.col("city").isin(*cities))
    return flat if null_text is None else flat.na.fill(null_text)


def flatten_store_small(stores: DataFrame) -> DataFrame:
    """The ten-column store master of the older job; a missing channel is one space."""
    return stores.select(
        F.col("store_number").alias("customer_code"),
        F.col("store_display_name").alias("store_name"),
        F.col("branch_name").alias("office_code"),
        F.col("region_name").alias("sales_center"),
        F.col("branch_name").alias("account_code"),
        F.col("store_type_name").alias("account_name"),
        F.coalesce(_attribute(10), F.lit(" ")).alias("channel"),
        F.lit(SEGMENT).alias("segment"),
        F.col("street").alias("city"),
        F.col("district_name").alias("prefecture"),
    )


def flatten_product(products: DataFrame) -> DataFrame:
    """The 21 columns of a product; its first image, if any."""
    renamed = {"product_code": "pk", "sub_category_name": "subcategory_name",
               "sub_category_local_name": "subcategory_local_name"}
    names = ("product_code product_name product_type product_uuid product_local_name "
             "product_short_name brand_name brand_local_name manufacturer_name "
             "manufacturer_local_name is_deleted product_client_code container_type size "
             "unit_measurement is_active category_name category_local_name sub_category_name "
             "sub_category_local_name").split()
    return products.select(
        *[F.col(renamed.get(n, n)).alias(n) for n in names],
        F.get("images", F.lit(0))["image_url"].alias("images"),
    )
