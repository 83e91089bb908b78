import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfline.functions import clean, dates
from shelfline.sinks.export import export_ready


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def texts(spark, *cells):
    return spark.createDataFrame([(c,) for c in cells], "c string")


def test_parse_day(spark):
    df = texts(spark, "20210131", "", "00000000", "20210231", None, "x")
    plain = [dt.date(2021, 1, 31), None, None, None, None, None]
    assert values(df, clean.parse_day("c")) == plain
    ruled = clean.parse_day("c", blank=clean.LEAP_DAY, zero=clean.OPEN_DAY)
    assert values(df, ruled) == [plain[0], dt.date(2020, 2, 29), dt.date(2099, 1, 1), None, None, None]


def test_month_and_day_text(spark):
    assert values(texts(spark, "202101", "", None), clean.month_text("c")) == ["2021-01", "-", None]
    assert values(texts(spark, "20210131", "", None), clean.day_text("c")) == ["2021-01-31", "--", "--"]


def test_transaction_rules(spark):
    df = spark.createDataFrame([("202002", "", None, "keep"), ("202101", "20210101", "20210102", None)],
                               "CALMONTH string, CALDAY_prevyear string, BUDAT string, note string")
    kept = clean.apply_transaction_rules(df).collect()
    assert [r.CALMONTH for r in kept] == ["2020-02", "2021-01"]
    assert [r.CALDAY_prevyear for r in kept] == [dt.date(2020, 2, 29), dt.date(2021, 1, 1)]
    assert [r.BUDAT for r in kept] == [None, dt.date(2021, 1, 2)]
    assert [r.note for r in kept] == ["keep", None]
    filled = clean.apply_transaction_rules(df, null_text="").collect()
    assert [r.note for r in filled] == ["keep", ""]


def test_clean_equipment(spark):
    df = spark.createDataFrame([("20200904", "00000000", None)], "addat string, idat2 string, item string")
    assert clean.clean_equipment(df).first() == (dt.date(2020, 9, 4), dt.date(2099, 1, 1), "")


def test_epoch_is_independent_of_the_session_zone(spark):
    df = texts(spark, "0", "1600000000", "soon", "-5", None)
    want = [dt.datetime(1970, 1, 1, 9), dt.datetime(2020, 9, 13, 21, 26, 40), None, None, None]
    assert values(df, clean.epoch_to_wall("c")) == want
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert values(df, clean.epoch_to_wall("c")) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_blank_matching_is_unicode_aware(spark):
    df = texts(spark, "部門1", "部門", "A1", "7", None)
    out = clean.blank_matching(df, ["c"], r"\w+[0-9]{1}")
    assert [r.c for r in out.collect()] == [None, "部門", None, "7", None]


def test_recode_passes_other_values(spark):
    df = texts(spark, "a", "z", None)
    assert values(df, clean.recode("c", {"a": "A"})) == ["A", "z", None]


def test_leading_digits(spark):
    df = spark.createDataFrame([("0123456789x", "L0"), ("x0123456789", "L0"), ("0123456789", None)],
                               "code string, lv string")
    assert [r.code for r in clean.leading_digit_codes(df, "code", "lv").collect()] == ["0123456789x"]


def test_loose_and_short_dates(spark):
    df = texts(spark, "2021-09-01", "2021/09/01", "20210901", "2021-09-01 10:00", "no")
    assert values(df, clean.loose_date("c")) == [dt.date(2021, 9, 1)] * 4 + [None]
    assert values(texts(spark, "210901", "bad"), clean.short_year_day("c")) == [dt.date(2021, 9, 1), None]


def test_dirty_casts(spark):
    df = texts(spark, "1", "n/a")
    assert [r.c for r in clean.cast_columns(df, {"c": "int"}, dirty=True).collect()] == [1, None]


def test_populated_profile(spark):
    df = spark.createDataFrame([(0, float("nan"), "", None), (0, 0.0, "", None)],
                               "a int, b double, c string, d date")
    assert clean.populated_profile(df).first() == (False, False, False, False)
    more = df.union(spark.createDataFrame([(1, 2.0, "x", dt.date(2020, 1, 1))], df.schema))
    assert clean.populated_profile(more).first() == (True, True, True, True)


def test_column_names(spark):
    df = spark.createDataFrame([(1,)], "`Customer Code` int")
    assert clean.normalise_columns(df).columns == ["customer_code"]


def test_export_values(spark):
    df = spark.createDataFrame([("", None, Decimal("-1.7"), None), ("202101", "20210102", Decimal("2.9"), "n")],
                               "calmonth string, calday string, amount decimal(18,6), note string")
    assert [tuple(r) for r in export_ready(df).collect()] == [
        ("-", "--", -1, ""), ("2021-01", "2021-01-02", 2, "n")]


def test_windows():
    day = dt.date(2020, 3, 1)
    assert dates.two_days(day) == dates.Window(dt.date(2020, 2, 29), day)
    assert dates.month_of(dt.date(2020, 2, 10)) == dates.Window(dt.date(2020, 2, 1), dt.date(2020, 2, 29))
    assert dates.current_month(dt.date(2020, 12, 5), dt.date(2021, 1, 3)).last == dt.date(2021, 1, 31)
    assert dates.month_to_date(day).days() == [day]


def test_date_list(spark):
    df = spark.createDataFrame([(dt.date(2020, 2, 28), dt.date(2020, 3, 1))], "a date, b date")
    assert [r.day_key for r in dates.date_list(df, "a", "b").collect()] == ["20200228", "20200229", "20200301"]


def test_week_text(spark):
    df = spark.createDataFrame([(dt.date(2021, 9, 30),)], "d date")
    assert df.select(*clean.year_week_text("d")).first() == ("2021", "09305")
    assert df.select(F.lit(1)).count() == 1


def test_unreadable_days_are_refused_or_set_apart(spark):
    df = spark.createDataFrame([(1, "20240105"), (2, "20241345"), (3, ""), (4, None)], "k int, calday string")
    good, bad = clean.split_unreadable(df)
    assert [r.k for r in good.orderBy("k").collect()] == [1, 3, 4]
    assert [(r.k, r.reason) for r in bad.collect()] == [(2, "calday")]
    assert clean.apply_transaction_rules(good, strict=True).count() == 3
    with pytest.raises(Exception, match="unreadable day in calday"):
        clean.apply_transaction_rules(df, strict=True).collect()
