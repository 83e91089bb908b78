"""Cleaning rules for single columns and whole frames.

Text dates, sentinels, null policy, casts. Every function is a JVM expression;
dirty text gives null rather than an ANSI error unless a rule says otherwise.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sentinels of the source systems.
LEAP_DAY = dt.date(2020, 2, 29)
OPEN_DAY = dt.date(2099, 1, 1)
FAR_DAY = dt.date(2199, 1, 1)
ZERO_DAY = "00000000"

# Columns of the sales extract that hold a day or a month as text.
DAY_COLUMNS = (
    "calday", "budat", "bw_calday_week", "calday_prevyear", "calday_week_prevyear",
    "0calday", "zjdate__zjcpdate", "0calday_week_prevyear",
)
MONTH_COLUMNS = ("calmonth",)
EQUIPMENT_DAY_COLUMNS = ("addat", "idat2")


def parse_day(col: Column | str, *, blank: dt.date | None = None, zero: dt.date | None = None) -> Column:
    """``yyyyMMdd`` text as a date.

    ``blank`` replaces the empty string (the leap day has no partner in other
    years), ``zero`` replaces ``00000000``. Other unreadable text gives null.
    """
    c = F.col(col) if isinstance(col, str) else col
    day = F.try_to_date(c, "yyyyMMdd")
    if zero is not None:
        day = F.when(c == ZERO_DAY, F.lit(zero)).otherwise(day)
    if blank is not None:
        day = F.when(c == "", F.lit(blank)).otherwise(day)
    return day


def month_text(col: Column | str) -> Column:
    """``yyyyMM`` as ``yyyy-MM``; the empty string gives ``-``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.substring(c, 1, 4), F.lit("-"), c.substr(F.lit(5), F.length(c)))


def day_text(col: Column | str) -> Column:
    """``yyyyMMdd`` as ``yyyy-MM-dd``; null counts as empty and gives ``--``."""
    c = F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
    return F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), c.substr(F.lit(7), F.length(c)))


def _present(df: DataFrame, names: Iterable[str]) -> list[str]:
    wanted = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() in wanted]


def apply_transaction_rules(
    df: DataFrame,
    day_cols: Iterable[str] = DAY_COLUMNS,
    month_cols: Iterable[str] = MONTH_COLUMNS,
    *,
    blank: dt.date | None = LEAP_DAY,
    zero: dt.date | None = None,
    null_text: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Month and day rules over the columns that exist in ``df``.

    With ``strict`` a row with an unreadable day fails the job, as loads want it;
    otherwise such a day becomes null. :func:`split_unreadable` sets such rows apart.

    The blank day is a parameter because the sources disagree: one writes the
    leap day, another a far-future day. ``null_text`` fills null text columns
    (daily sales and equipment want ``''``); typed columns keep their nulls.
    """
    days = _present(df, day_cols)
    exprs = {c: parse_day(f"`{c}`", blank=blank, zero=zero) for c in days}
    if strict:
        exprs = {c: F.when(_unreadable(c, day), F.raise_error(F.concat(F.lit(f"unreadable day in {c}: "), F.col(f"`{c}`")))).otherwise(day)
                 for c, day in exprs.items()}
    exprs |= {c: month_text(f"`{c}`") for c in _present(df, month_cols)}
    out = df.withColumns(exprs) if exprs else df
    return out if null_text is None else out.na.fill(null_text)


def _unreadable(name: str, day: Column) -> Column:
    text = F.col(f"`{name}`")
    return text.isNotNull() & (text != "") & day.isNull()


def split_unreadable(df: DataFrame, day_cols: Iterable[str] = DAY_COLUMNS, *, blank: dt.date | None = LEAP_DAY,
                     zero: dt.date | None = None) -> tuple[DataFrame, DataFrame]:
    """(readable, rejected): rejected rows have the columns at fault in ``reason``."""
    faults = F.array_compact(F.array(*[
        F.when(_unreadable(c, parse_day(f"`{c}`", blank=blank, zero=zero)), F.lit(c)) for c in _present(df, day_cols)]))
    judged = df.withColumn("reason", F.concat_ws(",", faults))
    return judged.where("reason = ''").drop("reason"), judged.where("reason <> ''")


def clean_equipment(df: DataFrame, *, strict: bool = False) -> DataFrame:
    """Equipment placement: zero days are open-ended, null text becomes empty."""
    return apply_transaction_rules(
        df, EQUIPMENT_DAY_COLUMNS, (), blank=None, zero=OPEN_DAY, null_text="", strict=strict
    )


def epoch_to_wall(col: Column | str, tz: str = "Asia/Tokyo") -> Column:
    """Epoch seconds as a wall clock in ``tz``; non-digit text gives null.

    Uses zone-free timestamps, so the result does not depend on the session zone.
    """
    c = (F.col(col) if isinstance(col, str) else col).cast("string")
    seconds = F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def loose_date(col: Column | str) -> Column:
    """A date from ISO, slash or compact text, null when none fits."""
    c = F.trim(F.col(col) if isinstance(col, str) else col)
    return F.coalesce(
        F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"),
        F.try_to_date(F.substring(c, 1, 10), "yyyy/MM/dd"),
        F.try_to_date(c, "yyyyMMdd"),
    )


def short_year_day(col: Column | str, century: str = "20") -> Column:
    """``yymmdd`` text as a date of ``century``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_date(F.concat(F.lit(century), c), "yyyyMMdd")


def blank_matching(df: DataFrame, columns: Iterable[str], pattern: str) -> DataFrame:
    """Null every cell in which ``pattern`` occurs (Unicode-aware)."""
    hit = "(?U)" + pattern
    return df.withColumns({c: F.when(~F.col(c).rlike(hit), F.col(c)) for c in columns})


def normalise_name(col: Column | str) -> Column:
    """Spaces to underscores, lower case."""
    return F.lower(F.translate(F.col(col) if isinstance(col, str) else col, " ", "_"))


def normalise_columns(df: DataFrame) -> DataFrame:
    """The same rule on the column names of ``df``."""
    return df.toDF(*[c.replace(" ", "_").lower() for c in df.columns])


def select_line(source: Column | str, target: Column | str) -> Column:
    """The text ``source as target,`` used when drafting a column list."""
    return F.concat(F.col(source) if isinstance(source, str) else source, F.lit(" as "),
                    F.col(target) if isinstance(target, str) else target, F.lit(","))


def cast_columns(df: DataFrame, types: Mapping[str, str | T.DataType], *, dirty: bool = False) -> DataFrame:
    """Cast named columns; ``dirty`` input gives null instead of an error."""
    def one(name: str, kind: str | T.DataType) -> Column:
        return F.col(name).try_cast(kind) if dirty else F.col(name).cast(kind)

    return df.withColumns({n: one(n, k) for n, k in types.items()})


def recode(col: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, pass the others through."""
    c = F.col(col) if isinstance(col, str) else col
    out = None
    for value, new in mapping.items():
        out = F.when(c == value, F.lit(new)) if out is None else out.when(c == value, F.lit(new))
    return c if out is None else out.otherwise(c)


def leading_digit_codes(df: DataFrame, code: str, level: str) -> DataFrame:
    """Rows with a level and a code that starts with ten digits."""
    return df.where(F.col(level).isNotNull() & F.col(code).rlike("^[0-9]{10}"))


def year_week_text(day: Column | str) -> tuple[Column, Column]:
    """Year text, and ``MMdd`` followed by the week of the month."""
    d = F.col(day) if isinstance(day, str) else day
    week = F.ceil(F.dayofmonth(d) / F.lit(7)).cast("string")
    return F.date_format(d, "yyyy"), F.concat(F.date_format(d, "MMdd"), week)


def populated_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row telling for each column whether any cell is set and non-zero."""
    names = list(columns or df.columns)
    kinds = dict(df.dtypes)

    def seen(name: str) -> Column:
        c = F.col(name)
        if kinds[name] in ("double", "float"):
            # NaN counts as missing, as a null does.
            return c.isNotNull() & ~F.isnan(c) & (c != 0)
        if kinds[name] == "string":
            return c.isNotNull() & (c != "")
        if kinds[name] == "boolean":
            return F.coalesce(c, F.lit(False))
        if kinds[name].startswith(("date", "timestamp")):
            return c.isNotNull()
        return c.isNotNull() & (c != 0)

    return df.agg(*[F.coalesce(F.bool_or(seen(n)), F.lit(False)).alias(n) for n in names])
