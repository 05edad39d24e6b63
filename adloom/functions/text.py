"""Parsing of text columns. Bad input becomes null; nothing here raises under ANSI."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\f\v"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def _whole(c: Column, kind: str) -> Column:
    """A whole number, also where it is written with a point (``5.0``); 5.5 is none."""
    number = c.try_cast("decimal(38,18)")
    return F.coalesce(c.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))


def to_int(c: Column) -> Column:
    return _whole(c, "int")


def to_long(c: Column) -> Column:
    return _whole(c, "bigint")


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_money(c: Column) -> Column:
    return c.try_cast("decimal(12,2)")


def to_day(c: Column) -> Column:
    """Date written yyyy-MM-dd."""
    return F.try_to_date(c, "yyyy-MM-dd")


def to_wall_clock(c: Column) -> Column:
    """ISO text to a timestamp without zone (what a DATETIME column holds)."""
    return c.try_cast("timestamp_ntz")


def to_instant(c: Column) -> Column:
    """ISO text, with or without zone, to a point in time."""
    return F.try_to_timestamp(c)


def day_label(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def minute_label(ts: Column) -> Column:
    return F.date_format(ts, "dd_MM_yyyy_HH_mm")


def iso_text(ts: Column) -> Column:
    """Timestamp without zone to ISO text, independent of the session zone."""
    return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))


def comma_list(c: Column) -> Column:
    """Trimmed items of a comma list; an empty array for null."""
    items = F.transform(F.split(c, ","), strip)
    return F.coalesce(items, F.array().cast("array<string>"))


# Fixed value: how an age range is written in the targeting text.
AGE_RANGE = r"Age (\d+)-(\d+)"


def targeting_fields(targeting: Column) -> dict[str, Column]:
    """Age range, interest and country out of ``Age 18-35, Sports, Norway``.
    Parts that are missing come out as null."""
    parts = F.transform(F.split(targeting, ","), strip)
    return {
        "target_age_min": to_int(F.regexp_extract(targeting, AGE_RANGE, 1)),
        "target_age_max": to_int(F.regexp_extract(targeting, AGE_RANGE, 2)),
        "target_interest": F.get(parts, F.lit(1)),
        "target_country": F.get(parts, F.lit(2)),
    }
