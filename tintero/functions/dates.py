"""Date expressions: lenient parsing, integer day keys, calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO_DAY = r"^\s*(\d{4}-\d{1,2}-\d{1,2})([ T].*)?$"


def lenient_date(c: Column, formats: tuple[str, ...] = ()) -> Column:
    """Day of an ISO date, as written, or of the first of ``formats`` that reads it; else null.

    A time of day and a zone after a date are dropped, so neither shifts the day.
    """
    text = c.cast("string")
    parsed = F.when(F.rlike(text, F.lit(_ISO_DAY)), F.try_to_timestamp(F.regexp_extract(text, _ISO_DAY, 1)))
    others = [parsed_day(day_text(text), f) for f in formats]
    return F.coalesce(parsed.cast("date"), *others) if others else parsed.cast("date")


#: A time of day after a date, with whatever follows it.
_TIME = r"[T ]+\d{1,2}:\d{2}.*$"


def day_text(c: Column) -> Column:
    """The part of a date text before its time of day, without outer blanks; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(c.cast("string"), f"(?s){_TIME}", "")), F.lit(""))


def parsed_day(text: Column, name: str) -> Column:
    """The day that ``text`` names under the format ``name``, null if it names none."""
    return F.try_to_timestamp(text, F.lit(name)).cast("date")


def day_key(day: Column) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_text(day: Column) -> Column:
    """Two-digit month."""
    return F.date_format(day, "MM")


def calendar(day: Column) -> dict[str, Column]:
    return {
        "date_id": day_key(day),
        "year": F.year(day),
        "month": month_text(day),
        "day": F.dayofmonth(day),
        "day_of_week": F.date_format(day, "EEEE"),
    }


def month_of(date_id: Column, year: Column | None = None, month: Column | None = None) -> Column:
    """yyyy-MM from year and month where both are present, else from the day key."""
    key = date_id.cast("int")
    by_key = F.format_string("%04d-%02d", _div(key, 10000), _div(key, 100) % 100)
    by_key = F.when(key.isNotNull(), by_key)
    if year is None or month is None:
        return by_key
    by_parts = F.format_string("%04d-%02d", year.cast("int"), month.cast("int"))
    return F.when(year.isNotNull() & month.isNotNull(), by_parts).otherwise(by_key)


def day_of(date_id: Column) -> Column:
    """The date of a yyyymmdd key, null when there is no such day."""
    return F.try_to_timestamp(date_id.cast("string"), F.lit("yyyyMMdd")).cast("date")


def month_key(date_id: Column) -> Column:
    """yyyymm of a day key, as a number."""
    return _div(date_id, 100)


def key_year(date_id: Column) -> Column:
    return _div(date_id, 10000)


def key_month(date_id: Column) -> Column:
    return _div(date_id, 100) % 100


def _div(c: Column, by: int) -> Column:
    return F.floor(c / by).cast("int")
