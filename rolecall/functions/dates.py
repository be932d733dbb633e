"""Posting dates. All times are UTC wall time without zone, whatever the session zone is."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

_WALL = r"\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)?"
_OFFSET = r"([+-])([01]\d|2[0-3]):?([0-5]\d)?"
_UTC = rf"^({_WALL})\s*(?:[zZ]|UTC)?\z"
_SHIFTED = rf"^({_WALL})\s*{_OFFSET}\z"


# Year, then week and day, day of the year, or month and day without hyphens; the time.
_OTHER = r"^(\d{4})(?:-?W(\d\d)-?([1-7])|-?(\d{3})|(\d\d)(\d\d))([T ].*)?\z"


def _extended(text: Column) -> Column:
    """Basic, ordinal and week forms of ISO 8601 in the extended form; NULL if it is none."""
    part = [F.regexp_extract(text, _OTHER, i) for i in range(8)]
    year = part[1].try_cast("int")
    week, weekday, day = (part[i].try_cast("int") for i in (2, 3, 4))
    monday = F.date_add(F.trunc(F.concat(part[1], F.lit("-01-04")).try_cast("date"), "week"), (week - 1) * 7)
    of_week = F.when((week > 0) & (F.year(F.date_add(monday, 3)) == year), F.date_add(monday, weekday - 1))
    of_year = F.date_add(F.concat(part[1], F.lit("-01-01")).try_cast("date"), day - 1)
    of_year = F.when((day > 0) & (F.year(of_year) == year), of_year)
    of_month = F.when(part[5] != "", F.concat_ws("-", part[1], part[5], part[6]))
    time = F.regexp_replace(part[7], r"^([T ]\d\d)(\d\d)(\d\d)", "$1:$2:$3")
    time = F.regexp_replace(time, r"^([T ]\d\d)(\d\d)(?!\d)", "$1:$2")
    return F.concat(F.coalesce(of_week.cast("string"), of_year.cast("string"), of_month), time)


def parse_posted(created: Column) -> Column:
    """ISO 8601 text as UTC time; NULL when empty or not a date.

    Dates may be in extended or basic form, by month, week (`2024-W01-5`) or day of the year
    (`2024-005`).

    An offset is applied to the wall time itself, so neither the session zone nor its
    daylight-saving rules play a part. Most texts are in UTC and need one match only.
    """
    text = F.trim(created)
    # Few texts have another form; theirs is made once, not wherever it is looked at.
    other = F.transform(F.array(_extended(text)), _wall_time)[0]
    return F.when(text.rlike(_OTHER), other).otherwise(_wall_time(text))


def _wall_time(text: Column) -> Column:
    """A text of the extended form as UTC time."""

    def wall(pattern: str) -> Column:
        return F.regexp_extract(text, pattern, 1).try_cast("timestamp_ntz")

    def shift(group: int) -> Column:
        number = F.regexp_extract(text, _SHIFTED, group).try_cast("int")
        sign = F.when(F.regexp_extract(text, _SHIFTED, 2) == "-", -1).otherwise(1)
        return sign * F.coalesce(number, F.lit(0))

    shifted = wall(_SHIFTED) - F.make_dt_interval(hours=shift(3), mins=shift(4))
    return F.coalesce(wall(_UTC), shifted)


def utc_time(time: datetime) -> Column:
    """A Python time as UTC time; one without zone is taken to be UTC already."""
    if time.tzinfo is not None:
        time = time.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(time.isoformat(sep=" ")).cast("timestamp_ntz")


def posted_day(time: Column) -> Column:
    return F.to_date(time)


def posted_week(time: Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(F.to_date(time), "week")
