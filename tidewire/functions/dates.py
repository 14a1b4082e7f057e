"""Dates and times as people and machines write them, by their parts instead of a list of whole formats.

A text is a date, maybe a time of day, maybe an offset, in this order or with the time first. The date is told
by what its numbers can be: a year first, a month by name, or three numbers, of which dots put the day
first and other marks the month, unless that can't be one. What is missing comes from a default date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: English month names by their first three letters, and the two-digit year from which on the last century is meant.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
LAST_CENTURY = 70

_NAME = rf"({'|'.join(MONTHS)})[a-z]*\.?"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_YEAR = r"(\d{4}|'?\d{2})"
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*(?:([ap])\.?m\b\.?)?"
_HOUR = r"\b(\d{1,2})\s*([ap])\.?m\b\.?"
_OFFSET = r"(?:(?<![a-z])(z|utc|gmt)\b)?\s*(?:([+-])(\d{2}):?(\d{2})?)?\s*$"


def _part(text: Column, pattern: str, group: int) -> Column:
    """A group of the first match, null where it is empty."""
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found)


def parse_date(raw: Column, default: str = "1970-01-01", day_first: bool = False) -> Column:
    """The moment that a text names, as TIMESTAMP_NTZ: in UTC where it has an offset or counts seconds, else as it stands there.

    Year, month or day that the text lacks come from ``default``. Null for null and for texts that are no date,
    or one that doesn't exist. ``day_first`` reads 02/03/2024 as the second of March.
    """
    s = F.lower(F.trim(F.regexp_replace(raw, r"[\s ]+", " ")))
    return _let(s, lambda s: F.coalesce(_epoch(s), _let(_plain(s), lambda plain: _let(_date(plain), lambda date: _moment(plain, date, default, day_first)))))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it stands in the result."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _epoch(s: Column) -> Column:
    at = F.when(s.rlike(r"^\d{10}$"), F.timestamp_seconds(s.try_cast("bigint"))).when(s.rlike(r"^\d{13}$"), F.timestamp_millis(s.try_cast("bigint")))
    return F.convert_timezone(None, F.lit("UTC"), at.cast("timestamp_ntz"))


def _plain(s: Column) -> Column:
    """The text with marks between digits that stand together, without the T before a time and the name of the weekday."""
    compact = F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})(?:[t ]?(\d{2})(\d{2})(\d{2})?)?(z?)$", r"$1-$2-$3 $4:$5:$6$7")
    compact = F.regexp_replace(F.regexp_replace(compact, r" ::$", ""), r":(z?)$", "$1")
    spaced = F.regexp_replace(compact, r"(?<=\d)t(?=\d)", " ")
    return F.regexp_replace(spaced, r"\b(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\b\.?,?", " ")


def _date(plain: Column) -> Column:
    """What is left without time and offset."""
    untimed = F.regexp_replace(plain, rf"(?:{_TIME}|{_HOUR})\s*(?:{_OFFSET})?", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(untimed, r"\b(?:at|of|on|the)\b", " "), r"\s*,\s*|\s+", " "))


_YMD = r"^(\d{4})[-/. ](\d{1,2})(?:[-/. ](\d{1,2}))?$"
_NUMBERS = r"^(\d{1,2})([-/. ])(\d{1,2})[-/. ](\d{4}|\d{2})$"
#: Patterns with a month's name, and which groups are year, month and day.
_NAMED = {
    rf"^{_DAY}[ /-]*{_NAME}(?:[ ,/-]*{_YEAR})?$": (3, 2, 1), rf"^{_NAME}[ -]*{_DAY}(?:[ ,-]+{_YEAR})?$": (3, 1, 2), rf"^{_NAME}[ ,-]*(\d{{4}})$": (2, 1, None),
    rf"^(\d{{4}})[ -]*{_NAME}(?:[ -]*{_DAY})?$": (1, 2, 3), rf"^{_NAME}$": (None, 1, None),
}


def _moment(plain: Column, date: Column, default: str, day_first: bool) -> Column:
    timed = plain.rlike(_TIME) | plain.rlike(_HOUR)
    # The offset stands behind a time only: elsewhere a minus may belong to the date.
    tail = F.when(timed, F.regexp_extract(plain, rf"(?:{_TIME}|{_HOUR})\s*({_OFFSET})", 8))
    hour = F.coalesce(_part(plain, _TIME, 1), _part(plain, _HOUR, 1)).try_cast("int")
    half = F.coalesce(_part(plain, _TIME, 5), _part(plain, _HOUR, 2))
    hour = F.when(half == "p", F.when(hour <= 12, hour % 12 + 12)).when(half == "a", F.when(hour <= 12, hour % 12)).otherwise(hour)
    minute, second = F.coalesce(_part(plain, _TIME, 2), F.lit("0")), F.coalesce(_part(plain, _TIME, 3), F.lit("0"))
    micros = F.rpad(F.substring(F.coalesce(_part(plain, _TIME, 4), F.lit("0")), 1, 6), 6, "0").try_cast("int")

    first, other = _part(date, _NUMBERS, 1).try_cast("int"), _part(date, _NUMBERS, 3).try_cast("int")
    by_day = F.when(first > 12, True).when(other > 12, False).otherwise((F.regexp_extract(date, _NUMBERS, 2) == ".") | F.lit(day_first))
    years, months, days = [_part(date, _YMD, 1), _part(date, _NUMBERS, 4)], [_part(date, _YMD, 2), F.when(by_day, other).otherwise(first).cast("string")], [_part(date, _YMD, 3), F.when(by_day, first).otherwise(other).cast("string")]
    known = date.rlike(_YMD) | date.rlike(_NUMBERS) | (timed & (date == ""))
    numbered = F.create_map(*[x for k, m in enumerate(MONTHS, 1) for x in (F.lit(m), F.lit(str(k)))])
    for pattern, groups in _NAMED.items():
        known = known | date.rlike(pattern)
        year, month, day = (None if g is None else _part(date, pattern, g) for g in groups)
        years += [] if year is None else [F.replace(year, F.lit("'"), F.lit(""))]
        months.append(F.try_element_at(numbered, F.substring(month, 1, 3)))
        days += [] if day is None else [day]
    y, m, d = default.split("-")
    year = F.coalesce(*years)
    number = year.try_cast("int")
    number = F.when(F.length(year) == 2, F.when(number < LAST_CENTURY, 2000 + number).otherwise(1900 + number)).otherwise(number)
    day_of = F.concat_ws("-", F.lpad(F.coalesce(number, F.lit(int(y))).cast("string"), 4, "0"), F.coalesce(*months, F.lit(m)), F.coalesce(*days, F.lit(d)))
    minute, second = minute.try_cast("int"), second.try_cast("int")
    real = (F.coalesce(hour, F.lit(0)) < 24) & (minute < 60) & (second < 60)
    # A date and an interval, so that no clock change of the session's zone moves the time.
    wall = F.when(known & real & (half.isNull() | hour.isNotNull()), F.try_to_date(day_of, "yyyy-M-d"))
    sign = F.when(F.regexp_extract(tail, _OFFSET, 2) == "-", -1).otherwise(1)
    ahead = sign * (F.coalesce(_part(tail, _OFFSET, 3).try_cast("int"), F.lit(0)) * 60 + F.coalesce(_part(tail, _OFFSET, 4).try_cast("int"), F.lit(0)))
    return wall.cast("timestamp_ntz") + F.make_dt_interval(hours=F.coalesce(hour, F.lit(0)), mins=minute - F.coalesce(ahead, F.lit(0)), secs=(second + micros / 1_000_000).cast("decimal(18,6)"))
