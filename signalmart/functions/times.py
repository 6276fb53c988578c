"""Time expressions: wire timestamps, minute and day grain, dashboard time filters."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"\d{4}-\d{2}-\d{2}"
_CLOCK = r"[T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?"
_OFFSET = r"(Z|[+-]\d{2}(:?\d{2})?)"
_COMMON = rf"^(?!0000){_DATE}({_CLOCK}{_OFFSET}?)?\z"

# Hours, minutes and seconds, with colons or without, and the six digits of the fraction that count.
_HMS = r"(\d{2})(?::(\d{2})(?::(\d{2}))?|(\d{2})(\d{2})?)?(?:[.,](\d{1,6})\d*)?"
_TIME = rf"^{_HMS}(?:Z|([+-]){_HMS})?\z"
_PARTS = "$1,$2$4,$3$5,$6,$7,$8,$9$11,$10$12,$13"
# One character before the offset is passed over where a fraction could begin.
_STRAY = (
    r"^(\d{2}(?::\d{2}(?::\d{2})?|\d{2}(?:\d{2})?)?)[\x00-\x7F]"
    r"(?=(?:Z|[+-]\d{2}(?::\d{2}(?::\d{2})?|\d{2}(?:\d{2})?)?(?:[.,]\d+)?)\z)"
)
_WEEK_DATE = r"^\d{4}(-W\d{2}(-\d)?|W\d{2}\d?)\z"
_SECOND, _DAY = 1_000_000, 86_400_000_000


def _char(text: Column, place: int) -> Column:
    return F.substring(text, place + 1, 1)


def _split_at(text: Column) -> Column:
    """Length of the date in front of the separator, which may be any one character; NULL if there is no date.

    Where a week date is followed by digits, these tell whether its day is there or not.
    """
    n = F.length(text)
    digits = F.length(F.regexp_extract(text, r"(?s)^.{7}([0-9]*)", 1)) + 7
    dashed = (
        F.when(_char(text, 5) != "W", 10)
        .when((n > 8) & (_char(text, 8) != "-"), 8)
        .when(n == 8, 8)
        .when((n > 10) & _char(text, 10).between("0", "9"), 8)
        .when(n > 9, 10)
    )
    basic = F.when(_char(text, 4) != "W", 8).when(digits < 9, digits).when(digits % 2 == 0, 7).otherwise(8)
    return F.when(n == 7, 7).when(n > 7, F.when(_char(text, 4) == "-", dashed).otherwise(basic))


def _date_of(text: Column) -> Column:
    """Calendar or week date, dashed or not, as days since 1970; NULL for anything else."""
    year = F.when(text.rlike(r"^(?!0000)\d{4}"), F.substring(text, 1, 4))
    plain = F.replace(text, F.lit("-"), F.lit(""))
    iso = F.concat_ws("-", year, F.substring(plain, 5, 2), F.substring(plain, 7, 2))
    calendar = F.when(text.rlike(rf"^({_DATE}|\d{{8}})\z"), iso.try_cast("date"))
    week = F.substring(plain, 6, 2).try_cast("int")
    day = F.coalesce(F.substring(plain, 8, 1).try_cast("int"), F.lit(1))
    fourth = F.concat(year, F.lit("-01-04")).try_cast("date")  # always in the first week
    last = F.weekofyear(F.concat(year, F.lit("-12-28")).try_cast("date"))  # always in the last one
    monday = F.unix_date(fourth) - F.weekday(fourth)
    exists = text.rlike(_WEEK_DATE) & week.between(1, last) & day.between(1, 7)
    return F.coalesce(F.unix_date(calendar), F.when(exists, monday + (week - 1) * 7 + day - 1))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value worked out once, and outside the generated code of the common forms."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _instant(date: Column, parts: Column) -> Column:
    """Microseconds since 1970 of a date and the parts of a time; NULL where one is out of range."""

    def number(place: int) -> Column:
        return F.coalesce(parts[place].try_cast("bigint"), F.lit(0))

    def micros(place: int) -> Column:
        fraction = F.coalesce(F.rpad(parts[place + 3], 6, "0").try_cast("bigint"), F.lit(0))
        return ((number(place) * 60 + number(place + 1)) * 60 + number(place + 2)) * _SECOND + fraction

    in_range = parts.isNotNull() & (number(0) < 24) & (number(1) < 60) & (number(2) < 60) & (micros(5) < _DAY)
    offset = F.when(parts[4] == "-", -micros(5)).otherwise(micros(5))
    return F.when(in_range, date * _DAY + micros(0) - offset)


def _any_iso(text: Column) -> Column:
    """The whole grammar: basic and extended forms, week dates, any separator, offsets to the microsecond."""

    def timed(date: Column, clock: Column) -> Column:
        known = F.when(clock.rlike(_TIME), clock).otherwise(F.regexp_replace(clock, _STRAY, "$1"))
        parts = F.split(F.regexp_replace(known, _TIME, _PARTS), ",")
        return _let(F.when(known.rlike(_TIME), parts), lambda p: _instant(date, p))

    def dated(at: Column, text: Column) -> Column:
        date = _date_of(F.substr(text, F.lit(1), at)).cast("bigint")
        clock = F.substr(text, at + 2)
        return F.when(F.length(text) <= at, date * _DAY).otherwise(timed(date, clock))

    micros = _let(text, lambda t: _let(_split_at(t), lambda at: dated(at, t)))
    return F.timestamp_micros(micros)


def iso_timestamp(text: Column) -> Column:
    """Instant of an ISO-8601 date or date-time; no offset means UTC, anything else is NULL.

    The common forms are left to the cast; it alone would also take partial dates and bare clock times, hence
    the guard. All other forms are worked out part by part.
    """
    dotted = F.replace(text, F.lit(","), F.lit("."))
    # The cast only reads an offset behind seconds.
    dotted = F.when(F.substring(text, 17, 1) == ":", dotted).otherwise(
        F.concat(F.substring(dotted, 1, 16), F.lit(":00"), F.substr(dotted, F.lit(17)))
    )
    complete = (
        F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z")))
        .when(F.substr(text, F.lit(17)).rlike("[Z+-]"), dotted)
        .otherwise(F.concat(dotted, F.lit("Z")))
    )
    return F.coalesce(F.when(text.rlike(_COMMON), complete.try_cast("timestamp")), _any_iso(text))


def as_time(value: datetime | Column | None) -> Column:
    """Literal, column or scalar subquery as given; None is the clock of the query."""
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(value)


def minute_of(ts: Column | str) -> Column:
    return F.date_trunc("minute", ts)


def date_key_of(ts: Column | str) -> Column:
    """YYYYMMDD of the UTC day as int."""
    return F.date_format(ts, "yyyyMMdd").cast("int")


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'")


def minutes(n: int) -> Column:
    return F.make_dt_interval(mins=F.lit(n))


def since(df, column: str, as_of: Column, hours: int):
    """Rows strictly younger than `hours` before `as_of`."""
    lo = as_of - F.make_dt_interval(hours=F.lit(hours))
    return _pruned(df, lo, None).where(F.col(column) > lo)


def between(df, column: str, lo: Column, hi: Column):
    """Dashboard time filter: both ends included."""
    return _pruned(df, lo, hi).where(F.col(column).between(lo, hi))


def _pruned(df, lo: Column, hi: Column | None):
    """Add the day bounds a time bound implies, so stored tables skip whole partitions."""
    if "date_key" not in df.columns:
        return df
    df = df.where(F.col("date_key") >= date_key_of(lo))
    return df if hi is None else df.where(F.col("date_key") <= date_key_of(hi))
