"""ISO 8601 verdict and conversion.

A cast to TIMESTAMP is no substitute: it accepts ``2026``, ``2026-8-9`` or a
trailing ``UTC`` and rejects basic and week dates. Most records carry the plain
extended form, which one regular expression settles, calendar included. Only the
rest is taken apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

_MONTH_DAY = (
    r"(?:(?:0[13578]|1[02])-(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[469]|11)-(?:0[1-9]|[12]\d|30)"
    r"|02-(?:0[1-9]|1\d|2[0-8]))"
)
_CLOCK = r"(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d{1,6})?"
#: extended form that is certainly valid and that a cast converts correctly
PLAIN = rf"^(?!0000)\d{{4}}-{_MONTH_DAY}[T ]{_CLOCK}(?:Z|[+-](?:0\d|1[0-7]):[0-5]\d)?\z"

_HMS = r"(\d\d)(?::(\d\d)(?::(\d\d)(?:[.,](\d+))?)?|(\d\d)(?:(\d\d)(?:[.,](\d+))?)?)?"
#: every accepted shape; groups are merged by _LAYOUT
SHAPE = (
    r"^(?:(\d{4})-(\d\d)-(\d\d)|(\d{4})(\d\d)(\d\d)|(\d{4})-W(\d\d)(?:-(\d)(?!\d))?|(\d{4})W(\d\d)(\d)?)"
    rf"(?:[\s\S]{_HMS}(Z|([+-]){_HMS})?)?\z"
)
_LAYOUT = "|".join(
    [
        "$1$4$7$10",  # year
        "$2$5",  # month
        "$3$6",  # day
        "$8$11",  # week
        "$9$12",  # weekday
        "$13",  # hour
        "$14$17",  # minute
        "$15$18",  # second
        "$16$19",  # fraction
        "$21",  # zone sign
        "$22",  # zone hours
        "$23$26",  # zone minutes
        "$24$27",  # zone seconds
        "$25$28",  # zone fraction
    ]
)
_NAMES = (
    "year month day week weekday hour minute second fraction "
    "zone_sign zone_hour zone_minute zone_second zone_fraction"
).split()


def _pieces(text: Column) -> Column:
    """One array with all components of a text that has an accepted shape."""
    return F.split(F.regexp_replace(text, SHAPE, _LAYOUT), r"\|", -1)


class _Parts:
    """Named integer access to the array made by ``_pieces``."""

    def __init__(self, pieces: Column) -> None:
        self._pieces = pieces

    def text(self, name: str) -> Column:
        return self._pieces.getItem(_NAMES.index(name))

    def number(self, name: str, default: int = 0) -> Column:
        return F.coalesce(F.nullif(self.text(name), F.lit("")).cast("int"), F.lit(default))

    def given(self, name: str) -> Column:
        return self.text(name) != ""

    def micros(self, name: str) -> Column:
        return F.rpad(self.text(name), 6, "0").cast("bigint")


def _leap(year: Column) -> Column:
    return (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))


def _days_in_month(year: Column, month: Column) -> Column:
    return (
        F.when(month == 2, F.when(_leap(year), 29).otherwise(28))
        .when(month.isin(4, 6, 9, 11), 30)
        .otherwise(31)
    )


def _year_shift(year: Column) -> Column:
    """Weekday of 31 December, 0 for Sunday."""
    century = F.floor(year / 4) - F.floor(year / 100) + F.floor(year / 400)
    return (year + century) % 7


def _components_ok(pieces: Column) -> Column:
    p = _Parts(pieces)
    year, month, day = p.number("year"), p.number("month"), p.number("day")
    week, weekday = p.number("week"), p.number("weekday", 1)
    long_year = (_year_shift(year) == 4) | (_year_shift(year - 1) == 3)
    calendar_ok = (month >= 1) & (month <= 12) & (day >= 1) & (day <= _days_in_month(year, month))
    week_ok = (
        (week >= 1)
        & ((week <= 52) | ((week == 53) & long_year))
        & (weekday >= 1)
        & (weekday <= 7)
        & ~((year == 9999) & (week == 52) & (weekday >= 6))
    )
    clock_ok = (p.number("hour") <= 23) & (p.number("minute") <= 59) & (p.number("second") <= 59)
    zone = p.number("zone_hour") * 3600 + p.number("zone_minute") * 60 + p.number("zone_second")
    return (year >= 1) & F.when(p.given("week"), week_ok).otherwise(calendar_ok) & clock_ok & (zone < 86_400)


def is_iso8601(text: Column) -> Column:
    """True when the text is an ISO 8601 date or date-time with a real date, clock and offset."""
    return (
        F.when(F.rlike(text, F.lit(PLAIN)), True)
        .when(F.rlike(text, F.lit(SHAPE)), let(_pieces(text), _components_ok))
        .otherwise(False)
    )


def _instant(pieces: Column) -> Column:
    p = _Parts(pieces)
    year = p.number("year")
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    week_day = F.unix_date(fourth) - F.weekday(fourth) + (p.number("week") - 1) * 7 + p.number("weekday", 1) - 1
    calendar_day = F.unix_date(F.make_date(year, p.number("month"), p.number("day")))
    days = F.when(p.given("week"), week_day).otherwise(calendar_day).cast("bigint")
    clock = days * 86_400 + p.number("hour") * 3600 + p.number("minute") * 60 + p.number("second")
    zone = p.number("zone_hour") * 3600 + p.number("zone_minute") * 60 + p.number("zone_second")
    offset = zone.cast("bigint") * 1_000_000 + p.micros("zone_fraction")
    sign = F.when(p.text("zone_sign") == "-", -1).otherwise(1)
    return F.timestamp_micros(clock * 1_000_000 + p.micros("fraction") - sign * offset)


def iso8601_timestamp(text: Column) -> Column:
    """The instant of a valid ISO 8601 text, NULL for every other text. Naive text is UTC."""
    zoned = F.when(F.rlike(text, F.lit(r"(?:Z|[+-]\d\d:\d\d)\z")), text).otherwise(F.concat(text, F.lit("Z")))
    return F.when(F.rlike(text, F.lit(PLAIN)), zoned.try_cast("timestamp")).when(
        F.rlike(text, F.lit(SHAPE)),
        let(_pieces(text), lambda p: F.when(_components_ok(p), _instant(p))),
    )
