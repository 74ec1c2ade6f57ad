"""Age of a newest value against a clock: dates, zoned and unzoned times, ISO text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Clock:
    """The moment that ages are measured from.

    Unset means the time of the query. A naive ``as_of`` is a wall-clock time in the
    session zone, an aware one is an instant.
    """

    as_of: datetime | None = None

    @property
    def instant(self) -> Column:
        if self.as_of is None:
            return F.current_timestamp()
        if self.as_of.tzinfo is None:
            return self.wall.cast("timestamp")
        return F.lit(self.as_of.isoformat()).cast("timestamp")

    @property
    def wall(self) -> Column:
        if self.as_of is None:
            return F.localtimestamp()
        if self.as_of.tzinfo is None:
            return F.lit(self.as_of.isoformat()).cast("timestamp_ntz")
        return self.instant.cast("timestamp_ntz")


def hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end).cast("double") / F.lit(1e6) / F.lit(3600.0)


# Steps that mark the date: ``D`` and year, month, day, or ``W`` and year, week, day, then a bar and the time without the
# separator before it. Where digits follow a compact week, their number tells which of them is the separator.
_DATES = [
    (r"^(\d{4})-(\d\d)-(\d\d)(?:.(.+))?$", "D$1$2$3|$4"),
    (r"^(\d{4})(\d\d)(\d\d)(?:.(.+))?$", "D$1$2$3|$4"),
    (r"^(\d{4})-W(\d\d)-(\d)(?:\D(.+))?$", "W$1$2$3|$4"),
    (r"^(\d{4})-W(\d\d)(?:(?:[^-]|-(?=.\d))(.+))?$", "W$1$21|$3"),
    (r"^(\d{4})W(\d\d)(\d)(?:\D(.+)|\d((?:\d\d)*(?!\d).+|(?:\d\d)+))?$", "W$1$2$3|$4$5"),
    (r"^(\d{4})W(\d\d)(?:\D(.+)|\d((?:\d\d)+(?:\D.*)?))?$", "W$1$21|$3$4"),
]


def _python_reads(text: str) -> datetime | None:
    try:
        return datetime.fromisoformat(text)
    except ValueError:
        return None


# Patch releases of Python 3.13 differ in two points, where the driver's is followed: whether a point before an offset may have no
# fraction, and whether an offset below a second counts.
_POINT_ALONE = _python_reads("2000-01-01T00:00:00.+00:00") is not None
_BELOW_SECOND = _python_reads("2000-01-01T00:00:00+00:00:00.5") not in (None, _python_reads("2000-01-01T00:00:00+00:00"))
# Before an offset, one more ASCII character or anything after six digits of a fraction is passed over.
_PASSED_OVER = [
    (rf"^(\d\d(?:(:?)\d\d(?:\2\d\d)?)?)[\x00-\x7F{'' if _POINT_ALONE else '&&[^.,]'}]$", "$1"),
    (r"^([\d:]+[.,]\d{6}).*$", "$1"),
    (r"^(\d{12}).*$", "$1"),
]
# A time or offset without colons and with a point; a fraction without a point has two digits at least.
_PLAIN = [
    (r"^(\d\d):(\d\d)(?::(\d\d))?(?=$|[.,])", "$1$2$3"),
    (r"^(\d{6})(\d{2,})$", "$1.$2"),
    (r"^(\d+),", "$1."),
]


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), 0)


def _rewritten(text: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, replacement in steps:
        text = F.regexp_replace(text, f"(?s){pattern}", replacement)
    return text


def _marked_date(marked: Column) -> Column:
    """A marked date as ``yyyy-MM-dd``; null for a year or a week that there isn't. A calendar date may still be none."""
    calendar = F.concat_ws("-", marked.substr(2, 4), marked.substr(6, 2), marked.substr(8, 2))
    year, week, day = (marked.substr(at, n).try_cast("int") for at, n in ((2, 4), (6, 2), (8, 1)))
    # The fourth of January is in the first week; a week 53 that belongs to the next year is none.
    fourth = F.make_date(F.greatest(year, F.lit(1)), F.lit(1), F.lit(4))
    date = F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7 + day - 1)
    valid = week.between(1, 53) & day.between(1, 7) & (F.extract(F.lit("YEAROFWEEK"), date) == year)
    in_week = F.when(valid, date.cast("string"))
    return F.when(year > 0, F.when(marked.startswith("D"), calendar).when(F.length(in_week) == 10, in_week))


def _digits(text: Column) -> Column:
    """A time or offset as twelve digits, down to microseconds; null if it is malformed."""
    plain = _rewritten(text, _PLAIN)

    def padded(plain: Column) -> Column:
        fraction = F.regexp_extract(plain, r"\.(\d{1,6})", 1)
        digits = F.concat(F.rpad(F.substring_index(plain, ".", 1), 6, "0"), F.rpad(fraction, 6, "0"))
        return F.when(plain.rlike(r"^(\d\d){1,3}(\.\d+)?$"), digits)

    return _let(plain, padded)


def _offset(zone: Column) -> Column:
    """A signed offset in microseconds, below a day; null if it is malformed."""

    def size(digits: Column) -> Column:
        hours, minutes, seconds, micros = (digits.substr(at, n).cast("long") for at, n in ((1, 2), (3, 2), (5, 2), (7, 6)))
        whole = hours * 3600 + minutes * 60 + seconds
        exact = whole * 1_000_000 + micros
        return exact if _BELOW_SECOND else F.when(whole == 0, whole).otherwise(exact)

    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    return _let(_digits(zone.substr(2, 1 << 30)), lambda d: _let(size(d), lambda n: F.when(n < 86_400_000_000, n * sign)))


def iso_spelling(text: Column) -> Column:
    """ISO text as ``yyyy-MM-dd HH:mm:ss.SSSSSS`` and, if it has one, its offset in microseconds; null for any other text.

    What is read is what ``datetime.fromisoformat`` of Python 3.13 reads: calendar and week dates, extended and compact forms, any
    separator, fractions of any length, offsets below a day down to microseconds, and the malformed times that it accepts.
    """
    marked = _rewritten(F.replace(text, F.lit("Z"), F.lit("+00:00")), _DATES)

    def spelled(marked: Column) -> Column:
        time = F.regexp_replace(marked, r"^[^|]*\|", "")
        return _let(time, lambda time: with_time(F.substring_index(marked, "|", 1), time))

    def with_time(date: Column, time: Column) -> Column:
        zone = F.regexp_replace(time, "(?s)^[^+-]*", "")
        return _let(zone, lambda zone: with_zone(date, F.regexp_extract(time, "(?s)^[^+-]*", 0), zone))

    def with_zone(date: Column, body: Column, zone: Column) -> Column:
        read = F.when(zone == "", body).otherwise(_rewritten(body, _PASSED_OVER))
        digits = F.when((body == "") & (zone == ""), F.lit("0" * 12)).otherwise(_digits(read))
        offset = F.when(zone == "", "").otherwise(F.concat(F.lit(" "), _offset(zone).cast("string")))
        return _let(digits, lambda digits: F.concat(_marked_date(date), F.lit(" "), clock(digits), offset))

    def clock(digits: Column) -> Column:
        in_range = (digits.substr(1, 2) < "24") & (digits.substr(3, 2) < "60") & (digits.substr(5, 2) < "60")
        return F.when(in_range, F.regexp_replace(digits, r"(\d\d)(\d\d)(\d\d)(\d{6})", "$1:$2:$3.$4"))

    return F.when(F.length(text) >= 7, _let(marked, lambda m: F.when(m.rlike(r"(?s)^[DW]\d+\|"), spelled(m))))


def iso_age_hours(iso: Column, clock: Clock) -> Column:
    """Hours from a text in ``iso_spelling`` to the clock; null when it is no valid time."""
    wall = F.substring(iso, 1, 26).try_cast("timestamp_ntz")
    offset = F.nullif(F.substring(iso, 28, 30), F.lit("")).cast("long")
    as_utc = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), wall)
    since = (F.unix_micros(clock.instant) - (as_utc - offset)).cast("double") / F.lit(1e6) / F.lit(3600.0)
    return F.coalesce(since, hours_between(F.when(offset.isNull(), wall), clock.wall))
