"""Tolerant parsing of raw text: dates, HHMM clock times, numbers.

Every function takes and returns Columns and turns what it cannot read into NULL; nothing
raises on bad data, also with ANSI mode on.
"""

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

# Fixed value: letters (with accents), blanks, hyphen, full stop and apostrophe make up plain text.
PLAIN_TEXT = r"^[A-Za-zÀ-ÿ\s\-\.']+$"
ALL_DIGITS = "^[0-9]+$"


def blank_to_null(c: Column) -> Column:
    trimmed = F.trim(c)
    return F.when(trimmed != "", trimmed)


def num(c: Column, type_name: str) -> Column:
    """Text to a numeric type; surrounding blanks are cut, blank or unreadable text is NULL."""
    return c.try_cast(type_name)


def parse_int(c: Column) -> Column:
    """Integer from digits-only text, else NULL (so ``'1.0'`` is NULL)."""
    return F.when(c.rlike(ALL_DIGITS), c.try_cast("int"))


def ymd_date(year: Column, month: Column, day: Column) -> Column:
    """Date from three text parts, NULL unless they name a real day."""
    for part in (year, month, day):
        if not isinstance(part, Column):
            raise TypeError("year, month and day must be Columns")
    parts = [part.try_cast("int") for part in (year, month, day)]
    midnight = [F.lit(0), F.lit(0), F.lit(0)]
    return F.try_make_timestamp_ntz(*parts, *midnight).cast("date")


def clock_number(c: Column) -> Column:
    """Clock time as a number (``0930`` and ``930.0`` are 930), NULL unless one to four digits."""
    readable = c.rlike(r"^\s*[0-9]{1,4}(\.0)?\s*$")
    return F.when(readable, c.try_cast("double").cast("int"))


def hhmm(c: Column) -> Column:
    """Clock time as four digits; a trailing ``.0`` is cut, anything else unreadable is NULL."""
    return F.lpad(clock_number(c).cast("string"), 4, "0")


def build_ts(date: Column, clock: Column, midnight: str = "next_day") -> Column:
    """Timestamp without zone from a date and a clock time (four digits, or their number).

    ``2400`` is the following midnight, or NULL with ``midnight="null"``. It is computed as
    minutes added to the date, with no text formatting and no time zone on the way.
    """
    if midnight not in ("next_day", "null"):
        raise ValueError(f"unknown midnight rule: {midnight}")
    number = clock.try_cast("int")
    in_day = number <= 2400 if midnight == "next_day" else number < 2400
    minutes = number - 40 * F.call_function("div", number, F.lit(100)).cast("int")
    return F.when(
        in_day & (number % 100 < 60),
        F.timestamp_add("MINUTE", minutes, date.cast("timestamp_ntz")),
    )


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970-01-01 of a zone-less timestamp, whatever the session's time zone."""
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double")
    return F.unix_date(F.to_date(ts)).cast("long") * 86400 + clock


def from_epoch_seconds(seconds: Column) -> Column:
    """Inverse of ``epoch_seconds``, to the microsecond."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.round(seconds * 1e6).cast("long"), epoch)


def abs_minutes(a: Column, b: Column) -> Column:
    """Distance between two timestamps in minutes."""
    return F.abs(epoch_seconds(a) - epoch_seconds(b)) / 60.0


def lenient_ts(c: Column) -> Column:
    """Timestamp without zone from ISO-like text, NULL when unreadable."""
    return blank_to_null(c).try_cast("timestamp_ntz")


def row_sum(columns: list[Column]) -> Column:
    """Sum across columns with NULL counted as zero."""
    return reduce(add, (F.coalesce(c, F.lit(0.0)) for c in columns))


def null_flag(c: Column) -> Column:
    """1 where the value is missing, else 0."""
    return c.isNull().cast("int")


def iso_weekday(date: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(date) + 1


def sunday_weekday(date: Column) -> Column:
    """Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(date)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """Rounded percentage, NULL for an empty whole."""
    return F.round(F.try_divide(part * 100.0, whole), places)
