"""Zone-fixed time expressions.

The job's semantics depend on one declared zone (local dates, the text hashed
into violation ids, ISO strings), never on the caller's session zone. All local
wall-clock values here are ``TIMESTAMP_NTZ`` computed from epoch microseconds,
so the same input gives the same output under any ``spark.sql.session.timeZone``.
"""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from trafficwatch.config import TIMEZONE
from trafficwatch.functions.text import strip


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ntz() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def utc_wall(ts: Column | str) -> Column:
    """UTC wall clock of an instant (``TIMESTAMP``) as ``TIMESTAMP_NTZ``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), epoch_ntz())


def local_time(ts: Column | str, tz: str = TIMEZONE) -> Column:
    """Wall clock of an instant in zone ``tz`` as ``TIMESTAMP_NTZ``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall(ts))


def local_date(ts: Column | str, tz: str = TIMEZONE) -> Column:
    """Calendar date of an instant in zone ``tz``."""
    return local_time(ts, tz).cast("date")


def local_text(ts: Column | str, tz: str = TIMEZONE) -> Column:
    """``CAST(ts AS STRING)`` as a session in zone ``tz`` would print it."""
    return local_time(ts, tz).cast("string")


def ntz_micros(ntz: Column | str) -> Column:
    """Microseconds between 1970-01-01 and a ``TIMESTAMP_NTZ`` wall clock. Day number and
    time of day are taken from the wall clock itself: a difference of timestamps would
    read it in the session zone, whose gap and overlap hours shift it."""
    t = _col(ntz)
    days = F.date_diff(t.cast("date"), F.expr("date'1970-01-01'")).cast("long")
    seconds = (F.extract(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("long")
    return ((days * 24 + F.hour(t)) * 60 + F.minute(t)) * F.lit(60_000_000) + seconds


def wall_text(ntz: Column | str, separator: str = "T", digits: int = 6) -> Column:
    """``yyyy-MM-dd<separator>HH:mm:ss.f...`` of a ``TIMESTAMP_NTZ`` wall clock with
    ``digits`` (1 to 6) cut digits of the second, from its own text."""
    t = _col(ntz)
    text = t.cast("string")  # zone-free; the fraction is left out or shortened
    micros = F.lpad(F.pmod(ntz_micros(t), F.lit(1_000_000)).cast("string"), 6, "0")
    return F.concat(F.substring_index(text, " ", 1), F.lit(separator),
                    F.substring(F.substring_index(text, " ", -1), 1, 8), F.lit("."), F.substring(micros, 1, digits))


def from_wall(ntz: Column | str, tz: str) -> Column:
    """Instant (``TIMESTAMP``) of a wall clock read in zone ``tz``."""
    as_utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), _col(ntz))
    return F.timestamp_micros(ntz_micros(as_utc))


def _div(value: Column, by: int) -> Column:
    """Whole quotient, rounded down, without a detour over doubles. ``value`` is moved above zero (it
    counts microseconds of the years 1 to 9999, or fewer) and so stands in the result once."""
    above = 10**18 // by
    return F.call_function("div", value + F.lit(above * by), F.lit(by)) - F.lit(above)


def _digits(value: Column, width: int = 2) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def iso_text(ts: Column | str, tz: str = TIMEZONE) -> Column:
    """ISO-8601 text with milliseconds and the zone's offset, e.g.
    ``2026-09-24T10:00:00.000+08:00``; null stays null.

    Everything follows from two numbers by integer arithmetic: the instant and its offset. No part
    of it stands in a branch, so generated code computes the offset once per value; ``ts`` may be an
    expression of its own, for it stands in the result a few times only."""
    t = _col(ts)
    micros = F.unix_micros(t)
    offset = _div(F.unix_micros(F.from_utc_timestamp(t, tz)) - micros, 60_000_000)  # minutes
    millis = _div(micros + offset * F.lit(60_000_000), 1000)
    of_day = F.pmod(millis, F.lit(86_400_000))
    seconds = _div(of_day, 1000)
    day = F.date_from_unix_date(_div(millis, 86_400_000).cast("int"))
    size = F.abs(offset)
    return F.concat(
        day.cast("string"), F.lit("T"), _digits(_div(seconds, 3600)), F.lit(":"), _digits(F.pmod(_div(seconds, 60), F.lit(60))),
        F.lit(":"), _digits(F.pmod(seconds, F.lit(60))), F.lit("."), _digits(F.pmod(of_day, F.lit(1000)), 3),
        F.when(offset < 0, F.lit("-")).otherwise(F.lit("+")), _digits(_div(size, 60)), F.lit(":"), _digits(F.pmod(size, F.lit(60))))


# An offset only counts after a time of day ("…07:00:00+08:00", "…00Z"), so the
# "-01" that ends a date-only value is not taken for one.
_OFFSET_RE = r"\d{2}:\d{2}(:\d{2}(\.\d*)?)?\s*(Z|[+-]\d{2}(:?\d{2})?)$"


def parse_time(text: Column | str, tz: str = TIMEZONE, *, strict: bool = False) -> Column:
    """ISO-8601 text to an instant. ``Z`` and explicit offsets are honoured, a
    naive value is read as wall clock in ``tz``. Unparseable text is null, or
    raises when ``strict`` (whatever the session's ANSI setting)."""
    s = strip(text)
    has_offset = s.rlike(_OFFSET_RE)
    parsed = F.when(has_offset, s.try_cast("timestamp")).otherwise(
        from_wall(s.try_cast("timestamp_ntz"), tz)
    )
    return require_parsed(s, parsed, "time") if strict else parsed


# A date and time without offset, as a cast takes it, and what may follow.
_NAIVE_RE = r"\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}:\d{1,2}(?:\.\d*)?"
_SHIFT_RE = r"\s*(?:Z|[+-]\d{2}(?::?\d{2}){0,2})"
# The form most texts have; it is read as it is.
_USUAL_RE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d*)?(Z|[+-]\d{2}(:\d{2})?)?$"

# ISO-8601 as Python's ``fromisoformat`` reads it: calendar dates and weeks, times and offsets,
# each compact or with separators, any one character between date and time.
_CALENDAR_RE = r"\d{4}-\d{2}-\d{2}|\d{8}"
_WEEK_RE = r"\d{4}-W\d{2}(?:-\d(?!\d))?|\d{4}W\d{2}(?:\d(?!\d))?"
_CLOCK_RE = r"\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?|\d{2}(?:\d{2}(?:[.,]\d+)?)?)?"
_ISO_RE = rf"(?s)^(?:{_CALENDAR_RE}|{_WEEK_RE})(?:.{_CLOCK_RE}(?:Z|[+-]{_CLOCK_RE})?)?$"
# Steps that write such a text in the usual form, one after another: (pattern, replacement).
_TO_USUAL = (
    (r"^(.{10})$", "$1T00:00:00"),
    (r"(?s)^(.{10}).", "$1T"),
    (r"^(.{13})(?=$|[Z+-])", "$1:00"),
    (r"^(.{13})(\d{2})", "$1:$2"),
    (r"^(.{16})(?=$|[Z+-])", "$1:00"),
    (r"^(.{16})(\d{2})", "$1:$2"),
    (r"^(.{19}),", "$1."),
    (r"^(.{16,}[+-]\d{2})(\d{2})", "$1:$2"),
    (r"^(.{16,}[+-]\d{2}:\d{2})(\d{2})$", "$1:$2"),
)


def _week_date(text: Column) -> Column:
    """Date of the year, week and day (Monday if left out) that a text in :data:`_WEEK_RE` form
    begins with. A year's first week holds its fourth of January."""
    parts = r"^\d{4}-?W(\d{2})(?:-?(\d)(?!\d))?"
    week = F.regexp_extract(text, parts, 1).try_cast("int")
    day = F.rpad(F.regexp_extract(text, parts, 2), 1, "1").try_cast("int")
    first = F.trunc(F.concat(F.substring(text, 1, 4), F.lit("-01-04")).try_cast("date"), "week")
    monday = F.date_add(first, (week - 1) * 7)
    return F.when((day >= 1) & (day <= 7) & (F.weekofyear(monday) == week), F.date_add(monday, day - 1))


def _usual_form(text: Column) -> Column:
    """Text in :data:`_ISO_RE` form in the usual one; null if its week does not exist."""
    week = F.concat(_week_date(text).cast("string"), F.regexp_replace(text, rf"^(?:{_WEEK_RE})", ""))
    calendar = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
    form = F.when(text.rlike(r"^\d{4}-?W"), week).otherwise(calendar)
    for pattern, replacement in _TO_USUAL:
        form = F.regexp_replace(form, pattern, replacement)
    return form


def parse_iso_time(text: Column | str, tz: str = TIMEZONE, *, strict: bool = False) -> Column:
    """ISO-8601 text to an instant, in every form of Python's ``fromisoformat`` (compact, weeks, offsets
    with seconds) or Spark's cast (one-digit parts). ``Z`` and explicit offsets, of 18 hours at most, are
    honoured, a naive value is read as wall clock in ``tz``. Unparseable text is null, or raises when
    ``strict`` (whatever the session's ANSI setting).

    Every step uses the step before it once, so the expression stays small wherever it is put:
    text without an offset gets the zone's name, and one cast reads what is complete."""
    s = strip(text)
    full = F.when(~s.rlike(_USUAL_RE) & s.rlike(_ISO_RE), _usual_form(s)).otherwise(s)
    full = F.regexp_replace(full, r"^(\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2})$", "$1:00")
    full = F.regexp_replace(full, r"^(\d{4}-\d{1,2}-\d{1,2})$", "$1T00:00:00")
    full = F.regexp_replace(full, rf"^({_NAIVE_RE})$", f"$1 {tz}")
    # A cast would also take other zones' names, and a time without a date for one of today.
    parsed = F.regexp_extract(full, rf"^{_NAIVE_RE}( ?{re.escape(tz)}|{_SHIFT_RE})$", 0).try_cast("timestamp")
    return require_parsed(s, parsed, "time") if strict else parsed


def require_parsed(text: Column, parsed: Column, what: str) -> Column:
    """``parsed``, failing the job where it is null: on text that did not parse, and on
    missing or blank text."""
    shown = F.coalesce(F.nullif(text, F.lit("")), F.lit("(blank)"))
    return F.coalesce(parsed, F.raise_error(F.concat(F.lit(f"cannot parse {what}: "), shown)))


def seconds_floor(ts: Column | str) -> Column:
    """Whole epoch seconds of an instant, floored (``CAST(ts AS BIGINT)``)."""
    return _col(ts).cast("long")
