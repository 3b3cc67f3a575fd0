"""Time helpers: zone-explicit epoch seconds, formatting and hour ranges.

Parsing is strict (``try_to_timestamp``: bad text -> NULL, never an error) and
the zone is a parameter, never the JVM or session default.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickweave.functions.codes import DATE_TIME_FORMAT
from clickweave.functions.columns import bind


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_wall_clock(col, fmt: str = DATE_TIME_FORMAT) -> Column:
    """Text -> TIMESTAMP_NTZ wall clock; NULL for text not matching ``fmt``.

    The text is read with an explicit UTC offset and the instant is turned
    back from its epoch, so the session zone (and its clock changes) never
    takes part.
    """
    instant = F.try_to_timestamp(F.concat(_c(col), F.lit(" +00:00")), F.lit(f"{fmt} xxx"))
    seconds = (F.unix_micros(instant) / F.lit(1_000_000)).cast("decimal(18,6)")
    epoch0 = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return epoch0 + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def wall_clock_to_epoch(ntz, tz: str) -> Column:
    """TIMESTAMP_NTZ read as wall-clock time in ``tz`` -> epoch seconds (bigint).

    Independent of ``spark.sql.session.timeZone``.
    """
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), _c(ntz))
    # a TIMESTAMP_NTZ literal: a Python datetime literal would be read in a zone
    epoch0 = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return F.timestamp_diff("SECOND", epoch0, utc)


# strict shape of the default pattern yyyy-MM-dd HH:mm:ss
_DEFAULT_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"


def _session_time_zone() -> str | None:
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    return s.conf.get("spark.sql.session.timeZone") if s is not None else None


#: Six numbers in the order of the default pattern; what follows is not looked at.
_LENIENT_SHAPE = (
    r"^[ \t]*([0-9]{1,9})-[ \t]*([0-9]{1,9})-[ \t]*([0-9]{1,9}) "
    r"[ \t]*([0-9]{1,9}):[ \t]*([0-9]{1,9}):[ \t]*([0-9]{1,9})(?![0-9])"
)


def lenient_wall_clock(col) -> Column:
    """Text -> TIMESTAMP_NTZ wall clock, read as a lenient calendar does.

    Fields need no leading zeros, text behind them is ignored, and values out
    of range roll over: month 13 is January of the next year, day 0 the last of
    the month before, 25:61:61 is 02:02:01 a day later. NULL when the six
    numbers are not there, one has over nine digits, or the year after rolling
    is not 1 to 9999.
    """
    fields = ("year", "month", "day", "hour", "minute", "second")
    numbers = F.struct(*(F.regexp_extract(_c(col), _LENIENT_SHAPE, i).try_cast("long").alias(f) for i, f in enumerate(fields, 1)))

    def first_of_month(months: Column) -> Column:
        date = F.make_date(F.floor(months / 12).cast("int"), (months % 12 + 1).cast("int"), F.lit(1))
        return F.when(months.between(12, 9999 * 12 + 11), date)

    def seconds(n: Column) -> Column:
        date = bind(n["year"] * 12 + n["month"] - 1, first_of_month)
        days = F.datediff(date, F.lit("1970-01-01")).cast("long") + n["day"] - 1
        return days * 86400 + n["hour"] * 3600 + n["minute"] * 60 + n["second"]

    def wall_clock(s: Column) -> Column:
        epoch0 = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
        rest = F.pmod(s, F.lit(86400)).cast("decimal(18,6)")
        # years 1 to 9999, in seconds
        time = epoch0 + F.make_dt_interval(F.floor(s / 86400).cast("int"), F.lit(0), F.lit(0), rest)
        return F.when(s.between(-62135596800, 253402300799), time)

    return bind(bind(numbers, seconds), wall_clock)


def epoch_seconds(col, tz: str, fmt: str = DATE_TIME_FORMAT, lenient: bool = False) -> Column:
    """Text wall-clock time in ``tz`` -> epoch seconds; NULL when unparsable.

    ``lenient`` (default pattern only) reads as :func:`lenient_wall_clock`.

    For the default pattern the text is shape-checked and then cast (several
    times cheaper than pattern parsing, equally strict: out-of-range fields
    give NULL); when ``tz`` is the session zone the cast already yields the
    instant. Any other pattern or zone takes the general path.
    """
    c = _c(col)
    if lenient:
        if fmt != DATE_TIME_FORMAT:
            raise ValueError("lenient reading knows the default pattern only")
        # text of the strict shape needs no rolling unless a field is out of range
        strict = epoch_seconds(c, tz, fmt)
        return F.coalesce(strict, wall_clock_to_epoch(lenient_wall_clock(c), tz))
    if fmt == DATE_TIME_FORMAT:
        ok = c.rlike(_DEFAULT_SHAPE)
        if tz == _session_time_zone():
            return F.unix_seconds(F.when(ok, c.try_cast("timestamp")))
        return wall_clock_to_epoch(F.when(ok, c.try_cast("timestamp_ntz")), tz)
    return wall_clock_to_epoch(parse_wall_clock(c, fmt), tz)


def wall_clock_literal_epoch(text: str, tz: str, fmt: str = DATE_TIME_FORMAT) -> Column:
    """Constant version of :func:`epoch_seconds` (constant-folded by Catalyst)."""
    return epoch_seconds(F.lit(text), tz, fmt)


def format_wall_clock(col, fmt: str = DATE_TIME_FORMAT) -> Column:
    return F.date_format(_c(col), fmt)


def hours_in_range(start: str, end: str, fmt: str = "%Y-%m-%d-%H") -> list[_dt.datetime]:
    """Every hour from ``start`` to ``end``, both inclusive, each once.

    ``start``/``end`` are ``yyyy-MM-dd-HH`` strings. Bounded by the range the
    caller asks for (path selection happens on the driver, like a partition
    filter), not by the data.
    """
    s = _dt.datetime.strptime(start, fmt)
    e = _dt.datetime.strptime(end, fmt)
    if e < s:
        raise ValueError(f"end {end} is before start {start}")
    out, h = [], s
    while h <= e:
        out.append(h)
        h += _dt.timedelta(hours=1)
    return out


def days_in_range(start: str, end: str, fmt: str = "%Y-%m-%d") -> list[_dt.date]:
    s = _dt.datetime.strptime(start, fmt).date()
    e = _dt.datetime.strptime(end, fmt).date()
    if e < s:
        raise ValueError(f"end {end} is before start {start}")
    return [s + _dt.timedelta(days=i) for i in range((e - s).days + 1)]
