"""Time parsing, grain bucketing and zone conversion (DAT-*).

All bucketing works on TIMESTAMP_NTZ wall-clock values, so results never
depend on the session time zone; zones are always explicit parameters.
"""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("YEAR", "MONTH", "WEEK", "DAY", "HR", "MIN", "SEC")
_ALIASES = {"HOUR": "HR", "MINUTE": "MIN", "SECOND": "SEC", "YR": "YEAR"}

_PARTS = {
    "YEAR": ("year",),
    "MONTH": ("year", "month"),
    "WEEK": ("year", "week"),
    "DAY": ("year", "month", "day"),
    "HR": ("year", "month", "day", "hour"),
    "MIN": ("year", "month", "day", "hour", "minute"),
    "SEC": ("year", "month", "day", "hour", "minute", "second"),
}

# date_trunc unit per grain (WEEK truncates to the ISO Monday).
_TRUNC = {"YEAR": "year", "MONTH": "month", "WEEK": "week", "DAY": "day",
          "HR": "hour", "MIN": "minute", "SEC": "second"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def normalize_grain(grain: str) -> str:
    g = str(grain).upper()
    g = _ALIASES.get(g, g)
    if g not in _PARTS:
        raise ValueError(f"unknown grain {grain!r}; expected one of {GRAINS}")
    return g


def grain_columns(grain: str) -> tuple[str, ...]:
    """Names of the integer time-part columns of a grain."""
    return _PARTS[normalize_grain(grain)]


def grain_parts(ts, grain: str, week_year: str = "iso") -> list[Column]:
    """Integer time parts of an NTZ timestamp at a grain (DAT-6, PRJ-4).

    WEEK gives the ISO week-year and ISO week (DAT-4); ``week_year='calendar'``
    gives the calendar year instead (DAT-5, wrong at year ends; opt-in only).
    """
    g = normalize_grain(grain)
    t = _col(ts)
    out = []
    for name in _PARTS[g]:
        if name == "year":
            if g == "WEEK" and week_year == "iso":
                c = F.extract(F.lit("YEAROFWEEK"), t)
            else:
                c = F.year(t)
        elif name == "week":
            c = F.weekofyear(t)
        elif name == "month":
            c = F.month(t)
        elif name == "day":
            c = F.dayofmonth(t)
        elif name == "hour":
            c = F.hour(t)
        elif name == "minute":
            c = F.minute(t)
        else:
            c = F.second(t)
        out.append(c.cast("int").alias(name))
    return out


def bucket_start(ts, grain: str) -> Column:
    """Start of the grain bucket, kept as TIMESTAMP_NTZ."""
    g = normalize_grain(grain)
    t = _col(ts)
    # date_trunc returns a session-zone TIMESTAMP; rebuild the NTZ value from
    # wall-clock parts instead so that no zone is involved.
    if g == "WEEK":
        d = F.date_sub(F.to_date(t), (F.dayofweek(t) + 5) % 7)
        return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), F.lit(0), F.lit(0), F.lit(0))
    y = F.year(t)
    mo = F.month(t) if g != "YEAR" else F.lit(1)
    d = F.dayofmonth(t) if g in ("DAY", "HR", "MIN", "SEC") else F.lit(1)
    h = F.hour(t) if g in ("HR", "MIN", "SEC") else F.lit(0)
    mi = F.minute(t) if g in ("MIN", "SEC") else F.lit(0)
    s = F.second(t) if g == "SEC" else F.lit(0)
    return F.make_timestamp_ntz(y, mo, d, h, mi, s)


def parts_to_timestamp(grain: str, prefix: str = "") -> Column:
    """NTZ bucket start rebuilt from the integer part columns of a grain."""
    g = normalize_grain(grain)
    c = lambda n: F.col(prefix + n)
    if g == "WEEK":
        jan4 = F.make_date(c("year"), F.lit(1), F.lit(4))
        monday = F.date_add(F.date_sub(jan4, (F.dayofweek(jan4) + 5) % 7), (c("week") - 1) * 7)
        return F.make_timestamp_ntz(F.year(monday), F.month(monday), F.dayofmonth(monday),
                                    F.lit(0), F.lit(0), F.lit(0))
    names = _PARTS[g]
    get = lambda n, default: c(n) if n in names else F.lit(default)
    return F.make_timestamp_ntz(get("year", 1970), get("month", 1), get("day", 1),
                                get("hour", 0), get("minute", 0), get("second", 0))


def _int(c) -> Column:
    return c.try_cast("int")


def parse_post_time(created_at) -> Column:
    """``EEE MMM dd HH:mm:ss Z yyyy`` -> NTZ wall clock; the offset field is
    skipped (DAT-1) and the month name is matched case-insensitively (DAT-2).

    The format is fixed-width: one shape check, then substrings; ``try_``
    construction turns an impossible date into null. A malformed value is a
    reject (null), never a job failure, even under ANSI mode, and no
    formatter or session zone is involved."""
    c = _col(created_at)
    shape = r"^[A-Za-z]{3} [A-Za-z]{3} \d{2} \d{2}:\d{2}:\d{2} [+-]\d{4} \d{4}$"
    month = F.array_position(F.array(*[F.lit(m.upper()) for m in _MONTH_NAMES]), F.upper(F.substring(c, 5, 3)))
    parts = [_int(F.substring(c, 27, 4)), month.cast("int"), _int(F.substring(c, 9, 2)),
             _int(F.substring(c, 12, 2)), _int(F.substring(c, 15, 2)), _int(F.substring(c, 18, 2))]
    return F.when(c.rlike(shape), F.try_make_timestamp_ntz(*parts))


def _fixed_fields(s, pattern: str, spans) -> Column:
    """NTZ from fixed-position digit fields after one shape check; a value of
    the wrong shape or an impossible date/time gives null."""
    c = _col(s)
    parts = [_int(F.substring(c, a, n)) for a, n in spans]
    return F.when(c.rlike(pattern), F.try_make_timestamp_ntz(*parts))


def parse_local_time(s) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> NTZ; malformed -> null (no exception, no zone)."""
    return _fixed_fields(F.trim(_col(s)), r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
                         ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2)))


def parse_compact_time(s) -> Column:
    """``yyyyMMdd'T'HHmmss`` -> NTZ; malformed -> null."""
    return _fixed_fields(s, r"^\d{8}T\d{6}$", ((1, 4), (5, 2), (7, 2), (10, 2), (12, 2), (14, 2)))


def format_local_time(ts, date_sep: str = "-", mid: str = " ", time_sep: str = ":") -> Column:
    """NTZ -> ``yyyy-MM-dd HH:mm:ss`` (separators configurable) from
    wall-clock parts, so no session zone is involved."""
    t = _col(ts)
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat(F.lpad(F.year(t).cast("string"), 4, "0"), F.lit(date_sep), two(F.month(t)), F.lit(date_sep),
                    two(F.dayofmonth(t)), F.lit(mid), two(F.hour(t)), F.lit(time_sep), two(F.minute(t)),
                    F.lit(time_sep), two(F.second(t)))


_DAY_NAMES = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")  # dayofweek 1..7
_MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def format_post_time(ts) -> Column:
    """NTZ -> ``EEE MMM dd HH:mm:ss +0000 yyyy``, assembled from wall-clock
    parts so no session zone is involved (``date_format`` would cast to the
    session zone first)."""
    t = _col(ts)
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    day = F.element_at(F.array(*[F.lit(d) for d in _DAY_NAMES]), F.dayofweek(t))
    mon = F.element_at(F.array(*[F.lit(m) for m in _MONTH_NAMES]), F.month(t))
    return F.concat(day, F.lit(" "), mon, F.lit(" "), two(F.dayofmonth(t)), F.lit(" "), two(F.hour(t)), F.lit(":"),
                    two(F.minute(t)), F.lit(":"), two(F.second(t)), F.lit(" +0000 "),
                    F.lpad(F.year(t).cast("string"), 4, "0"))


def convert_zone(ts, from_tz: str, to_tz: str) -> Column:
    """Wall clock in ``from_tz`` -> wall clock in ``to_tz`` (DAT-3)."""
    if from_tz == to_tz:
        return _col(ts)
    return F.convert_timezone(F.lit(from_tz), F.lit(to_tz), _col(ts))


def parse_trade_time(s, from_tz: str = "Europe/Oslo", to_tz: str = "America/Los_Angeles") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` local to ``from_tz`` -> NTZ in ``to_tz``."""
    return convert_zone(parse_local_time(s), from_tz, to_tz)


def reformat_compact_time(s) -> Column:
    """``yyyyMMdd'T'HHmmss`` -> ``yyyy-MM-dd HH:mm:ss`` (DAT-7); malformed -> null.
    The output is cut from the validated input, so the value is parsed once."""
    c = _col(s)
    sub = lambda a, n: F.substring(c, a, n)
    text = F.concat(sub(1, 4), F.lit("-"), sub(5, 2), F.lit("-"), sub(7, 2), F.lit(" "), sub(10, 2), F.lit(":"),
                    sub(12, 2), F.lit(":"), sub(14, 2))
    return F.when(parse_compact_time(c).isNotNull(), text)


def floor_minutes(ts, n: int) -> Column:
    """Floor to an n-minute block within the hour, label ``yyyyMMddHHmmss``;
    n = 0 gives the day label ``yyyy-MM-dd`` (DAT-8). n must divide 60."""
    t = _col(ts)
    if n == 0:
        return F.substring(format_local_time(t), 1, 10)
    if n <= 0 or 60 % n:
        raise ValueError("n must divide 60")
    m = (F.minute(t) / n).cast("int") * n
    block = F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), m, F.lit(0))
    return format_local_time(block, "", "", "")


def epoch_to_local(epoch_seconds, tz: str) -> Column:
    """Epoch seconds -> NTZ wall clock in ``tz`` (DAT-9)."""
    utc = F.timestamp_add("SECOND", _col(epoch_seconds).cast("long"),
                         _epoch_ntz())
    return convert_zone(utc, "UTC", tz)


def wall_clock_instant(ts) -> Column:
    """NTZ wall clock -> TIMESTAMP instant that reads the same in UTC, without
    the session zone (event-time column for watermarks; ``window()`` then
    aligns to wall-clock hours and days)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), _col(ts)))


def instant_wall_clock(ts) -> Column:
    """Inverse of ``wall_clock_instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), _epoch_ntz())


def local_to_epoch_millis(ts, tz: str = "UTC") -> Column:
    """NTZ wall clock in ``tz`` -> epoch milliseconds (DAT-10, DAT-11)."""
    utc = convert_zone(_col(ts), tz, "UTC")
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), utc)


def local_to_utc_strict(ts, tz: str) -> Column:
    """Wall clock in ``tz`` -> UTC wall clock; raises on a time that does not
    exist (spring gap) or exists twice (autumn fold) in ``tz`` (DAT-12)."""
    t = _col(ts)
    utc = convert_zone(t, tz, "UTC")
    back = convert_zone(utc, "UTC", tz)
    later = convert_zone(utc + F.expr("INTERVAL 1 HOUR"), "UTC", tz)
    earlier = convert_zone(utc - F.expr("INTERVAL 1 HOUR"), "UTC", tz)
    bad = (back != t) | (later == t) | (earlier == t)
    return F.when(bad, F.raise_error(F.concat(F.lit(f"ambiguous or non-existent time in {tz}: "),
                                              t.cast("string")))).otherwise(utc)


def local_hour_to_utc(label: str, tz: str = "America/New_York") -> _dt.datetime:
    """Scalar form of DAT-12 for a ``YYYY_MM_DD_HH`` parameter; raises ValueError."""
    naive = _dt.datetime.strptime(label, "%Y_%m_%d_%H")
    zone = ZoneInfo(tz)
    a = naive.replace(tzinfo=zone, fold=0)
    b = naive.replace(tzinfo=zone, fold=1)
    utc = a.astimezone(_dt.timezone.utc)
    if utc.astimezone(zone).replace(tzinfo=None) != naive:
        raise ValueError(f"{label} does not exist in {tz}")
    if a.utcoffset() != b.utcoffset():
        raise ValueError(f"{label} is ambiguous in {tz}")
    return utc.replace(tzinfo=None)


def display_shift(ts, hours: int = -5) -> Column:
    """Fixed display offset (DAT-15): UTC wall clock shifted by ``hours``."""
    return F.timestamp_add("HOUR", F.lit(hours), _col(ts))


def parts_label(grain: str = "SEC") -> Column:
    """``y-m-d h:m:s`` without zero padding (DAT-13)."""
    c = F.col
    return F.concat(c("year"), F.lit("-"), c("month"), F.lit("-"), c("day"), F.lit(" "),
                    c("hour"), F.lit(":"), c("minute"), F.lit(":"), c("second"))
