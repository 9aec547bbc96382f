"""Date and time functions on epoch milliseconds.

All of them work on zone-less timestamps, so the session time zone never changes a result;
a zone other than UTC is named explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
DAY_MS = 86_400_000

# Zodiac signs with the last month*100+day of each; the first sign also closes the year.
ZODIAC_LAST_DAY = [
    (119, "摩羯座"), (218, "水瓶座"), (320, "双鱼座"), (419, "白羊座"), (520, "金牛座"), (621, "双子座"),
    (722, "巨蟹座"), (822, "狮子座"), (922, "处女座"), (1023, "天秤座"), (1122, "天蝎座"), (1221, "射手座"),
    (1231, "摩羯座"),
]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ms_of(ntz: Column | str) -> Column:
    """Zone-less timestamp (read as UTC) to epoch milliseconds.

    Put together from its fields: ``timestampdiff`` would move hours the session's zone skips.
    """
    t = _c(ntz)
    days = F.unix_date(t.cast("date")).cast("bigint")
    millis = (F.date_part(F.lit("SECOND"), t) * 1000).cast("bigint")
    return days * DAY_MS + F.hour(t) * 3_600_000 + F.minute(t) * 60_000 + millis


def ntz_of(ms: Column | str, zone: str = "UTC") -> Column:
    """Epoch milliseconds to the zone-less wall clock of ``zone``."""
    wall = F.timestamp_add("MILLISECOND", _c(ms), F.expr(EPOCH))
    return wall if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), wall)


def ts_to_date(ms: Column | str, zone: str = "UTC") -> Column:
    """``yyyy-MM-dd`` of epoch milliseconds."""
    return ntz_of(ms, zone).cast("date").cast("string")


def ts_to_datetime(ms: Column | str, zone: str = "UTC") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of epoch milliseconds."""
    return F.substring(ntz_of(ms, zone).cast("string"), 1, 19)


def ts_to_partition(ms: Column | str, zone: str = "UTC") -> Column:
    """``yyyyMMdd`` of epoch milliseconds."""
    return F.regexp_replace(ts_to_date(ms, zone), "-", "")


def datetime_to_ts(text: Column | str, zone: str = "UTC") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in ``zone`` to epoch milliseconds; null when unreadable."""
    wall = _c(text).try_cast("timestamp_ntz")
    return ms_of(wall if zone == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), wall))


def date_to_ts(text: Column | str, zone: str = "UTC") -> Column:
    """Midnight of a ``yyyy-MM-dd`` date in ``zone`` as epoch milliseconds."""
    return datetime_to_ts(text, zone)


def millis_to_date(text: Column | str, zone: str = "UTC") -> Column:
    """Text holding epoch milliseconds to ``yyyy-MM-dd``; null when it is no number."""
    return ts_to_date(_c(text).try_cast("bigint"), zone)


def today_int(as_of: Column | None = None) -> Column:
    """A date as the integer yyyyMMdd, today unless ``as_of`` is given."""
    day = F.current_date() if as_of is None else as_of
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def window_start(ms: Column | str, seconds: int) -> Column:
    """Start of the tumbling window of ``seconds`` that holds ``ms``."""
    ms = _c(ms)
    return ms - F.pmod(ms, F.lit(seconds * 1000).cast("bigint"))


def day_diff(ms: Column | str, last_date: Column | str, zone: str = "UTC") -> Column:
    """Whole 24-hour days from midnight of ``last_date`` to ``ms``."""
    gap = _c(ms) - date_to_ts(last_date, zone)
    return ((gap - gap % F.lit(DAY_MS)) / F.lit(DAY_MS)).cast("bigint")


def epoch_day(days: Column | str) -> Column:
    """Days since 1970-01-01 to a date; null when it is no number."""
    return F.date_add(F.lit("1970-01-01").cast("date"), _c(days).try_cast("int"))


def age(birthday: Column | str, as_of: Column | str) -> Column:
    """Full years between two dates; -1 when the birthday is missing."""
    b, a = _c(birthday), _c(as_of)
    early = (F.month(a) * 100 + F.dayofmonth(a)) < (F.month(b) * 100 + F.dayofmonth(b))
    return F.coalesce(F.year(a) - F.year(b) - early.cast("int"), F.lit(-1))


def decade(birthday: Column | str) -> Column:
    """First year of the decade of a date."""
    y = F.year(_c(birthday))
    return y - F.pmod(y, F.lit(10))


def zodiac(birthday: Column | str) -> Column:
    """Zodiac sign of a date."""
    b = _c(birthday)
    day = F.month(b) * 100 + F.dayofmonth(b)
    sign = None
    for last, name in ZODIAC_LAST_DAY:
        sign = F.when(day <= last, name) if sign is None else sign.when(day <= last, name)
    return sign
