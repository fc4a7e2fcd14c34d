"""Hours written as ``yyyyMMddHH`` integers.

Such integers sort like time but do not add like time (2023032323 + 1 is not
an hour).  The Column functions below do calendar arithmetic on the digits
with integer operations only: no parsing per row, no session time zone, no
daylight-saving gaps, and still inside generated code.
"""

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_FORMAT = "yyyyMMddHH"
BUCKET_HOUR = "yyyy-MM-dd-HH"
BUCKET_DAY = "yyyy-MM-dd"
BUCKET_MONTH = "yyyy-MM"

# How many trailing digits of yyyyMMddHH a bucket drops.
_BUCKET_DROPS = {BUCKET_HOUR: 1, BUCKET_DAY: 100, BUCKET_MONTH: 10_000}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _div(x: Column, n: int) -> Column:
    """Integer quotient; the ``div`` operator has no Column method."""
    return F.call_function("div", x, F.lit(n))


def _days_in_month(year: Column, month: Column) -> Column:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return (
        F.when(month == 2, F.when(leap, 29).otherwise(28))
        .when(month.isin(4, 6, 9, 11), 30)
        .otherwise(31)
    )


def _split(x: Column):
    year = _div(x, 1_000_000)
    month = _div(x, 10_000) % 100
    day = _div(x, 100) % 100
    return year, month, day, x % 100


_PARTS = ("year", "month", "day", "hh")


def hour_parts(hour, prefix: str) -> dict[str, Column]:
    """Year, month, day and hour of day, to be columns of a projection of their own.

    The calendar functions below name them many times.  As expressions they
    are written out at each place, and the JVM never compiles a generated
    method of more than 8,000 bytes.
    """
    return {f"{prefix}_{part}": value for part, value in zip(_PARTS, _split(_col(hour)))}


def parts_of(prefix: str) -> tuple[Column, ...]:
    """The columns of :func:`hour_parts`, as ``parts`` of the functions below."""
    return tuple(F.col(f"{prefix}_{part}") for part in _PARTS)


def is_hour(hour, parts=None) -> Column:
    """True if the integer is a real ``yyyyMMddHH`` hour."""
    x = _col(hour)
    year, month, day, hh = parts or _split(x)
    return (
        x.between(1000_01_01_00, 9999_12_31_23)
        & month.between(1, 12)
        & (hh <= 23)
        & (day >= 1)
        & ((day <= 28) | (day <= _days_in_month(year, month)))
    )


def next_hour(hour, parts=None) -> Column:
    """The first real hour greater than the integer, itself a real hour or not.

    For a log row this is the end of its hourly window, hence the id of the
    hourly batch it belongs to: ``h <= x < next_hour(h)`` as integers, exactly
    as a per-hour range filter would place it.
    """
    x = _col(hour)
    year, month, day, hh = parts or _split(x)
    last = _days_in_month(year, month)
    year_start = year * 1_000_000 + 10_100
    month_start = year * 1_000_000 + month * 10_000 + 100
    return (
        F.when(month == 0, year_start)
        .when((month > 12) | ((month == 12) & ((day > 31) | ((day == 31) & (hh >= 23)))), year_start + 1_000_000)
        .when(day == 0, month_start)
        .when((day > last) | ((day == last) & (hh >= 23)), month_start + 10_000)
        .when(hh >= 23, x - hh + 100)
        .otherwise(x + 1)
        .cast("bigint")
    )


def hour_of(ts) -> Column:
    """``yyyyMMddHH`` integer of a timestamp, from its calendar fields."""
    t = _col(ts)
    digits = ((F.year(t) * 100 + F.month(t)) * 100 + F.dayofmonth(t)).cast("bigint")
    return digits * 100 + F.hour(t)


def hour_of_epoch(seconds) -> Column:
    """``yyyyMMddHH`` integer of epoch seconds, in the session time zone."""
    return hour_of(F.timestamp_seconds(_col(seconds)))


def hour_timestamp(hour) -> Column:
    """Timestamp of a ``yyyyMMddHH`` integer or text; NULL if it is no hour."""
    return F.try_to_timestamp(_col(hour).cast("string"), F.lit(HOUR_FORMAT))


def shift_hours(hour, hours: int) -> Column:
    """Add hours (may be negative) to a ``yyyyMMddHH`` column."""
    moved = hour_timestamp(hour) + F.make_dt_interval(F.lit(0), F.lit(hours))
    return hour_of(moved)


def bucket_text(hour, bucket_format: str = BUCKET_HOUR) -> Column:
    """Text of the time bucket of an hour; NULL if it is no hour."""
    return F.date_format(hour_timestamp(hour), bucket_format)


def has_bucket_key(bucket_format: str) -> bool:
    return bucket_format in _BUCKET_DROPS


def bucket_key(hour, bucket_format: str = BUCKET_HOUR, parts=None) -> Column:
    """The bucket as an integer prefix of the hour: 8 bytes to group by
    instead of a formatted string, and nothing to parse per log row."""
    x = _col(hour)
    drop = _BUCKET_DROPS[bucket_format]
    return F.when(is_hour(x, parts), x if drop == 1 else _div(x, drop))


def bucket_key_text(key, bucket_format: str = BUCKET_HOUR) -> Column:
    """Text of a :func:`bucket_key`, for the few rows left after grouping."""
    digits = _col(key).cast("string")
    parts = [F.substring(digits, 1, 4)]
    parts += [F.substring(digits, 5 + 2 * i, 2) for i in range(bucket_format.count("-"))]
    text = parts[0]
    for part in parts[1:]:
        text = F.concat(text, F.lit("-"), part)
    return text


def bucket_text_key(text, bucket_format: str = BUCKET_HOUR) -> Column:
    """Back from bucket text to the integer key; other text is an error."""
    t = _col(text)
    return F.when(
        F.length(t) == len(bucket_format), F.translate(t, "-", "").cast("bigint")
    ).when(
        t.isNotNull(), F.raise_error(F.concat(F.lit(f"not a bucket of the form {bucket_format}: "), t)).cast("bigint")
    )


# --- driver-side window lists -------------------------------------------------


def parse_hour(hour) -> datetime:
    return datetime.strptime(str(hour), "%Y%m%d%H")


def format_hour(moment: datetime) -> int:
    return int(moment.strftime("%Y%m%d%H"))


def move_hour(hour: int, *, hours: int = 0, days: int = 0) -> int:
    return format_hour(parse_hour(hour) + timedelta(hours=hours, days=days))


def hours_between(start: int, end: int) -> list[int]:
    """Hours from ``start`` (in) to ``end`` (out)."""
    moment, stop = parse_hour(start), parse_hour(end)
    out = []
    while moment < stop:
        out.append(format_hour(moment))
        moment += timedelta(hours=1)
    return out


def hourly_batch_ids(start: int, end: int) -> list[int]:
    """Ids of the hourly batches of ``[start, end)``: each hour's end."""
    return [move_hour(h, hours=1) for h in hours_between(start, end)]
