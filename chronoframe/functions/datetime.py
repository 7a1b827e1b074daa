"""Date and time expressions (X02–X08).  All arithmetic is on ``timestamp_ntz`` micro-seconds since
1970-01-01, so results do not depend on the session time zone."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(c) -> Column:
    """Micro-seconds since the epoch of a timestamp / timestamp_ntz / date column."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _c(c).cast("timestamp_ntz"))


def from_epoch_micros(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH))


def floor_ts(c, minutes: int) -> Column:
    """Floor to a multiple of ``minutes`` counted from the epoch (same as ``window().start``)."""
    step = int(minutes) * 60_000_000
    return from_epoch_micros(F.floor(epoch_micros(c) / F.lit(step)) * F.lit(step))


def date_parts(c) -> dict[str, Column]:
    """Year, month, day, hour, minute."""
    c = _c(c)
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c), "hour": F.hour(c),
            "minute": F.minute(c)}


def iso_weekday(c) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(_c(c)) + 1


_PY_TO_SPARK = [("%Y", "yyyy"), ("%m", "MM"), ("%d", "dd"), ("%H", "HH"), ("%M", "mm"), ("%S", "ss"),
                ("%f", "SSSSSS"), ("%y", "yy"), ("%b", "MMM"), ("%j", "DDD")]


def strftime_to_spark(fmt: str) -> str:
    """Translate a strftime pattern to a Spark datetime pattern (literal text is quoted)."""
    out, i = [], 0
    table = dict(_PY_TO_SPARK)
    while i < len(fmt):
        tok = fmt[i:i + 2]
        if tok in table:
            out.append(table[tok])
            i += 2
        elif fmt[i].isalpha():
            out.append("'" + fmt[i] + "'")
            i += 1
        else:
            out.append(fmt[i])
            i += 1
    return "".join(out)


def parse_datetime(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Text → timestamp_ntz with a format; unparsable text → null (``try_to_timestamp``).

    The reference's default pattern writes minute where month is meant; the default here is the
    intended ``yyyy-MM-dd``.  ``%``-patterns are translated.
    """
    if "%" in fmt:
        fmt = strftime_to_spark(fmt)
    return F.try_to_timestamp(_c(c).cast("string"), F.lit(fmt)).cast("timestamp_ntz")


def time_id_to_ts(date_col, time_id_col, granularity_min: int, start_min: int = 0) -> Column:
    """``date + (time_id − 1)·granularity + start`` minutes."""
    minutes = (_c(time_id_col).cast("long") - 1) * int(granularity_min) + int(start_min)
    return F.timestamp_add("MINUTE", minutes, _c(date_col).cast("timestamp_ntz"))


def minute_of_day(c) -> Column:
    c = _c(c)
    return F.hour(c) * 60 + F.minute(c)


def cyclical(c, resample_minutes: int) -> dict[str, Column]:
    """sin/cos of time of day (in resample steps), weekday/7 and month/12.

    Day phase = (minute of day / resample) / (1440 / resample); weekday is Monday = 1 … 7; month 1 … 12.
    """
    c = _c(c)
    steps = 1440.0 / float(resample_minutes)
    day = (minute_of_day(c) / F.lit(float(resample_minutes))) / F.lit(steps)
    week = iso_weekday(c) / F.lit(7.0)
    month = F.month(c) / F.lit(12.0)
    two_pi = 2.0 * math.pi
    return {
        "day_sin": F.sin(F.lit(two_pi) * day), "day_cos": F.cos(F.lit(two_pi) * day),
        "week_sin": F.sin(F.lit(two_pi) * week), "week_cos": F.cos(F.lit(two_pi) * week),
        "month_sin": F.sin(F.lit(two_pi) * month), "month_cos": F.cos(F.lit(two_pi) * month),
    }


# Fixed values of the alternative time encoding (X07): seconds per day and days per year.
DAY_SECONDS = 24 * 60 * 60
YEAR_DAYS = 365.2425


def time_encoding(c) -> dict[str, Column]:
    """sin/cos of unix seconds with period one day and one (mean Gregorian) year."""
    secs = epoch_micros(c) / F.lit(1_000_000.0)
    day = F.lit(2.0 * math.pi / DAY_SECONDS) * secs
    year = F.lit(2.0 * math.pi / (YEAR_DAYS * DAY_SECONDS)) * secs
    return {"day_sin": F.sin(day), "day_cos": F.cos(day), "year_sin": F.sin(year), "year_cos": F.cos(year)}
