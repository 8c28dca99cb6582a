"""Calendar, Fourier and event-calendar column expressions."""

from __future__ import annotations

import math
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import col

TWO_PI = 2.0 * math.pi


def day_of_week(ts) -> Column:
    """Monday = 0 ... Sunday = 6 (Spark ``weekday``)."""
    return F.weekday(col(ts))


def is_leap_year(ts) -> Column:
    y = F.year(col(ts))
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def is_leap_day(ts) -> Column:
    return (F.month(col(ts)) == 2) & (F.dayofmonth(col(ts)) == 29)


def calendar_parts(ts="ts") -> dict:
    t = col(ts)
    dow = day_of_week(t)
    return {
        "hour_of_day": F.hour(t),
        "day_of_week": dow,
        "month": F.month(t),
        "year": F.year(t),
        "is_weekend": (dow >= 5).cast("int"),
    }


def adjusted_day_of_year(ts="ts", leap_adjust: bool = True) -> Column:
    t = col(ts)
    doy = F.dayofyear(t)
    if leap_adjust:
        doy = doy - (is_leap_year(t) & (F.month(t) >= 3)).cast("int")
    return doy


def fourier_terms(ts="ts", leap_adjust: bool = True, period_days: int = 365) -> dict:
    """Daily, weekly, yearly (k = 1, 2) terms."""
    t = col(ts)
    h = F.hour(t).cast("double")
    d = day_of_week(t).cast("double")
    y = adjusted_day_of_year(t, leap_adjust).cast("double")
    out = {
        "sin_day": F.sin(F.lit(TWO_PI) * h / 24.0),
        "cos_day": F.cos(F.lit(TWO_PI) * h / 24.0),
        "sin_week": F.sin(F.lit(TWO_PI) * d / 7.0),
        "cos_week": F.cos(F.lit(TWO_PI) * d / 7.0),
    }
    for k in (1, 2):
        out[f"sin_year_{k}"] = F.sin(F.lit(TWO_PI * k) * y / float(period_days))
        out[f"cos_year_{k}"] = F.cos(F.lit(TWO_PI * k) * y / float(period_days))
    return out


def fourier_week_hours(ts="ts") -> dict:
    """Daily k=1,2 on fractional hour, weekly k=1 on hour of week."""
    t = col(ts)
    hour = F.hour(t).cast("double") + F.minute(t).cast("double") / 60.0
    how = (day_of_week(t) * 24 + F.hour(t)).cast("double")
    return {
        "sin_day_1": F.sin(F.lit(TWO_PI) * hour / 24.0),
        "cos_day_1": F.cos(F.lit(TWO_PI) * hour / 24.0),
        "sin_day_2": F.sin(F.lit(2 * TWO_PI) * hour / 24.0),
        "cos_day_2": F.cos(F.lit(2 * TWO_PI) * hour / 24.0),
        "sin_week_1": F.sin(F.lit(TWO_PI) * how / 168.0),
        "cos_week_1": F.cos(F.lit(TWO_PI) * how / 168.0),
    }


ONE_HOT_CATEGORIES = {"hour": ("hour_of_day", range(24)),
                      "dow": ("day_of_week", range(7)),
                      "month": ("month", range(1, 13))}


def one_hot(parts: dict | None = None) -> dict:
    """P25: 43 indicator columns with fixed categories (absent ones are 0)."""
    out = {}
    for prefix, (src, cats) in ONE_HOT_CATEGORIES.items():
        for k in cats:
            out[f"{prefix}_{k}"] = (F.col(src) == k).cast("int")
    return out


#: days of a calendar that are broadcast at most (the list comes from the caller, so its size is known)
MAX_BROADCAST_DAYS = 100_000


def event_flag(df: DataFrame, ranges, ts: str = "ts", name: str = "is_event",
               end: str = "midnight") -> DataFrame:
    """1 when ``ts`` lies in any inclusive [start, end] date range, else 0.

    ``end='midnight'`` reproduces ``between('start', 'end')`` on timestamps: the
    last day counts only for its 00:00 row; ``'whole_day'`` includes it fully.
    The ranges are laid out as days, so the range join is an equi-join on the day
    whatever the length of the calendar.  A NULL ``ts`` lies in no range: 0.
    """
    whole: dict[date, bool] = {}
    for s, e in ranges:
        first, last = date.fromisoformat(str(s)[:10]), date.fromisoformat(str(e)[:10])
        for k in range((last - first).days + 1):
            day = first + timedelta(days=k)
            whole[day] = whole.get(day, False) or end == "whole_day" or day < last
    if not whole:
        return df.withColumn(name, F.lit(0))
    days = df.sparkSession.createDataFrame(sorted(whole.items()), "_day date, _whole boolean")
    if len(whole) <= MAX_BROADCAST_DAYS:
        days = F.broadcast(days)
    stamp = F.col(ts).cast("timestamp_ntz")
    inside = F.col("_day").isNotNull() & (F.col("_whole") | (stamp == F.date_trunc("day", stamp).cast("timestamp_ntz")))
    return (df.join(days, F.to_date(stamp) == F.col("_day"), "left")
              .withColumn(name, F.coalesce(inside, F.lit(False)).cast("int")).drop("_day", "_whole"))
