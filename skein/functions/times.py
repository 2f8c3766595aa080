"""Column functions for publish times written in words. `now` is always given, so that reruns agree; the session's time zone holds throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.text import strip

# How relative times are written.
DAYS_AGO = r"^(\d+)天前$"
HOURS_AGO = r"^(\d+)小时前$"
MINUTES_AGO = r"^(\d+)分钟前$"
JUST_NOW = "刚刚"
FULL_DATE = r"^\d{4}-\d{2}-\d{2}$"
MONTH_DAY = r"^\d{2}-\d{2}$"


def normalize_timestamp(c: Column) -> Column:
    """Whole numbers lose leading zeros, fractional ones what follows the point, other text is stripped. The result is text."""
    s = strip(c.cast("string"))
    return F.when(s.rlike(r"^\d{1,18}$"), s.try_cast("long").cast("string")).when(s.rlike(r"^-?\d+\.\d+$"), s.try_cast("double").try_cast("long").cast("string")).otherwise(s)


def publish_epoch(c: Column, now: Column) -> Column:
    """Seconds since the epoch of a date, a month and day (of last year if over a day ahead of now), or a time ago; null for all else."""
    v = strip(c)

    def ago(pattern: str, seconds: int) -> Column:
        return F.unix_timestamp(now) - F.regexp_extract(v, pattern, 1).try_cast("long") * seconds

    this_year = F.try_to_timestamp(F.concat_ws("-", F.year(now).cast("string"), v), F.lit("yyyy-MM-dd"))
    last_year = F.try_to_timestamp(F.concat_ws("-", (F.year(now) - 1).cast("string"), v), F.lit("yyyy-MM-dd"))
    month_day = F.when(F.unix_timestamp(this_year) > F.unix_timestamp(now) + 86400, last_year).otherwise(this_year)
    return (
        F.when(v.rlike(FULL_DATE), F.unix_timestamp(F.try_to_timestamp(v, F.lit("yyyy-MM-dd"))))
        .when(v.rlike(MONTH_DAY), F.unix_timestamp(month_day))
        .when(v.rlike(DAYS_AGO), ago(DAYS_AGO, 86400))
        .when(v.rlike(HOURS_AGO), ago(HOURS_AGO, 3600))
        .when(v.rlike(MINUTES_AGO), ago(MINUTES_AGO, 60))
        .when(v == JUST_NOW, F.unix_timestamp(now))
    )


def publish_resolved(c: Column, epoch: Column) -> Column:
    """The time as precise as it was said: a day, an hour or a minute. Other text passes, blank text becomes null."""
    v, at = strip(c), F.timestamp_seconds(epoch)
    known = epoch.isNotNull()
    return (
        F.when(F.coalesce(v, F.lit("")) == "", None)
        .when(v.rlike(FULL_DATE), v)
        .when(v.rlike(MONTH_DAY) & known, F.date_format(at, "yyyy-MM-dd"))
        .when(v.rlike(DAYS_AGO) & known, F.date_format(at, "yyyy-MM-dd"))
        .when(v.rlike(HOURS_AGO) & known, F.date_format(at, "yyyy-MM-dd HH:00"))
        .when((v.rlike(MINUTES_AGO) | (v == JUST_NOW)) & known, F.date_format(at, "yyyy-MM-dd HH:mm"))
        .otherwise(v)
    )
