"""Run stamps and day buckets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.labels import DAY_BUCKETS, STAMP_FORMAT


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day_of_month_bucket(ts: Column | str, buckets: int = DAY_BUCKETS) -> Column:
    """(day of month - 1) mod buckets; day 31 falls in bucket 0."""
    return F.pmod(F.dayofmonth(_c(ts)) - 1, F.lit(buckets)).cast("bigint")


def day_bucket_of(day: int, buckets: int = DAY_BUCKETS) -> int:
    """Driver-side bucket for a day of month (1..31)."""
    if not 1 <= int(day) <= 31:
        raise ValueError(f"day of month out of range: {day}")
    return (int(day) - 1) % buckets


def validate_day(day: int, buckets: int = DAY_BUCKETS) -> int:
    if not 0 <= int(day) < buckets:
        raise ValueError(f"day bucket must be in 0..{buckets - 1}, got {day}")
    return int(day)


def utc_stamp(ts: Column | str) -> Column:
    return F.date_format(_c(ts), STAMP_FORMAT)


def utc_stamp_now(now: dt.datetime | None = None) -> str:
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.strftime("%Y-%m-%dT%H-%M-%S")


def sample_pct(sample_size: int | None, total: int | None) -> int | None:
    """min(round(sample / total * 100), 100) with half-to-even rounding."""
    if sample_size is None:
        return None
    if sample_size < 0:
        raise ValueError("sample_size must be >= 0")
    if not total:
        raise ValueError("input table size is required and must be > 0 when sampling")
    return min(round(sample_size / total * 100), 100)
