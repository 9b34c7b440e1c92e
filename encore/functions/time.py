"""Date/time column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats and zone used by the raw inputs.
PLAYED_AT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSX"   # 'Z' read as a UTC offset, not a literal
FRACTION_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SS][.S]X"   # none, or one to six digits
DEFAULT_TZ = "America/Mexico_City"
DISPLAY_FORMAT = "yyyy-MM-dd"
EXPORT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_utc(c, pattern: str = PLAYED_AT_PATTERN) -> Column:
    """ISO text without a fraction or with one of one to six digits -> instant.

    Other text (a time or a year alone, other formats) gives NULL; it never becomes a time of the run's own day.
    """
    c = _c(c)
    return F.coalesce(F.try_to_timestamp(c, F.lit(pattern)), F.try_to_timestamp(c, F.lit(FRACTION_PATTERN)))


def to_local(ts_utc, tz: str = DEFAULT_TZ) -> Column:
    """UTC instant -> local wall clock as TIMESTAMP_NTZ (never shifted again)."""
    return F.from_utc_timestamp(_c(ts_utc), tz).cast("timestamp_ntz")


def as_ntz(ts) -> Column:
    """Instant rendered as a UTC wall clock (session zone is UTC)."""
    return _c(ts).cast("timestamp_ntz")


def calendar_fields(local) -> dict[str, Column]:
    local = _c(local)
    return {
        "play_hour": F.hour(local),
        "play_day_of_week": F.dayofweek(local),   # 1 = Sunday ... 7 = Saturday
        "play_month": F.month(local),
        "play_year": F.year(local),
    }


def season(month) -> Column:
    """3-5 Spring, 6-8 Summer, 9-11 Fall, else Winter (NULL month -> Winter, T3)."""
    m = _c(month)
    return (F.when(m.between(3, 5), "Spring")
            .when(m.between(6, 8), "Summer")
            .when(m.between(9, 11), "Fall")
            .otherwise("Winter"))


def as_of_date(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (_dt.date, str)):
        return F.lit(str(as_of)).cast("date")
    return _c(as_of)


def in_trailing_window(local, as_of, days_back: int, upper: bool = False) -> Column:
    """date(local) >= as_of - days_back (T24: lower bound only unless ``upper``)."""
    d = F.to_date(_c(local))
    a = as_of_date(as_of)
    cond = d >= F.date_sub(a, int(days_back))
    if upper:
        cond = cond & (d <= a)
    return cond


def duration_minutes(ms) -> Column:
    """round(ms / 60000, 2) with HALF_UP done in exact integer arithmetic (P10)."""
    c = _c(ms)
    return F.when(c >= 0, F.floor((c + 300) / 600) / 100.0).otherwise(F.round(c / 60000.0, 2))


def date_part_of_iso(c) -> Column:
    """Text before the 'T' of an ISO string."""
    return F.split_part(_c(c), F.lit("T"), F.lit(1))


def reformat_date(c, fmt: str = DISPLAY_FORMAT) -> Column:
    """Drop the fraction, parse, format; keep the original text when parsing fails."""
    c = _c(c)
    ts = F.try_to_timestamp(F.split_part(c, F.lit("."), F.lit(1)), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return F.coalesce(F.date_format(ts, fmt), c)
