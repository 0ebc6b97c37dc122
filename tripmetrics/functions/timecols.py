"""Date/time scalars (T1-T5) and the day/hour keys every rollup groups by.

All take a TIMESTAMP column and work in the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: messages with a time outside [EARLIEST, LATEST) are rejects (reason ``event_time``)
EARLIEST = "2000-01-01 00:00:00"
LATEST = "2100-01-01 00:00:00"


def time_in_range(ts: Column) -> Column:
    """Is an event time inside the accepted range?  Bounds every calendar."""
    return (ts >= F.lit(EARLIEST).cast("timestamp")) & (ts < F.lit(LATEST).cast("timestamp"))


def hour_text(ts: Column) -> Column:
    """Hour of day as two-digit text ``"HH"``."""
    return F.date_format(ts, "HH")


def epoch_s(ts: Column) -> Column:
    """Epoch seconds, fraction dropped."""
    return F.unix_timestamp(ts)


def hour_start_s(ts: Column) -> Column:
    """Start of the hour, epoch seconds."""
    return F.unix_timestamp(F.date_trunc("hour", ts))


def day_start_s(ts: Column) -> Column:
    """T4: start of the day, epoch seconds."""
    return F.unix_timestamp(F.date_trunc("day", ts))


def minute_start_s(ts: Column) -> Column:
    """T5: start of the minute, epoch seconds."""
    return F.unix_timestamp(F.date_trunc("minute", ts))


def hour_label(ts: Column, cut_early_s: int = 0) -> Column:
    """Hour a row is counted in when the hourly cut fires ``cut_early_s``
    seconds before the full hour (H8).

    Rows in the last ``cut_early_s`` seconds of an hour move to the next
    hour, except across midnight: they stay in hour 23 of their own day.
    """
    if not cut_early_s:
        return F.hour(ts)
    shifted = ts + F.make_interval(secs=F.lit(cut_early_s))
    return F.when(F.to_date(shifted) > F.to_date(ts), F.lit(23)).otherwise(F.hour(shifted))


def with_time_keys(df: DataFrame, ts_col: str = "ts", cut_early_s: int = 0) -> DataFrame:
    """Add ``day`` (DATE) and ``hour`` (INT 0-23) from ``ts_col``."""
    ts = F.col(ts_col)
    return df.withColumn("day", F.to_date(ts)).withColumn("hour", hour_label(ts, cut_early_s))


def time_buckets(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """T1-T5 side by side for every row."""
    ts = F.col(ts_col)
    return df.select(
        "*",
        hour_text(ts).alias("hh"),
        epoch_s(ts).alias("epoch_s"),
        hour_start_s(ts).alias("hour_start_s"),
        day_start_s(ts).alias("day_start_s"),
        minute_start_s(ts).alias("minute_start_s"))
