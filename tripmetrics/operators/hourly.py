"""Hourly curves (H1-H9).

The original job derived each hourly value as "cumulative now minus the
cumulative stored at the previous hour".  For additive counters that equals
a plain ``GROUP BY day, hour`` -- no stored snapshot, no ordering, one
pre-aggregated shuffle.  Hourly *drivers* are the exception: the delta of a
cumulative distinct count is the number of terminals first seen that day in
that hour (H2), computed from each terminal's first trip of the day.

Only the dense (day x 24) tables use windows, and those run on at most 24
aggregated rows per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmetrics.functions.timecols import hour_label
from tripmetrics.operators.daily import COUNTER_COLUMNS, counter_aggs, day_range, trip_facts
from tripmetrics.schema import HOURLY_COLUMNS

SPINE_COLUMNS = [*HOURLY_COLUMNS, "three_harsh"]


def hourly_totals(trips: DataFrame, cut_early_s: int = 0) -> DataFrame:
    """H1/H9: counters per ``(day, hour)`` with trips; ``cut_early_s`` = H8."""
    return trip_facts(trips, cut_early_s).groupBy("day", "hour").agg(*counter_aggs())


def first_seen(trips: DataFrame) -> DataFrame:
    """``(day, terminal_id, first_ts)``: each terminal's first trip of each day."""
    return (trips.withColumn("day", F.to_date("ts"))
            .groupBy("day", "terminal_id").agg(F.min("ts").alias("first_ts")))


def hourly_new_drivers(trips: DataFrame, cut_early_s: int = 0) -> DataFrame:
    """H2: ``(day, hour, drivers)`` = terminals whose first trip of the day
    falls in that hour.  Summed over a day it equals the daily distinct count."""
    firsts = first_seen(trips)
    return (firsts.withColumn("hour", hour_label(F.col("first_ts"), cut_early_s))
            .groupBy("day", "hour").agg(F.count(F.lit(1)).alias("drivers")))


def day_hour_grid(days: DataFrame) -> DataFrame:
    """Dense ``(day, hour)`` grid, 24 rows per day."""
    return days.select("day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))


def hourly_with_drivers(trips: DataFrame, cut_early_s: int = 0, extra_aggs=(), extra_cols=()) -> DataFrame:
    """Hourly counters and first-seen drivers in one pass: ``(day, hour,
    n_trips, <counters>, drivers, *extra_cols)``.

    Grouping sets ``(day, hour)`` and ``(day, terminal)`` share one
    pre-aggregated shuffle and one parse.  A terminal's group keeps its least
    hour, in which it counts as a driver; the closing aggregate reads one row
    per hour and per terminal of a day.
    """
    sums = ["n_trips", *COUNTER_COLUMNS, *extra_cols]
    facts = trip_facts(trips, cut_early_s).withColumn("_hour", F.col("hour"))
    both = facts.groupingSets([["day", "hour"], ["day", "terminal_id"]], "day", "hour", "terminal_id").agg(
        *counter_aggs(), *extra_aggs, F.min("_hour").alias("_first"), F.grouping("hour").alias("_terminal"))
    is_hour = F.col("_terminal") == 0
    return (both.withColumn("hour", F.when(is_hour, F.col("hour")).otherwise(F.col("_first")))
            .groupBy("day", "hour").agg(
                *[F.sum(F.when(is_hour, F.col(c)).otherwise(F.lit(0).cast("long"))).alias(c) for c in sums],
                F.sum(F.col("_terminal").cast("long")).alias("drivers")))


def hourly_spine(trips: DataFrame, cut_early_s: int = 0, days: DataFrame | None = None) -> DataFrame:
    """H7: the six hourly series (and three-harsh) on a dense 24-hour grid
    for every day in range; empty hours are 0 (not stale values).
    ``days``: the calendar, see ``daily.daily_spine``."""
    return spine_from_hourly(hourly_with_drivers(trips, cut_early_s), days)


def spine_from_hourly(hourly: DataFrame, days: DataFrame | None = None, extra_cols=()) -> DataFrame:
    """Dense (day x 24) grid left-joined to an hourly table, 0 where empty."""
    grid = day_hour_grid(days if days is not None else day_range(hourly, "n_trips"))
    joined = grid.join(hourly, ["day", "hour"], "left")
    return joined.select("day", "hour", *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
                                          for c in [*SPINE_COLUMNS, *extra_cols]])


def hourly_cumulative(trips: DataFrame, cut_early_s: int = 0, days: DataFrame | None = None) -> DataFrame:
    """H3: cumulative value of each series at the end of every hour
    (what the ``BS_BY_HOUR`` snapshot holds after that hour's cut)."""
    spine = hourly_spine(trips, cut_early_s, days)
    w = Window.partitionBy("day").orderBy("hour").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return spine.select("day", "hour", *[F.sum(c).over(w).alias(c) for c in SPINE_COLUMNS])


def hourly_delta(cumulative: DataFrame) -> DataFrame:
    """H4: hourly values from cumulative readings, ``x - lag(x)`` within a day."""
    w = Window.partitionBy("day").orderBy("hour")
    cols = [c for c in cumulative.columns if c not in ("day", "hour")]
    return cumulative.select("day", "hour", *[
        (F.col(c) - F.coalesce(F.lag(c).over(w), F.lit(0))).alias(c) for c in cols])


def hourly_long(hourly: DataFrame, value_name: str = "delta") -> DataFrame:
    """Long form ``(day, hour, metric, <value_name>)`` of a wide hourly table."""
    cols = [c for c in hourly.columns if c not in ("day", "hour")]
    return hourly.unpivot(["day", "hour"], cols, "metric", value_name)


def hourly_changed(trips: DataFrame, cut_early_s: int = 0, days: DataFrame | None = None) -> DataFrame:
    """H5/P5: only the (day, hour, metric) deltas that are non-zero -- the
    writes the "emit only if changed" variant performs.  The spine already
    holds the deltas of the cumulative curve."""
    return hourly_long(hourly_spine(trips, cut_early_s, days).select("day", "hour", *HOURLY_COLUMNS)).where(
        F.col("delta") != 0)


def hourly_skip23(trips: DataFrame, cut_early_s: int = 0, days: DataFrame | None = None) -> DataFrame:
    """Every hourly value except hour 23 (the older variant)."""
    return hourly_spine(trips, cut_early_s, days).where(F.col("hour") != 23)


__all__ = ["hourly_totals", "hourly_new_drivers", "hourly_spine", "hourly_cumulative", "hourly_delta",
           "hourly_changed", "hourly_skip23", "hourly_long", "first_seen", "day_hour_grid",
           "COUNTER_COLUMNS"]
