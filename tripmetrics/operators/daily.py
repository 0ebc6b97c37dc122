"""Daily counters (A1-A7) and the day spine.

Every daily metric is one hash aggregate keyed by ``day``: map-side partial
aggregation collapses each input partition to one row per day before the
shuffle, so the exchange carries (days x partitions) rows whatever the input
size or key skew.  Distinct drivers add one exchange keyed by
``(day, terminal_id)`` -- again pre-aggregated, so a terminal holding a third
of all trips still sends one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.functions.timecols import time_in_range, with_time_keys

COUNTER_COLUMNS = ["mileage", "acce_times", "dece_times", "turn_times", "three_harsh", "over_3g"]


def trip_facts(trips: DataFrame, cut_early_s: int = 0) -> DataFrame:
    """Trips with ``day``, ``hour``, ``three_harsh`` and ``over_3g``.

    The explicit not-null filter on the keys makes every branch that reads
    these facts start from the same plan (joins on ``day``/``hour`` would
    otherwise add it to some branches only), so shared aggregates are
    computed once and their shuffle reused.
    """
    keyed = with_time_keys(trips, cut_early_s=cut_early_s)
    keyed = keyed.where(F.col("day").isNotNull() & F.col("hour").isNotNull())
    return keyed.withColumns({
        "three_harsh": F.expr("CAST(acce_times AS BIGINT) + dece_times + turn_times"),
        "over_3g": F.expr("CAST(acce_over_3g AS BIGINT) + dece_over_3g"),
    })


def counter_aggs() -> list[Column]:
    """Additive counters as exact BIGINT sums (no 32-bit overflow)."""
    return [F.count(F.lit(1)).alias("n_trips")] + \
        [F.sum(F.col(c).cast("long")).alias(c) for c in COUNTER_COLUMNS]


def drivers_agg(approx: bool = False) -> Column:
    """A2: distinct terminals; ``approx`` uses the HyperLogLog++ sketch."""
    if approx:
        return F.approx_count_distinct("terminal_id").alias("drivers")
    return F.count_distinct("terminal_id").alias("drivers")


def daily_totals(trips: DataFrame) -> DataFrame:
    """``(day, n_trips, mileage, acce_times, dece_times,
    turn_times, three_harsh, over_3g)`` for every day with trips."""
    return trip_facts(trips).groupBy("day").agg(*counter_aggs())


def daily_drivers(trips: DataFrame, approx: bool = False) -> DataFrame:
    """A2: ``(day, drivers)`` -- distinct terminals per day."""
    return with_time_keys(trips).groupBy("day").agg(drivers_agg(approx))


def day_range(agg: DataFrame, guard_col: str, day_col: str = "day") -> DataFrame:
    """Every calendar day between the first and last day of the aggregated
    table ``agg``.

    One global min/max (partial aggregates, one row out) exploded into a
    sequence: rows = days in range, independent of data volume.  The bounds
    read ``guard_col`` (a count computed by ``agg``); a min/max of the
    grouping key alone would let the optimizer drop ``agg`` and recompute the
    bounds from the raw input -- a second parse of every message -- instead
    of reusing ``agg``'s shuffle.
    """
    day = F.when(F.col(guard_col) >= 0, F.col(day_col))
    bounds = agg.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))


def days_between(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Every calendar day from the first to the last timestamp of ``df``.

    Pass the *message* frame: the bounds then come from the envelope times
    alone (a one-column scan, no JSON parse), and a day on which only
    malformed messages arrived still gets its zero row.  Times outside the
    accepted range (such messages are rejects) do not stretch the calendar, so
    it never has more days than that range.
    """
    bounds = df.where(time_in_range(F.col(ts_col))).agg(
        F.to_date(F.min(ts_col)).alias("lo"), F.to_date(F.max(ts_col)).alias("hi"))
    return bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))


def daily_spine(trips: DataFrame, approx: bool = False, days: DataFrame | None = None) -> DataFrame:
    """All counters and drivers for every day in range, 0 on empty days.

    ``days``: the calendar (e.g. ``days_between(messages)``); by default the
    days between the first and last day with trips.
    """
    facts = trip_facts(trips)
    per_day = facts.groupBy("day").agg(*counter_aggs(), drivers_agg(approx))
    metrics = ["n_trips", *COUNTER_COLUMNS, "drivers"]
    days = days if days is not None else day_range(per_day, "n_trips")
    return (days.join(per_day, "day", "left")
            .select("day", *[F.coalesce(F.col(m), F.lit(0).cast("long")).alias(m) for m in metrics]))
