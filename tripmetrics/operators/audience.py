"""Distinct drivers of any range of days from stored partial results.

Distinct counts do not add up, so the drivers of a week cannot come from daily
counts.  Two mergeable forms are kept instead, and neither needs the raw rows again:

* exact: a bitmap of driver numbers per day (``day_bitmaps``), joined by OR.  Numbers
  come from a dictionary ``(terminal_id, number)`` that only ever grows
  (``terminal_numbers``), so bitmaps written earlier stay valid.  A bitmap row holds
  32,768 numbers in 4 KB, whatever the number of trips.
* approximate: a HyperLogLog sketch per hour (``hour_sketches``), joined by union;
  ``lg_k`` = 14 gives a standard error of about 0.8 %.

Trips are reduced to distinct ``(day, terminal_id)`` before anything is joined, so a
terminal with a third of all trips moves one row per day and map task.  A null
terminal is no driver.  Ranges that hold no trips count 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmetrics.functions.timecols import with_time_keys

#: groups in which new terminals are numbered; each is one sort, of distinct terminals only
NUMBER_GROUPS = 4096


def terminal_numbers(terminals: DataFrame, known: DataFrame | None = None, groups: int = NUMBER_GROUPS) -> DataFrame:
    """The dictionary ``(terminal_id, number)``: the rows of ``known`` as they are, and a
    number (from 1, nearly dense) for every other terminal of ``terminals``.

    Numbers of group g are g + 1, g + 1 + groups, ...; terminals of a group are numbered in
    their order after those already known.  ``groups`` must not change between calls."""
    new = terminals.where(F.col("terminal_id").isNotNull()).select("terminal_id").distinct()
    if known is not None:
        new = new.join(known, "terminal_id", "left_anti")
    grouped = new.withColumn("g", F.pmod(F.xxhash64("terminal_id"), F.lit(groups)))
    row = (F.row_number().over(Window.partitionBy("g").orderBy("terminal_id")) - 1).cast("long")
    if known is None:
        return grouped.select("terminal_id", (row * groups + F.col("g") + 1).alias("number"))
    used = known.groupBy(F.pmod(F.col("number") - 1, F.lit(groups)).alias("g")).agg(
        (F.max(F.expr(f"(number - 1) div {groups}")) + 1).alias("used"))
    placed = grouped.withColumn("row", row).join(used, "g", "left")
    numbers = (F.col("row") + F.coalesce("used", F.lit(0))) * groups + F.col("g") + 1
    return known.select("terminal_id", "number").unionByName(placed.select("terminal_id", numbers.alias("number")))


def day_bitmaps(trips: DataFrame, numbers: DataFrame) -> DataFrame:
    """``(day, part, bits)``: the numbers of a day's drivers, 32,768 to a bitmap."""
    seen = with_time_keys(trips).select("day", "terminal_id").distinct().join(numbers, "terminal_id")
    return seen.groupBy("day", F.bitmap_bucket_number("number").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def hour_sketches(trips: DataFrame, lg_k: int = 14) -> DataFrame:
    """``(day, hour, sketch)``: a HyperLogLog sketch of an hour's drivers."""
    return with_time_keys(trips).groupBy("day", "hour").agg(F.hll_sketch_agg("terminal_id", lg_k).alias("sketch"))


def trailing_days(days: DataFrame, n: int) -> DataFrame:
    """For each day of ``days(day)`` the range of ``n`` days that ends with it."""
    return days.select("day", F.date_sub("day", n - 1).alias("lo"), F.col("day").alias("hi"))


def _met(ranges: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows of ``table(day, ..)`` by range: an equality join on the days of the ranges."""
    each = ranges.select(F.col(key).alias("_key"), F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("_day"))
    return each.join(table, F.col("_day") == F.col("day")).drop("_day", "day")


def _of_all(ranges: DataFrame, counted: DataFrame, key: str, name: str) -> DataFrame:
    return ranges.select(key).join(counted, F.col(key) == F.col("_key"), "left").select(
        key, F.coalesce(name, F.lit(0).cast("long")).alias(name))


def range_drivers(bitmaps: DataFrame, ranges: DataFrame, key: str = "day") -> DataFrame:
    """Exact ``(key, drivers)`` for each row of ``ranges(key, lo, hi)``, both days included.
    ``key`` must tell the ranges apart."""
    joined = _met(ranges, bitmaps, key).groupBy("_key", "part").agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = joined.groupBy("_key").agg(F.sum(F.bitmap_count("bits")).alias("drivers"))
    return _of_all(ranges, counted, key, "drivers")


def range_drivers_approx(sketches: DataFrame, ranges: DataFrame, key: str = "day") -> DataFrame:
    """Estimated ``(key, drivers_approx)`` for each row of ``ranges(key, lo, hi)``."""
    merged = _met(ranges, sketches, key).groupBy("_key").agg(F.hll_union_agg("sketch").alias("sketch"))
    counted = merged.select("_key", F.hll_sketch_estimate("sketch").alias("drivers_approx"))
    return _of_all(ranges, counted, key, "drivers_approx")
