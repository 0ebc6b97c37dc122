"""Time-ordered lookups without a window per device over raw rows.

Rows are cut into time slices of ``slice_s`` seconds.  Order matters only
inside a ``(device, slice)`` group; what goes from slice to slice is one
aggregated row per group, so a device that holds a third of all rows is spread
over as many tasks as it has slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmetrics.schema import HEARTBEAT_TTL_MAIN_S

SLICE_S = 3600


def _slice(slice_s: int) -> Column:
    return F.floor(F.unix_micros("ts") / F.lit(slice_s * 1_000_000)).alias("slice")


def as_of_join(left: DataFrame, beats: DataFrame, slice_s: int = SLICE_S) -> DataFrame:
    """Every row of ``left(terminal_id, ts, ..)`` with ``last_beat``: the time of the
    last of ``beats(terminal_id, ts)`` at or before it, null if there is none.

    Within a slice, beats and rows are read in the order of time; before the slice's
    first beat the last beat of any earlier slice counts (a running maximum over one
    row per device and slice).  A row without terminal or time finds no beat."""
    rows = left.withColumn("slice", _slice(slice_s))
    own = beats.where("terminal_id IS NOT NULL AND ts IS NOT NULL").select("terminal_id", "ts", _slice(slice_s))
    per_slice = own.groupBy("terminal_id", "slice").agg(F.max("ts").alias("last"))
    asked = rows.groupBy("terminal_id", "slice").agg(F.lit(None).cast("timestamp").alias("last"))
    grid = asked.unionByName(per_slice).groupBy("terminal_id", "slice").agg(F.max("last").alias("last"))
    before = Window.partitionBy("terminal_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = grid.select("terminal_id", "slice", F.max("last").over(before).alias("carried"))
    tagged = rows.select("terminal_id", "slice", "ts", F.struct(*left.columns).alias("row"), F.lit(None).cast("timestamp").alias("beat"))
    marks = own.select("terminal_id", "slice", "ts", F.lit(None).cast(tagged.schema["row"].dataType).alias("row"), F.col("ts").alias("beat"))
    # at one time beats come first
    so_far = Window.partitionBy("terminal_id", "slice").orderBy("ts", F.col("beat").isNull()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    met = tagged.unionByName(marks).withColumn("near", F.max("beat").over(so_far)).where("row IS NOT NULL")
    out = met.join(carried, ["terminal_id", "slice"], "left")
    return out.select("row.*", F.coalesce("near", "carried").alias("last_beat"))


def trip_liveness(trips: DataFrame, beats: DataFrame, ttl_s: int = HEARTBEAT_TTL_MAIN_S, slice_s: int = SLICE_S) -> DataFrame:
    """L2 for every trip: ``trips`` with ``last_beat`` and ``alive`` (the liveness key of its
    device was there: the last beat is less than the TTL old)."""
    found = as_of_join(trips, beats, slice_s)
    age = F.unix_micros("ts") - F.unix_micros("last_beat")
    return found.withColumn("alive", F.coalesce(age < ttl_s * 1_000_000, F.lit(False)))


def reading_deltas(readings: DataFrame, slice_s: int = SLICE_S) -> DataFrame:
    """H4 for irregular cumulative readings ``(event_id, terminal_id, ts, reading)``: each
    reading with ``delta``, the growth since the device's reading before it (in the order of
    time, then id), and ``reset``.  A smaller reading than the one before is a counter that began
    again, so all of it is growth; a device's first reading grows by 0, as what it
    stood at before is unknown.  Hours without a reading need no boundary row: their
    growth comes with the next reading.  Null readings are left out."""
    rows = readings.where("reading IS NOT NULL AND terminal_id IS NOT NULL AND ts IS NOT NULL").withColumn("slice", _slice(slice_s))
    at = F.struct("ts", "event_id", "reading")
    edges = rows.groupBy("terminal_id", "slice").agg(F.max(at).alias("last"))
    before = Window.partitionBy("terminal_id").orderBy("slice")
    carried = edges.select("terminal_id", "slice", F.lag("last.reading").over(before).alias("carried"))
    inside = Window.partitionBy("terminal_id", "slice").orderBy("ts", "event_id")
    own = rows.withColumn("previous", F.lag("reading").over(inside)).join(carried, ["terminal_id", "slice"])
    was = F.coalesce("previous", "carried")
    return own.withColumns({
        "reset": F.coalesce(F.col("reading") < was, F.lit(False)),
        "delta": F.when(F.col("reading") < was, F.col("reading")).otherwise(F.coalesce(F.col("reading") - was, F.lit(0))),
    }).drop("previous", "carried", "slice")


def hourly_reading_deltas(readings: DataFrame, slice_s: int = SLICE_S) -> DataFrame:
    """``(day, hour, n_readings, resets, delta)`` over all devices, by the hour of the later reading."""
    return reading_deltas(readings, slice_s).groupBy(F.to_date("ts").alias("day"), F.hour("ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n_readings"), F.sum(F.col("reset").cast("long")).alias("resets"),
        F.sum(F.col("delta").cast("long")).alias("delta"))
