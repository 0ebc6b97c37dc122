"""Running counters as trips arrive (A10).

A running sum over a whole day cannot be a window partitioned by ``day``:
that puts a day -- or a hot terminal -- into one task.  Instead the rows are
cut into time slices.  The slice is computed from the row's own time, so it is
data: no result depends on how an exchange is planned or reused.  Each
slice computes its local running sums, and a small table of per-slice totals
supplies the offset of every slice:

    running(row) = sum of earlier slices of the same day + local running(row)

The slice-totals table has at most (days x slices of a day) rows, and a task
holds the rows of whole slices: choose ``slice_s`` so that one fits a task.

First trips, totals and local sums each read the trips.  Their facts are therefore
stored once below the checkpoint folder, so that messages are parsed once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmetrics.operators.daily import COUNTER_COLUMNS, trip_facts
from tripmetrics.session import checkpoint_root

_SLICE = "_slice"
DEFAULT_SLICE_S = 60


def prefix_sums(df: DataFrame, partition_cols: list[str], time_col: str, order_cols: list[str],
                value_cols: list[str], slice_s: int = DEFAULT_SLICE_S) -> DataFrame:
    """Running sums of ``value_cols`` within ``partition_cols`` in the order of
    ``time_col`` and ``order_cols`` (inclusive of the current row).

    ``time_col`` and ``order_cols`` must make rows unique within a partition.
    Rows are read twice: shuffled by partition and slice for the local sums, and
    summed up before the shuffle for the totals.
    """
    sliced = df.withColumn(_SLICE, F.floor(F.unix_timestamp(time_col) / slice_s))
    local_w = (Window.partitionBy(*partition_cols, _SLICE).orderBy(time_col, *order_cols)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = sliced.select("*", *[F.sum(F.col(v).cast("long")).over(local_w).alias(f"_run_{v}") for v in value_cols])
    totals = sliced.groupBy(*partition_cols, _SLICE).agg(
        *[F.sum(F.col(v).cast("long")).alias(f"_tot_{v}") for v in value_cols])
    before_w = (Window.partitionBy(*partition_cols).orderBy(_SLICE)
                .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*partition_cols, _SLICE, *[
        F.coalesce(F.sum(f"_tot_{v}").over(before_w), F.lit(0).cast("long")).alias(f"_off_{v}")
        for v in value_cols])
    out = local.join(offsets, [*partition_cols, _SLICE], "left")
    keep = [c for c in df.columns if c not in value_cols]
    return out.select(*keep, *[(F.col(f"_run_{v}") + F.col(f"_off_{v}")).alias(v) for v in value_cols])


def running_totals(trips: DataFrame, slice_s: int = DEFAULT_SLICE_S) -> DataFrame:
    """A10: every counter of the day as it stood right after each trip.

    Output ``(event_id, line_no, ts, day, n_trips, mileage, drivers,
    acce_times, dece_times, turn_times, three_harsh, over_3g)`` in BIGINT.
    Trips are ordered by ``(ts, event_id, line_no)``.  Running drivers count
    a terminal at its first trip of the day: a marker row per
    ``(day, terminal)`` (from a pre-aggregated min) sorts just before that
    trip, so no join against the trips is needed.
    """
    spark = trips.sparkSession
    path = f"{checkpoint_root(spark)}/running_facts/{uuid.uuid4().hex}"
    trip_facts(trips).select("day", "ts", "event_id", "line_no", "terminal_id", *COUNTER_COLUMNS).write.parquet(path)
    facts = spark.read.parquet(path)
    values = ["n_trips", *COUNTER_COLUMNS, "drivers"]
    base = facts.select(
        "day", "ts", "event_id", "line_no", F.lit(1).alias("_kind"),
        F.lit(1).cast("long").alias("n_trips"),
        *[F.col(c).cast("long").alias(c) for c in COUNTER_COLUMNS],
        F.lit(0).cast("long").alias("drivers"))
    firsts = facts.groupBy("day", "terminal_id").agg(
        F.min(F.struct("ts", "event_id", "line_no")).alias("f"))
    markers = firsts.select(
        "day", F.col("f.ts").alias("ts"), F.col("f.event_id").alias("event_id"),
        F.col("f.line_no").alias("line_no"), F.lit(0).alias("_kind"),
        *[F.lit(0).cast("long").alias(c) for c in ["n_trips", *COUNTER_COLUMNS]],
        F.lit(1).cast("long").alias("drivers"))
    summed = prefix_sums(base.unionByName(markers), ["day"], "ts", ["event_id", "line_no", "_kind"],
                         values, slice_s)
    return summed.where(F.col("_kind") == 1).select("event_id", "line_no", "ts", "day", *values)
