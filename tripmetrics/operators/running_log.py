"""Running totals kept up to date (A10): late trips re-add only what they touch.

``running.running_totals`` reads every trip of a day.  Here three logs under one folder
hold what it would compute, each partitioned by ``(day, batch_id)``:

* ``facts``: the trips, sorted by time within files of disjoint times;
* ``firsts``: first trip of a terminal on a day, where a batch brings an earlier one;
* ``totals_<slice_s>``: what a batch adds to each time slice.  A first trip that moves
  takes its driver away from the slice that held it.

``append_trips`` reads the batch and the first trips of its days, never earlier trips.
``running_between`` reads the totals of the days asked for (a row per slice and batch)
and the trips of the slices asked for, whose bounds reach the row groups.

A batch that runs again replaces exactly its own partitions, with the same rows, as it
looks only at batches of smaller id.  So ids grow from batch to batch, and a
batch is complete before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmetrics.operators.daily import COUNTER_COLUMNS, trip_facts
from tripmetrics.operators.running import DEFAULT_SLICE_S
from tripmetrics.streaming.sinks import make_folder, overwrite_partitions

_FACTS = ("event_id long, line_no int, ts timestamp, terminal_id string, "
          + ", ".join(f"{c} long" for c in COUNTER_COLUMNS) + ", day date, batch_id long")
_FIRSTS = "terminal_id string, ts timestamp, event_id long, line_no int, old_ts timestamp, day date, batch_id long"
VALUES = ["n_trips", *COUNTER_COLUMNS, "drivers"]


def _totals_schema() -> str:
    return "slice long, " + ", ".join(f"{v} long" for v in VALUES) + ", day date, batch_id long"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    make_folder(spark, path)
    return spark.read.schema(schema).parquet(path)


def _slice(ts: str, slice_s: int) -> Column:
    return F.floor(F.unix_timestamp(ts) / slice_s)


def _first() -> Column:
    return F.min(F.struct("ts", "event_id", "line_no")).alias("f")


def append_trips(trips: DataFrame, root: str, batch_id: int, slice_s: int = DEFAULT_SLICE_S) -> None:
    """Add a batch of parsed trips, whatever their times, to the logs under ``root``."""
    spark = trips.sparkSession
    own_batch = F.lit(batch_id).cast("long")
    facts = trip_facts(trips).select(
        "event_id", "line_no", "ts", "terminal_id", *[F.col(c).cast("long").alias(c) for c in COUNTER_COLUMNS], "day",
        own_batch.alias("batch_id"))
    overwrite_partitions(facts.repartitionByRange("day", "ts").sortWithinPartitions("day", "ts"),
                         f"{root}/facts", ["day", "batch_id"])
    own = _read(spark, f"{root}/facts", _FACTS).where(F.col("batch_id") == own_batch)
    days = [r["day"] for r in own.select("day").distinct().collect()]  # bounded by the accepted time range

    old = (_read(spark, f"{root}/firsts", _FIRSTS).where(F.col("day").isin(days) & (F.col("batch_id") < own_batch))
           .groupBy("day", "terminal_id").agg(_first()).select("day", "terminal_id", F.col("f").alias("was")))
    new = own.groupBy("day", "terminal_id").agg(_first())
    # rows without a terminal have one first trip of a day together, as in the full run
    same = (new["day"] == old["day"]) & new["terminal_id"].eqNullSafe(old["terminal_id"])
    moved = new.join(old, same, "left").where("was IS NULL OR f < was").select(
        new["terminal_id"], "f.*", F.col("was.ts").alias("old_ts"), new["day"], own_batch.alias("batch_id"))
    overwrite_partitions(moved, f"{root}/firsts", ["day", "batch_id"])
    moved = _read(spark, f"{root}/firsts", _FIRSTS).where(F.col("batch_id") == own_batch)

    zeros = {v: F.lit(0).cast("long") for v in VALUES}

    def drivers(ts: str, sign: int) -> DataFrame:
        cols = {**zeros, "drivers": F.lit(sign).cast("long")}
        return moved.where(F.col(ts).isNotNull()).select(
            "day", _slice(ts, slice_s).alias("slice"), *[c.alias(v) for v, c in cols.items()])

    counters = own.select("day", _slice("ts", slice_s).alias("slice"), F.lit(1).cast("long").alias("n_trips"),
                          *COUNTER_COLUMNS, zeros["drivers"].alias("drivers"))
    parts = counters.unionByName(drivers("ts", 1)).unionByName(drivers("old_ts", -1))
    added = parts.groupBy("day", "slice").agg(*[F.sum(v).alias(v) for v in VALUES])
    overwrite_partitions(added.withColumn("batch_id", own_batch), f"{root}/totals_{slice_s}", ["day", "batch_id"])


def slice_totals(spark: SparkSession, root: str, slice_s: int = DEFAULT_SLICE_S) -> DataFrame:
    """``(day, slice, <values>)`` over all batches."""
    log = _read(spark, f"{root}/totals_{slice_s}", _totals_schema())
    return log.groupBy("day", "slice").agg(*[F.sum(v).alias(v) for v in VALUES])


def running_between(spark: SparkSession, root: str, since: str | None = None, until: str | None = None,
                    slice_s: int = DEFAULT_SLICE_S) -> DataFrame:
    """The rows of ``running_totals`` with ``since <= ts < until`` (timestamp text, session zone)."""
    facts, firsts = _read(spark, f"{root}/facts", _FACTS), _read(spark, f"{root}/firsts", _FIRSTS)
    totals = _read(spark, f"{root}/totals_{slice_s}", _totals_schema())
    wanted = F.lit(True)
    if since is not None:
        lo = F.lit(since).cast("timestamp")
        start = F.timestamp_seconds(_floor_s(lo, slice_s))  # from the start of the slice
        firsts, totals = firsts.where(F.col("day") >= F.to_date(start)), totals.where(F.col("day") >= F.to_date(start))
        facts = facts.where((F.col("day") >= F.to_date(start)) & (F.col("ts") >= start))
        wanted = wanted & (F.col("ts") >= lo)
    if until is not None:
        hi = F.lit(until).cast("timestamp")
        firsts, totals = firsts.where(F.col("day") <= F.to_date(hi)), totals.where(F.col("day") <= F.to_date(hi))
        facts = facts.where((F.col("day") <= F.to_date(hi)) & (F.col("ts") < hi))
        wanted = wanted & (F.col("ts") < hi)

    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    rows = facts.select("day", "ts", "event_id", "line_no", F.lit(1).alias("_kind"), one.alias("n_trips"), *COUNTER_COLUMNS, zero.alias("drivers"))
    first = firsts.groupBy("day", "terminal_id").agg(_first())
    markers = first.select("day", "f.ts", "f.event_id", "f.line_no", F.lit(0).alias("_kind"), zero.alias("n_trips"),
                           *[zero.alias(c) for c in COUNTER_COLUMNS], one.alias("drivers"))
    if since is not None:
        markers = markers.where(F.col("ts") >= start)
    if until is not None:
        markers = markers.where(F.col("ts") < hi)
    sliced = rows.unionByName(markers).withColumn("slice", _slice("ts", slice_s))
    inside = (Window.partitionBy("day", "slice").orderBy("ts", "event_id", "line_no", "_kind")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = sliced.select("day", "slice", "ts", "event_id", "line_no", "_kind", *[F.sum(v).over(inside).alias(v) for v in VALUES])
    before = Window.partitionBy("day").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    summed = totals.groupBy("day", "slice").agg(*[F.sum(v).alias(v) for v in VALUES])
    offsets = summed.select("day", "slice", *[F.coalesce(F.sum(v).over(before), zero).alias(f"_off_{v}") for v in VALUES])
    out = local.where((F.col("_kind") == 1) & wanted).join(offsets, ["day", "slice"])
    return out.select("event_id", "line_no", "ts", "day", *[(F.col(v) + F.col(f"_off_{v}")).alias(v) for v in VALUES])


def _floor_s(ts: Column, slice_s: int) -> Column:
    return F.floor(F.unix_timestamp(ts) / slice_s) * slice_s
