"""Device heartbeat and liveness.

A heartbeat is any raw message whose text contains
``"terminalId":"<id>"`` -- looked for in the undecoded payload, as the
monitor does it, so it also sees messages that fail to parse.  Times outside
the accepted range are no beats, which bounds the hourly grid.

Liveness never orders the raw beats of a device in one task.  Beats are
first rolled up by time bucket (partial aggregation, skew-proof); windows
then run on the rolled-up rows, whose number per device is bounded by the
time span (span / bucket width), not by the data volume:

* outages (L2): bucket width = TTL.  Two beats in one bucket are less than a
  TTL apart, so a gap longer than the TTL can only separate the last beat of
  a bucket from the first beat of the next non-empty bucket.
* status grid (L3): bucket = hour; the latest beat at an hour's end is a
  running max over the hourly maxima.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmetrics.functions.timecols import epoch_s, time_in_range
from tripmetrics.schema import HEARTBEAT_TTL_MAIN_S


def heartbeat_filter(messages: DataFrame, terminal_ids: list[str] | DataFrame) -> DataFrame:
    """``(event_id, ts, terminal_id)``, one row per message and monitored
    id whose marker its text holds (a payload may hold several devices).

    ``terminal_ids``: a list, or a table ``(terminal_id)`` of any size.  All
    ids are read from the text at once, so the work per message does not grow
    with the number of monitored devices.
    """
    if isinstance(terminal_ids, list) and not terminal_ids:
        raise ValueError("heartbeat_filter needs at least one terminal id")
    found = messages.where(time_in_range(F.col("ts")) & F.col("value").contains('"terminalId":"')).select(
        "event_id", "ts",
        F.explode(F.array_distinct(F.expr(r"""regexp_extract_all(value, '"terminalId":"([^"]*)"', 1)"""))).alias("terminal_id"))
    if isinstance(terminal_ids, list):
        return found.where(F.col("terminal_id").isin(terminal_ids))
    return found.join(terminal_ids.select("terminal_id").distinct(), "terminal_id", "left_semi").select(
        "event_id", "ts", "terminal_id")


def heartbeat_last(beats: DataFrame) -> DataFrame:
    """L1: ``(terminal_id, day, last_beat_s)`` -- latest beat per day, epoch s."""
    return (beats.groupBy("terminal_id", F.to_date("ts").alias("day"))
            .agg(F.max(epoch_s(F.col("ts"))).alias("last_beat_s")))


def heartbeat_outages(beats: DataFrame, ttl_s: int = HEARTBEAT_TTL_MAIN_S) -> DataFrame:
    """L2: closed outages ``(terminal_id, outage_start_s, outage_end_s,
    outage_s)``: the key expired at ``last beat + ttl`` and came back at the
    next beat.  A gap of exactly ``ttl`` is no outage."""
    sec = beats.select("terminal_id", epoch_s(F.col("ts")).alias("s"))
    per_bucket = sec.groupBy("terminal_id", F.floor(F.col("s") / ttl_s).alias("bucket")).agg(
        F.min("s").alias("first_s"), F.max("s").alias("last_s"))
    w = Window.partitionBy("terminal_id").orderBy("bucket")
    nxt = per_bucket.select("terminal_id", "last_s", F.lead("first_s").over(w).alias("next_s"))
    gaps = nxt.where(F.col("next_s") - F.col("last_s") > ttl_s)
    return gaps.select(
        "terminal_id",
        (F.col("last_s") + ttl_s).alias("outage_start_s"),
        F.col("next_s").alias("outage_end_s"),
        (F.col("next_s") - F.col("last_s") - ttl_s).alias("outage_s"))


def heartbeat_runs(beats: DataFrame, ttl_s: int = HEARTBEAT_TTL_MAIN_S) -> DataFrame:
    """L3: the times a device was alive, ``(terminal_id, first_beat_s, last_beat_s,
    expired_s)``: beats at most a TTL apart are one run, and the key expires a TTL after
    the last of them.  Runs are cut on buckets of a TTL's width, as outages are."""
    sec = beats.select("terminal_id", epoch_s(F.col("ts")).alias("s")).where(F.col("s").isNotNull())
    per_bucket = sec.groupBy("terminal_id", F.floor(F.col("s") / ttl_s).alias("bucket")).agg(
        F.min("s").alias("first_s"), F.max("s").alias("last_s"))
    w = Window.partitionBy("terminal_id").orderBy("bucket")
    begins = F.coalesce(F.col("first_s") - F.lag("last_s").over(w) > ttl_s, F.lit(True))
    numbered = per_bucket.withColumn("_new", begins.cast("int")).withColumn("_run", F.sum("_new").over(w))
    runs = numbered.groupBy("terminal_id", "_run").agg(
        F.min("first_s").alias("first_beat_s"), F.max("last_s").alias("last_beat_s"))
    return runs.select("terminal_id", "first_beat_s", "last_beat_s", (F.col("last_beat_s") + ttl_s).alias("expired_s"))


def heartbeat_status(beats: DataFrame, ttl_s: int = HEARTBEAT_TTL_MAIN_S) -> DataFrame:
    """L3: is the liveness key alive at the end of each hour?

    Grid per device: every hour from its first beat to the hour in which its
    last beat's TTL runs out (afterwards the key stays expired).  Output
    ``(terminal_id, day, hour, as_of_s, last_beat_s, alive)``: ``as_of_s`` is
    the hour's last second, ``last_beat_s`` the latest beat at or before it,
    and ``alive`` means ``as_of_s < last_beat_s + ttl``.
    """
    hour = F.date_trunc("hour", F.col("ts"))
    per_hour = beats.groupBy("terminal_id", hour.alias("h")).agg(F.max(epoch_s(F.col("ts"))).alias("hour_max"))
    expiry = F.date_trunc("hour", F.timestamp_seconds(F.max("hour_max") + ttl_s))
    span = per_hour.groupBy("terminal_id").agg(F.min("h").alias("h_start"), expiry.alias("h_end"))
    grid = span.select("terminal_id", F.explode(F.sequence("h_start", "h_end", F.expr("INTERVAL 1 HOUR"))).alias("h"))
    w = Window.partitionBy("terminal_id").orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = grid.join(per_hour, ["terminal_id", "h"], "left").select(
        "terminal_id", "h", F.max("hour_max").over(w).alias("last_beat_s"))
    as_of = F.unix_timestamp("h") + 3599
    return filled.select(
        "terminal_id", F.to_date("h").alias("day"), F.hour("h").alias("hour"),
        as_of.alias("as_of_s"), "last_beat_s",
        (as_of < F.col("last_beat_s") + ttl_s).alias("alive"))


def liveness_now(last: DataFrame, as_of_s: int, ttl_s: int = HEARTBEAT_TTL_MAIN_S) -> DataFrame:
    """L1/L3 at one moment: ``last(terminal_id, .., last_beat_s)`` (any number of
    rows per terminal) -> ``(terminal_id, last_beat_s, as_of_s, alive)``."""
    latest = last.groupBy("terminal_id").agg(F.max("last_beat_s").alias("last_beat_s"))
    as_of = F.lit(as_of_s).cast("long")
    return latest.select("terminal_id", "last_beat_s", as_of.alias("as_of_s"),
                         (as_of < F.col("last_beat_s") + ttl_s).alias("alive"))
