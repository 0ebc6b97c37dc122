"""At-least-once sources (S1): a producer that retries sends the same payload
again, as a record with a new offset and a new time.

A message is a repeat if an equal payload came at most ``within_s`` seconds before
it.  A repeat counts as a payload seen, so a chain of retries stays one message; an equal
payload after a longer pause is a message of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WITHIN_S = 600


def first_copies(messages: DataFrame, within_s: int = WITHIN_S) -> DataFrame:
    """``messages(event_id, ts, value)`` without repeats.

    Times are cut into slices of ``within_s``: of equal payloads in a slice only the
    first (by time, then id) can be new, and it is new if the last one of the slices before is
    farther away.  So a payload that is sent again and again is reduced before the
    shuffle to one row per slice and task, and no window orders raw messages.
    Null payloads hold no trip and are left out."""
    width = within_s * 1_000_000
    us = F.unix_micros("ts")
    rows = messages.where("value IS NOT NULL").select(
        F.sha2("value", 256).alias("digest"), F.floor(us / F.lit(width)).alias("slice"), us.alias("us"),
        F.struct("ts", "event_id", "value").alias("m"))
    per_slice = rows.groupBy("digest", "slice").agg(F.min("m").alias("m"), F.min("us").alias("first"), F.max("us").alias("last"))
    before = F.lag("last").over(Window.partitionBy("digest").orderBy("slice"))
    return per_slice.withColumn("before", before).where(f"before IS NULL OR first - before > {width}").select(
        "m.event_id", "m.ts", "m.value")


def stream_first_copies(messages: DataFrame, within: str = f"{WITHIN_S} seconds") -> DataFrame:
    """The stream without repeats that arrive within ``within`` of the first copy.

    The state holds the digests of that time and no payloads.  It is bounded by the
    time of arrival (the batch's time, which a batch that is run again keeps), not by the messages'
    own time: a catch-up or a late message is never dropped as too old."""
    seen = messages.withColumns({"_digest": F.sha2("value", 256), "_seen": F.current_timestamp()})
    once = seen.withWatermark("_seen", within).dropDuplicatesWithinWatermark(["_digest"])
    return once.select(*messages.columns)
