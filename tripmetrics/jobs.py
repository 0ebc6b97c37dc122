"""Runnable jobs: the application-level entry points.

* ``live_job``       -- trip stream to today's counters, hourly curves, score
                        distribution and quarantine (the main live job).
* ``monitor_job``    -- heartbeat liveness of monitored terminals.
* ``widecol_scan``   -- count and projection of a wide-column cell table.
* ``serving_snapshot`` -- the key/field/value view over the landed trips.
* ``repair_rejects`` -- rejects of the live job that newer rules or corrected lines turn into trips.
* ``compact``        -- rewrite the closed days of the live job's logs.

The live job reads and parses the source once: a landing query writes parsed
trips, rejects and heartbeats, and the stateful queries stream from those.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmetrics.functions.variants import ParseRules
from tripmetrics.operators.daily import days_between
from tripmetrics.operators.repair import read_repaired, repair, with_repairs
from tripmetrics.operators.serving import serving_kv
from tripmetrics.schema import HEARTBEAT_TTL_MAIN_S, HEARTBEAT_TTL_MONITOR_S
from tripmetrics.session import checkpoint_root
from tripmetrics.sources.widecol import read_cells, widecol_count, widecol_project
from tripmetrics.streaming import streams


def _ckpt(spark: SparkSession, job: str, name: str) -> str:
    return os.path.join(checkpoint_root(spark), "jobs", job, name)


def live_job(spark: SparkSession, messages: DataFrame, out_root: str, *,
             monitored: list[str] | DataFrame | None = None, ttl_s: int = HEARTBEAT_TTL_MAIN_S,
             watermark: str = streams.DEFAULT_WATERMARK, cut_early_s: int = 0,
             max_files_per_trigger: int = streams.MAX_FILES_PER_TRIGGER, expiry: bool = False,
             trigger: dict | None = None, job: str = "live") -> dict[str, StreamingQuery]:
    """Start the live job on a streaming message source.

    Tables under ``out_root``: ``landed`` (trips, rejects and beats; the
    source is read and parsed once), ``hourly``, ``daily``, ``first_seen``,
    ``score`` and, with ``monitored`` terminal ids (a list or a table),
    ``last_beat`` and ``heartbeat`` sessions; ``serving`` holds the published
    key/field/value rows ``(day, part, key, field, value)`` of every day with
    trips, refreshed by the batch that changes a day, and ``serving_changes`` the feed of the keys
    that each batch changed.  Trips that ``repair_rejects`` adds to ``repaired`` reach all
    rollups with the next batch (checkpoints of rollups made before that table was a source
    do not fit; start those jobs with a new name and folder).  ``max_files_per_trigger`` bounds a rollup's batch and changes no
    result; ``watermark`` is that of the sessions.  ``expiry`` adds ``expired``: a row when
    a device falls silent (``streaming.expiry``; needs protobuf and pandas on the workers).  With an
    ``availableNow`` trigger the landing query finishes before the rollups
    start (catch-up run).
    """
    path = {n: os.path.join(out_root, n) for n in
            ["landed", "daily", "hourly", "first_seen", "score", "last_beat", "heartbeat", "serving",
                                                  "repaired"]}
    make = streams.make_folder
    make(spark, path["landed"])  # the readers below open both at once
    make(spark, path["repaired"])
    queries = {"land": streams.stream_land(messages, path["landed"], monitored=monitored,
                                           checkpoint=_ckpt(spark, job, "land"), trigger=trigger)}
    if trigger and trigger.get("availableNow"):
        queries["land"].awaitTermination()

    def options(name: str) -> dict:
        return {"checkpoint": _ckpt(spark, job, name), "trigger": trigger}

    if monitored is not None:
        def beats() -> DataFrame:
            return streams.landed_beats(spark, path["landed"])

        queries["heartbeat"] = streams.stream_heartbeat(beats(), path["heartbeat"], monitored, ttl_s=ttl_s,
                                                        watermark=watermark, **options("heartbeat"))
        queries["last_beat"] = streams.stream_last_beat(beats(), path["last_beat"], publish=path["serving"],
                                                        **options("last_beat"))

        if expiry:
            from tripmetrics.streaming.expiry import stream_expiry

            queries["expiry"] = stream_expiry(beats(), os.path.join(out_root, "expired"), ttl_s=ttl_s,
                                              watermark=watermark, **options("expiry"))

    def trips() -> DataFrame:
        return with_repairs(streams.landed_trips(spark, path["landed"], max_files_per_trigger),
                            streams.repaired_trips(spark, path["repaired"], max_files_per_trigger))

    queries["daily"] = streams.stream_daily(trips(), path["daily"], **options("daily"))
    queries["hourly"] = streams.stream_hourly(trips(), path["hourly"], cut_early_s=cut_early_s,
                                              publish=path["serving"], **options("hourly"))
    queries["first_seen"] = streams.stream_first_seen(trips(), path["first_seen"], cut_early_s=cut_early_s,
                                                      publish=path["serving"], **options("first_seen"))
    queries["score"] = streams.stream_score(trips(), path["score"], publish=path["serving"], **options("score"))
    return queries


def monitor_job(spark: SparkSession, messages: DataFrame, out_path: str, monitored: list[str], *,
                ttl_s: int = HEARTBEAT_TTL_MONITOR_S, watermark: str = streams.DEFAULT_WATERMARK,
                trigger: dict | None = None, job: str = "monitor") -> StreamingQuery:
    """Start the heartbeat monitor: liveness sessions of ``monitored``."""
    return streams.stream_heartbeat(messages, out_path, monitored, ttl_s=ttl_s, watermark=watermark,
                                    checkpoint=_ckpt(spark, job, "heartbeat"), trigger=trigger)


def widecol_scan(spark: SparkSession, cells_path: str, file_format: str = "parquet"
                 ) -> tuple[DataFrame, DataFrame]:
    """Row count and six-qualifier projection of a cell table."""
    cells = read_cells(spark, cells_path, file_format)
    return widecol_count(cells), widecol_project(cells)


def compact(spark: SparkSession, out_root: str, before_day: str) -> None:
    """Compact the closed days of the live job's logs: ``landed`` into
    ``landed_compact`` and ``first_seen`` into ``first_seen_compact``."""
    streams.compact_landed(spark, os.path.join(out_root, "landed"), os.path.join(out_root, "landed_compact"), before_day)
    streams.compact_first_seen(spark, os.path.join(out_root, "first_seen"),
                               os.path.join(out_root, "first_seen_compact"), before_day)


def repair_rejects(spark: SparkSession, out_root: str, rules: ParseRules = ParseRules(),
                   corrections: DataFrame | None = None, days: list | None = None) -> None:
    """Repair rejects that ``live_job`` landed: read again under ``rules``, or from ``corrections``
    ``(event_id, line_no, line[, ts])``.  ``days`` looks at the rejects of those days only."""
    path = os.path.join(out_root, "repaired")
    streams.make_folder(spark, path)
    repair(streams.landed_table(spark, os.path.join(out_root, "landed"), "reject", days), path, rules, corrections)


def serving_snapshot(spark: SparkSession, out_root: str, days: list | None = None) -> DataFrame:
    """Batch serving view over the table ``live_job`` landed: trips (repaired ones too), rejects
    (their times extend the calendar, so a day with only malformed messages
    still gets its zero rows) and heartbeats.  ``days`` reads those days only."""
    path = os.path.join(out_root, "landed")
    repairs = os.path.join(out_root, "repaired")
    streams.make_folder(spark, repairs)
    repaired = read_repaired(spark, repairs)
    trips = with_repairs(streams.landed_table(spark, path, "trip", days),
                         repaired if days is None else repaired.where(F.col("day").isin(days)))
    beats = streams.landed_table(spark, path, "beat", days)
    times = streams.landed_table(spark, path, days=days).where("kind != 'beat'").select("ts").union(trips.select("ts"))
    return serving_kv(trips, beats, days_between(times))
