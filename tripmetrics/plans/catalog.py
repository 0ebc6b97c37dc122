"""Named queries: each takes ``(spark, data_dir)`` and returns a DataFrame.

Inputs are the ``events`` table of the data folder, turned by Spark into
trip messages (see ``sources.fixtures``) and parsed from JSON text, so every
query exercises the full path message -> lines -> typed trips -> rollup.
Days are presented as ``yyyy-MM-dd`` text and times as epoch seconds.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmetrics.functions.parse import land_lines, parse_lines, parse_trips, read_lines, rejected_trips
from tripmetrics.functions.timecols import epoch_s, time_buckets
from tripmetrics.functions.variants import ParseRules, raw_lines, variant_trips
from tripmetrics.operators import (
    asof, audience, daily, dedup, heartbeat, hourly, repair, running, running_log, scores, serving)
from tripmetrics.schema import HOUR_CUT_EARLY_S, HOURLY_COLUMNS, TRIP_COLUMNS
from tripmetrics.session import checkpoint_root
from tripmetrics.sources.fixtures import (
    counter_readings, drifted_messages, retried_messages, trip_messages, trip_payloads, versioned_cells, widecol_cells)
from tripmetrics.sources.messages import split_payloads
from tripmetrics.sources.tables import read_events
from tripmetrics.sources.widecol import key_range, read_cells, widecol_count, widecol_project, write_sorted

# Terminal whose messages act as heartbeats in the fixture data.
HEARTBEAT_TERMINAL = "7"
MONITORED_TERMINALS = ["7", "8", "11"]
# Row keys of the range scan: from 10 January, 06:00, up to 13 January.
RANGE_START, RANGE_STOP = "202401100600", "20240113"

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, d: str) -> DataFrame:
    return read_events(spark, d, ["event_id", "ts", "user_id", "value", "props"])


def _messages(spark: SparkSession, d: str, dirty: bool = False) -> DataFrame:
    return trip_messages(_events(spark, d), dirty=dirty)


def _trips(spark: SparkSession, d: str) -> DataFrame:
    return parse_trips(_messages(spark, d))


def _trips_and_days(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Trips plus the calendar of days between the first and last message."""
    messages = _messages(spark, d)
    return parse_trips(messages), daily.days_between(messages)


def _beats(spark: SparkSession, d: str) -> DataFrame:
    return heartbeat.heartbeat_filter(_messages(spark, d), [HEARTBEAT_TERMINAL])


def _day_text(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def q_payload_lines(spark, d):
    lines = parse_lines(split_payloads(trip_payloads(_events(spark, d))))
    return (lines.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "terminal_id")
            .agg(F.count_distinct("event_id").alias("n_payloads"),
                 F.count(F.lit(1)).alias("n_lines"),
                 F.sum(F.col("mileage").cast("long")).alias("mileage")))


def q_trip_parse(spark, d):
    return _trips(spark, d).select("event_id", "line_no", *TRIP_COLUMNS)


def q_heartbeat_filter(spark, d):
    return _beats(spark, d).select("event_id", "terminal_id", epoch_s(F.col("ts")).alias("epoch_s"))


def q_over_3g_counts(spark, d):
    return _trips(spark, d).select(
        "event_id", "acce_over_3g", "dece_over_3g",
        (F.col("acce_over_3g") + F.col("dece_over_3g")).alias("over_3g"))


def q_time_buckets(spark, d):
    return time_buckets(_trips(spark, d).select("event_id", "ts")).drop("ts")


def q_daily_totals(spark, d):
    return _day_text(daily.daily_totals(_trips(spark, d)))


def q_daily_drivers(spark, d):
    return _day_text(daily.daily_drivers(_trips(spark, d)))


def q_daily_spine(spark, d):
    trips, days = _trips_and_days(spark, d)
    return _day_text(daily.daily_spine(trips, days=days))


def q_running_totals(spark, d):
    return _day_text(running.running_totals(_trips(spark, d))).drop("line_no", "ts")


def q_trip_score(spark, d):
    return scores.trip_scores(_trips(spark, d)).select("event_id", "trip_score_raw", "trip_score", "bucket")


def q_score_distribution(spark, d):
    trips, days = _trips_and_days(spark, d)
    return _day_text(scores.score_distribution(trips, days)).select(
        "day", "bucket", "label", "score_range", "n_trips")


def q_subscore_distribution(spark, d):
    trips, days = _trips_and_days(spark, d)
    return _day_text(scores.subscore_distribution(trips, days))


def q_score_share(spark, d):
    trips, days = _trips_and_days(spark, d)
    dist = scores.score_distribution(trips, days)
    return _day_text(scores.score_share(dist))


def q_hourly_totals(spark, d):
    return _day_text(hourly.hourly_totals(_trips(spark, d)))


def q_hourly_new_drivers(spark, d):
    return _day_text(hourly.hourly_new_drivers(_trips(spark, d)))


def q_hourly_cumulative(spark, d):
    trips, days = _trips_and_days(spark, d)
    return _day_text(hourly.hourly_cumulative(trips, days=days))


def q_hourly_delta(spark, d):
    trips, days = _trips_and_days(spark, d)
    return _day_text(hourly.hourly_delta(hourly.hourly_cumulative(trips, days=days)))


def q_hourly_changed(spark, d):
    trips, days = _trips_and_days(spark, d)
    return _day_text(hourly.hourly_changed(trips, days=days))


def q_hourly_skip23(spark, d):
    trips, days = _trips_and_days(spark, d)
    return _day_text(hourly.hourly_skip23(trips, days=days))


def q_hourly_spine(spark, d):
    trips, days = _trips_and_days(spark, d)
    return _day_text(hourly.hourly_spine(trips, days=days))


def q_hourly_cut_early(spark, d):
    return _day_text(hourly.hourly_totals(_trips(spark, d), cut_early_s=HOUR_CUT_EARLY_S))


def q_heartbeat_last(spark, d):
    return _day_text(heartbeat.heartbeat_last(_beats(spark, d)))


def q_heartbeat_outages(spark, d):
    return heartbeat.heartbeat_outages(_beats(spark, d))


def q_heartbeat_status(spark, d):
    return _day_text(heartbeat.heartbeat_status(_beats(spark, d)))


def _cells(spark, d):
    return widecol_cells(read_events(spark, d, ["ts", "user_id", "event_type", "value"]))


def q_widecol_count(spark, d):
    return widecol_count(_cells(spark, d))


def q_widecol_project(spark, d):
    return widecol_project(_cells(spark, d))


def q_widecol_versions(spark, d):
    cells = versioned_cells(read_events(spark, d, ["ts"]))
    return widecol_project(cells, qualifiers=["totalNum", "weakNum"])


def q_heartbeat_multi(spark, d):
    payloads = trip_payloads(_events(spark, d), by_terminal=False)
    beats = heartbeat.heartbeat_filter(payloads, MONITORED_TERMINALS)
    return beats.select("event_id", "terminal_id", epoch_s(F.col("ts")).alias("epoch_s"))


def q_serving_kv(spark, d):
    messages = _messages(spark, d)
    beats = heartbeat.heartbeat_filter(messages, [HEARTBEAT_TERMINAL])
    days = daily.days_between(messages)
    return _day_text(serving.serving_kv(parse_trips(messages), beats, days))


def q_trip_rejects(spark, d):
    rej = rejected_trips(_messages(spark, d, dirty=True))
    return rej.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rejects"))


def q_payload_dedup(spark, d):
    trips = parse_trips(dedup.first_copies(retried_messages(_messages(spark, d))))
    return _day_text(daily.daily_totals(trips)).select("day", "n_trips", "mileage", "over_3g")


def q_trip_liveness(spark, d):
    messages = _messages(spark, d)
    beats = heartbeat.heartbeat_filter(messages.where("event_id % 3 = 0"), MONITORED_TERMINALS)
    trips = parse_trips(messages).select("event_id", "terminal_id", "ts")
    return asof.trip_liveness(trips, beats).select(
        "event_id", "terminal_id", epoch_s(F.col("last_beat")).alias("last_beat_s"), "alive")


def q_reading_delta(spark, d):
    readings = counter_readings(read_events(spark, d, ["event_id", "ts", "user_id"]))
    return _day_text(asof.hourly_reading_deltas(readings))


def q_widecol_range(spark, d):
    path = f"{checkpoint_root(spark)}/widecol/{uuid.uuid4().hex}"
    write_sorted(_cells(spark, d).withColumn("version", F.lit(1).cast("long")), path)
    return widecol_project(key_range(read_cells(spark, path), RANGE_START, RANGE_STOP))


def q_heartbeat_runs(spark, d):
    return heartbeat.heartbeat_runs(heartbeat.heartbeat_filter(_messages(spark, d), MONITORED_TERMINALS))


def q_drivers_trailing_week(spark, d):
    trips, days = _trips_and_days(spark, d)
    root = f"{checkpoint_root(spark)}/audience/{uuid.uuid4().hex}"
    seen = trips.select("terminal_id", "ts")
    audience.terminal_numbers(seen).write.parquet(f"{root}/numbers")
    audience.day_bitmaps(seen, spark.read.parquet(f"{root}/numbers")).write.parquet(f"{root}/bitmaps")
    ranges = audience.trailing_days(days, 7)
    return _day_text(audience.range_drivers(spark.read.parquet(f"{root}/bitmaps"), ranges))


def q_running_incremental(spark, d):
    """Every trip is appended: most at once, then a batch of trips that come late."""
    trips = _trips(spark, d)
    root = f"{checkpoint_root(spark)}/running/{uuid.uuid4().hex}"
    late = F.expr("CAST(terminal_id AS BIGINT) % 2 = 1 AND event_id % 5 = 0")
    for batch_id, part in enumerate((trips.where(~late), trips.where(late))):
        running_log.append_trips(part, root, batch_id)
    return _day_text(running_log.running_between(spark, root)).drop("line_no", "ts")


# Rules that know the mileage's second name and the firmware's build number.
DRIFT_RULES = ParseRules(2, {"mileage": ("mileageKm",)}, {"firmware_build": ("$.firmware.build", "string")})


def q_trip_variant(spark, d):
    """Messages of mixed firmware, landed as variants before the rules that read them."""
    path = f"{checkpoint_root(spark)}/raw/{uuid.uuid4().hex}"
    raw_lines(drifted_messages(_events(spark, d))).write.parquet(path)
    return variant_trips(spark.read.parquet(path), DRIFT_RULES).select(
        "event_id", "line_no", *TRIP_COLUMNS, *DRIFT_RULES.extra)


def q_trip_repair(spark, d):
    """Damaged messages, their rejects repaired from corrected lines, in two runs that overlap."""
    root = f"{checkpoint_root(spark)}/repaired/{uuid.uuid4().hex}"
    path = f"{root}/repaired"
    spark.createDataFrame([], repair.REPAIRED_SCHEMA).write.parquet(path)
    land_lines(_messages(spark, d, dirty=True), f"{root}/lines")
    dirty = read_lines(spark, f"{root}/lines")
    corrected = split_payloads(_messages(spark, d)).select("event_id", "line_no", "line")
    for part in (corrected.where("event_id % 2 = 0"), corrected):
        repair.repair(rejected_trips(dirty.where("rejected")), path, ParseRules(), part)
    return repair.with_repairs(parse_trips(dirty.where("not rejected")), repair.read_repaired(spark, path)).drop("ts")


QUERIES: dict[str, Query] = {
    "payload_lines": q_payload_lines,
    "trip_parse": q_trip_parse,
    "heartbeat_filter": q_heartbeat_filter,
    "over_3g_counts": q_over_3g_counts,
    "time_buckets": q_time_buckets,
    "daily_totals": q_daily_totals,
    "daily_drivers": q_daily_drivers,
    "daily_spine": q_daily_spine,
    "running_totals": q_running_totals,
    "trip_score": q_trip_score,
    "score_distribution": q_score_distribution,
    "subscore_distribution": q_subscore_distribution,
    "score_share": q_score_share,
    "hourly_totals": q_hourly_totals,
    "hourly_new_drivers": q_hourly_new_drivers,
    "hourly_cumulative": q_hourly_cumulative,
    "hourly_delta": q_hourly_delta,
    "hourly_changed": q_hourly_changed,
    "hourly_skip23": q_hourly_skip23,
    "hourly_spine": q_hourly_spine,
    "hourly_cut_early": q_hourly_cut_early,
    "heartbeat_last": q_heartbeat_last,
    "heartbeat_outages": q_heartbeat_outages,
    "heartbeat_status": q_heartbeat_status,
    "widecol_count": q_widecol_count,
    "widecol_project": q_widecol_project,
    "widecol_versions": q_widecol_versions,
    "heartbeat_multi": q_heartbeat_multi,
    "serving_kv": q_serving_kv,
    "trip_rejects": q_trip_rejects,
    "payload_dedup": q_payload_dedup,
    "trip_liveness": q_trip_liveness,
    "reading_delta": q_reading_delta,
    "widecol_range": q_widecol_range,
    "heartbeat_runs": q_heartbeat_runs,
    "drivers_trailing_week": q_drivers_trailing_week,
    "running_incremental": q_running_incremental,
    "trip_variant": q_trip_variant,
    "trip_repair": q_trip_repair,
}

__all__ = ["QUERIES", "HEARTBEAT_TERMINAL", "HOURLY_COLUMNS"]
