"""Structured Streaming counterparts of the batch rollups.

Each ``stream_*`` rollup takes a streaming DataFrame of raw messages
``(event_id, ts, value)`` -- from ``sources.messages.message_stream`` -- or
of parsed trips landed by ``stream_land`` (``landed_trips``), and returns a
*started* query writing a parquet table through a replay-safe
``foreachBatch`` sink, with its checkpoint under the shared checkpoint root.

* State is Spark's state store (per-key, on executors, checkpointed), not an
  external key-value server; updates are exact (no lost read-add-write).
* No rollup loses a row, however late it is or however a catch-up is cut into
  batches.  Day, hour and bucket rollups have few keys (bounded by the accepted
  time range), so their state needs no watermark.  First-seen drivers and last beats
  are minima and maxima: batches append to a log that readers reduce.
* With ``watermark`` given, state is evicted instead: a row whose window had closed before
  its batch started (judged by the previous batch's watermark) is dropped
  and counted in the query progress.  That is safe only where the source is read
  in about the order of time.  Sessions always need one; they read whole
  landing batches, so no file limit can cut a batch below the watermark.
* Exact distinct drivers come from the first-seen log (streaming
  ``count(DISTINCT)`` is not supported, and a per-day set would be one
  unbounded state row); a HyperLogLog++ estimate is optional.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripmetrics.functions.parse import parse_lines, parse_trips
from tripmetrics.functions.scoring import score_bucket, trip_score
from tripmetrics.operators.daily import COUNTER_COLUMNS, counter_aggs, trip_facts
from tripmetrics.operators.heartbeat import heartbeat_filter
from tripmetrics.operators.repair import REPAIRED_SCHEMA
from tripmetrics.schema import HEARTBEAT_TTL_MAIN_S, TRIGGER_INTERVAL, TRIP_COLUMNS, TRIP_FIELDS
from tripmetrics.session import checkpoint_root
from tripmetrics.sources.messages import split_payloads
from tripmetrics.functions.timecols import time_in_range
from tripmetrics.operators.serving import kv_from_first_hours, kv_from_hourly, kv_from_last_beats, kv_from_scores
from tripmetrics.streaming.sinks import Publisher, batch_log_writer, make_folder, overwrite_partitions, partition_writer

DEFAULT_WATERMARK = "1 hour"

# Landed table: envelope, the 17 trip fields, reject text, partition columns.
LANDED_SCHEMA = T.StructType(
    [T.StructField("event_id", T.LongType()), T.StructField("line_no", T.IntegerType()),
     T.StructField("ts", T.TimestampType())]
    + [T.StructField(n, t) for n, t in TRIP_FIELDS]
    + [T.StructField("line", T.StringType()), T.StructField("reject_reason", T.StringType()),
       T.StructField("kind", T.StringType()), T.StructField("day", T.DateType())])
MAX_FILES_PER_TRIGGER = 1000
FILES_PER_BATCH = 8


def _zone(df: DataFrame) -> str:
    return df.sparkSession.conf.get("spark.sql.session.timeZone")


def _local(df: DataFrame, ts: str | Column = "ts") -> Column:
    """Wall-clock time of the session zone as a timestamp whose UTC fields are
    the local ones: event-time windows are cut on UTC, so days and hours of
    the zone need it."""
    return F.from_utc_timestamp(ts, _zone(df))


def _window_day(start: str = "w.start") -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(start) / 86400).cast("int")).alias("day")


def _window_hour(start: str = "w.start") -> Column:
    return F.expr(f"CAST(pmod(unix_seconds({start}) div 3600, 24) AS INT)").alias("hour")


def _start(df: DataFrame, name: str, writer, output_mode: str, checkpoint: str | None,
           trigger: dict | None) -> StreamingQuery:
    spark = df.sparkSession
    ckpt = checkpoint or os.path.join(checkpoint_root(spark), "streams", name)
    w = (df.writeStream.queryName(name).outputMode(output_mode)
         .option("checkpointLocation", ckpt).foreachBatch(writer))
    w = w.trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL}))
    return w.start()


def as_trips(source: DataFrame) -> DataFrame:
    """Trips from a stream of raw messages (parsed here) or of already
    parsed trips (e.g. the table ``stream_land`` writes)."""
    return parse_trips(source) if "value" in source.columns else source


def _bounded(df: DataFrame, column: str, watermark: str | None) -> DataFrame:
    return df.withWatermark(column, watermark) if watermark else df


def _trips(source: DataFrame, watermark: str | None, cut_early_s: int = 0) -> DataFrame:
    trips = as_trips(source)
    return trip_facts(_bounded(trips.withColumn("_local", _local(trips)), "_local", watermark), cut_early_s)


def stream_daily(messages: DataFrame, path: str, *, watermark: str | None = None,
                 approx_drivers: bool = False, checkpoint: str | None = None,
                 trigger: dict | None = None) -> StreamingQuery:
    """A1, A3-A7 live: table ``(day, n_trips, <counters>)`` partitioned by
    ``day``; every batch rewrites only the days it touched.

    State is one row of counters per day.  Exact distinct drivers are
    *not* kept here -- a set of every terminal of the day would be one
    unbounded state row -- but in the first-seen log (``drivers_from_first_seen``).  ``approx_drivers`` adds a HyperLogLog++
    estimate (fixed-size state) as ``drivers_approx``.
    """
    trips = _trips(messages, watermark)
    extra = [F.approx_count_distinct("terminal_id").alias("drivers_approx")] if approx_drivers else []
    agg = trips.groupBy(F.window("_local", "1 day").alias("w")).agg(*counter_aggs(), *extra)
    out = agg.select(_window_day(), "n_trips", *COUNTER_COLUMNS,
                     *(["drivers_approx"] if approx_drivers else []))
    return _start(out, "daily_totals", partition_writer(path, ["day"]), "update", checkpoint, trigger)


def drivers_from_first_seen(first_seen: DataFrame) -> DataFrame:
    """Exact ``(day, drivers)`` from the first-seen table."""
    return first_seen.groupBy("day").agg(F.count(F.lit(1)).alias("drivers"))


def stream_hourly(messages: DataFrame, path: str, *, watermark: str | None = None,
                  cut_early_s: int = 0, checkpoint: str | None = None,
                  trigger: dict | None = None, publish: str | None = None) -> StreamingQuery:
    """H1 live: table ``(day, hour, n_trips, <counters>)`` partitioned by
    ``(day, hour)``.

    Rows are windowed on the time they are *counted* at: ``ts`` moved
    ``cut_early_s`` later, but never past the end of its own day (H8).
    """
    trips = as_trips(messages)
    ts = F.col("ts")
    moved = ts + F.make_interval(secs=F.lit(cut_early_s))
    last_hour = F.date_trunc("day", ts) + F.expr("INTERVAL 23 HOURS")
    label_ts = F.when(F.to_date(moved) > F.to_date(ts), last_hour).otherwise(moved) if cut_early_s else ts
    labelled = trip_facts(_bounded(trips.withColumn("_label_ts", _local(trips, label_ts)), "_label_ts", watermark))
    agg = labelled.groupBy(F.window("_label_ts", "1 hour").alias("w")).agg(*counter_aggs())
    out = agg.select(_window_day(), _window_hour(),
                     "n_trips", *COUNTER_COLUMNS)
    spark = messages.sparkSession

    def read(days: list) -> DataFrame:
        return spark.read.parquet(path).where(F.col("day").isin(days))

    own = Publisher(publish, "hourly", read, kv_from_hourly) if publish else None
    return _start(out, "hourly_totals", partition_writer(path, ["day", "hour"], publish=own), "update",
                  checkpoint, trigger)


def stream_first_seen(messages: DataFrame, path: str, *, watermark: str | None = None,
                      checkpoint: str | None = None, trigger: dict | None = None,
                      publish: str | None = None, cut_early_s: int = 0) -> StreamingQuery:
    """H2 live: log of ``(day, terminal_id, first_ts)`` -- each terminal's
    earliest trip per day by event time (not by arrival).  Each batch appends its
    own minima, without state.  With a watermark, state keyed by ``(day, terminal)`` keeps
    the log to keys whose minimum changed.  Read it with ``first_seen_table``."""
    trips = _trips(messages, watermark)
    key = [F.window("_local", "1 day").alias("w"), "terminal_id"]

    def earliest(rows: DataFrame) -> DataFrame:
        agg = rows.groupBy(*key).agg(F.min("ts").alias("first_ts"))
        return agg.select(_window_day(), "terminal_id", "first_ts")

    out = earliest(trips) if watermark else trips.select("_local", "terminal_id", "ts")
    spark = messages.sparkSession

    def read(days: list) -> DataFrame:
        return hourly_from_first_seen(first_seen_table(spark, path, days=days), cut_early_s)

    own = Publisher(publish, "drivers", read, kv_from_first_hours) if publish else None
    return _start(out, "first_seen", batch_log_writer(path, ["day"], own, None if watermark else earliest), "update",
                  checkpoint, trigger)


def first_seen_table(spark, path: str, compact_path: str | None = None, days: list | None = None) -> DataFrame:
    """``(day, terminal_id, first_ts)`` reduced from the first-seen log and,
    if given, its compacted table.  The reduction is a minimum, so log and
    compacted rows may overlap freely."""
    rows = spark.read.parquet(path).select("day", "terminal_id", "first_ts")
    if compact_path:
        rows = rows.unionByName(spark.read.parquet(compact_path).select("day", "terminal_id", "first_ts"))
    if days is not None:
        rows = rows.where(F.col("day").isin(days))
    return rows.groupBy("day", "terminal_id").agg(F.min("first_ts").alias("first_ts"))


def compact_first_seen(spark, path: str, compact_path: str, before_day: str) -> None:
    """Batch compaction: reduce every log row of days before ``before_day``
    (closed days) into ``compact_path``, one partition per day (replacing
    those days' partitions, so it can be re-run).  Log partitions of
    compacted days can then be dropped by retention."""
    closed = first_seen_table(spark, path).where(F.col("day") < F.lit(before_day).cast("date"))
    overwrite_partitions(closed, compact_path, ["day"])


def hourly_from_first_seen(first_seen: DataFrame, cut_early_s: int = 0) -> DataFrame:
    """``(day, hour, drivers)`` from the first-seen table."""
    from tripmetrics.functions.timecols import hour_label
    return (first_seen.withColumn("hour", hour_label(F.col("first_ts"), cut_early_s))
            .groupBy("day", "hour").agg(F.count(F.lit(1)).alias("drivers")))


def stream_score(messages: DataFrame, path: str, *, watermark: str | None = None,
                 checkpoint: str | None = None, trigger: dict | None = None,
                 publish: str | None = None) -> StreamingQuery:
    """A8 live: table ``(day, bucket, n_trips)`` partitioned by
    ``(day, bucket)``; shares follow from ``operators.scores.score_share``."""
    trips = _trips(messages, watermark).withColumn("bucket", score_bucket(trip_score()))
    agg = trips.groupBy(F.window("_local", "1 day").alias("w"), "bucket").agg(F.count(F.lit(1)).alias("n_trips"))
    out = agg.select(_window_day(), "bucket", "n_trips")
    spark = messages.sparkSession

    def read(days: list) -> DataFrame:
        return spark.read.parquet(path).where(F.col("day").isin(days))

    own = Publisher(publish, "score", read, kv_from_scores) if publish else None
    return _start(out, "score_distribution", partition_writer(path, ["day", "bucket"], publish=own), "update",
                  checkpoint, trigger)


def stream_heartbeat(messages: DataFrame, path: str, terminal_ids: list[str], *,
                     ttl_s: int = HEARTBEAT_TTL_MAIN_S, watermark: str = DEFAULT_WATERMARK,
                     checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """L2 live: liveness sessions per terminal via ``session_window(ts, ttl)``.

    ``messages``: raw messages (filtered here for ``terminal_ids``) or beats
    ``(event_id, ts, terminal_id)`` already landed by ``stream_land``.

    Table ``(terminal_id, session_start, session_end, beats)``: the key was
    alive over ``[session_start, session_end)`` where ``session_end`` = last
    beat + TTL (the expiry).  Gaps between consecutive sessions are outages;
    sessions are emitted once final (append mode, after the watermark).
    Sessions merge at a gap of exactly the TTL, as the key would survive.
    """
    source = messages
    beats = source if "value" not in source.columns else heartbeat_filter(source, terminal_ids)
    beats = beats.withWatermark("ts", watermark)
    sess = beats.groupBy("terminal_id", F.session_window("ts", f"{ttl_s} seconds").alias("s")).agg(
        F.count(F.lit(1)).alias("beats"))
    out = sess.select("terminal_id", F.col("s.start").alias("session_start"),
                      F.col("s.end").alias("session_end"), "beats",
                      F.to_date("s.start").alias("day"))
    # Final rows only ever get appended: the file sink's commit log makes
    # that exactly-once across restarts.
    return _append_files(out, "heartbeat_sessions", path, ["day"], checkpoint, trigger)


def stream_last_beat(source: DataFrame, path: str, terminal_ids: list[str] | DataFrame | None = None, *,
                     watermark: str | None = None, checkpoint: str | None = None,
                     trigger: dict | None = None, publish: str | None = None) -> StreamingQuery:
    """L1 live: log of ``(day, terminal_id, last_beat_s)``, written in the batch
    in which a beat arrives (no wait for the watermark), so an open session
    and a device that has gone silent both show.  Read it with
    ``last_beats``; ``heartbeat.liveness_now`` tells who is alive."""
    beats = source if "value" not in source.columns else heartbeat_filter(source, terminal_ids)
    beats = _bounded(beats.withColumn("_local", _local(beats)), "_local", watermark)
    key = [F.window("_local", "1 day").alias("w"), "terminal_id"]

    def latest(rows: DataFrame) -> DataFrame:
        agg = rows.groupBy(*key).agg(F.max(F.unix_timestamp("ts")).alias("last_beat_s"))
        return agg.select(_window_day(), "terminal_id", "last_beat_s")

    out = latest(beats) if watermark else beats.select("_local", "terminal_id", "ts")
    spark = source.sparkSession

    def read(days: list) -> DataFrame:
        return last_beats(spark, path, days)

    own = Publisher(publish, "monitor", read, kv_from_last_beats) if publish else None
    return _start(out, "last_beat", batch_log_writer(path, ["day"], own, None if watermark else latest), "update",
                  checkpoint, trigger)


def last_beats(spark, path: str, days: list | None = None) -> DataFrame:
    """``(day, terminal_id, last_beat_s)`` reduced from the last-beat log."""
    rows = spark.read.parquet(path)
    if days is not None:
        rows = rows.where(F.col("day").isin(days))
    return rows.groupBy("day", "terminal_id").agg(F.max("last_beat_s").alias("last_beat_s"))


def _append_files(df: DataFrame, name: str, path: str, partition_cols: list[str],
                  checkpoint: str | None, trigger: dict | None) -> StreamingQuery:
    spark = df.sparkSession
    ckpt = checkpoint or os.path.join(checkpoint_root(spark), "streams", name)
    refuse_lost_checkpoint(spark, path, ckpt)
    w = (df.writeStream.queryName(name).outputMode("append").format("parquet")
         .option("path", path).option("checkpointLocation", ckpt).partitionBy(*partition_cols))
    w = w.trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL}))
    return w.start()


def outages_from_sessions(sessions: DataFrame) -> DataFrame:
    """Outages ``(terminal_id, outage_start_s, outage_end_s, outage_s)`` from
    the sessions table: from a session's expiry to the next session's start."""
    from pyspark.sql import Window
    w = Window.partitionBy("terminal_id").orderBy("session_start")
    nxt = sessions.select("terminal_id", F.unix_timestamp("session_end").alias("outage_start_s"),
                          F.unix_timestamp(F.lead("session_start").over(w)).alias("outage_end_s"))
    return nxt.where(F.col("outage_end_s").isNotNull()).withColumn(
        "outage_s", F.col("outage_end_s") - F.col("outage_start_s"))


def stream_rejects(messages: DataFrame, path: str, *, checkpoint: str | None = None,
                   trigger: dict | None = None) -> StreamingQuery:
    """P2 live: quarantine table of malformed lines ``(event_id, line_no, ts,
    line, reject_reason, day)``; append-only, stateless."""
    parsed = parse_lines(split_payloads(messages))
    bad = parsed.where(F.col("reject_reason").isNotNull()).select(
        "event_id", "line_no", "ts", "line", "reject_reason", F.to_date("ts").alias("day"))
    return _append_files(bad, "trip_rejects", path, ["day"], checkpoint, trigger)


def _exists(spark, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def refuse_lost_checkpoint(spark, path: str, checkpoint: str) -> None:
    """A file sink numbers its batches by its checkpoint.  With output of an
    earlier run but no checkpoint, new batches would pass for old ones and be
    skipped, so that is an error."""
    if _exists(spark, os.path.join(path, "_spark_metadata")) and not _exists(spark, os.path.join(checkpoint, "offsets")):
        raise RuntimeError(f"{path} holds committed batches but its checkpoint {checkpoint} is gone; "
                           "restore the checkpoint or start with a new output folder")


def stream_land(messages: DataFrame, path: str, *, monitored: list[str] | DataFrame | None = None,
                checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Parse every message once and land the result in one table, partitioned
    by ``kind`` and ``day``: ``trip`` rows, ``reject`` rows and, with
    ``monitored`` ids, a ``beat`` row per message and id that its raw text
    names.

    Written by the file sink: readers see the files that its commit log lists,
    so a batch that is run again after a failure is counted once.  The rollups
    stream from this table instead of re-reading and re-parsing the source.
    A batch writes a few files per kind and day.
    """
    lines = "transform(split(value, '\\r\\n'), (l, i) -> named_struct('line_no', i, 'line', l, 'id', CAST(NULL AS STRING)))"
    rows = lines
    if monitored is not None:
        ids = """array_distinct(regexp_extract_all(value, '"terminalId":"([^"]*)"', 1))"""
        if isinstance(monitored, list):
            named = ", ".join("'" + i.replace("\\", "\\\\").replace("'", "\\'") + "'" for i in monitored)
            ids = f"array_intersect({ids}, array({named}))"
        beats = f"transform({ids}, t -> named_struct('line_no', CAST(NULL AS INT), 'line', CAST(NULL AS STRING), 'id', t))"
        rows = f"concat({lines}, {beats})"
    items = messages.selectExpr("event_id", "ts", f"explode({rows}) AS r").selectExpr(
        "event_id", "ts", "r.line_no", "r.line", "r.id AS _id").where("_id IS NOT NULL OR length(trim(line)) > 0")
    if isinstance(monitored, DataFrame):
        known = monitored.select(F.col("terminal_id").alias("_known")).distinct()
        items = items.join(known, F.col("_id") == F.col("_known"), "left").where(
            "_id IS NULL OR _known IS NOT NULL").drop("_known")
    items = items.where(F.col("_id").isNull() | time_in_range(F.col("ts")))
    parsed = parse_lines(items)
    landed = parsed.withColumns({
        "kind": F.expr("CASE WHEN _id IS NOT NULL THEN 'beat' WHEN reject_reason IS NULL THEN 'trip' ELSE 'reject' END"),
        "terminal_id": F.coalesce("_id", "terminal_id"),
        "day": F.to_date("ts"),
    }).withColumns({
        "line": F.expr("CASE WHEN kind = 'reject' THEN line END"),
        "reject_reason": F.expr("CASE WHEN kind = 'reject' THEN reject_reason END"),
    }).select(*[f.name for f in LANDED_SCHEMA.fields])
    dealt = landed.repartition(FILES_PER_BATCH, "kind", "day", F.expr("pmod(event_id, 4)"))
    return _append_files(dealt, "land", path, ["kind", "day"], checkpoint, trigger)


def _landed_stream(spark, path: str, kind: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("parquet").schema(LANDED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).where(F.col("kind") == kind)


def landed_trips(spark, path: str, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Streaming read of the trips that ``stream_land`` has committed."""
    return _landed_stream(spark, path, "trip", max_files_per_trigger).select(
        "event_id", "line_no", "ts", *TRIP_COLUMNS)


def repaired_trips(spark, path: str, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Streaming read of the repaired trips (``operators.repair``)."""
    return (spark.readStream.format("parquet").schema(REPAIRED_SCHEMA)
            .option("maxFilesPerTrigger", str(max_files_per_trigger)).load(path).select(
                "event_id", "line_no", "ts", *TRIP_COLUMNS))


def landed_beats(spark, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of the heartbeats that ``stream_land`` has committed.

    Without a limit a batch holds whole landing batches, as the sink's log lists their files
    at once; a query with a watermark (sessions) must read it so."""
    return _landed_stream(spark, path, "beat", max_files_per_trigger).select("event_id", "ts", "terminal_id")


def landed_table(spark, path: str, kind: str | None = None, days: list | None = None) -> DataFrame:
    """Batch read of the landed (or compacted) table; ``kind`` and ``days``
    prune partitions."""
    rows = spark.read.schema(LANDED_SCHEMA).parquet(path)
    if kind is not None:
        rows = rows.where(F.col("kind") == kind)
    if days is not None:
        rows = rows.where(F.col("day").isin(days))
    return rows


def compact_landed(spark, path: str, compact_path: str, before_day: str) -> None:
    """Rewrite the landed rows of the days before ``before_day`` (closed days)
    into few files, one folder per kind and day; each run replaces the
    folders of the days that it rewrites, and rewrites only days that the
    compacted table does not hold yet."""
    make_folder(spark, compact_path)
    held = spark.read.schema(LANDED_SCHEMA).parquet(compact_path).select("day").distinct()
    closed = landed_table(spark, path).where(F.col("day") < F.lit(before_day).cast("date"))
    fresh = closed.join(F.broadcast(held), "day", "left_anti").select(*[f.name for f in LANDED_SCHEMA.fields])
    overwrite_partitions(fresh.repartition("kind", "day", F.expr("pmod(xxhash64(event_id), 8)")), compact_path,
                         ["kind", "day"])
