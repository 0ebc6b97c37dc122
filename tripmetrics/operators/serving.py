"""Serving view (S6): every published metric as ``(day, key, field, value)``.

Dashboards read key/field/value triples (the original job kept them in a
key-value store).  This builds the same triples per day from the rollups:
daily scalar keys (field ``""``), hourly hashes (field ``"00"``-``"23"``,
dense, 0 for quiet hours), the ``BS_BY_HOUR`` snapshot (cumulative at the
day's last cut = day total), score counts and shares (field = bucket label)
and the monitor key (field = terminal, latest heartbeat, epoch s).  Values are text.

Daily values are summed from the dense hourly table (hourly new drivers add
up to the daily distinct count).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.operators.heartbeat import heartbeat_last
from tripmetrics.functions.scoring import score_bucket, share_basis_points_sql, share_text_sql, trip_score
from tripmetrics.operators.hourly import SPINE_COLUMNS, day_hour_grid, hourly_with_drivers, spine_from_hourly
from tripmetrics.operators.scores import N_BUCKETS
from tripmetrics.schema import (BUCKET_LABELS, DAILY_KEYS, HOURLY_METRICS, KEY_BY_HOUR, KEY_MONITOR,
                                KEY_SCORE_COUNT, KEY_SCORE_SHARE)

_EMPTY_SHARE = "0.0"


def kv_from_spine(spine: DataFrame, columns: list[str], buckets: list[str] = ()) -> DataFrame:
    """Triples of the metrics ``columns`` (and score ``buckets``) of a spine
    ``(day, hour, ..)``: hourly values on every row; day totals, the snapshot
    and scores on hour 0.  The spine may hold a part of the metrics only."""
    # Built as SQL text: one call into the JVM for ~40 triples.
    wide = spine.selectExpr("day", "hour", *columns,
                            *[f"sum({c}) OVER (PARTITION BY day) AS d_{c}" for c in [*columns, *buckets]])
    total = " + ".join(f"d_{b}" for b in buckets)

    def triple(key: str, field: str, value: str, daily_only: bool) -> str:
        keep = "hour = 0" if daily_only else "true"
        return (f"named_struct('key', '{key}', 'field', {field}, "
                f"'value', CAST({value} AS STRING), 'keep', {keep})")

    hh = "lpad(CAST(hour AS STRING), 2, '0')"
    hourly = [m for m in HOURLY_METRICS if m[0] in columns]
    items = [triple(key, hh, col, False) for col, key, _ in hourly]
    items += [triple(key, "''", f"d_{col}", True) for col, key in DAILY_KEYS if col in columns]
    items += [triple(KEY_BY_HOUR, f"'{snap}'", f"d_{col}", True) for col, _, snap in hourly]
    for i, b in enumerate(buckets):
        label = f"'{BUCKET_LABELS[i]}'"
        share = (f"coalesce({share_text_sql(share_basis_points_sql(f'd_{b}', total))}, "
                 f"'{_EMPTY_SHARE}')")
        items += [triple(KEY_SCORE_COUNT, label, f"d_{b}", True),
                  triple(KEY_SCORE_SHARE, label, share, True)]
    return (wide.selectExpr("day", f"explode(filter(array({', '.join(items)}), t -> t.keep)) AS t")
            .selectExpr("day", "t.key AS key", "t.field AS field", "t.value AS value"))


def _dense(hourly: DataFrame, columns: list[str]) -> DataFrame:
    grid = day_hour_grid(hourly.select("day").distinct())
    return grid.join(hourly, ["day", "hour"], "left").select(
        "day", "hour", *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in columns])


def kv_from_hourly(hourly: DataFrame) -> DataFrame:
    """Triples of the counters of an hourly table (zero hours filled in)."""
    columns = [c for c in SPINE_COLUMNS if c != "drivers"]
    return kv_from_spine(_dense(hourly, columns), columns)


def kv_from_first_hours(first_hours: DataFrame) -> DataFrame:
    """Driver triples from ``(day, hour, drivers)`` of first-seen drivers."""
    return kv_from_spine(_dense(first_hours, ["drivers"]), ["drivers"])


def kv_from_scores(counts: DataFrame) -> DataFrame:
    """Score counts (empty buckets are 0) and shares from ``(day, bucket, n_trips)``."""
    buckets = [f"n_b{i}" for i in range(N_BUCKETS)]
    days = counts.groupBy("day").agg(*[
        F.sum(F.when(F.col("bucket") == i, F.col("n_trips")).otherwise(F.lit(0).cast("long"))).alias(b)
        for i, b in enumerate(buckets)])
    return kv_from_spine(days.withColumn("hour", F.lit(0)), [], buckets)


def kv_from_last_beats(last: DataFrame) -> DataFrame:
    """Monitor triples from ``(day, terminal_id, last_beat_s)``."""
    return last.select("day", F.lit(KEY_MONITOR).alias("key"), F.col("terminal_id").alias("field"),
                       F.col("last_beat_s").cast("string").alias("value"))


def serving_kv(trips: DataFrame, beats: DataFrame | None = None, days: DataFrame | None = None) -> DataFrame:
    """Long ``(day, key, field, value)`` table of all published metrics.

    One linear plan: an hourly rollup carrying the counters *and* the
    five score-bucket counts (every message parsed once), the dense hourly
    spine, day totals as a window over the day's 24 spine rows, then a single
    explode that emits the hourly triples on every row and the daily, snapshot
    and score triples on hour 0.  (Branching the spine into separate daily and
    score tables would let column pruning give every branch its own rollup,
    i.e. parse the messages once per branch.)
    """
    buckets = [f"n_b{i}" for i in range(N_BUCKETS)]
    scored = trips.withColumn("_bucket", score_bucket(trip_score()))
    hourly = hourly_with_drivers(scored, extra_aggs=[
        F.sum(F.when(F.col("_bucket") == i, 1).otherwise(0).cast("long")).alias(b)
        for i, b in enumerate(buckets)], extra_cols=buckets)
    spine = spine_from_hourly(hourly, days, buckets)

    out = kv_from_spine(spine, SPINE_COLUMNS, buckets)
    if beats is None:
        return out
    return out.unionByName(kv_from_last_beats(heartbeat_last(beats)))
