"""Trip-score distribution and shares.

Per-trip work (score, bucket, per-bucket sub-score counts) is column
arithmetic; the only shuffle is the ``(day, bucket)`` hash aggregate.  The
five-bucket spine and the share window run on the aggregated table
(5 rows per day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmetrics.functions.scoring import (bucket_bounds, bucket_label, score_bucket, share_basis_points_sql,
                                           share_text_sql, subscore_bucket, trip_score, weighted_score)
from tripmetrics.functions.timecols import with_time_keys
from tripmetrics.operators.daily import day_range
from tripmetrics.schema import BUCKET_LABELS, SUBSCORE_COLUMNS

N_BUCKETS = len(BUCKET_LABELS)


def trip_scores(trips: DataFrame) -> DataFrame:
    """``trip_score_raw`` (DOUBLE), ``trip_score`` (INT) and ``bucket``."""
    return trips.withColumns({
        "trip_score_raw": weighted_score(),
        "trip_score": trip_score(),
    }).withColumn("bucket", score_bucket(F.col("trip_score")))


def _bucket_grid(days: DataFrame) -> DataFrame:
    return days.select("day", F.explode(F.sequence(F.lit(0), F.lit(N_BUCKETS - 1))).alias("bucket"))


def _bounds_columns():
    bounds = bucket_bounds()
    lo = F.element_at(F.array(*[F.lit(b[1]).cast("int") for b in bounds]), F.col("bucket") + 1)
    hi = F.element_at(F.array(*[F.lit(b[2]).cast("int") for b in bounds]), F.col("bucket") + 1)

    def text(b_lo, b_hi):
        if b_lo is None:
            return f"<={b_hi}"
        return f">={b_lo}" if b_hi is None else f"{b_lo}-{b_hi}"
    rng = F.element_at(F.array(*[F.lit(text(b[1], b[2])) for b in bounds]), F.col("bucket") + 1)
    return lo, hi, rng


def score_distribution(trips: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """``(day, bucket, label, n_trips)`` for all 5 buckets of every day
    in range (0 where empty), plus the bucket's true score bounds
    ``score_lo``/``score_hi`` (NULL = open) and as text ``score_range``.
    ``days``: the calendar, see ``daily.daily_spine``."""
    per = (with_time_keys(trip_scores(trips)).groupBy("day", "bucket")
           .agg(F.count(F.lit(1)).alias("n_trips")))
    lo, hi, rng = _bounds_columns()
    days = days if days is not None else day_range(per, "n_trips")
    return (_bucket_grid(days).join(per, ["day", "bucket"], "left")
            .select("day", "bucket", bucket_label(F.col("bucket")).alias("label"),
                    lo.alias("score_lo"), hi.alias("score_hi"), rng.alias("score_range"),
                    F.coalesce("n_trips", F.lit(0).cast("long")).alias("n_trips")))


def subscore_distribution(trips: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """older rule, one count per sub-score (10 per trip):
    ``(day, bucket, label, n_scores)``.

    Each trip contributes five per-bucket counts as columns, so rows are not
    multiplied by ten before the shuffle; the five sums are unpivoted after.
    """
    keyed = with_time_keys(trips)
    per_bucket = []
    for b in range(N_BUCKETS):
        hits = None
        for c in SUBSCORE_COLUMNS:
            term = F.when(subscore_bucket(F.col(c)) == b, 1).otherwise(0)
            hits = term if hits is None else hits + term
        per_bucket.append(F.sum(hits.cast("long")).alias(f"b{b}"))
    per = keyed.groupBy("day").agg(*per_bucket)
    long = per.unpivot(["day"], [f"b{b}" for b in range(N_BUCKETS)], "bcol", "n_scores") \
        .withColumn("bucket", F.substring("bcol", 2, 1).cast("int"))
    days = days if days is not None else day_range(per, "b0")
    return (_bucket_grid(days).join(long, ["day", "bucket"], "left")
            .select("day", "bucket", bucket_label(F.col("bucket")).alias("label"),
                    F.coalesce("n_scores", F.lit(0).cast("long")).alias("n_scores")))


def score_share(distribution: DataFrame, count_col: str = "n_trips") -> DataFrame:
    """Share of each bucket in its day: ``share`` (DOUBLE),
    ``share_bp`` (basis points, half up) and ``share_text`` (``"0.0313"``).
    Shares are NULL on a day without trips."""
    w = Window.partitionBy("day")
    total = F.sum(count_col).over(w)
    with_total = distribution.withColumn("day_total", total)
    bp = share_basis_points_sql(f"`{count_col}`", "day_total")
    return with_total.select(
        "day", "bucket", "label", count_col,
        F.when(F.col("day_total") > 0, F.col(count_col) / F.col("day_total")).alias("share"),
        F.expr(bp).alias("share_bp"),
        F.expr(share_text_sql(bp)).alias("share_text"))
