"""Trip score, score buckets and share text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmetrics.schema import (BUCKET_LABELS, SCORE_BUCKET_UPPER, SCORE_DIVISOR, SCORE_WEIGHTS,
                                SUBSCORE_BUCKET_LOWER, SUBSCORE_COLUMNS, SUBSCORE_TOP_INCLUSIVE)


def weighted_score() -> Column:
    """weighted mean of the ten sub-scores (DOUBLE), summed as BIGINT."""
    total = None
    for w, c in zip(SCORE_WEIGHTS, SUBSCORE_COLUMNS):
        term = F.col(c).cast("long") * F.lit(w)
        total = term if total is None else total + term
    return total / F.lit(SCORE_DIVISOR)


def trip_score() -> Column:
    """integer trip score, fraction truncated."""
    return weighted_score().cast("int")


def score_bucket(score: Column) -> Column:
    """bucket 0-4 of an integer trip score."""
    expr = F.lit(len(SCORE_BUCKET_UPPER))
    for i, upper in reversed(list(enumerate(SCORE_BUCKET_UPPER))):
        expr = F.when(score <= F.lit(upper), F.lit(i)).otherwise(expr)
    return expr


def subscore_bucket(score: Column) -> Column:
    """bucket 0-4 of one sub-score: <60, [60,70), [70,80), [80,90], >90."""
    lo1, lo2, lo3 = SUBSCORE_BUCKET_LOWER
    return (F.when(score < lo1, 0).when(score < lo2, 1).when(score < lo3, 2)
            .when(score <= SUBSCORE_TOP_INCLUSIVE, 3).otherwise(4))


def bucket_label(bucket: Column) -> Column:
    """F8: dashboard label of a bucket number."""
    return F.element_at(F.array(*[F.lit(x) for x in BUCKET_LABELS]), bucket + 1)


def bucket_bounds() -> list[tuple[int, int | None, int | None]]:
    """True inclusive score bounds of the F6 buckets: (bucket, lo, hi)."""
    out, lo = [], None
    for i, hi in enumerate(SCORE_BUCKET_UPPER):
        out.append((i, lo, hi))
        lo = hi + 1
    out.append((len(SCORE_BUCKET_UPPER), lo, None))
    return out


def share_basis_points_sql(n: str, total: str) -> str:
    """n/total in basis points, rounded half up, exact integer arithmetic;
    NULL when ``total`` is 0.  SQL text over column names / expressions."""
    return (f"CAST(CASE WHEN CAST({total} AS BIGINT) > 0 THEN (20000 * CAST({n} AS BIGINT) + "
            f"CAST({total} AS BIGINT)) DIV (2 * CAST({total} AS BIGINT)) END AS INT)")


def share_text_sql(bp: str) -> str:
    """basis points as 4-decimal SQL text, e.g. 313 -> ``"0.0313"``."""
    return f"concat(CAST(({bp}) DIV 10000 AS STRING), '.', lpad(CAST(({bp}) % 10000 AS STRING), 4, '0'))"
