"""Operator 13: centroid clustering filtered by n-simplex projection.

Vectors are turned into integers, so every decision is exact.  A few pivots span
a base simplex.  The squared distances of a vector to the pivots, taken once,
place it as the apex of a simplex on that base: one coordinate per pivot, the
last one the altitude (>= 0).  For two apexes the plain Euclidean distance is a
lower bound of the true one; with the altitudes on opposite sides it is an
upper bound.  The coordinates are cached with the vectors.  In each round the
bounds, and the exact distance to the centroid of the least lower bound, rule
centroids out; the rest are compared in integers (ties: the smaller number).

Per round a task keeps one sum per centroid and component whatever it reads,
the sums of the tasks are added by Spark, and only centroids x components
numbers reach the driver.  The vectors are never shuffled.

Kept are vectors of exactly ``dims`` components, none null, NaN or infinite; others (a
null vector too) are left out.  A row without id is never a start but is assigned like
the rest (without any start there are no rows); rows that repeat an id are vectors of their own, and as starts they are
ordered by hash, then components.  With fewer starts than ``k`` there are so
many centroids; an empty table gives no rows.  A component whose
integer is beyond 2**27 raises, as distances would leave the 64-bit range.
Columns besides the id and the vector are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import cut, id_long, id_text, ship_package

PIVOTS = 12
_MOST = 1 << 27
_SLACK = 1e-7
_FLAT = 1e-3


class Simplex:
    """The base simplex of some integer points and the projection onto it."""

    def __init__(self, points: np.ndarray, most: int = PIVOTS) -> None:
        """Pivots are taken farthest first; a point that lies (almost) in the
        span of those before it adds nothing and is left out."""
        square = ((points[:, None] - points[None]) ** 2).sum(2).astype(float)
        chosen, base = [0], np.zeros((0, 0))
        while len(chosen) < min(most, len(points)):
            rest = [i for i in range(len(points)) if i not in chosen]
            heights = [(self._height(square, chosen, base, i), -i) for i in rest]
            high, i = max(heights)
            if high <= _FLAT * max(square.max(), 1):
                break
            row = self._coordinates(square, chosen, base, -i)
            base = np.block([[base, np.zeros((len(base), 1))], [row, np.sqrt(high)]])
            chosen.append(-i)
        self.pivots, self.base = points[chosen], base
        self._norms = (base**2).sum(1)

    @staticmethod
    def _coordinates(square: np.ndarray, chosen: list[int], base: np.ndarray, i: int) -> np.ndarray:
        first = square[chosen[0], i]
        right = ((base**2).sum(1) + first - square[chosen[1:], i]) / 2
        return np.linalg.solve(base, right) if len(base) else right

    def _height(self, square: np.ndarray, chosen: list[int], base: np.ndarray, i: int) -> float:
        return float(square[chosen[0], i] - (self._coordinates(square, chosen, base, i) ** 2).sum())

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """One row of coordinates per vector, the altitude last."""
        square = np.stack([((vectors - p) ** 2).sum(1) for p in self.pivots], 1).astype(float)
        flat = np.zeros((len(vectors), 0))
        if len(self.base):
            flat = np.linalg.solve(self.base, (self._norms + square[:, :1] - square[:, 1:]).T / 2).T
        height = np.sqrt(np.maximum(square[:, 0] - (flat**2).sum(1), 0))
        return np.concatenate([flat, height[:, None]], 1)


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances between the points of
    the apexes ``a`` (rows) and ``b`` (columns), widened for rounding."""
    flat = np.zeros((len(a), len(b)))
    for j in range(a.shape[1] - 1):
        flat += (a[:, j, None] - b[None, :, j]) ** 2
    slack = _SLACK * ((a**2).sum(1)[:, None] + (b**2).sum(1)[None]) + 0.5
    low = flat + (a[:, -1, None] - b[None, :, -1]) ** 2 - slack
    return low, flat + (a[:, -1, None] + b[None, :, -1]) ** 2 + slack


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """``(centroid number, squared distance, distances computed)``."""
    low, high = bounds(apexes, places)
    every = np.arange(len(vectors))
    likely = low.argmin(1)
    first = ((vectors - centroids[likely]) ** 2).sum(1)
    open_ = low <= np.minimum(high.min(1), first)[:, None]
    best, number, work = first.copy(), likely.copy(), len(vectors)
    for c in range(len(centroids)):
        rows = every[open_[:, c] & (likely != c)]
        if not len(rows):
            continue
        work += len(rows)
        d = ((vectors[rows] - centroids[c]) ** 2).sum(1)
        better = (d < best[rows]) | ((d == best[rows]) & (c < number[rows]))
        best[rows[better]], number[rows[better]] = d[better], c
    return number, best, work


def integers(df: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """``(id, v)``: the kept vectors as arrays of integers."""
    x = F.transform(F.col(vec_col), lambda e: e.cast("double"))
    good = (F.size(x) == dims) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    whole = F.transform(x, lambda e: F.floor(e * F.lit(float(scale))).cast("long"))
    ranged = F.transform(
        whole,
        lambda e: F.when(F.abs(e) <= _MOST, e.cast("int")).otherwise(F.raise_error(F.lit("vector component beyond 2**27"))),
    )
    return df.where(F.coalesce(good, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), ranged.alias("v"))


def _stack(column: pd.Series, kind: type) -> np.ndarray:
    return np.array(column.tolist(), kind)


def _projected(simplex: Simplex):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(apex=list(simplex.apexes(_stack(pdf["v"], np.int64))))

    return run


def _sums(centroids: np.ndarray, places: np.ndarray):
    """A task's vectors added up per centroid: one row each at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for pdf in batches:
            if len(pdf):
                v = _stack(pdf["v"], np.int64)
                number, _, _ = nearest(v, _stack(pdf["apex"], float), centroids, places)
                np.add.at(total, number, v)
                counts += np.bincount(number, minlength=len(centroids))
        hit = np.flatnonzero(counts)
        if len(hit):
            yield pd.DataFrame({"cluster": hit.astype(np.int32), "n": counts[hit], "total": list(total[hit])})

    return run


def _assigned(centroids: np.ndarray, places: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                number, distance, _ = nearest(_stack(pdf["v"], np.int64), _stack(pdf["apex"], float), centroids, places)
                yield pd.DataFrame({"id": pdf["id"].array, "cluster": number.astype(np.int32), "distance": distance})

    return run


def starts(points: DataFrame, k: int) -> np.ndarray:
    """The first ``k`` vectors by the hash of their ids."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    top = points.where("id IS NOT NULL").select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()
    return np.array([r["v"] for r in top], np.int64)


def cluster_vectors(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = 16, rounds: int = 3,
    dims: int = 64, scale: int = 64, pivots: int = PIVOTS,
) -> DataFrame:
    """``(id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256)``
    of every kept vector."""
    spark = df.sparkSession
    ship_package(spark)
    points = integers(df, id_col, vec_col, dims, scale)
    centroids = starts(points, k)
    schema = f"{id_col} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], schema)
    simplex = Simplex(centroids, pivots)
    placed = cut(points.select(id_text("id"), "v").mapInPandas(_projected(simplex), "id string, v array<int>, apex array<double>"))
    for _ in range(rounds):
        sums = (
            placed.mapInPandas(_sums(centroids, simplex.apexes(centroids)), "cluster int, n long, total array<long>")
            .select("cluster", "n", F.posexplode("total").alias("i", "x"))
            .groupBy("cluster", "i").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
            .collect()  # centroids x components numbers
        )
        centroids = centroids.copy()
        for r in sums:
            centroids[r["cluster"], r["i"]] = r["x"] // r["n"]
    out = placed.mapInPandas(_assigned(centroids, simplex.apexes(centroids)), "id string, cluster int, distance long")
    out = cut(id_long(out, "id"))
    inertia = {r["cluster"]: r["x"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("x")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def by_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)

    return out.select(
        F.col("id").alias(id_col), "cluster", "distance",
        by_cluster([inertia.get(c, 0) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        by_cluster(digests, "string").alias("centroid_sha256"),
    )
