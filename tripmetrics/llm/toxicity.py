"""Operator 3: toxicity by a linear classifier over character n-grams.

A text's features are the hashed n-grams of 3 to 5 characters of its lower-cased whole text, present
or absent.  Each feature is scaled by its naive Bayes log-count ratio between
toxic and other training texts, and a logistic model is fitted on the scaled
features by adaptive gradient steps.  The score is the model's probability.

Training reads at most about ``FIT_ROWS`` labelled rows: all of them, or those
whose hashed id falls below the matching share.  The chosen ids (bounded by
that number) are broadcast to the scan, so no text is shuffled but the sample's.
The fit runs in one task on that bounded sample; scoring covers every row.

Null and empty texts have no features and score the model's base rate, as do
texts of fewer than three characters.  Without usable labels, or with one class
only, all rows score that class's share (0 without rows).  Columns besides id
and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import id_long, id_text, mix, ship_package

FIT_ROWS = 4_000
BITS = 20
SIZES = (3, 4, 5)
EPOCHS = 6
RATE = 0.1
ALPHA = 1.0
DECAY = 1e-4
MIN_DOCS = 3
_B = np.uint64(0xD6E8FEB86659FD93)


def features(text: str | None, bits: int = BITS, sizes: tuple[int, ...] = SIZES) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out = []
    h = c
    for n in range(2, max(sizes) + 1):
        if len(c) < n:
            break
        h = h[: len(c) - n + 1] * _B + c[n - 1 :]
        if n in sizes:
            out.append((mix(h + np.uint64(n)) >> np.uint64(64 - bits)).astype(np.int32))
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.int32)


def log_ratios(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, alpha: float = ALPHA) -> np.ndarray:
    """Naive Bayes log-count ratio of each feature; 0 for those of under MIN_DOCS texts."""
    p = np.full(1 << bits, alpha)
    q = np.full(1 << bits, alpha)
    for idx, y in zip(rows, labels, strict=True):
        (p if y else q)[idx] += 1
    r = np.log(p / p.sum()) - np.log(q / q.sum())
    return np.where(p + q < MIN_DOCS + 2 * alpha, 0.0, r)


def fit(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights (already times the ratios) and the intercept."""
    share = float(np.mean(labels)) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return np.zeros(1 << bits, np.float32), 40.0 if share else -40.0
    r = log_ratios(rows, labels, bits)
    w, seen = np.zeros(1 << bits), np.full(1 << bits, 1e-6)
    b, b_seen = float(np.log(share / (1 - share))), 1e-6
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            idx = rows[k]
            x = r[idx]
            z = float(w[idx] @ x) + b
            g = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[k]
            step = g * x + DECAY * w[idx]
            seen[idx] += step * step
            w[idx] -= RATE * step / np.sqrt(seen[idx])
            b_seen += g * g
            b -= RATE * g / np.sqrt(b_seen)
    return (w * r).astype(np.float32), b


def held_out(id_col: str, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def sample_ids(ids: DataFrame, rows: int) -> DataFrame:
    """All of ``ids(doc_id, ...)``, or about ``rows`` of them by hashed id."""
    count = ids.count()
    if count <= rows:
        return ids
    low = int(rows / count * 2**64) - 2**63
    return ids.where(F.xxhash64("doc_id") < low)


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[np.ndarray, float]:
    """Fit on ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``."""
    known = (
        labels.where("toxic in (0, 1) and doc_id is not null")
        .where(~held_out("doc_id", 5, 0))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    chosen = F.broadcast(sample_ids(known, rows))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(chosen, "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got, ys, ids = [], [], []  # one task holds the bounded sample
        for pdf in batches:
            for doc_id, text, toxic in zip(pdf["doc_id"], pdf["text"], pdf["toxic"], strict=True):
                with np.errstate(over="ignore"):
                    got.append(features(text))
                ys.append(toxic)
                ids.append((doc_id, text or ""))
        order = sorted(range(len(ids)), key=ids.__getitem__)  # the fit must not depend on the order of arrival
        w, b = fit([got[k] for k in order], np.array(ys, float)[order])
        yield pd.DataFrame({"w": [w.tobytes()], "b": [b]})

    # repartition, not coalesce: the scan and the join keep their tasks, only the sample moves
    row = sample.repartition(1).mapInPandas(run, "w binary, b double").first()
    if row is None:
        return fit([], np.empty(0))
    return np.frombuffer(bytes(row["w"]), np.float32), row["b"]


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, b = shared.value
        for pdf in batches:
            z = np.empty(len(pdf))
            with np.errstate(over="ignore"):
                for k, text in enumerate(pdf["text"]):
                    z[k] = w[features(text)].sum(dtype=np.float64) + b
            s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pd.DataFrame(
                {"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "score": s, "predicted": (s >= 0.5).astype(np.int32)}
            )

    own = docs.select(
        id_text("doc_id"), held_out("doc_id", 5, 0).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return id_long(own.mapInPandas(run, "doc_id string, held_out boolean, score double, predicted int"), "doc_id")


def score_toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    ship_package(docs.sparkSession)
    return score(docs, train(docs, labels, rows))
