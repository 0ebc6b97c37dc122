"""Operator 8: language identification by nearest centroids.

A text is the vector of its hashed n-grams of 1 to 3 characters (lower-cased whole text,
runs of other characters than letters as one space), weighted 1 + log(count), times the inverse document frequency over all
training documents, normalised.  Each language has up to ``CLUSTERS`` centroids,
clustered by cosine over a bounded sample of about ``FIT_ROWS`` of its documents.
The nearest centroid names the language; its cosine is the score.  A text farther
from its centroid than all but 1 in 200 of the documents that made it is marked
``rejected`` (the nearest language is still named).

Document frequencies cover every training document.  A text that is null or
has no letter is ``und`` with score 0, as is every text if nothing was learned.
Rows without an id are scored, not learned from.  Columns besides id, text and
lang are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmetrics.llm.common import id_long, id_text, mix, ship_package
from tripmetrics.llm.toxicity import held_out

BITS = 13
SIZES = 3
CLUSTERS = 3
FIT_ROWS = 1_500
PARTS = 4
ROUNDS = 12
REJECTED = 0.005
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")
_B = np.uint64(0xD6E8FEB86659FD93)


def counts(text: str | None, bits: int = BITS) -> np.ndarray:
    """How often each hashed n-gram occurs."""
    letters = _OTHER.sub(" ", text.lower()) if text else ""
    c = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out = np.zeros(1 << bits, np.int64)
    h = np.zeros(len(c) + 1, np.uint64)
    for n in range(1, SIZES + 1):
        if len(c) < n:
            break
        h = h[: len(c) - n + 1] * _B + c[n - 1 :]
        out += np.bincount((mix(h + np.uint64(n)) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return out


def vectors(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    """Normalised weighted vectors, one row per text."""
    out = np.zeros((len(texts), len(idf)), np.float32)
    with np.errstate(over="ignore"):
        for k, text in enumerate(texts):
            tf = counts(text)
            hit = np.flatnonzero(tf)
            v = (1 + np.log(tf[hit])) * idf[hit]
            out[k, hit] = v / max(np.sqrt(v @ v), 1e-12)
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def cluster(x: np.ndarray, k: int = CLUSTERS) -> tuple[np.ndarray, np.ndarray]:
    """Centroids by spherical k-means (farthest-first start) and for each the
    lowest cosine that is not rejected."""
    picked = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(picked) < min(k, len(x)):
        near = (x @ x[picked].T).max(axis=1)
        if near.min() > 1 - 1e-6:
            break
        picked.append(int(np.argmin(near)))
    centre = x[picked]
    for _ in range(ROUNDS):
        own = np.argmax(x @ centre.T, axis=1)
        sums = np.stack([x[own == j].sum(axis=0) if (own == j).any() else centre[j] for j in range(len(centre))])
        centre = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    near = x @ centre.T
    own, best = near.argmax(axis=1), near.max(axis=1)
    floor = [np.quantile(best[own == j], REJECTED) if (own == j).any() else 1.0 for j in range(len(centre))]
    return centre.astype(np.float32), np.array(floor)


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of each feature over ``texts(text)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(1 << BITS, np.int64), 0
        for pdf in batches:
            with np.errstate(over="ignore"):
                for text in pdf["text"]:
                    df += counts(text) > 0
            n += len(pdf)
        # the last row counts the documents
        yield pd.DataFrame({"feature": np.arange(len(df) + 1, dtype=np.int32), "df": np.r_[df, n]})

    total = np.zeros((1 << BITS) + 1, np.int64)
    for r in texts.mapInPandas(run, "feature int, df long").groupBy("feature").agg(F.sum("df").alias("df")).collect():
        total[r["feature"]] = r["df"]
    return np.log((1 + total[-1]) / (1 + total[:-1])) + 1


def train(docs: DataFrame, rows: int = FIT_ROWS) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """(idf, language of each centroid, centroids, lowest cosines)."""
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    ).where("lang is not null and text is not null and doc_id is not null")
    known = known.where(~held_out("doc_id", 4, 2))
    idf = inverse_frequencies(known.select("text"))
    # ids are chosen without their texts: the first by hash of each language, ranked in parts so
    # that a task sends on no more than it could place
    ids = known.select("doc_id", "lang").distinct().withColumn("hash", F.xxhash64("doc_id"))
    part = F.pmod("hash", F.lit(PARTS))
    rank = F.row_number().over(Window.partitionBy("lang", part).orderBy("hash", "doc_id"))
    chosen = ids.withColumn("rank", rank).where(F.col("rank") <= -(-rows // PARTS)).select("doc_id", "lang")
    # bounded: so many ids for each language; only the sample's texts move
    sample = known.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[[has_letter(t) for t in pdf["text"]]].sort_values(["doc_id", "text"])
        if not len(pdf):
            return pd.DataFrame({"lang": [], "centre": [], "floor": []})
        centre, floor = cluster(vectors(list(pdf["text"]), idf))
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centre": [c.tobytes() for c in centre], "floor": floor})

    got = sample.groupBy("lang").applyInPandas(run, "lang string, centre binary, floor double").collect()
    got.sort(key=lambda r: (r["lang"], bytes(r["centre"])))
    centres = np.array([np.frombuffer(bytes(r["centre"]), np.float32) for r in got], np.float32).reshape(len(got), 1 << BITS)
    return idf, [r["lang"] for r in got], centres, np.array([r["floor"] for r in got])


def predict(docs: DataFrame, model: tuple) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, rejected)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        idf, langs, centres, floors = shared.value
        for pdf in batches:
            for lo in range(0, len(pdf), 256):
                part = pdf.iloc[lo : lo + 256]
                texts = list(part["text"])
                known = np.array([bool(langs) and has_letter(t) for t in texts])
                near = vectors([t if ok else "" for t, ok in zip(texts, known, strict=True)], idf) @ centres.T
                best = near.argmax(axis=1) if langs else np.zeros(len(part), np.int64)
                cosine = near.max(axis=1) if langs else np.zeros(len(part))
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"],
                        "held_out": part["held_out"],
                        "lang_pred": [langs[j] if ok else UNKNOWN for j, ok in zip(best, known, strict=True)],
                        "score": np.where(known, np.clip(cosine, 0, 1), 0.0).astype(float),
                        "rejected": ~known | (cosine < (floors[best] if langs else 1.0)),
                    }
                )

    own = docs.select(
        id_text("doc_id"), held_out("doc_id", 4, 2).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    schema = "doc_id string, held_out boolean, lang_pred string, score double, rejected boolean"
    return id_long(own.mapInPandas(run, schema), "doc_id")


def identify(docs: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    ship_package(docs.sparkSession)
    return predict(docs, train(docs, rows))
