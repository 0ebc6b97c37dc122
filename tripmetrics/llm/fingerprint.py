"""Operator 5: bottom-k fingerprints of documents.

A fingerprint holds the ``K`` smallest distinct 64-bit hashes of a text's shingles
of ``SHINGLE`` code points (a shorter text is one shingle, an empty one has none),
as base64 of their little-endian bytes in ascending order.  Fingerprints of
parts merge into the fingerprint of the whole; two of them estimate resemblance
and containment, one the number of distinct shingles.  With fewer than ``K``
hashes these are exact.  Two empty fingerprints resemble each other by 1.

``edited_neighbours`` compares each document with an edited copy and with the
next document in descending order of ids.  Ranges of ids, bounded by ids that
occur, are dealt to tasks; each bound is also sent to the range before it, so
that a task streams its range in order and holds two documents at a time.
Rows that repeat an id are ordered by their text, rows without an id come last.
Null text counts as empty.  Columns besides id and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import id_long, id_text, mix

K = 128
SHINGLE = 8
ROWS_PER_RANGE = 500
MAX_RANGES = 10_000
_B = 0xD6E8FEB86659FD93


def points(text: str | None) -> np.ndarray:
    raw = (text or "").encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32).astype(np.uint64)


def shingle_hashes(c: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of every ``size`` consecutive code points (of all, if fewer)."""
    n = len(c)
    if n == 0:
        return c
    size = min(size, n)
    out, done, power, width, part = None, 0, _B, 1, c
    while width <= size:
        if size & width:
            piece = part[done : done + n - size + 1]
            out = piece if out is None else out * np.uint64(power & (2**64 - 1)) + piece
            done += width
        if 2 * width <= size:
            part = part[: len(part) - width] * np.uint64(power & (2**64 - 1)) + part[width:]
            power = power * power
        width *= 2
    return mix(out + np.uint64(size))


def bottom(h: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct values, ascending."""
    if len(h) > 8 * k:
        low = np.unique(h[h < np.uint64(int(2**64 * (4 * k / len(h))))])
        if len(low) >= k:
            return low[:k]
    return np.unique(h)[:k]


def to_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u8")


def merge(parts: list[np.ndarray], k: int = K) -> np.ndarray:
    """Fingerprint of the union of the parts' shingles."""
    return bottom(np.concatenate([np.empty(0, np.uint64), *parts]), k)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge([a, b], k)
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum() / len(union))


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[-1]) / 2.0**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge([a, b], k), k) / distinct(a, k))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """``(id_col, n_chars, n_distinct, fingerprint)`` per row of ``docs``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for t in pdf["text"]:
                with np.errstate(over="ignore"):
                    c = points(t)
                    s = bottom(shingle_hashes(c), k)
                rows.append((len(c), distinct(s, k), to_text(s)))
            out = pd.DataFrame(rows, columns=["n_chars", "n_distinct", "fingerprint"])
            out.insert(0, id_col, pdf[id_col].array)
            yield out

    own = docs.select(id_text(id_col), F.col(text_col).cast("string").alias("text"))
    schema = f"{id_col} string, n_chars long, n_distinct double, fingerprint string"
    return id_long(own.mapInPandas(run, schema), id_col)


def merged_fingerprints(parts: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """Fingerprint of each group of ``parts(*by, fingerprint)``: merged in each
    batch first, then by group, so a group's parts never meet in one task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = pdf.groupby(by, dropna=False, sort=False)["fingerprint"].agg(
                lambda fs: to_text(merge([from_text(f) for f in fs], k))
            )
            yield got.reset_index()

    schema = parts.select(*by, "fingerprint").schema
    salted = parts.select(*by, "fingerprint").mapInPandas(run, schema)
    values = salted.select(*by, F.explode(F.split(F.expr("regexp_replace(hex(unbase64(fingerprint)), '(.{16})', '$1 ')"), " ")).alias("v"))
    # ascending order of little-endian values: reverse the bytes of the hex text
    order = F.expr("concat(substr(v,15,2),substr(v,13,2),substr(v,11,2),substr(v,9,2),substr(v,7,2),substr(v,5,2),substr(v,3,2),substr(v,1,2))")
    ranked = values.where("v != ''").select(*by, order.alias("o"), "v").distinct()
    kept = ranked.selectExpr(*by, "o", "v", f"row_number() over (partition by {', '.join(by)} order by o) as r").where(f"r <= {k}")
    joined = kept.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("o", "v"))).alias("s"))
    return joined.select(*by, F.expr(r"regexp_replace(base64(unhex(array_join(transform(s, x -> x.v), ''))), '\\s', '')").alias("fingerprint"))


def _compared(k: int, size: int):
    def one(text: str) -> tuple:
        c = points(text)
        h = shingle_hashes(c, size)
        return text, c, h, bottom(h, k)

    def row(doc_id, doc: tuple, after: tuple) -> tuple:
        text, c, h, own = doc
        n, gone = len(c), len(c) // 3
        keep = n - gone
        tail = after[1][:gone]
        edited = text[:keep] + after[0][:gone]
        if gone == 0:
            sketch = own
        elif keep < size:
            sketch = bottom(shingle_hashes(np.r_[c[:keep], tail], size), k)
        else:
            joint = np.r_[c[keep - size + 1 : keep], tail]
            fresh = shingle_hashes(joint, size) if len(joint) >= size else joint[:0]
            sketch = bottom(np.r_[h[: keep - size + 1], fresh], k)
        return (
            doc_id,
            n,
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            to_text(own),
            to_text(sketch),
            resemblance(own, sketch, k),
            resemblance(own, after[3], k),
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        held = None  # (range, id, document) that waits for the next row
        for pdf in batches:
            rows = []
            for part, bound, doc_id, text in zip(pdf["part"], pdf["bound"], pdf["doc_id"], pdf["text"], strict=True):
                if held is None and bound:  # a second row of the bound's id
                    continue
                with np.errstate(over="ignore"):
                    doc = one(text or "")
                    if held is not None:
                        rows.append(row(held[0], held[1], doc))
                held = None if bound else (doc_id, doc)
            yield pd.DataFrame(rows, columns=names)

    return run


def edited_neighbours(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, size: int = SHINGLE
) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)``: the edited text is the document with its last
    third replaced by as much of the next document's beginning."""
    low = F.expr("-9223372036854775807 - 1")  # rows without an id come last
    own = docs.select(
        id_text(id_col).alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), low).alias("id"),
        F.col(text_col).cast("string").alias("text"),
    )
    ids = own.select("id")
    count, top = ids.agg(F.count("*"), F.max("id")).first()
    n = max(1, min(MAX_RANGES, count // ROWS_PER_RANGE))
    shares = [j / n for j in range(1, n)]
    inner = ids.agg(F.percentile_approx("id", shares, 10 * n)).first()[0] if shares and count else []
    bounds = np.unique(np.array([*inner, top if count else 0], np.int64))

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            order = pdf["id"].to_numpy()
            part = np.searchsorted(bounds, order)
            pdf = pdf.assign(part=part, bound=False)
            first = pdf[bounds[part] == order]  # a bound is the first of its range and the end of the one before
            yield pd.concat([pdf, first.assign(part=(first["part"] + 1) % len(bounds), bound=True)])[
                ["part", "bound", "id", "doc_id", "text"]
            ]

    compared = (
        own.mapInPandas(dealt, "part int, bound boolean, id long, doc_id string, text string")
        .repartition("part")
        .sortWithinPartitions("part", "bound", F.desc("id"), "text")
        .mapInPandas(
            _compared(k, size),
            "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double",
        )
    )
    return id_long(compared, "doc_id")
