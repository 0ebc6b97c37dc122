"""Helpers shared by the operators of this subpackage.

Words are the maximal runs of ``[^\\x20\\x09-\\x0D]``: exactly what
``bytes.split()`` returns on UTF-8 text, and ``bytes.lower()`` lowers A-Z only.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SLICE = 1 << 17
_LONG = 64
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that
    they can import it wherever they run."""
    sc = spark.sparkContext
    root = Path(__file__).resolve().parents[1]
    if getattr(sc, "_llm_package", None) or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="llm-package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._llm_package = str(archive)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a scratch folder
    only on a local master that names none (tests)."""
    ship_package(spark)
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.conf.get("tripmetrics.llm.scratch", None)
        if not path:
            if not spark.conf.get("spark.master", "local").startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            path = tempfile.mkdtemp(prefix="llm-checkpoint-")
            spark.conf.set("tripmetrics.llm.scratch", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is planned within drops its shuffle files when it has run (else they stay until
    the driver's collector comes by, and a job of many steps keeps those of all its steps)."""
    was = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, was)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (lineage cut; the
    files go when nothing refers to them, if the session cleans checkpoints).
    Nothing reads the step's shuffles after that; they are dropped at once."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # the select is planned here


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def id_text(col: str) -> Column:
    """An id for the way through pandas, where a null would make floats of longs."""
    return F.col(col).cast("long").cast("string").alias(col)


def id_long(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in cols})


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x + _GOLD  # a copy, worked on in place
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def gram_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Order-sensitive hash of every n consecutive entries of ``h``."""
    m = len(h) - n + 1
    out = np.full(m, n, np.uint64)
    for j in range(n):
        out = mix(out ^ h[j : j + m])
    return out


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    out = []
    for base in (_BASE, inverse):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Tokeniser:
    """Words of many texts as 64-bit hashes, vectorised over the bytes.

    A word's hash is a polynomial of its bytes (words of over 64 bytes:
    xxh3), the same wherever the word stands."""

    def __init__(self) -> None:
        self._up, self._down = _powers(_SLICE)

    def _slice(self, data: bytes, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        a = np.frombuffer(data, np.uint8, hi - lo, lo)
        if len(a) > len(self._up):
            self._up, self._down = _powers(len(a))
        gap = _SEPARATOR[a]
        edge = np.flatnonzero(np.diff(np.r_[True, gap, True].astype(np.int8)))
        start, end = edge[::2], edge[1::2]
        total = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(_BYTE[a] * self._up[: len(a)], out=total[1:])
        size = end - start
        h = mix((total[end] - total[start]) * self._down[start] + size.astype(np.uint64))
        for k in np.flatnonzero(size > _LONG):
            h[k] = xxhash.xxh3_64_intdigest(data[lo + start[k] : lo + end[k]])
        return h, start + lo

    def __call__(self, texts: Iterable[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words in order, number of words of each text)."""
        parts = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        data = b" ".join(parts)
        if lower:
            data = data.lower()
        hashes, starts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        lo = 0
        with np.errstate(over="ignore"):
            while lo < len(data):
                hi = min(lo + _SLICE, len(data))
                while hi < len(data) and not _SEPARATOR[data[hi]]:
                    hi += 1
                h, s = self._slice(data, lo, hi)
                hashes.append(h)
                starts.append(s)
                lo = hi
        begin = np.cumsum([0] + [len(p) + 1 for p in parts])
        where = np.searchsorted(np.concatenate(starts), begin)
        return np.concatenate(hashes), np.diff(where)


def chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about ``most`` (one row at least)."""
    lo, total = 0, 0
    for k, n in enumerate(sizes):
        total += n
        if total >= most:
            yield lo, k + 1
            lo, total = k + 1, 0
    if lo < len(sizes):
        yield lo, len(sizes)


def text_chunks(texts: pd.Series, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    return chunks([len(t) if t else 1 for t in texts], most)
