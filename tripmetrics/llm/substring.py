"""Operator 7: removal of word windows that occur more than once.

Texts are parsed by recompression.  Equal neighbouring words are named as runs
(of up to ``RUN`` words), then neighbouring symbols whose names fall in the
left and the right half of the alphabet (a coin per name) are named as pairs
(of up to ``PAIR`` words).  A name is a hash of what it stands for, so it is the
same in every document and partition, and a parse depends on the neighbouring
words only: in any window, all symbols but those that touch the first or last
``EDGE`` words are the same wherever the window's words occur.  A high-level
symbol starts at a symbol and takes symbols until it covers ``COVER`` words.  A
window's owner is the smallest name of the high-level symbols inside its
undisturbed part, so equal windows have equal owners.  Neighbouring windows of
one owner form a segment, named by all of its words.

1. Owners are counted by name over all documents, with their smallest and
   largest segment.  A window whose owner occurs once cannot repeat, unless the
   segment repeats a window itself.  Where an owner's segments are all the same,
   all of its windows repeat.
2. Elsewhere segments are counted; those that occur twice or more repeat as a
   whole.
3. One occurrence of each of these segments names its windows exactly; windows
   found twice or more are kept.
4. Each document drops the words that its repeated windows cover.

Every count is pre-aggregated and every join back is one that adaptive
execution can split, so a passage that a third of the documents share meets no
single task.

Null and blank texts have no words.  Texts shorter than a window keep all words.
Rows that repeat an id are rows of their own; so are rows without an id.
Columns besides id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import Tokeniser, cut, id_long, id_text, mix, text_chunks

RUN = 3
PAIR = 3
EDGE = RUN + PAIR - 1
COVER = 8
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def owner_span(window: int) -> int:
    """Start positions inside a window that a high-level symbol can have."""
    span = window - 2 * EDGE - (COVER + max(RUN, PAIR) - 1) + 1
    if span < max(RUN, PAIR):
        raise ValueError("the window is too short for a symbol inside it")
    return span


def name_runs(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and lengths after runs of 2 to RUN equal words became symbols."""
    start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    length = np.diff(np.r_[start, len(h)])
    short = length <= RUN
    times = np.where(short, 1, length)
    names = np.repeat(np.where(short & (length > 1), mix(h[start] ^ mix(length.astype(np.uint64))), h[start]), times)
    return names, np.repeat(np.where(short, length, 1), times)


def name_pairs(names: np.ndarray, lengths: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Names and lengths after left-right neighbours became symbols."""
    left = (mix(names + np.uint64(turn)) & np.uint64(1)).astype(bool)
    join = left[:-1] & ~left[1:] & (lengths[:-1] + lengths[1:] <= PAIR)
    at = np.flatnonzero(join)
    names, lengths = names.copy(), lengths.copy()
    names[at] = mix(mix(names[at] ^ np.uint64(turn)) + names[at + 1])
    lengths[at] += lengths[at + 1]
    keep = np.ones(len(names), bool)
    keep[at + 1] = False
    return names[keep], lengths[keep]


def high_symbols(h: np.ndarray) -> np.ndarray:
    """For each word the name of the high-level symbol that starts there, or
    the largest number."""
    value = np.full(len(h), _TOP)
    names, lengths = name_pairs(*name_runs(h), 1)
    starts = np.cumsum(lengths) - lengths
    top, total = names.copy(), lengths.copy()
    for step in range(1, COVER):
        n = len(names) - step
        if n <= 0:
            break
        more = total[:n] < COVER
        top[:n] = np.where(more, mix(top[:n] ^ names[step:]), top[:n])
        total[:n] += np.where(more, lengths[step:], 0)
    whole = total >= COVER
    value[starts[whole]] = top[whole] & ~np.uint64(1)
    return value


def sliding_min(v: np.ndarray, span: int) -> np.ndarray:
    """Smallest of each ``span`` consecutive values."""
    size, out = 1, v
    while 2 * size <= span:
        out = np.minimum(out[: len(out) - size], out[size:])
        size *= 2
    n = len(v) - span + 1
    return np.minimum(out[:n], out[span - size : span - size + n])


def window_names(h: np.ndarray, window: int) -> np.ndarray:
    """64-bit name of every window, by doubling."""
    size, power, out, taken = 1, h, None, 0
    n = len(h) - window + 1
    while size <= window:
        if window & size:
            part = power[taken : taken + n]
            out = mix(part) if out is None else mix(out + part)
            taken += size
        if 2 * size <= window:
            power = mix(mix(power[: len(power) - size]) + power[size:])
        size *= 2
    return out


def segments(h: np.ndarray, counts: np.ndarray, window: int):
    """Segments of several texts whose word hashes are concatenated in ``h``:
    (text, owner, name, first window's start in the text, number of windows,
    whether a window occurs twice in the segment)."""
    span = owner_span(window)
    begin = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    if len(h) < window:
        text = text[:0]
    n = max(len(h) - window + 1, 0)
    place = (np.arange(len(h)) - begin[np.repeat(np.arange(len(counts)), counts)])[:n]
    text = text[:n]
    valid = place + window <= counts[text]
    if not valid.any():
        e = np.empty(0, np.int64)
        return e, e.view(np.uint64), e.view(np.uint64), e, e, e.astype(bool)
    owner = sliding_min(high_symbols(h), span)[EDGE : EDGE + n]
    name = window_names(h, window)
    fresh = np.r_[True, (owner[1:] != owner[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]] & valid
    run = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    fresh |= valid & ((np.arange(n) - run) % span == 0)
    first = np.flatnonzero(fresh)
    stop = np.r_[first[1:], n]
    upto = np.cumsum(np.r_[0, valid])
    size = upto[stop] - upto[first]
    names = mix(mix(name[first]) + name[first + size - 1]) ^ size.astype(np.uint64)
    own = np.cumsum(fresh) - 1
    again = np.zeros(len(first), bool)
    for step in range(1, span):
        same = np.flatnonzero(name[step:] == name[:-step])
        same = same[valid[same] & valid[same + step] & (own[same] == own[same + step])]
        again[own[same]] = True
    return text[first], owner[first], names, place[first], size, again


def covered(starts: np.ndarray, sizes: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Which words the windows ``starts[k] .. starts[k] + sizes[k] - 1`` cover."""
    mark = np.zeros(n_words + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + sizes + window - 1, -1)
    return np.cumsum(mark)[:n_words] > 0


def _segments(window: int):
    span = owner_span(window)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Tokeniser()
        for pdf in batches:
            for lo, hi in text_chunks(pdf["text"]):
                part = pdf.iloc[lo:hi]
                with np.errstate(over="ignore"):
                    text, owner, name, place, size, again = segments(*words(part["text"]), window)
                yield pd.DataFrame(
                    {
                        "owner": owner.view(np.int64),
                        "name": name.view(np.int64),
                        "key": part["key"].to_numpy()[text],
                        "sub": part["sub"].to_numpy()[text],
                        "at": place * span + size - 1,
                        "again": again,
                    }
                )

    return run


def _windows(window: int):
    span = owner_span(window)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, unzip = Tokeniser(), zstandard.ZstdDecompressor()
        for pdf in batches:
            for lo, hi in text_chunks(pdf["packed"], 1 << 19):
                part = pdf.iloc[lo:hi]
                texts = [unzip.decompress(p).decode("utf-8", "surrogatepass") for p in part["packed"]]
                with np.errstate(over="ignore"):
                    h, counts = words(texts)
                    names = window_names(h, window)
                begin = np.cumsum(counts) - counts
                at = np.concatenate([np.asarray(a, np.int64) for a in part["at"]])
                k = np.repeat(np.arange(len(part)), [len(a) for a in part["at"]])
                place, size = at // span, at % span + 1
                step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                start = np.repeat(place, size) + step
                k = np.repeat(k, size)
                yield pd.DataFrame(
                    {
                        "window": names[begin[k] + start].view(np.int64),
                        "key": part["key"].to_numpy()[k],
                        "sub": part["sub"].to_numpy()[k],
                        "at": start * span,
                    }
                )

    return run


def _removed(window: int, cols: list[str], with_text: bool):
    span = owner_span(window)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unzip = zstandard.ZstdDecompressor()
        for pdf in batches:
            rows = []
            for packed, at in zip(pdf["packed"], pdf["at"], strict=True):
                words = unzip.decompress(packed).split() if packed is not None else []
                kept = words
                if at is not None:
                    at = np.asarray(at, np.int64)
                    gone = covered(at // span, at % span + 1, len(words), window)
                    kept = [words[i] for i in np.flatnonzero(~gone)]
                text = b" ".join(kept)
                row = (len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest())
                if with_text:  # a text that loses nothing stays as it is
                    if packed is not None and len(kept) == len(words):
                        text = unzip.decompress(packed)
                    row = (*row, None if packed is None else text.decode("utf-8", "surrogatepass"))
                rows.append(row)
            out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "kept_text"][: 3 + with_text])
            for k, c in enumerate(cols):
                out.insert(k, c, pdf[c].array)
            yield out

    return run


def _packed(cols: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        zip_ = zstandard.ZstdCompressor(level=3)
        for pdf in batches:
            yield pd.DataFrame(
                {
                    **{c: pdf[c] for c in cols},
                    "key": pdf["key"],
                    "sub": pdf["sub"],
                    "packed": [
                        None if t is None else zip_.compress(t.encode("utf-8", "surrogatepass")) for t in pdf["text"]
                    ],
                }
            )

    return run


def repeated_windows(docs: DataFrame, packed: DataFrame, window: int) -> DataFrame:
    """``docs(key, sub, text)`` -> ``(key, sub, at)`` of all repeated windows:
    ``at`` holds the first window's start and the number of windows."""
    found = docs.mapInPandas(_segments(window), "owner long, name long, key long, sub int, at long, again boolean")
    owners = (
        found.groupBy("owner")
        .agg(
            F.count("*").alias("c"), F.min("name").alias("lo"), F.max("name").alias("hi"), F.max("again").alias("again")
        )
        .where("c > 1 or again")
        .select("owner", F.expr("c > 1 and lo = hi").alias("one"))
    )
    shared = cut(found.drop("again").join(owners, "owner"))
    mixed = shared.where("not one")
    names = mixed.groupBy("name").agg(
        F.count("*").alias("c"), F.min(F.struct("key", "sub", "at")).alias("first")
    )
    whole = mixed.join(names.where("c > 1").select("name"), "name", "left_semi").select("key", "sub", "at")
    asked = (
        names.select("first.key", "first.sub", "first.at")
        .groupBy("key", "sub")
        .agg(F.collect_list("at").alias("at"))
    )
    windows = packed.join(asked, ["key", "sub"]).select("key", "sub", "packed", "at")
    windows = windows.mapInPandas(_windows(window), "window long, key long, sub int, at long")
    twice = windows.groupBy("window").agg(F.count("*").alias("c")).where("c > 1").select("window")
    single = windows.join(twice, "window", "left_semi").select("key", "sub", "at")
    return shared.where("one").select("key", "sub", "at").union(whole).union(single)


def drop_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 35,
    with_text: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(id_col, *carry, n_words, n_removed, kept_sha256[, kept_text])`` per row;
    ``carry`` names text columns to keep."""
    cols = [id_col, *carry]
    own = docs.select(
        id_text(id_col),
        *carry,
        F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col)).alias("key"),
        F.hash(text_col).alias("sub"),
        F.col(text_col).cast("string").alias("text"),
    )
    kept = "".join(f"{c} string, " for c in cols)
    packed = own.mapInPandas(_packed(cols), f"{kept}key long, sub int, packed binary")
    repeats = repeated_windows(own.select("key", "sub", "text"), packed.select("key", "sub", "packed"), window)
    marks = repeats.groupBy("key", "sub").agg(F.collect_list("at").alias("at"))
    schema = f"{kept}n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    rows = packed.join(marks, ["key", "sub"], "left").select(*cols, "packed", "at")
    return id_long(rows.mapInPandas(_removed(window, cols, with_text), schema), id_col)
