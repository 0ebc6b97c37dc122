"""Operator 1: near-duplicate classes by Fast Similarity Sketching.

A document's set holds its distinct word shingles.  Its sketch has ``COORDS``
coordinates.  In round r every element of the set is thrown into a bin (a
random bin in the first ``COORDS`` rounds, bin r - COORDS afterwards, so that
every bin fills) and a bin keeps the smallest hash of the first round that
reaches it.  Rounds stop when all bins are full.  Coordinates agree with the
probability of the resemblance and concentrate like independent trials.

Bands of ``ROWS`` coordinates make buckets; at a resemblance of 0.8 a pair misses
all of the 32 buckets with probability (1 - 0.8**4)**32 = 5e-8.  Every pair that
is linked is confirmed on the full sets.

Copies of one set are folded first.  A bucket's pairs are never all listed:
its smallest id is a hub that is compared with every member, which joins most of
a group of near copies.  Buckets whose other members are then of one class are
done.  For the members of the rest the pairs across classes are found exactly,
by an index of the rarest items of each set: two sets of n items that resemble
each other by 0.8 differ in n / 9 items at most, so they share one of their
n / 9 + 1 rarest ones.  Members that share a bucket with thousands but resemble
none have rare items of their own and meet few.

Null or blank texts have an empty set and are linked with nothing; a row
without doc_id is linked with nothing and has a null component and kept = true.
Rows that repeat a doc_id are judged each by its own text.  Columns besides
the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import Tokeniser, cut, gram_hash, id_long, id_text, mix, text_chunks
from tripmetrics.llm.components import components

COORDS = 128
ROWS = 4
COUNTERS = 1 << 18
_CLASS = 1.05
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: pd.Series, size: int, words: Tokeniser) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text."""
    h, counts = words(texts, lower=True)
    out = []
    with np.errstate(over="ignore"):
        grams = gram_hash(h, size) if len(h) >= size else np.empty(0, np.uint64)
        at = 0
        for n in counts:
            if n == 0:
                out.append(np.empty(0, np.uint64))
            elif n < size:
                out.append(gram_hash(h[at : at + n], n))
            else:
                own = np.sort(grams[at : at + n - size + 1])
                out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
            at += n
    return out


def fast_sketch(values: np.ndarray, owner: np.ndarray, n_sets: int, coords: int = COORDS) -> np.ndarray:
    """Sketches of ``n_sets`` non-empty sets: ``values[i]`` belongs to set
    ``owner[i]`` (ascending)."""
    out = np.full(n_sets * coords, _EMPTY, np.uint64)
    with np.errstate(over="ignore"):
        for r in range(2 * coords):
            h = mix(values ^ mix(np.full(1, 7919 + r, np.uint64)))
            if r < coords:
                slot = owner * coords + (h % np.uint64(coords)).astype(np.int64)
            else:
                slot = owner * coords + (r - coords)
            free = out[slot] == _EMPTY
            np.minimum.at(out, slot[free], mix(h[free]) >> np.uint64(1))
            short = (out.reshape(n_sets, coords) == _EMPTY).any(axis=1)
            if not short.any():
                break
            if not short.all():
                live = short[owner]
                values, owner = values[live], owner[live]
    return out.reshape(n_sets, coords)


def band_keys(sketches: np.ndarray, rows: int = ROWS) -> np.ndarray:
    n, t = sketches.shape
    with np.errstate(over="ignore"):
        keys = np.broadcast_to(np.arange(t // rows, dtype=np.uint64), (n, t // rows)).copy()
        for j in range(rows):
            keys = mix(keys ^ sketches[:, j::rows])
    return keys.view(np.int64)


def _sketched(id_col: str, text_col: str, size: int, coords: int, rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Tokeniser()
        for pdf in batches:
            for lo, hi in text_chunks(pdf[text_col]):
                sets = shingle_sets(pdf[text_col].iloc[lo:hi], size, words)
                full = [s for s in sets if len(s)]
                keys = iter(())
                if full:
                    owner = np.repeat(np.arange(len(full)), [len(s) for s in full])
                    keys = iter(band_keys(fast_sketch(np.concatenate(full), owner, len(full), coords), rows))
                yield pd.DataFrame(
                    {
                        id_col: pdf[id_col].iloc[lo:hi].array,
                        "n_shingles": np.array([len(s) for s in sets], np.int64),
                        "set_digest": [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets],
                        "bands": [next(keys) if len(s) else None for s in sets],
                    }
                )

    return run


def _sets(text_col: str, size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Tokeniser()
        for pdf in batches:
            for lo, hi in text_chunks(pdf[text_col]):
                sets = shingle_sets(pdf[text_col].iloc[lo:hi], size, words)
                yield pd.DataFrame({"id": pdf["id"].iloc[lo:hi].array, "items": [s.view(np.int64) for s in sets]})

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that are linked, judged on their full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("xs"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("ys"))
    sizes = (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", F.size("xs").alias("na"), F.size("ys").alias("nb"), F.size(F.array_intersect("xs", "ys")).alias("both"))
    )
    return sizes.where(f"100 * both >= {percent} * (na + nb - both)").select("a", "b").distinct()


def _labelled(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Add ``label``: the smallest id of the class that ``edges`` give each id."""
    found = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return members.join(found, members["id"] == found["node"], "left").select(
        *members.columns, F.coalesce("root", "id").alias("label")
    )


def _need(n1: str, n2: str, percent: int) -> str:
    """Items that two linked sets of these sizes have in common at least."""
    whole = 100 + percent
    return f"(({percent} * ({n1} + {n2}) + {whole - 1}) div {whole})"


def _item_counts(sets: DataFrame) -> np.ndarray:
    """How often items occur, by hashed item: a fixed number of counters.  Only
    the order that it gives matters, and any order is right."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(COUNTERS, np.int64)
        for pdf in batches:
            for items in pdf["items"]:
                total += np.bincount(_counter(items), minlength=COUNTERS)
        hit = np.flatnonzero(total)
        yield pd.DataFrame({"slot": hit.astype(np.int32), "c": total[hit]})

    out = np.zeros(COUNTERS, np.int64)
    got = sets.select("items").mapInPandas(run, "slot int, c long").groupBy("slot").agg(F.sum("c").alias("c")).toPandas()
    out[got["slot"].to_numpy()] = got["c"].to_numpy()
    return out


def _counter(items: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(np.asarray(items, np.int64).view(np.uint64)) % np.uint64(COUNTERS)).astype(np.int64)


def _prefixes(counts: np.ndarray, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 500):
                part = pdf.iloc[lo : lo + 500]
                items, sizes = [], []
                for own in part["items"]:
                    own = np.asarray(own, np.int64)
                    order = np.lexsort((own, counts[_counter(own)]))
                    size = len(own) - -(-percent * len(own) // 100) + 1
                    items.append(own[order[:size]])
                    sizes.append(size)
                yield pd.DataFrame(
                    {
                        "item": np.concatenate(items),
                        "id": np.repeat(part["id"].to_numpy(), sizes),
                        "label": np.repeat(part["label"].to_numpy(), sizes),
                        "n": np.repeat([len(x) for x in part["items"]], sizes),
                        "pos": np.concatenate([np.arange(x) for x in sizes]),
                    }
                )

    return run


def _prefix_pairs(open_sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different classes that can be linked: with items in one order,
    rare ones first, the first common item of two linked sets lies so early
    in both that enough items follow.

    Of an item's members only those outside its largest class ask; they ask by
    size class, so an item that many members hold meets only those for which it is
    early enough."""
    counts = _item_counts(open_sets)
    rows = cut(open_sets.mapInPandas(_prefixes(counts, percent), "item long, id long, label long, n long, pos long"))
    rows = rows.withColumn("cls", F.expr(f"cast(floor(ln(n) / ln({_CLASS})) as int)"))
    by_label = rows.groupBy("item", "label").agg(F.count("*").alias("c"))
    tops = (
        by_label.groupBy("item")
        .agg(F.max_by("label", F.struct("c", "label")).alias("top"), F.count("*").alias("labels"))
        .where("labels > 1")
        .select("item", "top")
    )
    held = cut(rows.join(tops, "item"))
    low = f"greatest(cast(floor(ln({percent} * n / 100) / ln({_CLASS})) as int) - 1, 0)"
    high = f"cast(floor(ln(100 * n / {percent}) / ln({_CLASS})) as int) + 1"
    asks = (
        held.where("label != top")
        .selectExpr("item", "id as a", "label as la", "n as na", "pos as pa", f"explode(sequence({low}, {high})) as cls")
        # the smallest set of a class needs the fewest common items
        .where(f"pa <= na - {_need('na', f'cast(floor(pow({_CLASS}, cls)) as long)', percent)}")
    )
    answers = held.selectExpr("item", "cls", "id as b", "label as lb", "n as nb", "pos as pb", "label = top as largest")
    need = _need("na", "nb", percent)
    pairs = asks.join(answers, ["item", "cls"]).where(
        f"la != lb and (largest or a < b) and least(na, nb) >= {need} and pa <= na - {need} and pb <= nb - {need}"
    )
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_classes(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``members(key, id, n)``: bucket members with set sizes; ``sets(id,
    items)``.  Returns ``(id, label)`` for ids in a class of two or more,
    label = smallest id of the class (the smallest id itself is absent)."""
    hubs = members.groupBy("key").agg(F.min(F.struct("id", "n")).alias("hub"))
    pairs = (
        members.join(hubs, "key")
        .where(f"id != hub.id and 100 * least(n, hub.n) >= {percent} * greatest(n, hub.n)")
        .select(F.col("hub.id").alias("a"), F.col("id").alias("b"))
        .distinct()
    )
    stars = cut(_confirmed(pairs, sets, percent))
    # a hub has met all members of its bucket; buckets of one class have nothing left to link
    rest = _labelled(members, stars).join(
        hubs.select("key", F.col("hub.id").alias("id")), ["key", "id"], "left_anti"
    )
    left = rest.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi")
    open_ids = rest.join(left.select("key"), "key", "left_semi").groupBy("id").agg(F.first("label").alias("label"))
    open_sets = cut(sets.join(open_ids, "id"))
    edges = stars
    if not open_sets.isEmpty():
        edges = stars.union(cut(_confirmed(_prefix_pairs(open_sets, percent), sets, percent)))
    found = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return found.select(F.col("node").alias("id"), F.col("root").alias("label"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
    coords: int = COORDS,
    rows: int = ROWS,
) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` per row of ``docs``."""
    own = docs.select(id_text(id_col), F.col(text_col).cast("string").alias(text_col))
    schema = f"{id_col} string, n_shingles long, set_digest string, bands array<long>"
    base = cut(id_long(own.mapInPandas(_sketched(id_col, text_col, size, coords, rows), schema), id_col))
    reps = cut(
        base.where(F.col("set_digest").isNotNull() & F.col(id_col).isNotNull())
        .groupBy("set_digest")
        .agg(F.min(id_col).alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    )
    buckets = reps.select("id", "n", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    members = cut(buckets.join(shared.select("key"), "key", "left_semi").select("key", "id", "n"))
    wanted = members.select("id").distinct()
    texts = own.select(F.col(id_col).cast("long").alias("id"), text_col).join(wanted, "id", "left_semi")
    sets = cut(texts.mapInPandas(_sets(text_col, size), "id long, items array<long>"))
    labels = link_classes(members, sets, percent)
    classes = reps.join(labels, "id", "left").select("set_digest", F.coalesce("label", "id").alias("component_id"))
    # a row without a set gets a key of its own, so that blank texts don't meet in one task
    key = F.when(F.col(id_col).isNull(), F.concat(F.lit("-"), F.uuid())).otherwise(
        F.coalesce("set_digest", F.concat(F.lit("-"), F.col(id_col).cast("string")))
    )
    return (
        base.select(id_col, "n_shingles", key.alias("set_digest"))
        .join(classes, "set_digest", "left")
        .select(id_col, "n_shingles", F.coalesce("component_id", id_col).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
    )
