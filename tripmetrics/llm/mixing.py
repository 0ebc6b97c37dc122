"""Operator 6: mixing sources to target weights.

The words of a source, its documents in a fixed pseudorandom order, form one
stream that is cut into blocks of ``block_words`` (the last one may be shorter).
Targets share the words of all sources by weight; a target stops at ``cap``
times its source's size and the excess is shared again by weight.  A source
gets as many output slots as blocks of its mean length meet its target.  How many
slots of an output shard go to which source is drawn down a tree over the shards: a
range of shards draws what its first half holds, a multinomial draw with its slots as weights,
cut at what there is and drawn again for the rest, and the other half has what remains.  So
all shards together give every source exactly its slots, and each task draws its own
shards from the root down: no list of shards exists anywhere.  Slot j of
a source takes block perm(j mod n) of its n blocks, where perm is a keyed
Feistel permutation for the pass j div n: within a pass no block repeats, so no
document is taken more than ``cap`` times.  Slots and blocks are joined by index.

Everything is seeded, so runs agree.  The order inside a source is that of hashed ids (without
an id, of source and text); running sums over slices of the hashes need no task to see a whole source.
Only the table of sources (name, size) comes to the driver.

Null text counts as empty; a document without words has nothing to take.
A null source is a source of its own, ordered last.  Rows that repeat an id
are rows of their own.  Weights repeat over the sources in code point order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import cut, mix

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK_WORDS = 128
SHARD_BLOCKS = 65_536
_SLICE_BITS = 10
_BROADCAST_ROWS = 10_000
_TASK_SLOTS = 200_000
_TASK_SHARDS = 16
_WORD = r"[^\\x20\\x09-\\x0D]+"


class Mix(NamedTuple):
    """``documents(doc_id, size, source_size, target, taken)``, ``pieces`` (one row per
    document and block it overlaps, with the block's passes) and ``slots`` (shard,
    source index, pass, block)."""

    documents: DataFrame
    pieces: DataFrame
    slots: DataFrame


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> list[Fraction]:
    """Target of each source, in order; capped sources hand their excess on."""
    total = Fraction(sum(sizes))
    weight = [Fraction(weights[k % len(weights)]) for k in range(len(sizes))]
    out: list[Fraction | None] = [None] * len(sizes)
    while True:
        free = [k for k, t in enumerate(out) if t is None]
        if not free:
            break
        rest = total - sum(t for t in out if t is not None)
        share = rest / sum(weight[k] for k in free)
        over = [k for k in free if share * weight[k] > cap * sizes[k]]
        if not over:
            for k in free:
                out[k] = share * weight[k]
            break
        for k in over:
            out[k] = Fraction(cap * sizes[k])
    return out


def _draw(have: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """n slots drawn from ``have``: multinomial, cut at what there is and drawn again for the rest."""
    counts = np.zeros(len(have), np.int64)
    while short := int(n - counts.sum()):
        rest = have - counts
        counts += np.minimum(rng.multinomial(short, rest / rest.sum()), rest)
    return counts


def shard_counts(
    slots: list[int], shard_blocks: int, seed: int, low: int = 0, high: int | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(shard, slots of each source, slots of each source in earlier shards)`` of the output shards
    ``low`` to ``high`` - 1.  Draws form a tree over the shards: a range of shards draws what
    its first half holds, the second half has the rest.  A draw depends on the seed and its range alone, so any part
    of the tree can be walked by itself."""
    n = -(-sum(slots) // shard_blocks)
    high = n if high is None else high
    none = np.zeros(len(slots), np.int64)
    todo = [(0, n, np.array(slots, np.int64), none)] if n else []
    while todo:
        a, b, have, before = todo.pop()
        if b <= low or a >= high:
            continue
        if b - a == 1:
            yield a, have, before
            continue
        mid = (a + b) // 2
        first = _draw(have, (mid - a) * shard_blocks, np.random.default_rng([seed, a, b]))
        todo += [(mid, b, have - first, before + first), (a, mid, first, before)]


def _drawn_shards(slots: list[int], n_blocks: list[int], shard_blocks: int, seed: int):
    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for low in pdf["id"]:
                for shard, counts, before in shard_counts(slots, shard_blocks, seed, low, low + _TASK_SHARDS):
                    src = np.flatnonzero(counts)
                    yield pd.DataFrame(
                        {"shard": shard, "src": src, "n_blocks": np.array(n_blocks)[src], "first": before[src], "count": counts[src]}
                    )

    return drawn


def permute(place: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keyed pseudorandom permutation of 0..n-1 at ``place`` (element-wise)."""
    half = np.ceil(np.log2(np.maximum(n, 2).astype(np.float64)) / 2 + 1e-9).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = place.astype(np.uint64)
    todo = np.arange(len(out))
    key = key.astype(np.uint64)
    with np.errstate(over="ignore"):
        while len(todo):
            x, m, h, k = out[todo], mask[todo], half[todo], key[todo]
            left, right = x >> h, x & m
            for turn in range(4):
                left, right = right, left ^ (mix(mix(right + k) ^ np.uint64(turn + 1)) & m)
            x = (left << h) | right
            out[todo] = x
            todo = todo[x >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _blocks(seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            with np.errstate(over="ignore"):
                key = mix(mix(pdf["src"].to_numpy().astype(np.uint64) + np.uint64(seed)) + pdf["turn"].to_numpy().astype(np.uint64))
            block = permute(pdf["place"].to_numpy(), pdf["n_blocks"].to_numpy(), key)
            yield pdf[["shard", "src", "slot", "turn"]].assign(block=block)

    return run


def _tie() -> Column:
    """Tells rows of one id apart: by source and text."""
    source = F.col("source").cast("string")
    return F.xxhash64(F.coalesce(source, F.lit("")), source.isNull(), F.col("text").cast("string"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = 20,
) -> Mix:
    """Mix ``docs(doc_id, source, text)``."""
    spark = docs.sparkSession
    sized = cut(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.expr(f"cast(coalesce(regexp_count(text, '{_WORD}'), 0) as long)").alias("size"),
            _tie().alias("tie"),
        )
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs")).collect()
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    goal = targets([r["words"] for r in totals], weights, cap)
    n_blocks = [-(-r["words"] // block_words) for r in totals]
    slots = [
        min(math.floor(g * n / r["words"] + Fraction(1, 2)), cap * n) if n else 0
        for g, n, r in zip(goal, n_blocks, totals, strict=True)
    ]
    # from Arrow columns: a list of rows would start Python workers of another kind, beside those of the other steps
    columns = {
        "src": pa.array(range(len(totals)), pa.int32()),
        "source": pa.array([r["source"] for r in totals], pa.string()),
        "source_size": pa.array([r["words"] for r in totals], pa.int64()),
        "target": pa.array([float(g) for g in goal], pa.float64()),
        "n_blocks": pa.array(n_blocks, pa.int64()),
    }
    table = spark.createDataFrame(pa.table(columns))
    small = F.broadcast(table) if len(totals) <= _BROADCAST_ROWS else table
    # slices are cuts of the order by hash, so their number changes no result
    bits = max(_SLICE_BITS, (sum(r["docs"] for r in totals) // 100_000).bit_length())
    place = f"xxhash64(doc_id, {seed}, case when doc_id is null then tie end)"

    named = sized.join(small.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "size", "tie", "src", "source_size", "target", F.expr(place).alias("place")
    ).withColumn("slice", F.expr(f"shiftright(place, {64 - bits})"))
    filled = named.where("size > 0")
    parts = filled.groupBy("src", "slice").agg(F.sum("size").alias("part"))
    bases = parts.selectExpr("src", "slice", "sum(part) over (partition by src order by slice) - part as base")
    placed = filled.selectExpr(
        "*", "sum(size) over (partition by src, slice order by place, doc_id, tie rows unbounded preceding) - size as own"
    ).join(bases, ["src", "slice"]).selectExpr("doc_id", "tie", "size", "src", "source_size", "target", "base + own as start")
    pieces = placed.selectExpr(
        "*", f"explode(sequence(start div {block_words}, (start + size - 1) div {block_words})) as block"
    ).selectExpr(
        "*",
        f"greatest(block * {block_words} - start, 0) as lo",
        f"least((block + 1) * {block_words} - start, size) as hi",
    )

    n_shards = -(-sum(slots) // shard_blocks)
    ranges = spark.range(0, n_shards, _TASK_SHARDS, max(1, -(-n_shards // _TASK_SHARDS)))
    drawn = ranges.mapInPandas(
        _drawn_shards(slots, n_blocks, shard_blocks, seed), "shard long, src int, n_blocks long, first long, count long"
    )
    # a shard's slots are listed in steps, so that no one task lists a large share
    step = 4096
    steps = drawn.selectExpr("*", f"explode(sequence(0L, count - 1, {step}L)) as skip").repartition(
        max(1, sum(slots) // _TASK_SLOTS), "shard", "src", "skip"
    )
    slot_rows = steps.selectExpr(
        "shard", "src", "n_blocks", f"explode(sequence(first + skip, first + least(skip + {step}, count) - 1)) as slot"
    ).selectExpr("shard", "src", "n_blocks", "slot", "slot div n_blocks as turn", "slot % n_blocks as place")
    slot_table = slot_rows.mapInPandas(_blocks(seed), "shard long, src int, slot long, turn long, block long")
    times = slot_table.groupBy("src", "block").agg(F.collect_list("turn").alias("turns"))
    # the planner takes the listed slots for a small table; they are as many as the blocks
    pieces = pieces.join(times.hint("merge"), ["src", "block"], "left")
    taken = pieces.groupBy("src", "start", "doc_id", "size", "source_size", "target").agg(
        F.sum(F.expr("(hi - lo) * coalesce(size(turns), 0)")).alias("taken")
    )
    out = ["doc_id", "size", "source_size", "target", "taken"]
    blank = named.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return Mix(taken.select(*out).union(blank.select(*out)), pieces, slot_table)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: one row per document and pass with the words taken
    in that pass (the text unchanged where a pass takes all of them).  Of rows
    with the same id, source and text one gives the text to all."""
    pieces = mix_sources(docs, **options).pieces
    cuts = (
        pieces.where("turns is not null")
        .selectExpr("doc_id", "tie", "src", "start", "lo", "hi", "explode(turns) as turn")
        .groupBy("doc_id", "tie", "src", "start", "turn")
        .agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("cuts"))
        .groupBy(F.xxhash64("doc_id", "tie").alias("_mix_key"), F.col("doc_id").alias("_mix_id"))
        .agg(F.collect_list("cuts").alias("_mix_passes"))
    )
    row = F.xxhash64(F.col("doc_id").cast("long"), _tie())
    texts = docs.withColumn("_mix_row", row).dropDuplicates(["_mix_row", "doc_id"])
    # the words of a document, its spans joined back in the order of the text
    words = f"regexp_extract_all(text, '{_WORD}', 0)"
    text = (
        f"case when aggregate(_mix_pass, 0L, (n, c) -> n + c.hi - c.lo) = regexp_count(text, '{_WORD}') then text else "
        f"array_join(flatten(transform(_mix_pass, c -> slice({words}, int(c.lo) + 1, int(c.hi - c.lo)))), ' ') end"
    )
    return (
        texts.join(cuts, (texts["_mix_row"] == cuts["_mix_key"]) & texts["doc_id"].eqNullSafe(cuts["_mix_id"]))
        .withColumn("_mix_pass", F.explode("_mix_passes"))
        .withColumn("text", F.expr(text))
        .withColumn("n_chars", F.length("text").cast("long"))
        .select(*docs.columns)
    )
