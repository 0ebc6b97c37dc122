"""Operator 12: grouping of spelling variants with a frequency-vector trie.

A word is described by how often each letter group occurs in it, the
groups in one order.  Words arranged by these counts, one group per level, form a trie.  An
insertion makes one count larger by one, a deletion smaller, and a replacement does
both (or neither, within a group).  So a depth-first search that may spend a surplus
and a deficit of one each meets every word at one edit.  The first difference
must be a surplus of the asking word: then each pair is met from one side
only.  Where few words are left in a subtree, the parities of all letter
counts are compared at once, and words that pass are verified on their letters (common
beginning and end).

Spark holds the trie in shards: subtrees of up to ``SHARD`` words.  A
bitmap of fixed size says which nodes are cut further; words and searches use the
same one, so a bit too many only makes shards smaller.  A word goes to its own shard and
asks in every shard that its budget reaches.  A task streams the searches of a
shard past its words, and hands on one partial result per word.  Subtrees that the last
cutting level leaves too large are dealt in blocks, each of which is asked.

Words are maximal runs of ASCII letters and U+00C0 to U+00FF, A-Z lowered; where ``damage`` divides
the crc32 of ``<doc_id>:<run>`` the run loses its code point at crc32 mod length.
A null id counts as empty text, a null text has no words, and rows that repeat an
id are counted each.  Columns besides the id and the text are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import cut, mix, ship_package

SHARD = 8192
LEAF = 24
FIRST_LEVEL, LAST_LEVEL = 4, 16
BITS = 1 << 22
_WORD = 1 << 15
_ASK = 1 << 16
_PAIR_BYTES = 1 << 23
# letters that vary much come first; code points beyond share the last groups
_LETTERS = "enatiohrslucdgbfmzwqyvpxkj"
LEVELS = len(_LETTERS) + 6
_GROUP = np.array([_LETTERS.find(chr(b)) if chr(b) in _LETTERS else len(_LETTERS) + b % 6 for b in range(256)], np.int64)
_PARITY = np.array([1 << (b - 97 if 97 <= b < 123 else 26 + b % 38) for b in range(256)], np.uint64)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shortest: int = 7, least: int = 2, damage: int = 31) -> DataFrame:
    """``(word, n)`` of the words of at least ``shortest`` code points."""
    low = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # greedy runs begin where a run begins, so runs of at least that length are whole
    runs = F.regexp_extract_all(low, F.lit(rf"([a-zÀ-ÿ]{{{shortest},}})"), F.lit(1))
    own = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id")
    rows = docs.select(own, F.explode(runs).alias("run")).selectExpr("run", "crc32(concat(id, ':', run)) as h")
    cut_out = "concat(substring(run, 1, cast(h % length(run) as int)), substring(run, cast(h % length(run) as int) + 2))"
    words = rows.selectExpr(f"case when h % {damage} = 0 then {cut_out} else run end as word")
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(f"n >= {least}")


class Words:
    """Some words: their bytes (Latin-1), letter-group counts and parities."""

    def __init__(self, words: list[str], n: np.ndarray) -> None:
        parts = [w.encode("latin-1") for w in words]
        self.words, self.n = words, n
        self.size = np.array([len(p) for p in parts], np.int64)
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.start = np.cumsum(self.size) - self.size
        owner = np.repeat(np.arange(len(parts)), self.size)
        counts = np.bincount(owner * LEVELS + _GROUP[self.data], minlength=len(parts) * LEVELS)
        self.counts = counts.reshape(len(parts), LEVELS)
        self.parity = np.zeros(len(parts), np.uint64)
        if len(parts):
            self.parity = np.bitwise_xor.reduceat(_PARITY[self.data], self.start)

    def __len__(self) -> int:
        return len(self.words)

    def letters(self, at: np.ndarray, width: int, back: bool) -> np.ndarray:
        """The words at these places as rows, from the front or from the back."""
        step = np.arange(width)
        size = self.size[at, None]
        place = self.start[at, None] + (size - 1 - step if back else step)
        return np.where(step < size, self.data[np.clip(place, 0, len(self.data) - 1)], 0)


def _key(counts: np.ndarray, depth: int) -> np.ndarray:
    """Hash of the first counts."""
    with np.errstate(over="ignore"):
        out = np.full(len(counts), depth, np.uint64)
        for j in range(depth):
            out = mix(out ^ counts[:, j].astype(np.uint64))
    return out >> np.uint64(1)


def _is_cut(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    bit = (key % np.uint64(BITS)).astype(np.int64)
    return (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def own_nodes(counts: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shard and depth of words."""
    depth = np.full(len(counts), FIRST_LEVEL)
    key = _key(counts, FIRST_LEVEL)
    for d in range(FIRST_LEVEL, LAST_LEVEL):
        more = (depth == d) & _is_cut(bits, key)
        key[more] = _key(counts[more], d + 1)
        depth[more] = d + 1
    return key, depth


def reached_nodes(counts: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, shard and depth of all searches: the budget spent level by level."""
    who, spent = np.arange(len(counts)), np.zeros(len(counts), np.int8)
    path = np.zeros((len(counts), LAST_LEVEL), np.int64)
    out = []
    for d in range(LAST_LEVEL):
        own = counts[who, d]
        less, more = (spent == 0) & (own > 0), spent == 1
        rows = np.concatenate([np.arange(len(who)), np.flatnonzero(less), np.flatnonzero(more)])
        step = np.repeat([0, -1, 1], [len(who), less.sum(), more.sum()])
        path = path[rows]
        path[:, d] = own[rows] + step
        who, spent = who[rows], spent[rows] + (step != 0)
        if d + 1 >= FIRST_LEVEL:
            key = _key(path, d + 1)
            on = _is_cut(bits, key) if d + 1 < LAST_LEVEL else np.zeros(len(key), bool)
            out.append((who[~on], key[~on], np.full((~on).sum(), d + 1)))
            who, spent, path = who[on], spent[on], path[on]
    return tuple(np.concatenate(x) for x in zip(*out))


def one_edit(a: Words, x: np.ndarray, b: Words, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs ``a[x], b[y]``, ``a`` of the same length or one longer:
    whether one edit apart, and whether ``a`` has the greater letter where they differ."""
    good, greater = np.zeros(len(x), bool), np.zeros(len(x), bool)
    order = np.argsort(a.size[x], kind="stable")
    lo = 0
    while lo < len(order):
        hi = lo + 1
        step = max(1, _PAIR_BYTES // int(a.size[x[order[lo]]]))
        hi = min(len(order), lo + step)
        while hi - lo > 1 and (hi - lo) * int(a.size[x[order[hi - 1]]]) > 2 * _PAIR_BYTES:
            hi = lo + (hi - lo) // 2
        at = order[lo:hi]
        width = int(a.size[x[at[-1]]])
        same = b.size[y[at]]
        front_a, front_b = a.letters(x[at], width, False), b.letters(y[at], width, False)
        differ = front_a != front_b
        first = np.where(differ.any(1), differ.argmax(1), width)
        differ = a.letters(x[at], width, True) != b.letters(y[at], width, True)
        last = np.where(differ.any(1), differ.argmax(1), width)
        longer = a.size[x[at]] - same
        good[at] = np.where(longer == 0, first + last == same - 1, np.minimum(first, same) + np.minimum(last, same) >= same)
        spot = np.minimum(first, width - 1)
        rows = np.arange(len(at))
        greater[at] = front_a[rows, spot] > front_b[rows, spot]
        lo = hi
    return good, greater


class Trie:
    """The words of a shard in the order of their counts; nodes are ranges."""

    def __init__(self, words: Words) -> None:
        order = np.lexsort(words.counts.T[::-1])
        self.words, self.order = words, order
        self.counts, self.parity, self.size = words.counts[order], words.parity[order], words.size[order]

    def search(self, ask: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``(asking word, word)`` of all pairs at one edit, each pair from one side."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        self._visit(ask, 0, len(self.order), 0, np.arange(len(ask)), np.zeros(len(ask), np.int8), found)
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        x, y = (np.concatenate(f) for f in zip(*found))
        y = self.order[y]
        good, greater = one_edit(ask, x, self.words, y)
        x, y, greater = x[good], y[good], greater[good]
        gap = ask.counts[x] - self.words.counts[y]
        first = gap[np.arange(len(x)), (gap != 0).argmax(1)]
        # a pair is met from the side of the first surplus, with equal counts of the greater letter
        own = (first > 0) | ((first == 0) & greater)
        return x[own], y[own]

    def _visit(self, ask: Words, lo: int, hi: int, depth: int, who: np.ndarray, spent: np.ndarray, found: list) -> None:
        if hi - lo <= LEAF or depth == LEVELS:
            for part in range(lo, hi, LEAF):
                end = min(hi, part + LEAF)
                odd = np.bitwise_count(ask.parity[who, None] ^ self.parity[None, part:end]) <= 2
                longer = ask.size[who, None] - self.size[None, part:end]
                i, j = np.nonzero(odd & ((longer == 0) | (longer == 1)))
                if len(i):
                    found.append((who[i], part + j))
            return
        column = self.counts[lo:hi, depth]
        edges = np.r_[0, np.flatnonzero(np.diff(column)) + 1, hi - lo]
        own = ask.counts[who, depth]
        for start, end in zip(edges[:-1], edges[1:]):
            gap = own - column[start]
            goes = (gap == 0) | ((gap == 1) & (spent == 0)) | ((gap == -1) & (spent == 1))
            if goes.any():
                self._visit(ask, lo + start, lo + end, depth + 1, who[goes], (spent + (gap != 0))[goes], found)


def _best(who: np.ndarray, near: np.ndarray, words: Words, n: np.ndarray, names: list[str]) -> pd.DataFrame:
    """Per word: its near words seen here, and the most frequent one."""
    label = np.array(names, object)[near]
    ties = pd.DataFrame({"who": who, "m": -n[near], "form": label}).sort_values(["who", "m", "form"], kind="stable")
    top = ties.groupby("who", sort=True).agg(n_near=("m", "size"), m=("m", "first"), form=("form", "first"))
    return pd.DataFrame({"word": np.array(words.words, object)[top.index.to_numpy()], "n_near": top["n_near"].to_numpy(), "m": -top["m"].to_numpy(), "form": top["form"].to_numpy()})


def _routed(bits: np.ndarray, blocks: np.ndarray):
    """Words to their shards (kind 0) and to the shards where they ask (kind 1)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            names, n = pdf["word"].to_numpy(object), pdf["n"].to_numpy()
            words = Words(list(names), n)
            key, depth = own_nodes(words.counts, bits)
            deep = np.where(depth == LAST_LEVEL, blocks[(key % np.uint64(len(blocks))).astype(np.int64)], 1)
            block = np.arange(len(names)) % deep
            yield pd.DataFrame({"shard": key.view(np.int64), "block": block, "kind": 0, "word": names, "n": n})
            who, key, depth = reached_nodes(words.counts, bits)
            deep = np.where(depth == LAST_LEVEL, blocks[(key % np.uint64(len(blocks))).astype(np.int64)], 1)
            rows = np.repeat(np.arange(len(who)), deep)
            block = np.arange(len(rows)) - np.repeat(np.cumsum(deep) - deep, deep)
            yield pd.DataFrame({"shard": key[rows].view(np.int64), "block": block, "kind": 1, "word": names[who[rows]], "n": n[who[rows]]})

    return run


def _runs(pdf: pd.DataFrame) -> Iterator[tuple[tuple, pd.DataFrame]]:
    keys = pdf[["shard", "block", "kind"]].to_numpy()
    edges = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, len(pdf)]
    for lo, hi in zip(edges[:-1], edges[1:]):
        if hi > lo:
            yield tuple(keys[lo]), pdf.iloc[lo:hi]


def _searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by shard, block and kind: the words of a shard are kept,
    those who ask stream past."""
    place, kept, asking, waiting, trie = None, [], [], 0, None

    def ask() -> Iterator[pd.DataFrame]:
        nonlocal asking, waiting, trie
        if kept and asking:
            if trie is None:
                both = pd.concat(kept)
                trie = Trie(Words(both["word"].tolist(), both["n"].to_numpy()))
            rows = pd.concat(asking)
            who = Words(rows["word"].tolist(), rows["n"].to_numpy())
            x, y = trie.search(who)
            if len(x):
                yield _best(x, y, who, trie.words.n, trie.words.words)
                yield _best(y, x, trie.words, who.n, who.words)
        asking, waiting = [], 0

    for pdf in batches:
        for (shard, block, kind), rows in _runs(pdf):
            if (shard, block) != place:
                yield from ask()
                place, kept, trie = (shard, block), [], None
            if kind == 0:
                kept.append(rows)
            elif kept:
                asking.append(rows)
                waiting += len(rows)
                if waiting >= _ASK:
                    yield from ask()
    yield from ask()


def _cut_nodes(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bitmap of the trie nodes that hold more than ``SHARD`` words, and the
    number of blocks of last-level nodes (fixed numbers of counters)."""
    bits, blocks = np.zeros(BITS // 8, np.uint8), np.ones(1 << 12, np.int64)

    def keys(depth: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    counts = Words(pdf["word"].tolist(), pdf["n"].to_numpy()).counts
                    key, at = own_nodes(counts, bits)
                    yield pd.DataFrame({"key": key[at == depth].view(np.int64)})

        return run

    for depth in range(FIRST_LEVEL, LAST_LEVEL + 1):
        large = words.mapInPandas(keys(depth), "key long").groupBy("key").agg(F.count("*").alias("c")).where(f"c > {SHARD}")
        if depth == LAST_LEVEL:
            for r in large.groupBy((F.col("key") % len(blocks)).alias("slot")).agg(F.sum("c").alias("c")).collect():
                blocks[r["slot"]] = r["c"] // SHARD + 1
            break
        bit = F.col("key") % BITS
        parts = large.groupBy((bit - bit % _WORD).alias("from")).agg(F.bitmap_construct_agg(bit % _WORD).alias("bits")).collect()
        if not parts:
            break
        for r in parts:
            part = np.frombuffer(r["bits"], np.uint8)
            bits[r["from"] // 8 :][: len(part)] |= part
    return bits, blocks


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, m, form)`` of the words of ``words(word, n)`` that have near words:
    their number, and the most frequent one with its n (ties: the smallest)."""
    ship_package(words.sparkSession)
    bits, blocks = _cut_nodes(words)
    routed = words.mapInPandas(_routed(bits, blocks), "shard long, block long, kind int, word string, n long")
    dealt = routed.repartition("shard", "block").sortWithinPartitions("shard", "block", "kind")
    partial = dealt.mapInPandas(_searched, "word string, n_near long, m long, form string")
    return partial.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "form")).alias("best")
    ).select("word", "n_near", (-F.col("best.m")).alias("m"), "best.form")


def variant_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, ratio: int = 10, shortest: int = 7,
                   least: int = 2, damage: int = 31) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``: a word's form is its most
    frequent near word if that occurs ``ratio`` times as often at least, its root the end of
    the forms' chain."""
    words = cut(word_counts(docs, id_col, text_col, shortest=shortest, least=least, damage=damage))
    near = words.join(near_words(words), "word", "left")
    has = F.expr(f"m >= {ratio} * n")
    out = cut(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                          F.when(has, F.col("form")).alias("form"), F.when(has, F.col("m")).alias("form_n")))
    links = cut(out.where("form is not null").select(F.col("word").alias("from"), F.col("form").alias("to")))
    roots = links.select(F.col("from").alias("word"), F.col("to").alias("root"))
    while True:  # n grows by the ratio with each step
        step = cut(roots.join(links, F.col("root") == F.col("from"), "left").select("word", F.coalesce("to", "root").alias("root"), "to"))
        roots = step.select("word", "root")
        if step.where("to is not null").isEmpty():
            break
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
