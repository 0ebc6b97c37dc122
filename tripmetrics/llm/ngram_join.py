"""Operator 11: n-gram Jaccard join as a blocked sparse matrix product.

The incidence matrix has a row per distinct set of word shingles and a column
per shingle; its product with its own transpose holds all overlap counts.
Columns are taken in one order for all sets, rare ones first (by a fixed number of
hashed counters; any order is right).  The first block of a set's columns is as
long as its size asks for: a set of n items that is linked with any other shares
one of its first n - ceil(n * percent / 100) + 1 columns with it.  The product of the
first blocks is computed sparsely, column by column, for sets of near size and columns that
leave enough columns after them in both.  The counts of a pair are added up over these
columns; pairs whose count with all that can follow is below the overlap that their two
sizes ask for are discarded, then those whose whole first blocks have too little in
common.  For the
others the product over all columns is the size of the intersection of the full sets.

A column of many sets is never squared.  Columns are cut into cells by size class
and, where the counters say that one is hot, by salt; the first ``HUBS`` sets of a cell, in
one hashed order, are its hubs.  A first product takes hubs against members only, and
what it links becomes a class.  Another round takes hubs of a column's largest class
against the sets outside it.  In the last product only sets that are still outside
the largest class ask, and no pair within a class is listed.  In both, sets whose parities
(``_parities``) differ in more bits than linked sets of their sizes differ in items do not meet.  So a group of near copies
costs a few rows per member, and columns of up to ``HUBS`` sets are multiplied whole at once.

Equal sets are one row of the matrix.  Sets are told apart by a 64-bit hash, as
are shingles.  Null or blank texts have an empty set and are linked with nothing; a
row without id is linked with nothing and has a null component.  Rows that repeat an
id are judged each by its own text.  Columns besides the id and the text are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmetrics.llm.common import Tokeniser, cut, id_long, id_text, mix, ship_package, text_chunks
from tripmetrics.llm.components import components
from tripmetrics.llm.minhash import shingle_sets

COUNTERS = 1 << 18
CELL = 50_000
HUBS = 16
ROUNDS = 1
BITS = 1 << 25
PARITY_WORDS = 4
_WORD = 1 << 15
_COLUMN = "gram long, salt int, cls int, node long, n int, pos int"


def _digest(items: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(items.tobytes()) - (1 << 63)


def _texts_to_sets(pdf: pd.DataFrame, text_col: str, size: int, words: Tokeniser) -> Iterator[tuple[int, list[np.ndarray]]]:
    for lo, hi in text_chunks(pdf[text_col]):
        yield lo, shingle_sets(pdf[text_col].iloc[lo:hi], size, words)


def _parities(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Per set ``64 * PARITY_WORDS`` bits: is the number of its items in each hashed class odd?
    Two sets that differ in d items differ in d bits at most."""
    bits = 64 * PARITY_WORDS
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    with np.errstate(over="ignore"):
        at = (mix(np.concatenate(sets) + np.uint64(1)) % np.uint64(bits)).astype(np.int64) if len(owner) else owner
    odd = (np.bincount(owner * bits + at, minlength=len(sets) * bits) & 1).astype(np.uint8)
    return list(np.packbits(odd.reshape(len(sets), bits), axis=1).view(np.int64))


def _slot(items: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(items) % np.uint64(COUNTERS)).astype(np.int64)


def _described(id_col: str, text_col: str, size: int):
    """Per text its size, hash and parities; then, in one row of each task, how often the
    shingles of the rows with an id occur, by hashed shingle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, total = Tokeniser(), np.zeros(COUNTERS, np.int64)
        for pdf in batches:
            for lo, sets in _texts_to_sets(pdf, text_col, size, words):
                ids = pdf[id_col].iloc[lo : lo + len(sets)]
                counted = [s for s, known in zip(sets, ids.notna()) if known]
                if counted:
                    total += np.bincount(_slot(np.concatenate(counted)), minlength=COUNTERS)
                yield pd.DataFrame(
                    {
                        id_col: ids.array,
                        "n_shingles": np.array([len(s) for s in sets], np.int64),
                        "node": pd.array([_digest(s) if len(s) else None for s in sets], dtype="Int64"),
                        "parity": _parities(sets),
                        "slot": None,
                        "c": None,
                    }
                )
        hit = np.flatnonzero(total)
        yield pd.DataFrame(
            {id_col: [None], "n_shingles": [0], "node": pd.array([None], dtype="Int64"), "parity": [None], "slot": [hit.astype(np.int32)], "c": [total[hit]]}
        )

    return run


def column_counts(described: DataFrame) -> np.ndarray:
    """How often shingles occur, by hashed shingle (``COUNTERS`` numbers): the tasks' counts added up."""
    each = described.where("slot IS NOT NULL").select(F.explode(F.arrays_zip("slot", "c")).alias("x"))
    out = np.zeros(COUNTERS, np.int64)
    table = each.groupBy(F.col("x.slot").alias("slot")).agg(F.sum("x.c").alias("c")).toArrow()
    out[table["slot"].to_numpy()] = table["c"].to_numpy()
    return out


def need(n1: int | str, n2: int | str, percent: int) -> int | str:
    """The overlap that two linked sets of these sizes have at least."""
    whole = 100 + percent
    if isinstance(n1, str):
        return f"(({percent} * ({n1} + {n2}) + {whole - 1}) div {whole})"
    return (percent * (n1 + n2) + whole - 1) // whole


def first_block(n: np.ndarray, percent: int) -> np.ndarray:
    """Columns of the first block of sets of these sizes."""
    return n - -(-percent * n // 100) + 1


def _blocks(text_col: str, size: int, percent: int, counts: np.ndarray):
    """Entries of the first blocks: one row per set and column."""
    ratio = np.log(100 / percent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Tokeniser()
        for pdf in batches:
            for _, sets in _texts_to_sets(pdf, text_col, size, words):
                sets = [s for s in sets if len(s)]
                if not sets:
                    continue
                sizes = np.array([len(s) for s in sets])
                owner = np.repeat(np.arange(len(sets)), sizes)
                items = np.concatenate(sets)
                often = counts[_slot(items)]
                order = np.lexsort((often, owner))  # stable, and items ascend within a set
                pos = np.arange(len(items)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                first = pos < np.repeat(first_block(sizes, percent), sizes)
                at, pos = order[first], pos[first]
                nodes = np.array([_digest(s) for s in sets], np.int64)
                node, n = nodes[owner[at]], sizes[owner[at]]
                salts = often[at] // CELL + 1
                with np.errstate(over="ignore"):
                    salt = mix(node.view(np.uint64)) % salts.astype(np.uint64)
                yield pd.DataFrame(
                    {
                        "gram": items[at].view(np.int64),
                        "salt": np.where(salts > 1, salt.astype(np.int64) + 1, 0).astype(np.int32),
                        "cls": np.floor(np.log(n) / ratio + 1e-9).astype(np.int32),
                        "node": node,
                        "n": n.astype(np.int32),
                        "pos": pos.astype(np.int32),
                    }
                )

    return run


def _early(percent: int) -> str:
    """Near sizes, and a common column so early in both sets that enough columns follow."""
    least = need("na", "nb", percent)
    return f"100 * least(na, nb) >= {percent} * greatest(na, nb) and pa <= na - {least} and pb <= nb - {least}"


def _accumulated(pairs: DataFrame, percent: int) -> DataFrame:
    """Add up a pair's early columns and keep the pairs that can reach their overlap: the
    columns met so far and all that follow the last of them in the shorter rest."""
    summed = pairs.groupBy("a", "b").agg(
        F.first("na").alias("na"), F.first("nb").alias("nb"), F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.count("*").alias("common"))
    return summed.where(f"common + least(na - pa, nb - pb) - 1 >= {need('na', 'nb', percent)}").select("a", "b")


def _blocks_met(pairs: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """The pairs whose first blocks have so much in common that, with the most the
    columns after them can add, the overlap can be reached.  ``blocks(node, n, grams)``
    holds the shared columns; others are of one set."""
    left = blocks.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("grams").alias("xs"))
    right = blocks.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("ys"))
    common = F.size(F.array_intersect("xs", "ys")).alias("common")
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", common)

    def rest(n: str) -> str:
        return f"(({percent} * {n} + 99) div 100 - 1)"

    return met.where(f"common + greatest({rest('na')}, {rest('nb')}) >= {need('na', 'nb', percent)}").select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are linked: the product over all their columns."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("xs"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("ys"))
    both = F.size(F.array_intersect("xs", "ys")).alias("both")
    sizes = pairs.join(left, "a").join(right, "b").select("a", "b", F.size("xs").alias("na"), F.size("ys").alias("nb"), both)
    return sizes.where(f"both >= {need('na', 'nb', percent)}").select("a", "b")


def _bit() -> Column:
    return F.pmod(F.xxhash64(F.col("id").cast("long")), F.lit(BITS))


def _bitmap(ids: DataFrame) -> np.ndarray:
    """Hashed ids as a bitmap of ``BITS`` bits, whatever their number."""
    rows = (
        ids.select(_bit().alias("bit"))
        .groupBy((F.expr(f"bit div {_WORD}")).alias("part"))
        .agg(F.bitmap_construct_agg(F.expr(f"bit % {_WORD}")).alias("bits"))
        .collect()
    )
    out = np.zeros(BITS // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(r["bits"], np.uint8)
        out[r["part"] * (_WORD // 8) :][: len(part)] = part
    return out


def _sets_of(docs: DataFrame, id_col: str, text_col: str, size: int, wanted: DataFrame) -> DataFrame:
    """``(node, items)`` of the nodes of ``wanted(node, id)``, from one text each.
    A bitmap of the ids drops other texts where they are read."""
    bits = _bitmap(wanted)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Tokeniser()
        for pdf in batches:
            bit = pdf["bit"].to_numpy()
            pdf = pdf[(bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1]
            for _, sets in _texts_to_sets(pdf, text_col, size, words):
                sets = [s for s in sets if len(s)]
                yield pd.DataFrame({"node": np.array([_digest(s) for s in sets], np.int64), "items": [s.view(np.int64) for s in sets]})

    texts = docs.select(F.col(id_col).alias("id"), text_col).select(_bit().alias("bit"), text_col)
    sets = texts.mapInPandas(run, "node long, items array<long>")
    return sets.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _pair(a: str, b: str) -> list[Column]:
    """The pair in one order, with sizes and positions."""
    swap = F.expr(f"{a}.node > {b}.node")
    out = []
    for name, field in (("", "node"), ("n", "n"), ("p", "pos")):
        x, y = F.col(f"{a}.{field}"), F.col(f"{b}.{field}")
        out += [F.when(swap, y).otherwise(x).alias(f"{name}a"), F.when(swap, x).otherwise(y).alias(f"{name}b")]
    return out


def _rank(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("node"))


def _entry(name: str, *more: str) -> Column:
    return F.struct("node", "n", "pos", *more).alias(name)


def _can_link(percent: int) -> str:
    """Near sizes, and no more unequal parities than linked sets of these sizes have items
    that only one of them holds."""
    unequal = " + ".join(f"bit_count(x.parity[{k}] ^ y.parity[{k}])" for k in range(PARITY_WORDS))
    return (f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) and "
            f"{unequal} <= x.n + y.n - 2 * {need('x.n', 'y.n', percent)}")


def _star_pairs(cells: DataFrame) -> DataFrame:
    """Hubs against members within the cells of a size class, then between the
    first hubs of a column's salted cells."""
    key = ["gram", "salt", "cls"]
    hubs = cells.where(f"rank <= {HUBS}").select(*key, _entry("x"), F.col("rank").alias("first"))
    inner = cells.select(*key, _entry("y"), "rank").join(hubs, key).where("first < rank")
    firsts = cells.where("rank = 1 and salt > 0").select("gram", "cls", _entry("y"))
    heads = firsts.groupBy("gram", "cls").agg(F.min("y").alias("x"))
    outer = firsts.join(heads, ["gram", "cls"]).where("x.node != y.node")
    return inner.select(*_pair("x", "y")).union(outer.select(*_pair("x", "y")))


def _largest_class_pairs(held: DataFrame, seed: int, percent: int) -> DataFrame:
    """Some sets of a column's largest class against all sets outside it."""
    order = Window.partitionBy("gram").orderBy(_rank(seed), "node")
    hubs = held.where("label = top").withColumn("rank", F.row_number().over(order)).where(f"rank <= {HUBS}")
    outside = held.where("label != top").select("gram", _entry("y", "parity"))
    return outside.join(hubs.select("gram", _entry("x", "parity")), "gram").where(_can_link(percent)).select(*_pair("x", "y"))


def _labelled(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    found = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return nodes.join(found, nodes["node"] == found["node"], "left").select(nodes["node"], F.coalesce("root", nodes["node"]).alias("label"))


def _open_cells(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """Cells of columns that hold several classes, with the largest class of each
    and the parities of the sets (``labels(node, label, parity)``)."""
    held = cells.select("gram", "cls", "node", "n", "pos").join(labels, "node")
    by_label = held.groupBy("gram", "label").agg(F.count("*").alias("c"))
    tops = (
        by_label.groupBy("gram")
        .agg(F.max_by("label", F.struct("c", "label")).alias("top"), F.count("*").alias("labels"))
        .where("labels > 1")
        .select("gram", "top")
    )
    return held.join(tops, "gram")


def _class_pairs(held: DataFrame, percent: int) -> DataFrame:
    """The columns' products between classes: who is outside a column's largest
    class asks the sets of its size class and the next ones."""
    asks = held.where("label != top").select(
        "gram", _entry("x", "parity"), F.col("label").alias("lx"),
        F.explode(F.expr("sequence(cls - 1, cls + 1)")).alias("cls"))
    answers = held.select("gram", "cls", _entry("y", "parity"), F.col("label").alias("ly"), F.expr("label = top").alias("largest"))
    # two sets that both ask meet once
    met = asks.join(answers, ["gram", "cls"]).where(
        f"lx != ly and (largest or x.node < y.node) and {_can_link(percent)}")
    return met.select(*_pair("x", "y"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``(id_col, n_shingles, component_id)`` per row of ``docs``."""
    ship_package(docs.sparkSession)
    own = docs.select(id_text(id_col), F.col(text_col).cast("string").alias(text_col))
    schema = f"{id_col} string, n_shingles long, node long, parity array<long>, slot array<int>, c array<long>"
    told = cut(id_long(own.mapInPandas(_described(id_col, text_col, size), schema), id_col))
    base = told.where("slot IS NULL").drop("slot", "c")
    named = own.where(F.col(id_col).isNotNull())
    described = base.where(F.col("node").isNotNull() & F.col(id_col).isNotNull())
    reps = described.groupBy("node").agg(F.min(id_col).alias("id"))
    parities = described.select("node", "parity").dropDuplicates(["node"])
    counts = column_counts(told)
    entries = named.select(text_col).mapInPandas(_blocks(text_col, size, percent, counts), _COLUMN)
    # equal sets fall together here; a column of one set is of no use
    once = entries.repartition("gram", "salt").groupBy("gram", "salt", "cls", "node").agg(F.first("n").alias("n"), F.first("pos").alias("pos"))
    cell = once.withColumn("hash", _rank(0)).selectExpr(
        "*", "row_number() over (partition by gram, salt, cls order by hash, node) as rank",
        "min(node) over (partition by gram, salt) as lo", "max(node) over (partition by gram, salt) as hi")
    cells = cut(cell.where("lo != hi or salt > 0").drop("lo", "hi", "hash"))

    blocks = cells.groupBy("node").agg(F.first("n").alias("n"), F.collect_list("gram").alias("grams"))

    def linked(pairs: DataFrame) -> DataFrame:
        early = cut(_accumulated(pairs.where(_early(percent)), percent))
        found = cut(_blocks_met(early, blocks, percent))
        wanted = cut(reps.join(found.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi"))
        return cut(_confirmed(found, _sets_of(named, id_col, text_col, size, wanted), percent))

    links, held = linked(_star_pairs(cells)), cells
    for seed in range(1, ROUNDS + 1):
        held = cut(_open_cells(held, _labelled(held.select("node").distinct(), links).join(parities, "node")))
        links = links.union(linked(_largest_class_pairs(held, seed, percent)))
    held = cut(_open_cells(held, _labelled(held.select("node").distinct(), links).join(parities, "node")))
    links = links.union(linked(_class_pairs(held, percent)))
    found = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    rooted = reps.join(found, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = rooted.join(least, "root").select("node", "component_id")
    # rows without a set or an id are kept apart, so that they do not meet in one task
    lone = F.col("node").isNull() | F.col(id_col).isNull()
    alone = base.where(lone).select(id_col, "n_shingles", F.col(id_col).alias("component_id"))
    return base.where(~lone).join(classes, "node").select(id_col, "n_shingles", "component_id").union(alone)
