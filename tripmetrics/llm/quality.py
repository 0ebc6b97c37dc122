"""Operator 2: quality rules as a learned decision list.

Statistics of each text are SQL expressions.  From the statistics of labelled
documents sequential covering learns rules that reject: a rule starts empty and
grows by the threshold condition with the best gain (rejected against kept
documents among those that the rule covers and no earlier rule does), is
pruned to the prefix that does best on rows held out of the growing, and is
accepted if it is precise on these.  Rows that it covers go, and the next rule
is grown.  Every step is one aggregation of counts by statistic and threshold
bin; only these counts (statistics x bins) come to the driver.  The rules end up
as one ordered conditional expression.

Only DataFrame and SQL functions are used.  Null and empty texts have no words and
fail the base rules.  Labels without a document, documents without a label and null
labels teach nothing; without any usable label no rule is learned.  A text label
that repeats an id counts each time.  Columns besides id and text are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import cut

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BINS = 32
MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_PRECISION = 0.85
_SEP = r"[\\x20\\x09-\\x0D]+"
_BLANKS = "' \\t\\n\\u000b\\u000c\\r'"
_SYMBOLS = "'#*$%&|<>'"
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"

#: the statistics that conditions test, from the counts of ``text_counts``
STATISTICS = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "n_words": "cast(n_words as double)",
}


class Condition(NamedTuple):
    statistic: str
    above: bool
    bound: float

    def expr(self) -> Column:
        value = F.col(f"stat.{self.statistic}")
        return value > self.bound if self.above else value <= self.bound


def text_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Counts of every whole text, one row per document, with the columns ``carry``.

    A word is repeated if a window of three words that holds it occurs twice or
    more: windows are hashed, sorted with their places, equal neighbours are
    marked, and the marked places' spans are added up."""

    def without(chars: str) -> str:
        return f"length(translate(t, {chars}, ''))"

    words = docs.select(
        F.col(id_col).cast("long").alias(id_col),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"),
        *carry,
    ).selectExpr(
        id_col,
        *carry,
        "t",
        f"filter(split(t, '{_SEP}'), w -> w != '') as words",
        f"filter(split(t, '\\n'), l -> translate(l, {_BLANKS}, '') != '') as lines",
    )
    grams = words.selectExpr(
        id_col,
        *carry,
        "cast(size(words) as long) as n_words",
        f"cast({without(_BLANKS)} as long) as word_chars",
        f"cast(length(t) - {without(_SYMBOLS)} as long) as n_symbols",
        f"cast(length(t) - {without(_UPPER)} as long) as n_upper",
        "cast(length(t) - length(translate(t, '!?', '')) as long) as n_marks",
        "cast(length(t) - length(translate(t, '0123456789', '')) as long) as n_digits",
        "cast(size(lines) as long) as n_lines",
        "cast(size(lines) - size(array_distinct(lines)) as long) as n_dup_lines",
        "cast(size(array_distinct(words)) as long) as n_distinct_words",
        "sort_array(transform(slice(words, 1, greatest(size(words) - 2, 0)), "
        "(w, i) -> struct(xxhash64(w, words[i + 1], words[i + 2]) as g, i as i))) as grams",
    )
    places = grams.withColumn(
        "places",
        F.expr(
            "sort_array(transform(filter(grams, (x, k) -> (k > 0 and grams[greatest(k - 1, 0)].g = x.g) or "
            "(k < size(grams) - 1 and grams[least(k + 1, size(grams) - 1)].g = x.g)), x -> x.i))"
        ),
    )
    total = F.expr(
        "aggregate(places, struct(-3 as last, 0L as n), "
        "(a, p) -> struct(p as last, a.n + least(p - a.last, 3) as n), a -> a.n)"
    )
    counts = [c for c in places.columns if c.startswith("n_") and c not in carry] + ["word_chars"]
    # as a generator's output the counts are made once: filters on them stay above it
    row = F.array(F.struct(*counts, total.alias("n_repeat_words")))
    return places.select(id_col, *carry, F.inline(row))


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")


def _gain(p: int, n: int, whole_p: int, whole_n: int) -> float:
    """FOIL gain of narrowing (whole_p, whole_n) to (p, n)."""
    if not p:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(whole_p / (whole_p + whole_n)))


def _best_condition(rows: DataFrame, bounds: dict[str, list[float]]) -> tuple[Condition, int, int, int, int] | None:
    """The condition with the best gain over ``rows(bad, bins)``."""
    counts = (
        rows.select("bad", F.posexplode("bins").alias("s", "bin"))
        .groupBy("s", "bin")
        .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))
        .collect()
    )
    if not counts:
        return None
    names = list(bounds)
    table: dict[int, dict[int, tuple[int, int]]] = {}
    for r in counts:
        table.setdefault(r["s"], {})[r["bin"]] = r["p"], r["n"]
    whole = [sum(v[c] for v in table[0].values()) for c in (0, 1)]
    if not whole[0] or not whole[1]:
        return None
    best, best_gain = None, 0.0
    for s, by_bin in sorted(table.items()):
        p = n = 0
        for k, bound in enumerate(bounds[names[s]]):
            p, n = p + by_bin.get(k, (0, 0))[0], n + by_bin.get(k, (0, 0))[1]
            for above, q, m in ((False, p, n), (True, whole[0] - p, whole[1] - n)):
                gain = _gain(q, m, *whole)
                # of bounds that cover the same rows the one that rejects least elsewhere
                tie = best and above and gain > 0 and (s, True, q, m) == (names.index(best[0].statistic), best[0].above, *best[1:3])
                if gain > best_gain + 1e-9 or tie:
                    best, best_gain = (Condition(names[s], above, bound), q, m, *whole), gain
    return best


def _all(rule: list[Condition]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.expr()
    return out


def learn_rules(counts: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> list[list[Condition]]:
    """Rules that cover documents with ``quality`` 0, in order."""
    stat = F.struct(*[F.expr(e).alias(s) for s, e in STATISTICS.items()]).alias("stat")
    marked = labels.select(F.col(id_col).cast("long").alias(id_col), F.col("quality").cast("int").alias("quality"))
    rows = cut(
        counts.join(marked.where("quality in (0, 1)"), id_col).select(
            F.expr("1 - quality").alias("bad"), stat, (F.pmod(F.xxhash64(id_col), F.lit(3)) == 0).alias("held")
        )
    )
    shares = [k / BINS for k in range(1, BINS)]
    cuts = rows.agg(*[F.percentile_approx(f"stat.{s}", shares).alias(s) for s in STATISTICS]).first()
    bounds = {s: sorted(set(cuts[s] or [])) for s in STATISTICS}
    bins = F.array(
        *[F.expr(f"size(filter(array({', '.join(f'{b!r}D' for b in bounds[s])}), b -> stat.{s} > b))") for s in STATISTICS]
    )
    rows = cut(rows.withColumn("bins", bins))
    rules: list[list[Condition]] = []
    covered = F.lit(False)
    for _ in range(MAX_RULES):
        left = rows.where(~covered)
        rule: list[Condition] = []
        while len(rule) < MAX_CONDITIONS:
            found = _best_condition(left.where("not held").where(_all(rule)), bounds)
            if found is None:
                break
            rule.append(found[0])
            if found[2] == 0:
                break
        if not rule:
            break
        held = left.where("held").agg(
            *[
                F.sum(F.when(_all(rule[: k + 1]), F.col("bad") if side else 1 - F.col("bad")).otherwise(0)).alias(f"{'p' if side else 'n'}{k}")
                for k in range(len(rule))
                for side in (True, False)
            ]
        ).first()
        score = [(((held[f"p{k}"] or 0) + 1) / ((held[f"p{k}"] or 0) + (held[f"n{k}"] or 0) + 2), -k) for k in range(len(rule))]
        precision, k = max(score)
        if precision < MIN_PRECISION:
            break
        rule = rule[: 1 - k]
        rules.append(rule)
        covered = covered | _all(rule)
    return rules


def rule_number(rules: list[list[Condition]]) -> Column:
    """The first rule (from 1) that covers the row, as one ordered conditional; null: none."""
    out = F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        out = F.when(_all(rules[k - 1]), F.lit(k)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, ``base_failed``, ``rule`` and ``kept`` of every document."""
    counts = cut(text_counts(docs, id_col, text_col))
    return verdicts(counts, learn_rules(counts, labels, id_col))


def verdicts(counts: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    stat = F.struct(*[F.expr(e).alias(s) for s, e in STATISTICS.items()])
    judged = counts.withColumn("stat", stat).withColumn("base_failed", base_failed()).withColumn("rule", rule_number(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).drop("stat")
