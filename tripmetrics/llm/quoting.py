"""Operator 10: quotation linking of chat and mail messages.

A line's quote level is its number of leading ``>`` marks (spaces between them
allowed).  Consecutive lines of one level form a passage; a passage's normal form
is lower case with single spaces.  The passages of a message's own (unquoted)
text are its paragraphs, its lines and the whole.  A quoted passage is looked
up as a whole, else by its lines: the latest earlier message of the
conversation that has the hash among its own passages is quoted.  A message replies to the
message from which its first-level quotes take the most characters (ties: the
latest); deeper levels are counted but link nothing.  Without a match it replies
to the message before it.  A conversation is then ordered as a thread: each
message is followed by its replies, in order of turns, each with its own
replies.  Quoted lines, and a line ending in a colon right before a quote (an
attribution), are left out of the text.

Lookups are windows by conversation, hash and block of turns, with one value per
earlier block, and running numbers are made by block and then by block totals,
so a long conversation is not one task's work.  Replies to the message before
form chains; only the chain heads' links are followed, by pointer doubling, and
only they are sorted by conversation.

Only DataFrame and SQL functions are used.  Null texts count as empty.  Rows
without a turn come last in their conversation; rows without conv_id form one
conversation.  Rows that tie in conversation and turn are ordered by role and text.
Columns besides conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import cut

BLOCK = 1024
_MARK = r"^[ \\t]*(>[ \\t]?)+"


def _numbered(messages: DataFrame) -> DataFrame:
    """Add ``seq`` (0, 1, .. by turn) to the messages of each conversation."""
    blocks = messages.withColumn("block", F.expr(f"coalesce(turn, 9223372036854775807) div {BLOCK}"))
    parts = blocks.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    bases = parts.selectExpr(
        "conv_id as c", "block as b", "sum(n) over (partition by conv_id order by block) - n as base"
    )
    own = blocks.selectExpr(
        "*",
        "row_number() over (partition by conv_id, block order by turn nulls last, role, text) - 1 as place",
    )
    joined = own.join(bases, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    return joined.selectExpr("conv_id", "turn", "role", "text", "base + place as seq")


def _passages(messages: DataFrame) -> DataFrame:
    """Add ``lines`` (level, text without marks), the text without quotes, and quoted passages."""
    levels = messages.withColumn(
        "lines",
        F.expr(
            "transform(split(coalesce(text, ''), '\\r\\n|\\n|\\r'), l -> struct("
            f"length(regexp_replace(regexp_extract(l, '{_MARK}', 0), '[^>]', '')) as level, "
            f"regexp_replace(l, '{_MARK}', '') as line))"
        ),
    )
    kept = levels.withColumn(
        "own",
        F.expr(
            "filter(lines, (x, i) -> x.level = 0 and not (x.line rlike ':[ \\\\t]*$' and i + 1 < size(lines) "
            "and lines[least(i + 1, size(lines) - 1)].level > 0))"
        ),
    )
    return kept.selectExpr(
        "conv_id", "turn", "role", "seq", "lines", "array_join(transform(own, x -> x.line), '\\n') as body"
    ).withColumn("body", F.expr("regexp_replace(trim(both ' \\n\\t' from body), '\\n{3,}', '\\n\\n')"))


def _normal(text: str) -> str:
    return f"trim(regexp_replace(lower({text}), '[ \\\\t\\\\r\\\\n]+', ' '))"


def _hashed(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the hash and length of each non-empty normal passage ``p``."""
    named = rows.selectExpr(*keep, f"{_normal('p')} as p").where("p != ''")
    return named.selectExpr(*keep, "xxhash64(p) as h", "length(p) as chars")


def _quotes(messages: DataFrame) -> DataFrame:
    """Quoted passages ``(conv_id, seq, level, part, line, h, chars)``: line is 0 for
    the whole passage, from 1 for its lines."""
    lines = messages.where("exists(lines, x -> x.level > 0)").selectExpr("conv_id", "seq", "posexplode(lines) as (i, x)")
    quoted = lines.selectExpr("conv_id", "seq", "i", "x.level as level", "x.line as line").where("level > 0")
    # lines of one passage have the same difference of place and rank in their level
    runs = quoted.selectExpr(
        "*", "i - row_number() over (partition by conv_id, seq, level order by i) as run"
    )
    parts = runs.groupBy("conv_id", "seq", "level", "run").agg(
        F.sort_array(F.collect_list(F.struct("i", "line"))).alias("ls"), F.min("i").alias("part")
    )
    each = parts.selectExpr(
        "conv_id",
        "seq",
        "level",
        "part",
        "posexplode(concat(array(array_join(transform(ls, l -> l.line), '\\n')), transform(ls, l -> l.line))) as (line, p)",
    )
    return _hashed(each, ["conv_id", "seq", "level", "part", "line"])


def _own_passages(messages: DataFrame) -> DataFrame:
    """``(conv_id, seq, h)`` of the whole own text, its paragraphs and its lines."""
    each = messages.where("body != ''").selectExpr(
        "conv_id",
        "seq",
        "explode(array_distinct(concat(array(body), split(body, '\\n[ \\t]*\\n'), split(body, '\\n')))) as p",
    )
    return _hashed(each, ["conv_id", "seq"]).select("conv_id", "seq", "h").distinct()


def _sources(quotes: DataFrame, own: DataFrame) -> DataFrame:
    """Add to each quote the latest earlier message ``src`` that holds its hash."""
    asked = quotes.select("conv_id", "h").distinct()
    held = own.join(
        asked.withColumnsRenamed({"conv_id": "c", "h": "k"}),
        (F.col("h") == F.col("k")) & F.col("conv_id").eqNullSafe(F.col("c")),
        "left_semi",
    )
    held = held.withColumn("block", F.expr(f"seq div {BLOCK}"))
    asks = quotes.withColumn("block", F.expr(f"seq div {BLOCK}"))
    # the last holder in each earlier block
    tops = held.groupBy("conv_id", "h", "block").agg(F.max("seq").alias("last")).selectExpr("*", "true as holds").unionByName(
        asks.select("conv_id", "h", "block").distinct().selectExpr("*", "cast(null as long) as last", "false as holds")
    )
    before = (
        tops.selectExpr(
            "conv_id as c",
            "h as k",
            "block as b",
            "holds",
            "max(last) over (partition by conv_id, h order by block "
            "range between unbounded preceding and 1 preceding) as earlier",
        )
        .where("not holds")
        .drop("holds")
    )
    here = held.selectExpr("conv_id", "h", "block", "seq", "seq as src", "cast(null as int) as level", "cast(null as int) as part", "cast(null as int) as line", "cast(null as int) as chars")
    both = here.unionByName(asks.withColumn("src", F.lit(None).cast("long"))).selectExpr(
        "*",
        "max(src) over (partition by conv_id, h, block order by seq range between unbounded preceding and 1 preceding) as near",
    )
    found = both.where("level is not null").join(
        before,
        (F.col("h") == F.col("k")) & (F.col("block") == F.col("b")) & F.col("conv_id").eqNullSafe(F.col("c")),
        "left",
    )
    return found.selectExpr("conv_id", "seq", "level", "part", "line", "chars", "coalesce(near, earlier) as src")


def quote_links(messages: DataFrame) -> DataFrame:
    """Links ``(conv_id, seq, level, src, chars)``: characters quoted from each source."""
    found = _sources(_quotes(messages), _own_passages(messages)).where("src is not null")
    # a passage found as a whole is not counted by its lines again
    whole = found.where("line = 0").selectExpr("conv_id as c", "seq as s", "part as p")
    lines = found.where("line > 0").join(
        whole,
        (F.col("seq") == F.col("s")) & (F.col("part") == F.col("p")) & F.col("conv_id").eqNullSafe(F.col("c")),
        "left_anti",
    )
    return (
        found.where("line = 0").unionByName(lines)
        .groupBy("conv_id", "seq", "level", "src")
        .agg(F.sum("chars").cast("long").alias("chars"))
    )


def _with_heads(messages: DataFrame) -> DataFrame:
    """Add ``head``: the last chain head at or before each message."""
    marked = messages.withColumn("block", F.expr(f"seq div {BLOCK}")).withColumn("at", F.expr("case when is_head then seq end"))
    tops = marked.groupBy("conv_id", "block").agg(F.max("at").alias("top")).selectExpr(
        "conv_id as c",
        "block as b",
        "max(top) over (partition by conv_id order by block rows between unbounded preceding and 1 preceding) as earlier",
    )
    near = marked.withColumn(
        "near", F.expr("max(at) over (partition by conv_id, block order by seq rows unbounded preceding)")
    )
    joined = near.join(tops, (F.col("block") == F.col("b")) & F.col("conv_id").eqNullSafe(F.col("c")))
    return joined.withColumn("head", F.expr("coalesce(near, earlier)")).drop("block", "at", "near", "earlier", "c", "b")


def _paths(messages: DataFrame) -> DataFrame:
    """``(conv_id, head, path)``: the sort key of each chain.

    A chain runs from its head to the message before the next head.  In a thread
    it follows the chain of its parent; of the chains that hang on one
    chain those with a later parent come first, then those with an earlier head."""
    heads = messages.where("is_head").select("conv_id", "head", F.expr("case when seq > 0 then parent end as parent"))
    owner = messages.selectExpr("conv_id as c", "seq as s", "head as up")
    chains = cut(
        heads.join(owner, (F.col("parent") == F.col("s")) & F.col("conv_id").eqNullSafe(F.col("c")), "left").selectExpr(
            "conv_id", "head", "up", "array(struct(-coalesce(parent, 1L) as low, head as head)) as path"
        )
    )
    while not chains.where("up is not null").isEmpty():
        far = chains.selectExpr("conv_id as c", "head as k", "up as next", "path as before")
        chains = cut(
            chains.join(far, (F.col("up") == F.col("k")) & F.col("conv_id").eqNullSafe(F.col("c")), "left").selectExpr(
                "conv_id", "head", "next as up", "case when k is null then path else concat(before, path) end as path"
            )
        )
    return chains.drop("up")


def thread(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, reply_to, n_quotes, n_linked, position, text)`` per message:
    reply_to is the turn answered, position its place in the thread (from 0)."""
    raw = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    messages = cut(_passages(_numbered(raw)))
    links = cut(quote_links(messages))
    passages = (
        _quotes(messages).where("line = 0").groupBy("conv_id", "seq").agg(F.count("*").alias("n_quotes"))
    )
    best = links.where("level = 1").groupBy("conv_id", "seq").agg(F.max_by("src", F.struct("chars", "src")).alias("parent"))
    linked = links.groupBy("conv_id", "seq").agg(F.count("*").alias("n_linked"))

    def with_(left: DataFrame, right: DataFrame) -> DataFrame:
        named = right.withColumnsRenamed({"conv_id": "c", "seq": "s"})
        same = (F.col("seq") == F.col("s")) & F.col("conv_id").eqNullSafe(F.col("c"))
        return left.join(named, same, "left").drop("c", "s")

    full = cut(with_(with_(with_(messages.drop("lines"), best), passages), linked))
    # chain heads: first messages, and messages that answer another than the one before
    full = cut(_with_heads(full.withColumn("is_head", F.expr("seq = 0 or coalesce(parent != seq - 1, false)"))))
    sizes = full.groupBy("conv_id", "head").agg(F.count("*").alias("n")).withColumnsRenamed({"conv_id": "c", "head": "k"})
    sized = _paths(full).join(sizes, (F.col("head") == F.col("k")) & F.col("conv_id").eqNullSafe(F.col("c")))
    placed = sized.selectExpr(
        "conv_id as c", "head as k", "sum(n) over (partition by conv_id order by path rows unbounded preceding) - n as base"
    )
    turns = full.selectExpr("conv_id as pc", "seq as ps", "turn as reply_to")
    out = full.join(
        placed, (F.col("head") == F.col("k")) & F.col("conv_id").eqNullSafe(F.col("c"))
    ).join(
        turns,
        F.expr("conv_id <=> pc and ps = case when seq > 0 then coalesce(parent, seq - 1) end"),
        "left",
    )
    return out.selectExpr(
        "conv_id",
        "turn",
        "role",
        "reply_to",
        "coalesce(n_quotes, 0L) as n_quotes",
        "coalesce(n_linked, 0L) as n_linked",
        "base + seq - head as position",
        "body as text",
    )
