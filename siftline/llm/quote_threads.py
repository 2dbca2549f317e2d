"""Quotation linking: quoted passages to the messages they come from, and conversations in reply order without quotes.

Lines that begin with one or more ``>`` are quotes of that depth. Passages (runs of quoted lines of one depth) and
their lines are normalised, hashed and looked up among the hashes of what messages say themselves. A message answers
the message that most of its outermost quotes come from.
"""

from __future__ import annotations

import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.ordering import in_blocks, with_running_total
from siftline.llm.shared_storage import checkpointed, written

_MARKS = re.compile(r"[ \t]*(?:>[ \t]*)+")
# How an introduction to a quote ends in four languages.
_INTRODUCTION = re.compile(r"(?:wrote|écrit|schrieb|escribió)[^\n]{0,40}:\s*$", re.I)
_SAID = "struct<body: string, own: array<bigint>, quotes: array<struct<level: int, passage: int, whole: boolean, hash: bigint, chars: int>>>"


def normal(text: str) -> str:
    return " ".join(text.split()).casefold()


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) - (1 << 63)


def split_quotes(text: str | None) -> list[tuple[int, str]]:
    """(depth, line without its marks) of every line."""
    out = []
    for line in (text or "").split("\n"):
        m = _MARKS.match(line)
        out.append((m[0].count(">"), line[m.end() :]) if m else (0, line))
    return out


def passages(lines: list[tuple[int, str]]) -> list[tuple[int, list[str]]]:
    """Runs of lines of one depth; blank lines and changes of depth end a run."""
    runs: list[tuple[int, list[str]]] = []
    going = False
    for depth, line in lines:
        if not line.strip():
            going = False
        elif going and runs[-1][0] == depth:
            runs[-1][1].append(line)
        else:
            runs.append((depth, [line]))
            going = True
    return runs


def said(text: str | None) -> tuple[str, list[int], list[dict]]:
    """(text without quotes and their introductions, hashes of what it says, its quoted passages and their lines)."""
    lines = split_quotes(text)
    kept = [line for i, (depth, line) in enumerate(lines) if not depth and not (_INTRODUCTION.search(line) and any(d for d, x in lines[i + 1 : i + 3]))]
    body = re.sub(r"\n{3,}", "\n\n", "\n".join(kept)).strip()
    own, quotes = {normal(body)}, []
    for _, run in passages([(0, x) for x in body.split("\n")]):
        own.update([normal(" ".join(run)), *map(normal, run)])
    for number, (depth, run) in enumerate(r for r in passages(lines) if r[0]):
        units = [(True, normal(" ".join(run)))] + [(False, normal(x)) for x in run if len(run) > 1]
        quotes += [{"level": depth, "passage": number, "whole": whole, "hash": _hash(u), "chars": len(u)} for whole, u in units if u]
    return body, sorted(_hash(u) for u in own if u), quotes


def threads(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", elsewhere_chars: int = 1) -> DataFrame:
    """A row per row of ``messages``: conv_id, turn, position, thread_turn, reply_to_turn, reply_depth, n_quotes, n_linked,
    quoted_conv_id, quoted_turn, text, text_hash.

    A quote is linked to the first message of its own conversation that says it and comes earlier, else to the first
    message of any other conversation that does, however short it is; a caller may keep passages and lines of fewer than
    ``elsewhere_chars`` normalised characters inside their own conversation, where they count in n_quotes like any
    other. reply_to_turn is the earlier message of the conversation most quoted at depth 1 (by characters, then the
    latest); quoted_conv_id and quoted_turn name the most quoted message anywhere. A thread is
    a message that answers none, with all that answer it; position numbers a conversation's messages from 0 by (thread,
    turn, hash of the text), so that answers follow what they answer. ``text`` has no quotes left.
    Null texts are empty. Rows without conversation or turn keep their row but link to nothing. Rows that share
    conversation and turn link as one message and keep their rows. Further columns are not read.
    """
    parse = F.pandas_udf(lambda texts: pd.DataFrame([said(t) for t in texts], columns=["body", "own", "quotes"]), _SAID)
    rows = messages.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"), parse(F.col(text_col)).alias("s"))
    # the number of a row is written with it, so it is the same whenever the row is read
    rows = written(rows.select(F.monotonically_increasing_id().alias("row"), "conv_id", "turn", "text_hash", "s.*"), "messages")

    says = rows.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", F.explode("own").alias("hash"))
    quotes = rows.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", F.explode("quotes").alias("q")).select("conv_id", "turn", "q.*").distinct()
    # only what is quoted somewhere needs an index; the first to say it stands for all who do
    asked = written(quotes.select("hash").distinct(), "quoted-hashes")
    said_by = says.join(asked, "hash")
    here = written(said_by.groupBy("conv_id", "hash").agg(F.min("turn").alias("here_turn")), "said-here")
    sayer = F.min(F.struct("conv_id", F.col("here_turn").alias("turn")))
    anywhere = written(here.groupBy("hash").agg(sayer.alias("first")), "said-first")
    # the conversation that says it first may quote it before that: its quotes come from the first of the others
    early = quotes.filter(F.col("chars") >= elsewhere_chars).join(anywhere, "hash").filter(F.col("conv_id") == F.col("first.conv_id")).filter(F.col("first.turn") >= F.col("turn"))
    others = here.join(early.select("hash", F.col("conv_id").alias("own_conv")).distinct(), "hash").filter("conv_id <> own_conv")
    others = written(others.groupBy("hash").agg(sayer.alias("other")), "said-by-others")
    found = quotes.join(here, ["conv_id", "hash"], "left").join(anywhere, "hash", "left").join(others, "hash", "left")
    inside = F.col("here_turn") < F.col("turn")
    elsewhere = F.when(F.col("chars") < elsewhere_chars, F.lit(None)).when(F.col("first.conv_id") == F.col("conv_id"), F.col("other")).otherwise(F.col("first"))
    found = found.withColumn("to_conv", F.when(inside, F.col("conv_id")).otherwise(elsewhere["conv_id"]))
    found = found.withColumn("to_turn", F.when(inside, F.col("here_turn")).otherwise(elsewhere["turn"]))
    # a passage found as a whole doesn't count its lines again
    by_passage = found.groupBy("conv_id", "turn", "passage").agg(F.max(F.col("whole") & F.col("to_turn").isNotNull()).alias("hit"), F.max(F.col("to_turn").isNotNull()).alias("any_hit"))
    found = written(found.join(by_passage, ["conv_id", "turn", "passage"]).filter(F.col("whole") | ~F.col("hit")), "quotes")
    sums = found.filter("to_turn IS NOT NULL").groupBy("conv_id", "turn", "level", "to_conv", "to_turn").agg(F.sum("chars").alias("chars"))
    best = sums.groupBy("conv_id", "turn").agg(
        F.max(F.when((F.col("to_conv") == F.col("conv_id")) & (F.col("level") == 1), F.struct("chars", "to_turn"))).alias("reply"),
        F.max(F.struct("chars", "to_conv", "to_turn")).alias("most"),
    )
    counts = found.groupBy("conv_id", "turn").agg(F.count_distinct("passage").alias("n_quotes"), F.count_distinct(F.when(F.col("any_hit"), F.col("passage"))).alias("n_linked"))
    about = counts.join(best, ["conv_id", "turn"], "left")
    about = written(about.select("conv_id", "turn", "n_quotes", "n_linked", F.col("reply.to_turn").alias("reply_to_turn"), F.col("most.to_conv").alias("quoted_conv_id"), F.col("most.to_turn").alias("quoted_turn")), "replies")
    roots = _roots(about.filter("reply_to_turn IS NOT NULL").select("conv_id", "turn", "reply_to_turn"))

    all_rows = rows.select("row", "conv_id", "turn", "text_hash").join(about, ["conv_id", "turn"], "left").join(roots, ["conv_id", "turn"], "left")
    all_rows = all_rows.withColumn("thread_turn", F.coalesce("thread_turn", "turn")).withColumn("reply_depth", F.coalesce("reply_depth", F.lit(0)))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "thread_turn", "turn", "text_hash")]
    placed = with_running_total(in_blocks(all_rows.withColumn("one", F.lit(1).cast("long")), order, "reply-order"), ["conv_id"], order, "one", "position")
    placed = placed.join(rows.select("row", F.col("body").alias("text")), "row")
    return placed.select("conv_id", "turn", "position", "thread_turn", "reply_to_turn", "reply_depth", F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "quoted_conv_id", "quoted_turn", "text", "text_hash")


def _roots(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, thread_turn, reply_depth) of messages that answer another: links are doubled until all end."""
    ends = checkpointed(replies.select("conv_id", "turn", F.col("reply_to_turn").alias("thread_turn"), F.lit(1).cast("int").alias("reply_depth")))
    while True:
        ahead = ends.select("conv_id", F.col("turn").alias("thread_turn"), F.col("thread_turn").alias("further"), F.col("reply_depth").alias("more"))
        longer = ends.join(ahead, ["conv_id", "thread_turn"], "left")
        moved = checkpointed(longer.select("conv_id", "turn", F.coalesce("further", "thread_turn").alias("thread_turn"), (F.col("reply_depth") + F.coalesce("more", F.lit(0))).alias("reply_depth"), F.col("further").isNotNull().alias("moved")))
        ends = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return ends
