"""Quotation linking in conversations (DataFrame functions only).

A line's quote level is its number of leading > marks. Neighbouring lines of one level form a passage. Passages are
normalised (lower case, white space as one space) and cut into sentences, so that a quote that was wrapped anew or
shortened still meets its original; sentences are compared by a 128-bit hash. The original of a quoted sentence is
the first message of the conversation that says it unquoted, if that came earlier. Every passage is linked with each
message that says some of it. A message answers the one that most of its shallowest linked level comes from, counted in
characters, of equals the later one; following the answers up to a message that answers none gives its thread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import cut, let

MARKS = r"^((?:[\x20\t]*>)+)\x20?"
#: Lines that introduce a quote in mail: "On <date>, <name> wrote:" and the like. Fixed values.
INTRODUCES = r"(?i)\b(wrote|writes|said|schrieb|écrit|escribió)\b.{0,80}:\s*$"
SENTENCE_END = r"(?<=[.!?])\s+"


def _lines(text: Column) -> Column:
    """[(depth, body)]: a blank line, or one that introduces a quote, just before a quote belongs to no level (-1)."""
    bare = F.transform(
        F.split(text, "\n", -1),
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 1), "[^>]", "")).alias("depth"),
            F.regexp_replace(x, MARKS, "").alias("body"),
        ),
    )

    def settle(lines: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            quoted_next = F.coalesce(F.get(lines, i + 1)["depth"] > 0, F.lit(False))
            leads = (x["depth"] == 0) & quoted_next & (x["body"].rlike(INTRODUCES) | (F.trim(x["body"]) == ""))
            return F.struct(F.when(leads, F.lit(-1)).otherwise(x["depth"]).alias("depth"), x["body"].alias("body"))

        return F.transform(lines, one)

    return let(bare, settle)


def _passages(lines: Column) -> Column:
    """[(depth, text)] of runs of lines with one depth, -1 left out; text normalised."""

    def cut_up(starts: Column) -> Column:
        def one(b: Column, k: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1), F.size(lines))
            run = F.array_join(F.transform(F.slice(lines, b + 1, end - b), lambda x: x["body"]), " ")
            return F.struct(F.get(lines, b)["depth"].alias("depth"), F.trim(F.regexp_replace(F.lower(run), r"\s+", " ")).alias("text"))

        return F.filter(F.transform(starts, one), lambda p: (p["depth"] >= 0) & (p["text"] != ""))

    numbered = F.transform(lines, lambda x, i: F.when((i == 0) | (x["depth"] != F.get(lines, i - 1)["depth"]), i))
    return let(F.filter(numbered, lambda i: i.isNotNull()), cut_up)


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without quotes, and passages of every message. Null text counts as empty."""
    rows = messages.select("conv_id", "turn", "role", _lines(F.coalesce(F.col("text"), F.lit(""))).alias("lines"))
    own = F.array_join(F.transform(F.filter("lines", lambda x: x["depth"] == 0), lambda x: x["body"]), "\n")
    return rows.select("conv_id", "turn", "role", F.btrim(own, F.lit(" \n\r\t")).alias("text"), _passages(F.col("lines")).alias("passages"))


def _sentences(messages: DataFrame) -> DataFrame:
    """conv_id, turn, passage, depth, hash and length of every sentence; messages without conv_id or turn have none."""
    placed = messages.filter("conv_id is not null and turn is not null").select("conv_id", "turn", F.posexplode("passages").alias("passage", "p"))
    cut_up = placed.select("conv_id", "turn", "passage", F.col("p.depth").alias("depth"), F.explode(F.split("p.text", SENTENCE_END)).alias("s"))
    return cut_up.filter("s <> ''").select("conv_id", "turn", "passage", "depth", F.md5(F.col("s").cast("binary")).alias("hash"), F.length("s").alias("size"))


def links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, passage, depth, original, quoted): every link of a quoted passage, by its number in the message
    and its quote level, with a message that says some of it; quoted counts those characters.

    A row with a null original counts the passage's characters that no earlier message says. Originals are cut down to
    one row for each conversation and sentence before the join, so a sentence that everybody says or quotes makes no
    pairs; adaptive execution splits the quotes' side if one of them is frequent.
    """
    said = _sentences(messages)
    first = said.filter("depth = 0").groupBy("conv_id", "hash").agg(F.min("turn").alias("origin"))
    quotes = said.filter("depth > 0").groupBy("conv_id", "turn", "passage", "depth", "hash").agg(F.sum("size").alias("size"))
    original = F.when(F.col("origin") < F.col("turn"), F.col("origin"))
    met = quotes.join(first, ["conv_id", "hash"], "left").withColumn("original", original)
    return met.groupBy("conv_id", "turn", "passage", "depth", "original").agg(F.sum("size").alias("quoted"))


def threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, replies): the first message of each answering message's thread, and the steps to it.

    parents: conv_id, turn, parent, one row for each message that answers another. Steps double in every round, so
    there are as many rounds as the logarithm of the longest chain; each is written, which cuts its lineage.
    """
    now = cut(parents.select("conv_id", "turn", F.col("parent").alias("thread"), F.lit(1).cast("long").alias("replies")))
    while True:
        up = now.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("further"), F.col("replies").alias("more"))
        step = now.join(up, ["conv_id", "thread"], "left")
        moved = cut(step.select(
            "conv_id", "turn", F.coalesce("further", "thread").alias("thread"),
            (F.col("replies") + F.coalesce("more", F.lit(0))).alias("replies"), F.col("further").isNotNull().alias("moved"),
        ))
        now = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return now


def linked(messages: DataFrame) -> DataFrame:
    """Every message without its quotes, in reply order.

    Columns: conv_id, turn, role, text, parent_turn (the message answered), thread (turn of the first message of its
    thread, its own where it answers none), replies (steps down from there), quoted_turns (all messages that its quotes
    are linked with, ascending), n_levels and n_levels_linked (quote levels, and those with a link), and reply_order,
    which rises along conv_id, thread and turn: an answer always follows what it answers. Null text counts as empty. Quotes whose original is missing go too. Rows repeated in messages are
    repeated here and don't quote each other; those without conv_id or turn stand alone. The order is a range sort
    over conv_id, thread and turn, so a conversation of any length is spread over many tasks.
    """
    rows = cut(parsed(messages))
    found = cut(links(rows))
    levels = found.groupBy("conv_id", "turn", "depth", "original").agg(F.sum("quoted").alias("quoted"))
    linked_depth = F.when(F.col("original").isNotNull(), F.col("depth"))
    near = F.struct(linked_depth.alias("depth"), (-F.col("quoted")).alias("votes"), (-F.col("original")).alias("later"))
    per_message = levels.groupBy("conv_id", "turn").agg(
        F.min(F.when(F.col("original").isNotNull(), near)).alias("near"),
        F.size(F.collect_set("depth")).alias("n_levels"),
        F.size(F.collect_set(linked_depth)).alias("n_levels_linked"),
        F.sort_array(F.collect_set("original")).alias("quoted_turns"),
    )
    facts = per_message.select("conv_id", "turn", (-F.col("near.later")).alias("parent_turn"), "n_levels", "n_levels_linked", "quoted_turns")
    answers = facts.filter("parent_turn is not null").select("conv_id", "turn", F.col("parent_turn").alias("parent"))
    out = rows.join(facts, ["conv_id", "turn"], "left").join(threads(answers), ["conv_id", "turn"], "left")
    out = out.select(
        "conv_id", "turn", "role", "text", "parent_turn",
        F.coalesce("thread", "turn").alias("thread"), F.coalesce("quoted_turns", F.array().cast("array<long>")).alias("quoted_turns"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("replies", "n_levels", "n_levels_linked")],
    )
    return out.orderBy("conv_id", "thread", "turn").withColumn("reply_order", F.monotonically_increasing_id())
