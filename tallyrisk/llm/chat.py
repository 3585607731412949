"""Reply trees to chat texts: best branches by self-joins, one marked text for each.

A message names the message it replies to, so a thread is a forest.  Every
root-to-leaf path is one possible conversation.  Paths are enumerated with
iterated self-joins of a narrow (thread, id, parent, score) table: in round k
each message knows its ancestor 2^k replies up, with the number and the scores
of the messages between.  A chain of n messages takes log2(n) rounds.  The same
tables, walked back from the chosen leaves, list the messages of every chosen
path; only then are the texts joined.

The text of a path marks each turn as ``<turn role>text</turn>`` and a line
break.  A backslash goes before each backslash, ``<turn`` and ``</turn`` of a
text, and in roles also before ``>``; so no text can pass for a mark, and
taking the backslashes off gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyrisk.llm.text import mapped, stored

#: What gets a backslash, in Spark's and in Python's notation alike.
IN_TEXT = r"\\|</?turn"
IN_ROLE = r"\\|</?turn|>"

#: An escaped character, or the end of a turn.
STEP = re.compile(r"\\.|</turn>\n", re.S)
ROLE = re.compile(r"<turn ((?:\\.|[^\\>])*)>", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)


def chained(conversations: DataFrame) -> DataFrame:
    """Conversations without branches as messages: each turn replies to the one before.

    ``conversations`` has conv_id, turn, role and text.  Turns go by ``turn``,
    null first; ties by role, then text, and repeated rows stay as turns of
    their own.  A null conv_id is a thread like any other.  A conversation ends
    as one text, so its turns may meet in one task.
    """
    order = Window.partitionBy("thread").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = conversations.select(F.col("conv_id").alias("thread"), "turn", "role", "text")
    rows = rows.withColumn("id", F.row_number().over(order).cast("long"))
    parent = F.when(F.col("id") > 1, F.col("id") - 1)
    return rows.select("thread", "id", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def best_paths(replies: DataFrame, best: int | None = 1) -> DataFrame:
    """The messages of the ``best`` root-to-leaf paths of each thread, or of all paths for None.

    ``replies`` has thread, id, parent and score.  Returns thread, leaf, rank,
    score, at (from 0 at the root) and id.  A path's score is the mean of its
    messages' scores, null counting as 0; ties go to the smaller leaf.  Of rows
    that repeat an id the one with the largest (parent, score) counts, rows
    without id are left out.  A parent that the thread does not hold makes a
    root; messages on or behind a circle of replies have no root and belong to
    no path.
    """
    score = F.coalesce("score", F.lit(0.0)).cast("double")
    nodes = replies.where("id IS NOT NULL").groupBy("thread", "id").agg(
        F.max(F.struct("parent", score.alias("score"))).alias("kept")
    )
    nodes = stored(nodes.select("thread", "id", "kept.parent", "kept.score"), "replies")
    known = nodes.select(F.col("thread").alias("t"), F.col("id").alias("held"))
    linked = F.col("thread").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("held"))
    state = stored(
        nodes.join(known, linked, "left").select(
            "thread", "id", F.col("held").alias("up"), F.lit(1).cast("long").alias("n"), F.col("score").alias("total")
        ),
        "climb",
    )
    leaves = nodes.select("thread", "id").join(
        nodes.select(F.col("thread").alias("t"), F.col("parent").alias("p")),
        F.col("thread").eqNullSafe(F.col("t")) & (F.col("id") == F.col("p")),
        "left_anti",
    )

    # Round k: up is the ancestor 2^k up, n and total cover the messages below it.
    most, climbing, jumps, done = nodes.count(), state, [], state.where("up IS NULL")
    while 2 ** len(jumps) <= most and (climbing := climbing.where("up IS NOT NULL")).head(1):
        jumps.append(climbing.select("thread", "id", "up"))
        there = state.select(
            F.col("thread").alias("t"), F.col("id").alias("mid"), F.col("up").alias("far"), F.col("n").alias("more"), F.col("total").alias("plus")
        )
        step = climbing.join(there, F.col("thread").eqNullSafe(F.col("t")) & (F.col("up") == F.col("mid")))
        climbing = stored(
            step.select("thread", "id", F.col("far").alias("up"), (F.col("n") + F.col("more")).alias("n"), (F.col("total") + F.col("plus")).alias("total")),
            "climb",
        )
        # Those that have reached a root keep their sums and need no more rounds.
        done = done.unionByName(climbing.where("up IS NULL"))
        state = done.unionByName(climbing.where("up IS NOT NULL"))

    ends = leaves.join(
        done.select(F.col("thread").alias("t"), F.col("id").alias("leaf"), "n", "total"),
        F.col("thread").eqNullSafe(F.col("t")) & (F.col("id") == F.col("leaf")),
    ).select("thread", "leaf", "n", (F.col("total") / F.col("n")).alias("score"))
    place = Window.partitionBy("thread").orderBy(F.desc("score"), "leaf")
    ends = ends.withColumn("rank", F.row_number().over(place))
    if best is not None:
        ends = ends.where(F.col("rank") <= best)

    # Back down the powers of two: every message listed so far adds the one 2^k above it.
    path = ends.select("thread", "leaf", "rank", "score", (F.col("n") - 1).alias("at"), F.col("leaf").alias("id"))
    for k in reversed(range(len(jumps))):
        jump = jumps[k].select(F.col("thread").alias("t"), F.col("id").alias("low"), "up")
        found = path.join(jump, F.col("thread").eqNullSafe(F.col("t")) & (F.col("id") == F.col("low")), "left")
        both = F.array(
            F.struct("at", "id"),
            F.when(F.col("up").isNotNull(), F.struct((F.col("at") - 2**k).alias("at"), F.col("up").alias("id"))),
        )
        path = found.select("thread", "leaf", "rank", "score", F.explode(both).alias("m"))
        path = path.where("m IS NOT NULL").select("thread", "leaf", "rank", "score", "m.at", "m.id")
    return path


def formatted(messages: DataFrame, best: int | None = 1, learn: str = "assistant") -> DataFrame:
    """One marked text for each of the ``best`` paths of a thread.

    ``messages`` has thread, id, parent, role, text and score; more columns do
    no harm.  Returns thread, leaf, rank, score, n_turns, formatted, and loss:
    the code-point ranges (start, end) of the escaped texts of role ``learn``.
    Null roles and texts are empty; of rows that repeat an id the largest
    (role, text) counts.  See ``best_paths`` for odd threads.  Texts are dealt
    by message, then by path, so a large thread is spread over many tasks.
    """
    messages = stored(messages.select("thread", "id", "parent", "score", "role", "text"), "messages")
    path = best_paths(messages.select("thread", "id", "parent", "score"), best)
    bodies = messages.where("id IS NOT NULL").groupBy(F.col("thread").alias("t"), F.col("id").alias("m")).agg(
        F.max(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("body")
    )
    turns = path.join(bodies, F.col("thread").eqNullSafe(F.col("t")) & (F.col("id") == F.col("m")))
    head = F.concat(F.lit("<turn "), F.regexp_replace("body.role", IN_ROLE, r"\\$0"), F.lit(">"))
    text = F.regexp_replace("body.text", IN_TEXT, r"\\$0")
    turns = turns.select(
        "thread", "leaf", "rank", "score", "at", head.alias("head"), text.alias("text"), (F.col("body.role") == learn).alias("learnt")
    )
    turns = turns.withColumn("piece", F.concat("head", "text", F.lit("</turn>\n")))
    before = Window.partitionBy("thread", "leaf").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)) + F.length("head")
    span = F.struct(begin.alias("start"), (begin + F.length("text")).alias("end"))
    turns = turns.select("thread", "leaf", "rank", "score", "at", "piece", F.when(F.col("learnt"), span).alias("span"))
    whole = turns.groupBy("thread", "leaf").agg(
        F.first("rank").alias("rank"),
        F.first("score").alias("score"),
        F.count("*").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list("span")).alias("loss"),
    )
    return whole.select("thread", "leaf", "rank", "score", "n_turns", F.array_join("pieces.piece", "").alias("formatted"), "loss")


def plain(escaped: str) -> str:
    """The text before its control strings were escaped."""
    return ESCAPED.sub(r"\1", escaped)


def turns_of(text: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a formatted text; raises if it is not one."""
    at = 0
    while at < len(text):
        head = ROLE.match(text, at)
        end = head and next((m for m in STEP.finditer(text, head.end()) if m[0] == "</turn>\n"), None)
        if not end:
            raise ValueError(f"no turn at {at}")
        yield plain(head[1]), plain(text[head.end() : end.start()])
        at = end.end()


def digests(conversations: DataFrame) -> DataFrame:
    """Counts and digests of all conversations, read back from their formatted texts."""

    def rows(given: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, text, loss in given:
            turns = list(turns_of(text))
            whole = "".join(f"{role}\n{said}\n" for role, said in turns)
            learnt = "".join(plain(text[x["start"] : x["end"]]) for x in loss)
            yield conv_id, len(turns), _sha(whole), len(learnt), _sha(learnt), len(text)

    texts = formatted(chained(conversations)).select("thread", "formatted", "loss")
    return mapped(
        texts,
        rows,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
