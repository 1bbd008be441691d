"""Chat formatting with prefix-target expansion, with DataFrame functions only.

A conversation is rendered once as a stream of turns. Every assistant turn becomes an example of its own: its context is the stream up to
the turn, its target is the reply, and only the reply (without its end mark) is under the loss mask. All examples of a conversation share
the stream, so an example stores the code-point positions of context and target in it, not a copy of every preceding turn: the output
grows with the turns, not with their square. ``examples_with_text`` writes the copies out where a consumer wants flat texts.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Inside texts and roles, ``<|`` gets a backslash after ``<``, and one more if
backslashes stand there already, so no text can open or close a turn and the texts can be read back exactly. In roles ``%`` and line ends are percent-encoded too.

Defined results: null text and null role are empty. Turns are ordered by turn number, nulls first, ties by role and text; repeated rows
are repeated turns. A conversation without assistant turns has a stream and no examples. Rows with a null id are one conversation.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def streams(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``stream``, its formatted text, and ``examples``, one entry per assistant turn.

    An example has ``example`` (from 0), ``context_end`` (its context is the stream's first so many code points), ``loss_start`` and
    ``loss_end`` (its reply) and ``end`` (its text is the stream up to here).
    """
    role_text = F.coalesce(F.col(role).cast("string"), F.lit(""))
    turn_text = F.coalesce(F.col(text).cast("string"), F.lit(""))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    rows = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), role_text.alias("role"), turn_text.alias("text"))
    rows = rows.withColumn("rendered", F.concat(head, body, F.lit(END + "\n"))).withColumn("head", F.length(head)).withColumn("body", F.length(body))
    in_order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(F.length("rendered").cast("long")).over(in_order), F.lit(0)))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("start", "role", "rendered", "head", "body"))).alias("turns"))
    replies = F.filter("turns", lambda t: t["role"] == ASSISTANT)
    examples = F.transform(
        replies,
        lambda t, i: F.struct(
            i.cast("long").alias("example"),
            t["start"].alias("context_end"),
            (t["start"] + t["head"]).alias("loss_start"),
            (t["start"] + t["head"] + t["body"]).alias("loss_end"),
            (t["start"] + F.length(t["rendered"])).alias("end"),
        ),
    )
    return grouped.select("conv_id", F.array_join(F.transform("turns", lambda t: t["rendered"]), "").alias("stream"), examples.alias("examples"))


def expand(formatted: DataFrame, keep: Sequence[str] = ("conv_id",), outer: bool = False) -> DataFrame:
    """One row per assistant turn: its target text, and its context as a position in the conversation's stream.

    ``keep`` names columns to repeat in every row; ``outer`` gives conversations without assistant turns a row without an example.
    """
    explode = F.explode_outer if outer else F.explode
    rows = formatted.select(*keep, "stream", explode("examples").alias("e"))
    target = _part(F.col("stream"), F.col("e.loss_start"), F.col("e.loss_end"))
    return rows.select(*keep, "e.example", "e.context_end", "e.loss_start", "e.loss_end", "e.end", target.alias("target"))


def examples_with_text(formatted: DataFrame) -> DataFrame:
    """Examples with their whole text copied out. Grows with the square of a conversation's turns: for consumers of short conversations."""
    rows = formatted.select("conv_id", "stream", F.explode("examples").alias("e"))
    return rows.select("conv_id", "e.example", F.substr("stream", F.lit(1), F.col("e.end").cast("int")).alias("text"), "e.loss_start", "e.loss_end")


def _part(text: Column, start: Column, end: Column) -> Column:
    return F.substr(text, (start + 1).cast("int"), (end - start).cast("int"))


def read_back(stream: Column) -> Column:
    """Turns (role, text) parsed out of a formatted stream."""
    turns = F.filter(F.split(stream, r"<\|im_start\|>"), lambda t: F.endswith(t, F.lit(END + "\n")))
    parsed = lambda t: F.struct(
        unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
        unescape(F.substr(t, F.locate("\n", t) + F.lit(1), F.length(t) - F.locate("\n", t) - F.lit(len(END) + 1))).alias("text"),
    )
    return F.transform(turns, parsed)


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation: what reading the formatted output back gives."""
    turns = read_back(F.col("stream"))
    told = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    told = formatted.select(
        "conv_id", "stream", "examples", F.size(turns).cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("stream").cast("long").alias("formatted_chars")
    )
    # one row per example, then what is under their masks in order; rows of a conversation stand together already, so nothing is shuffled again
    rest = ["conv_id", "n_turns", "turns_sha256", "formatted_chars"]
    masked = F.array_sort(F.collect_list(F.when(F.col("example").isNotNull(), F.struct("example", unescape(F.col("target")).alias("text")))))
    rows = expand(told, rest, outer=True).groupBy(*rest).agg(F.array_join(F.transform(masked, lambda e: e["text"]), "").alias("loss"))
    return rows.select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"), "formatted_chars"
    )
