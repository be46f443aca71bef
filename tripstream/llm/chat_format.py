"""Chat formatting: one training example per assistant turn (DataFrame functions only).

*Prefix-target expansion.* Every assistant turn becomes its own example: all
preceding turns as context, that turn as the only trainable text. Turns
after the last assistant turn (or all turns of a conversation without one)
come as one more example without a target, so no turn is lost.

Template (``esc`` = escaped text):

======================  =========================================
system                  ``[SYS]esc[/SYS]``
user                    ``[INST]esc[/INST]``
assistant               ``<s>esc</s>``
any other role          ``[ROLE]esc(role)[/ROLE][INST]esc[/INST]``
======================  =========================================

Escaping is reversible: inside a text, every control string gets one more
backslash behind its first character (``</s>`` -> ``<\\/s>``, ``<\\/s>`` ->
``<\\\\/s>``), so that a control string in the output always is the
template's own; other text stays as it is.

The output of ``format_chats`` holds, per example, the text and the span of
the loss mask; ``read_back`` parses those texts again.

Edge cases: null text -> empty; null role -> empty role; rows with equal turn
are ordered by role, then text; repeated rows count as turns of their own;
null conv_id is a conversation of its own; empty table -> no rows; a null
turn comes first. Other columns are ignored. A conversation is one unit of
work (its text is hashed as a whole), and its examples add up to the square
of its turns by definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Control strings are an opening character and one of these tails.
_TAIL = r"/?s>|/?INST\]|/?SYS\]|/?ROLE\]"
_ESCAPE = rf"([<\[])(\\*)({_TAIL})"
_UNESCAPE = rf"([<\[])\\(\\*)({_TAIL})"
# One turn of a formatted text; no control string is inside an escaped text.
_TURN = (r"(?s)(?:\[ROLE\].*?\[/ROLE\])?"
         r"(?:\[INST\].*?\[/INST\]|\[SYS\].*?\[/SYS\]|<s>.*?</s>)")


def escape(c) -> Column:
    return F.regexp_replace(c, _ESCAPE, r"$1\\$2$3")


def unescape(c) -> Column:
    return F.regexp_replace(c, _UNESCAPE, r"$1$2$3")


def format_turn(role: Column, text: Column) -> Column:
    inst = F.concat(F.lit("[INST]"), escape(text), F.lit("[/INST]"))
    return (F.when(role == "assistant", F.concat(F.lit("<s>"), escape(text), F.lit("</s>")))
            .when(role == "system", F.concat(F.lit("[SYS]"), escape(text), F.lit("[/SYS]")))
            .when(role == "user", inst)
            .otherwise(F.concat(F.lit("[ROLE]"), escape(role), F.lit("[/ROLE]"), inst)))


def format_chats(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """Examples: ``conv_id, target`` (index of the trained turn, null: none),
    ``last`` (holds the whole conversation), ``example``, ``loss_start``,
    ``loss_end`` (code points, the escaped reply without its marks)."""
    turns = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    turns = turns.select("conv_id", "turn", "role", "text",
                         format_turn(F.col("role"), F.col("text")).alias("block"))
    # where each block ends in the conversation's text; also the order of turns
    w = (Window.partitionBy("conv_id").orderBy("turn", "role", "text")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    turns = turns.select("conv_id", F.struct(
        F.sum(F.length("block")).over(w).alias("end"), (F.col("role") == "assistant").alias("trained"),
        F.length("block").alias("width"), "block").alias("b"))
    convs = (turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("b")).alias("t"))
             .select("conv_id", F.explode(F.array(F.struct(
                 F.transform("t", lambda x: x.dropFields("block")).alias("marks"),
                 F.array_join(F.transform("t", lambda x: x["block"]), "").alias("full")))).alias("c"))
             .select("conv_id", "c.marks", "c.full"))
    rows = (convs.select("conv_id", "full", F.size("marks").alias("n"), F.posexplode("marks"))
            .where(F.col("col.trained") | (F.col("pos") == F.col("n") - 1)))
    rows = rows.select("conv_id", "full", (F.col("pos") == F.col("n") - 1).alias("last"), "pos",
                       F.col("col.trained").alias("trained"), F.col("col.width").alias("width"),
                       F.col("col.end").alias("end"))
    return rows.select(
        "conv_id", F.when(F.col("trained"), F.col("pos")).alias("target"), "last",
        F.substring("full", F.lit(1), F.col("end").cast("int")).alias("example"),
        F.when(F.col("trained"), F.col("end") - F.col("width") + 3).alias("loss_start"),
        F.when(F.col("trained"), F.col("end") - 4).alias("loss_end"))


def parse_turns(example: Column) -> Column:
    """``array<struct<role, text>>`` read from a formatted text."""
    def one(b: Column) -> Column:
        other = F.regexp_extract(b, r"(?s)^\[ROLE\](.*?)\[/ROLE\]", 1)
        marked = b.startswith("[ROLE]")
        body = F.when(marked, F.substr(b, F.length(other) + 14)).otherwise(b)
        kind = (F.when(marked, unescape(other)).when(b.startswith("<s>"), "assistant")
                .when(b.startswith("[SYS]"), "system").otherwise("user"))
        head = F.when(b.startswith("<s>"), 3).when(b.startswith("[SYS]"), 5).otherwise(6)
        return F.struct(kind.alias("role"), unescape(
            F.substr(body, head + 1, F.length(body) - 2 * head - 1)).alias("text"))
    return F.transform(F.regexp_extract_all(example, F.lit(_TURN), F.lit(0)), one)


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the formatted texts: ``conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples``.

    Turns come from the example that holds the whole conversation, the text
    under the loss mask from every example's span.
    """
    turns = F.when(F.col("last"), parse_turns(F.col("example")))
    loss = F.when(F.col("target").isNotNull(), unescape(F.substring(
        "example", (F.col("loss_start") + 1).cast("int"),
        (F.col("loss_end") - F.col("loss_start")).cast("int"))))
    rows = examples.select("conv_id", "target", F.length("example").alias("chars"),
                           F.explode(F.array(F.struct(turns.alias("turns"), loss.alias("loss")))).alias("r"))
    rows = rows.select(
        "conv_id", "target", "chars", F.col("r.loss").alias("loss"), F.size("r.turns").alias("n"),
        F.sha2(F.array_join(F.transform("r.turns", lambda x: F.concat(
            x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("sha"),
        F.col("r.turns").isNotNull().alias("last"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(
        F.col("target").isNotNull(), F.struct("target", "loss")))), lambda x: x["loss"]), "")
    return (rows.groupBy("conv_id").agg(
        F.max(F.when(F.col("last"), F.col("n"))).cast("long").alias("n_turns"),
        F.max(F.when(F.col("last"), F.col("sha"))).alias("turns_sha256"),
        whole.alias("loss"), F.sum("chars").alias("formatted_chars"),
        F.count("target").alias("n_examples"))
        .select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "n_examples"))
