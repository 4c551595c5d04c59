"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example: all turns before it as context, and its text
alone under the loss mask.  Turns after the last assistant turn come in one more
example without a mask, so that every turn can be read back.

Template, for each turn: ``<|im_start|>role`` LF ``text<|im_end|>`` LF.  Inside
roles and texts the characters that control strings need are written as references,
so no text can open or close a turn; the references are undone on reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# fixed values: character and the reference it is written as; & first, so that undoing in reverse order is exact
REFERENCES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))
BREAK = ("\n", "&NewLine;")  # in roles only


def escape(text: Column, *more: tuple[str, str]) -> Column:
    for plain, written in (*REFERENCES, *more):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, *more: tuple[str, str]) -> Column:
    for plain, written in reversed((*REFERENCES, *more)):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trainable: str = "assistant") -> DataFrame:
    """(conv, example, formatted, loss_start, loss_end, last): the examples of each conversation.

    ``loss_start`` and ``loss_end`` count code points of ``formatted``; they are equal
    where nothing is to be learned.  ``last`` marks the example that holds every turn.
    Turns are ordered by number, null first; of turns with one number, by role
    and text.  Null roles and texts are empty; turns of a null conversation belong
    together.  A conversation is formatted in one task, as its last example needs it whole.
    """
    role, text = F.coalesce(F.col(f"`{role_col}`"), F.lit("")), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    turn = F.struct(F.col(f"`{turn_col}`").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    talks = turns.select(F.col(f"`{conv_col}`").alias("conv"), turn.alias("t")).groupBy("conv").agg(F.array_sort(F.collect_list("t"), _in_order).alias("turns"))

    def written(t: Column) -> Column:
        head = F.concat(F.lit(OPEN), escape(t["role"], BREAK), F.lit("\n"))
        body = escape(t["text"])
        return F.struct(t["role"].alias("role"), head.alias("head"), body.alias("body"), F.concat(head, body, F.lit(CLOSE)).alias("all"))

    talks = talks.select("conv", F.transform("turns", written).alias("turns")).withColumn("n", F.size("turns"))
    ends = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: (F.element_at("turns", i)["role"] == trainable) | (i == F.col("n")))
    each = talks.select("conv", "n", "turns", F.posexplode(ends).alias("example", "upto"))
    reply = F.element_at("turns", F.col("upto"))
    context = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("upto") - 1), lambda t: t["all"]), "")
    each = each.select("conv", "example", (F.col("upto") == F.col("n")).alias("last"), reply.alias("reply"), context.alias("context"))
    start = F.length("context") + F.length("reply.head")
    size = F.when(F.col("reply.role") == trainable, F.length("reply.body")).otherwise(0)
    return each.select(
        "conv", "example", F.concat("context", "reply.all").alias("formatted"), start.cast("long").alias("loss_start"), (start + size).cast("long").alias("loss_end"), "last"
    )


def _in_order(a: Column, b: Column) -> Column:
    def by(name: str, otherwise: Column) -> Column:
        x, y = a[name], b[name]
        return F.when(x.isNull() & y.isNotNull(), -1).when(y.isNull() & x.isNotNull(), 1).when(x < y, -1).when(x > y, 1).otherwise(otherwise)

    return by("turn", by("role", by("text", F.lit(0))))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted example."""
    parts = F.slice(F.split(formatted, F.lit(r"<\|im_end\|>\n"), -1), 1, F.size(F.split(formatted, F.lit(r"<\|im_end\|>\n"), -1)) - 1)

    def turn(part: Column) -> Column:
        body = F.substring(part, F.lit(len(OPEN) + 1), F.length(part))
        at = F.locate("\n", body)
        return F.struct(
            unescape(F.substring(body, F.lit(1), at - 1), BREAK).alias("role"), unescape(F.substring(body, at + 1, F.length(body))).alias("text")
        )

    return F.transform(parts, turn)


def read_loss(formatted: Column, start: Column, end: Column) -> Column:
    """The text under the mask, as it was."""
    return unescape(F.substring(formatted, (start + 1).cast("int"), (end - start).cast("int")))


def read_back(formatted: DataFrame) -> DataFrame:
    """One row for each conversation, from its examples alone: its turns, what is learned, the length of all examples."""
    loss = F.struct("example", read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("text"))
    return formatted.groupBy("conv").agg(
        F.first(F.when(F.col("last"), read_turns(F.col("formatted"))), ignorenulls=True).alias("turns"),
        F.array_join(F.transform(F.sort_array(F.collect_list(loss)), lambda x: x["text"]), "").alias("loss"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
