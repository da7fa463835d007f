"""Chat formatting by prefix-target expansion, with DataFrame functions only.

``expand`` turns conversations (one row per turn) into training examples: one
example per assistant turn, holding every earlier turn as context and that
reply as the only trainable part. Turns that no reply follows (a closing user
turn, a conversation without replies) are kept in one further example without
a trainable part, so the output still holds the whole conversation.

Template: a turn is ``open + role + body + text + close``. Control strings of
the template and of ``GUARDED`` inside roles and texts are escaped the way
character entities are: ``&`` first, then the first character of every control
string. ``unescape`` reverses the steps, ``&`` last, so escaping is reversible
for every input, and no text can open or close a turn.

Shape: the turns of a conversation meet in one row, because every example is
one string that holds all turns before its reply; grouping runs per
``conv_id``, so many equal conversations under different ids spread evenly.

Cases: null text is the empty text, null role the empty role (never
trainable); null conv_id is a conversation of its own; turns are ordered by
(turn, role, text), null turn numbers first, repeated rows stay repeated turns;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of common chat templates, escaped wherever a text holds them.
GUARDED = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ENTITIES = {"<": "&lt;", "[": "&#91;"}


@dataclass(frozen=True)
class Template:
    open: str = "<|turn|>"
    body: str = "<|text|>"
    close: str = "<|end|>"
    prefix: str = "<|"          # every control string of the template starts so
    trainable_role: str = "assistant"


def escape(col: Column, t: Template = Template()) -> Column:
    col = F.replace(col, F.lit("&"), F.lit("&amp;"))
    for s in (t.prefix, *GUARDED):
        col = F.replace(col, F.lit(s), F.lit(ENTITIES[s[0]] + s[1:]))
    return col


def unescape(col: Column) -> Column:
    for raw, entity in ENTITIES.items():
        col = F.replace(col, F.lit(entity), F.lit(raw))
    return F.replace(col, F.lit("&amp;"), F.lit("&"))


def expand(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Examples ``(conv_id, example, is_last, formatted, loss_start,
    loss_length)``; the trainable part is the ``loss_length`` code points of
    ``formatted`` from ``loss_start`` (counted from 0), both null where an
    example has none. ``example`` counts from 0 within the conversation."""
    t = template
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rendered = turns.select(
        "conv_id",
        F.struct(F.col("turn"), role.alias("role"), text.alias("text"),
                 F.concat(F.lit(t.open), escape(role, t), F.lit(t.body)).alias("head"),
                 escape(text, t).alias("said")).alias("t"))
    conv = rendered.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # positions of the turns that end an example: every reply, and the last turn
    ends = F.filter(F.sequence(F.lit(1), F.size("turns")),
                    lambda i: (F.element_at("turns", i)["role"] == t.trainable_role) | (i == F.size("turns")))
    conv = conv.withColumn("ends", ends)
    ex = conv.select("conv_id", "turns", F.size("ends").alias("n"), F.posexplode("ends").alias("example", "end"))
    before = F.concat_ws("", F.transform(F.slice("turns", 1, F.col("end") - 1),
                                         lambda x: F.concat(x["head"], x["said"], F.lit(t.close))))
    last = F.element_at("turns", F.col("end"))
    reply = last["role"] == t.trainable_role
    ex = ex.select("conv_id", "example", (F.col("example") == F.col("n") - 1).alias("is_last"),
                   F.concat(before, last["head"]).alias("lead"), last["said"].alias("said"), reply.alias("reply"))
    return ex.select("conv_id", "example", "is_last",
                     F.concat("lead", "said", F.lit(t.close)).alias("formatted"),
                     F.when(F.col("reply"), F.char_length("lead")).alias("loss_start"),
                     F.when(F.col("reply"), F.char_length("said")).alias("loss_length"))


def parse_turns(formatted: Column, template: Template = Template()) -> Column:
    """Turns ``array<struct<role, text>>`` read back from a formatted string."""
    t = template
    parts = F.filter(F.split(formatted, F.lit("\\Q" + t.close + "\\E"), -1), lambda p: p != "")

    def one(p):
        at = F.locate(t.body, p)
        n = F.char_length(F.lit(t.open))
        return F.struct(
            unescape(F.substring(p, n + 1, at - 1 - n)).alias("role"),
            unescape(F.substring(p, at + len(t.body), F.char_length(p))).alias("text"))
    return F.transform(parts, one)


def read_back(examples: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, from the formatted examples alone: all turns
    (of the last example, which holds the whole conversation) and the trainable
    texts in order, unescaped."""
    part = F.when(F.col("loss_start").isNotNull(),
                  unescape(F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_length"))))
    return (examples.groupBy("conv_id")
            .agg(F.max(F.when(F.col("is_last"), F.col("formatted"))).alias("whole"),
                 F.sort_array(F.collect_list(F.struct("example", part.alias("text")))).alias("parts"),
                 F.sum(F.char_length("formatted")).alias("formatted_chars"))
            .select("conv_id", parse_turns(F.col("whole"), template).alias("turns"),
                    F.concat_ws("", F.transform("parts", lambda p: p["text"])).alias("loss_text"),
                    "formatted_chars"))
