"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example: the turns up to and including it, with only its
own text under the loss mask.  If turns follow the last assistant turn, or there is none,
one more example without a mask holds the whole conversation, so no turn is lost.

A turn is written ``start role sep text end``.  Inside roles and texts a backslash is
doubled and a control string gets a backslash after its first character, so no control
string is left in them and ``unescape`` gives the original back.

Only DataFrame functions are used.  Turns are shuffled once, by conversation; a
conversation is formatted once and every example is a prefix of that string, so the
prefixes multiply in the output only.  A conversation is one row of output and must fit a
task; nothing else does.

Defined cases: NULL role or text counts as empty; NULL ``conv_id`` is a conversation of its
own; turns with the same number are ordered by role, then text, and repeated rows are
repeated turns; an empty table gives no examples; other columns are not carried.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F


@dataclass(frozen=True)
class Template:
    """Marks of a turn, and all strings that must not stand inside a text."""

    start: str = "<|im_start|>"
    sep: str = "<|message|>"
    end: str = "<|im_end|>"
    others: tuple[str, ...] = ("[INST]", "[/INST]", "<s>", "</s>")
    target: str = "assistant"

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.sep, self.end, *self.others)


def escape(text: Column, template: Template = Template()) -> Column:
    """``text`` without control strings; reversed by ``unescape``."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    choice = "|".join(map(_quoted, template.controls))
    return F.regexp_replace(doubled, f"(?s)(?=(?:{choice}))(.)", "$1\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", text)


def prefix_examples(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Examples of ``turns(conv_id, turn, role, text)``.

    ``conv_id, example`` (from 1), ``examples`` (how many the conversation has), ``text``,
    ``mask_start``, ``mask_end`` (code points, end exclusive; NULL without a target).
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    clean = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    inner = escape(F.col("text"), template)
    head = F.concat(F.lit(template.start), escape(F.col("role"), template), F.lit(template.sep))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = (
        clean.withColumn("inner", inner)
        .withColumn("piece", F.concat(head, "inner", F.lit(template.end)))
        .select(
            "conv_id",
            F.row_number().over(order).alias("at"),
            F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int").alias("stop"),
            F.length("inner").alias("size"),
            (F.col("role") == template.target).alias("target"),
            "piece",
        )
    )
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*placed.columns[1:]))).alias("turns"))
    last = F.element_at("turns", -1)
    wanted = F.filter("turns", lambda t: t["target"] | (t["at"] == F.size("turns")))
    exploded = whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("full"),
        F.transform(
            wanted, lambda t: F.struct(t["stop"].alias("stop"), t["size"].alias("size"), t["target"].alias("target"))
        ).alias("wanted"),
    ).select("conv_id", "full", F.size("wanted").alias("examples"), F.posexplode("wanted").alias("at", "t"))
    mask_end = F.when(F.col("t.target"), F.col("t.stop") - len(template.end))
    return exploded.select(
        "conv_id",
        (F.col("at") + 1).alias("example"),
        "examples",
        F.substring("full", F.lit(1), F.col("t.stop")).alias("text"),
        (mask_end - F.col("t.size")).alias("mask_start"),
        mask_end.alias("mask_end"),
    )


def read_turns(text: Column, template: Template = Template()) -> Column:
    """The turns of a formatted text as an array of (role, text), read back from its marks."""
    cut = F.split(text, _quoted(template.start), -1)
    pieces = F.slice(cut, 2, F.size(cut) - 1)

    def turn(piece: Column) -> Column:
        parts = F.split(piece, _quoted(template.sep), -1)
        body = F.split(parts[1], _quoted(template.end), -1)[0]
        return F.struct(unescape(parts[0]).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def masked_text(template: Template = Template()) -> Column:
    """The unescaped text under the mask of an example; empty without one."""
    raw = F.substring("text", F.col("mask_start") + 1, F.col("mask_end") - F.col("mask_start"))
    return F.coalesce(unescape(raw), F.lit(""))


def conversation_digest(examples: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation what its examples hold, read back from them.

    The examples of a conversation already lie in one partition, so this adds no shuffle.
    """
    read = examples.select(
        "conv_id",
        "example",
        F.length("text").cast("long").alias("chars"),
        masked_text(template).alias("loss"),
        # the last example holds every turn
        F.when(F.col("example") == F.col("examples"), read_turns(F.col("text"), template)).alias("turns"),
    )
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = read.select(
        "conv_id", "example", "chars", "loss",
        F.size("turns").cast("long").alias("n"), F.sha2(joined, 256).alias("digest"),
    )
    whole = read.groupBy("conv_id").agg(
        F.max("n").alias("n_turns"),
        F.max("digest").alias("turns_sha256"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
    )
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return whole.select(
        "conv_id", "n_turns", "turns_sha256",
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
