"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: all turns before it as context, then its own text as
the only trainable part. What follows the last assistant turn, or a conversation without one,
becomes a last example with nothing to train, so no turn is lost.

Control strings inside texts are stuffed: ``<``, k backslashes and the rest of a control string
become ``<``, k + 1 backslashes and that rest. The formatted text then holds control strings only
where the template put them, and taking one backslash away restores every text exactly.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.llm.common import column


@dataclass(frozen=True)
class Template:
    """Marks a turn as turn_start role role_end text turn_end.

    Every control string must start with a character that occurs in no other place of a control
    string, or stuffing could not be undone.
    """

    turn_start: str = "<|turn|>"
    role_end: str = "<|says|>"
    turn_end: str = "</s>"
    foreign: tuple[str, ...] = ("<s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>")

    def controls(self) -> list[str]:
        return [self.turn_start, self.role_end, self.turn_end, *self.foreign]

    def __post_init__(self) -> None:
        heads = {text[0] for text in self.controls()}
        if any(head in text[1:] for text in self.controls() for head in heads) or "\\" in heads:
            raise ValueError("a control string holds the first character of another inside")

    def _pattern(self, slashes: str) -> str:
        heads = "".join(sorted({re.escape(text[0]) for text in self.controls()}))
        rests = "|".join(
            sorted({re.escape(text[1:]) for text in self.controls()}, key=len, reverse=True)
        )
        return f"([{heads}]){slashes}({rests})"

    def stuff(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"(\\*)"), r"$1\\$2$3")

    def unstuff(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"\\(\\*)"), "$1$2$3")


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per example: conv_id, example, of (examples of the conversation), formatted,
    loss_start, loss_end (code points, end exclusive; equal when nothing is trained).

    Turns are ordered by turn, then role and text, so ties and repeated rows have one order and
    all stay. Null role and text are empty; a null turn comes first; rows with a null conv_id are
    one conversation. Columns other than these four are ignored.
    """
    rows = turns.select(
        column("conv_id").alias("conv_id"),
        F.struct(
            column("turn").alias("turn"),
            F.coalesce(column("role"), F.lit("")).alias("role"),
            F.coalesce(column("text"), F.lit("")).alias("text"),
        ).alias("said"),
    )

    def rendered(said: Column) -> Column:
        return F.struct(
            F.concat(
                F.lit(template.turn_start), template.stuff(said["role"]), F.lit(template.role_end)
            ).alias("head"),
            template.stuff(said["text"]).alias("body"),
            (said["role"] == "assistant").alias("target"),
        )

    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    whole = whole.select("conv_id", F.transform("said", rendered).alias("said")).withColumn(
        "ends",
        F.expr(
            "filter(transform(said, (t, i) -> IF(t.target OR i = size(said) - 1, i, -1)), i -> i >= 0)"
        ),
    )
    examples = whole.select(
        "conv_id",
        "said",
        F.size("ends").alias("of"),
        F.posexplode("ends").alias("example", "last"),
    )
    end = F.lit(template.turn_end)
    target = F.expr("said[last]")
    context = F.array_join(
        F.transform(
            F.slice("said", F.lit(1), F.col("last")), lambda t: F.concat(t["head"], t["body"], end)
        ),
        "",
    )
    start = F.length(context) + F.length(target["head"])
    trained = F.when(target["target"], F.length(target["body"])).otherwise(0)
    return examples.select(
        "conv_id",
        "example",
        "of",
        F.concat(context, target["head"], target["body"], end).alias("formatted"),
        start.alias("loss_start"),
        (start + trained).alias("loss_end"),
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns in a formatted text, unstuffed: array of (role, text)."""
    pieces = F.split(formatted, re.escape(template.turn_start))
    pieces = F.slice(pieces, F.lit(2), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        # A stuffed text cannot hold the marks, so the first of each is the template's.
        role = F.substring_index(piece, template.role_end, 1)
        text = piece.substr(
            F.length(role) + F.lit(len(template.role_end) + 1),
            F.length(piece) - F.length(role) - F.lit(len(template.role_end) + len(template.turn_end)),
        )
        return F.struct(template.unstuff(role).alias("role"), template.unstuff(text).alias("text"))

    return F.transform(pieces, turn)


def read_loss(template: Template = Template()) -> Column:
    """The trainable text of an example, unstuffed."""
    return template.unstuff(
        F.col("formatted").substr(
            F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")
        )
    )
