"""Chat formatting: a state machine over roles and a declarative template with a loss mask.

A conversation becomes segments of text, each with a flag that tells whether a
model is trained on it, and their concatenation. Control strings inside a text
are escaped by a backslash after their first character, so every control string
in the output is the template's own and the output can be read back.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import let


@dataclass(frozen=True)
class Turn:
    """The marks around a role's text and whether its text is trained on."""

    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, marks for any other role, and the order of roles.

    Every mark begins with ``[`` or ``<`` and has neither in its rest. ``follows``
    names for each role the roles that may come next; ``starts`` and ``ends``
    where a conversation may begin and end.
    """

    turns: dict[str, Turn] = field(
        default_factory=lambda: {
            "system": Turn("[SYS]", "[/SYS]"),
            "user": Turn("[INST]", "[/INST]"),
            "assistant": Turn("<s>", "</s>", loss=True),
        }
    )
    other: Turn = Turn("[ROLE]", "[/TURN]")
    other_text: str = "[TEXT]"
    starts: tuple[str, ...] = ("system", "user")
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    ends: tuple[str, ...] = ("assistant",)

    def controls(self) -> list[str]:
        marks = [m for t in (*self.turns.values(), self.other) for m in (t.opening, t.closing)]
        return [*marks, self.other_text]


INSTRUCT = Template()


def _rest(template: Template) -> str:
    return "|".join(re.escape(c[1:]) for c in template.controls())


def escape(text: Column, template: Template = INSTRUCT) -> Column:
    """One more backslash after the first character of each control string, with or without backslashes there."""
    return F.regexp_replace(text, F.lit(rf"([<\[])(\\*)({_rest(template)})"), F.lit(r"$1\\$2$3"))


def unescape(text: Column, template: Template = INSTRUCT) -> Column:
    """Takes the backslash of ``escape`` away again."""
    return F.regexp_replace(text, F.lit(rf"([<\[])\\(\\*)({_rest(template)})"), F.lit("$1$2$3"))


def _segment(text: Column | str, loss: bool = False) -> Column:
    return F.struct((F.lit(text) if isinstance(text, str) else text).alias("text"), F.lit(loss).alias("loss"))


def _segments(turn: Column, template: Template) -> Column:
    text = escape(turn["text"], template)
    known: Column | None = None
    for role, marks in template.turns.items():
        parts = F.array(_segment(marks.opening), _segment(text, marks.loss), _segment(marks.closing))
        known = F.when(turn["role"] == role, parts) if known is None else known.when(turn["role"] == role, parts)
    head = F.concat(F.lit(template.other.opening), escape(turn["role"], template), F.lit(template.other_text))
    other = F.array(_segment(head), _segment(text, template.other.loss), _segment(template.other.closing))
    return other if known is None else known.otherwise(other)


def _first_fault(turns: Column, template: Template) -> Column:
    """Index of the first turn that the state machine doesn't accept; the number of turns if it ends too early; else null."""

    def allowed(state: Column, role: Column) -> Column:
        fits = (state == "") & role.isin(*template.starts)
        for before, after in template.follows.items():
            fits = fits | ((state == before) & role.isin(*after))
        return fits

    def step(acc: Column, turn: Column) -> Column:
        fits = acc["fault"].isNull() & allowed(acc["state"], turn["role"])
        return F.struct(
            turn["role"].alias("state"),
            (acc["at"] + 1).alias("at"),
            F.coalesce(acc["fault"], F.when(~fits, acc["at"])).alias("fault"),
        )

    start = F.struct(F.lit("").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("fault"))
    return F.aggregate(
        turns, start, step, lambda acc: F.coalesce(acc["fault"], F.when(~acc["state"].isin(*template.ends), acc["at"]))
    )


def format_conversations(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation: conv_id, segments (text, loss), formatted, first_fault.

    Turns are taken in the order of turn, role, text (nulls first); null roles
    and texts are empty; a null conv_id is a conversation of its own; repeated
    rows are repeated turns. A conversation whose roles break the template's
    order is formatted all the same and ``first_fault`` tells where it breaks.
    Other columns play no part. A conversation is one row of the output, so it
    has to fit into one.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("turn"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    out = ordered.select(
        "conv_id",
        F.flatten(F.transform("turns", lambda t: _segments(t, template))).alias("segments"),
        _first_fault(F.col("turns"), template).alias("first_fault"),
    )
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    both = [(role, t.opening, t.closing) for role, t in template.turns.items()]
    both.append(("", template.other.opening, template.other.closing))
    pattern = "(?s)" + "|".join(f"{re.escape(a)}.*?{re.escape(b)}" for _, a, b in both)

    def turn(part: Column) -> Column:
        out: Column | None = None
        for role, a, b in both:
            inner = F.substring(part, F.lit(len(a) + 1), F.length(part) - len(a) - len(b))
            if role:
                got = F.struct(F.lit(role).alias("role"), unescape(inner, template).alias("text"))
            else:
                at = F.instr(inner, F.lit(template.other_text))
                name = F.substring(inner, F.lit(1), at - 1)
                text = F.substring(inner, at + len(template.other_text), F.length(inner))
                got = F.struct(unescape(name, template).alias("role"), unescape(text, template).alias("text"))
            found = F.startswith(part, F.lit(a))
            out = F.when(found, got) if out is None else out.when(found, got)
        return out

    return F.transform(F.regexp_extract_all(formatted, F.lit(pattern), F.lit(0)), turn)


def digests(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """What reading the output back gives: checksums of the turns and of the text under the loss mask."""
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template))
    read = let(
        read_turns(F.col("formatted"), template),
        lambda turns: F.struct(
            F.size(turns).cast("long").alias("n_turns"),
            F.sha2(
                F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256
            ).alias("turns_sha256"),
        ),
    )
    rows = formatted.select("conv_id", "formatted", "first_fault", read.alias("r"), F.array_join(loss, "").alias("loss"))
    return rows.select(
        "conv_id",
        "r.*",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "first_fault",
    )
