"""Conversations as training text, by a declarative template and a machine over roles.

A template gives each role an opening and a closing mark, names the roles whose
texts carry loss, and lists the moves between roles.  Inside texts every control
string gets a backslash after its first character and every backslash is
doubled, so no text can be taken for a mark and the original is read back by
dropping one backslash from each pair of characters that begins with one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "\x00start", "\x00end"


@dataclass(frozen=True)
class Template:
    """Marks by role, roles with loss, moves of the machine, and further strings to be escaped.

    A role without marks of its own is spelled out between ``named[0]`` and
    ``named[1]``; its text ends with ``named[2]``.
    """

    marks: dict[str, tuple[str, str]]
    loss: frozenset[str]
    moves: dict[str, frozenset[str]]
    named: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "[END]")
    reserved: tuple[str, ...] = field(default=())

    def controls(self) -> list[str]:
        return sorted({m for pair in self.marks.values() for m in pair} | set(self.named) | set(self.reserved))

    def __post_init__(self) -> None:
        controls = self.controls()
        opening = [pair[0] for pair in self.marks.values()] + [self.named[0]]
        if len(set(opening)) < len(opening):
            raise ValueError("two roles open alike")
        for c in controls:
            if len(c) < 2 or "\\" in c:
                raise ValueError(f"{c!r} cannot be a control string")
            for other in controls:
                # The end of one may not begin another: a text and a mark could then make up a control string.
                if any(other.startswith(c[k:]) or (len(c[k:]) > len(other) and c[k:].startswith(other)) for k in range(1, len(c))):
                    raise ValueError(f"{c!r} overlaps {other!r}")


#: Instruction marks; a system turn may open, then user and assistant alternate and the assistant ends.
INSTRUCT = Template(
    marks={"system": ("<<SYS>>", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[OUT]", "</s>")},
    loss=frozenset({"assistant"}),
    moves={START: frozenset({"system", "user"}), "system": frozenset({"user"}), "user": frozenset({"assistant"}), "assistant": frozenset({"user", END})},
    reserved=("<s>",),
)


def escape(text: Column, template: Template) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in template.controls():
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _mark(role: Column, template: Template, place: int, other: Column) -> Column:
    out = None
    for name, pair in template.marks.items():
        out = F.when(role == name, pair[place]) if out is None else out.when(role == name, pair[place])
    return other if out is None else out.otherwise(other)


def format_chats(turns: DataFrame, template: Template = INSTRUCT, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, segments, formatted, valid, bad_turn``.

    ``segments`` (struct ``text, loss``) in order make up ``formatted``; only the
    texts of the template's loss roles carry loss, never a mark.  Turns are put
    in order of ``turn``, then role and text (nulls first); repeated rows are
    repeated turns.  Null roles and texts are empty ones.  ``valid`` tells
    whether the machine goes from start to end over the roles, ``bad_turn`` is
    the place (from 0) of the first turn it does not allow, or the number of
    turns if only the end is not allowed, or null.  Rows with a null ``conv_id``
    are one conversation.  Turns are formatted before the one shuffle; a whole
    conversation is one value, as its output is.  Other columns are ignored.
    """
    name, said = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    opening = _mark(name, template, 0, F.concat(F.lit(template.named[0]), escape(name, template), F.lit(template.named[1])))
    shown = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").alias("turn"), name.alias("role"), said.alias("said"), opening.alias("opening"), escape(said, template).alias("text"),
                 _mark(name, template, 1, F.lit(template.named[2])).alias("closing"), name.isin(*template.loss).alias("loss")).alias("t"))
    held = shown.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        F.struct(t.opening.alias("text"), F.lit(False).alias("loss")), F.struct(t.text.alias("text"), t.loss.alias("loss")), F.struct(t.closing.alias("text"), F.lit(False).alias("loss")))))
    # The machine's state before each turn is the role of the turn before it.
    before = F.concat(F.array(F.lit(START)), F.transform("turns", lambda t: t.role))
    after = F.concat(F.transform("turns", lambda t: t.role), F.array(F.lit(END)))
    allowed = [f"{a}\n{b}" for a, ends in template.moves.items() for b in sorted(ends)]
    moves = F.zip_with(before, after, lambda a, b: F.concat(a, F.lit("\n"), b).isin(*allowed))
    bad = F.array_position(moves, False)
    out = held.select("conv_id", segments.alias("segments"), (bad == 0).alias("valid"), F.when(bad > 0, bad - 1).alias("bad_turn"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s.text), ""))


def read_chats(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns (struct ``role, text``) that a formatted conversation holds."""
    marks = [(name, re.escape(a), re.escape(b)) for name, (a, b) in template.marks.items()]
    head, mid, tail = map(re.escape, template.named)
    turn = "(?s)" + "|".join([f"{a}.*?{b}" for _, a, b in marks] + [f"{head}.*?{mid}.*?{tail}"])
    found = F.regexp_extract_all(formatted, F.lit(turn), F.lit(0))

    def parts(t: Column) -> Column:
        inner = lambda a, b: F.substring(t, F.lit(len(a) + 1), F.length(t) - len(a) - len(b))
        other = F.regexp_extract(t, f"(?s)^{head}(.*?){mid}(.*){tail}$", 1), F.regexp_extract(t, f"(?s)^{head}(.*?){mid}(.*){tail}$", 2)
        role, text = None, None
        for name, (a, b) in template.marks.items():
            role = F.when(t.startswith(a), name) if role is None else role.when(t.startswith(a), name)
            text = F.when(t.startswith(a), inner(a, b)) if text is None else text.when(t.startswith(a), inner(a, b))
        return F.struct(unescape(role.otherwise(other[0])).alias("role"), unescape(text.otherwise(other[1])).alias("text"))

    return F.transform(found, parts)
