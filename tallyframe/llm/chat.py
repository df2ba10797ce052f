"""Chat formatting: a state machine over roles and a template that says what is marked and learned."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = ""


@dataclass(frozen=True)
class Template:
    """What surrounds a turn, which roles are learned, and which role may follow which.

    A turn is ``open + role + sep + text + close``. ``open`` and ``close`` are the
    control strings; neither may hold the escape sign ``\\`` or occur in the other.
    """

    open: str = "### "
    sep: str = ": "
    close: str = " </turn>\n"
    learned: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )

    def marks(self) -> tuple[str, str, str]:
        """The parts of the control strings that must not appear in a text, white space apart."""
        return self.open.strip(), self.close.strip(), self.sep.strip()


def escape(text: Column, marks: tuple[str, ...]) -> Column:
    """The escape sign before every escape sign, and between the first two characters of any mark.

    No text then holds these two in a row, however marks overlap, so none holds a mark.
    """
    pairs = dict.fromkeys((m[0], m[1]) for m in marks)
    breaks = "|".join(f"(?<={re.escape(a)}){re.escape(b)}" for a, b in pairs)
    return F.regexp_replace(text, rf"\\|{breaks}", r"\\$0")


def unescape(text: Column) -> Column:
    """Undo ``escape``: an escape sign stands for the character behind it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def accepted(before: Column, role: Column, template: Template) -> Column:
    """Whether the state machine moves from one role to the next; its state is the role before."""
    allowed = [f"{a}\n{b}" for a, after in template.follows.items() for b in after]
    return F.concat(before, F.lit("\n"), role).isin(allowed)


def format_chats(
    turns: DataFrame,
    template: Template | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: ``segments`` with loss flags, the text they make, and the order's verdict.

    Returns the conversation id, ``n_turns``, ``first_bad_turn`` (number from 0 of
    the first turn whose role may not follow the one before, null if none),
    ``segments`` (array of text, loss, and whether the machine accepted the turn) and
    ``formatted`` (the segments joined). One pass over the turns moves the machine and
    emits the segments. Every conversation is formatted, valid or not;
    ``first_bad_turn`` is for the caller to filter by. Learned texts are segments of
    their own, so that marks carry no loss.

    Null text is an empty text, null role an empty role, which the machine refuses.
    Turns with equal numbers, and repeated rows, stay and are ordered by role and
    text; a null turn number sorts first. A null conversation id is one
    conversation. An empty table gives an empty table. Other columns are ignored.

    A conversation is one row of the result, so its turns meet in one task.
    """
    template = template or Template()
    opened, closed, sep = template.marks()
    if opened in closed or closed in opened or "\\" in opened + closed + sep or min(map(len, (opened, closed))) < 2:
        raise ValueError("control strings must differ, have two characters or more and no backslash")
    if any(p.endswith(m[0]) for p in (template.open, template.sep) for m in (opened, closed)) or any(
        p.startswith(m[1]) for p in (template.sep, template.close) for m in (opened, closed)
    ):
        raise ValueError("control strings must not make a mark together with a text beside them")
    role = F.coalesce(F.col(f"`{role_col}`"), F.lit(""))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    grouped = turns.groupBy(F.col(f"`{conv_col}`").alias(conv_col)).agg(
        F.sort_array(
            F.collect_list(F.struct(F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text")))
        ).alias("__turns")
    )

    def emit(t: Column, place: Column) -> Column:
        # A role is cut at the first separator, so a separator inside it is broken up too.
        name = F.replace(escape(t["role"], (opened, closed)), F.lit(sep), F.lit("\\" + sep))
        before = F.when(place == 0, F.lit(START)).otherwise(F.get(F.col("__turns"), place - 1)["role"])
        good = accepted(before, t["role"], template)
        pieces = [
            (F.concat(F.lit(template.open), name, F.lit(template.sep)), F.lit(False)),
            (escape(t["text"], (opened, closed)), t["role"].isin(list(template.learned))),
            (F.lit(template.close), F.lit(False)),
        ]
        return F.array(*[F.struct(x.alias("text"), loss.alias("loss"), good.alias("accepted")) for x, loss in pieces])

    emitted = grouped.withColumn("__moves", F.transform("__turns", emit))
    first_bad = F.array_position(F.transform("__moves", lambda m: m[0]["accepted"]), F.lit(False)) - 1
    return emitted.select(
        conv_col,
        F.size("__turns").cast("long").alias("n_turns"),
        F.when(first_bad >= 0, first_bad.cast("int")).alias("first_bad_turn"),
        F.flatten("__moves").alias("segments"),
    ).withColumn("formatted", F.array_join(F.col("segments.text"), ""))


def read_back(formatted: Column, template: Template | None = None) -> Column:
    """Turns of a formatted text: array of role and text, unescaped."""
    template = template or Template()
    pieces = F.split(formatted, re.escape(template.close), -1)
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def parse(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(template.open) + 1))
        # The first separator without an escape sign before it; a doubled sign is no escape.
        head = F.regexp_extract(body, rf"(?s)^((?:[^\\{template.sep[0]}]|\\.)*){re.escape(template.sep)}", 1)
        rest = F.substr(body, F.char_length(head) + len(template.sep) + 1)
        return F.struct(unescape(head).alias("role"), unescape(rest).alias("text"))

    return F.transform(turns, parse)
