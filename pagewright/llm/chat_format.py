"""Chat formatting: a finite-state machine over roles, and text segments with loss flags from a template.

Everything here is DataFrame expressions. Turns are ranked and checked by window functions, which sort
and spill; a conversation is gathered once, to build its one output row.

The state of the machine is the role last seen (``start`` before the first turn). Control strings inside
roles and texts are escaped by a backslash and read back exactly by :func:`read_turns`.

Defined results: a null text or role is empty. Rows are ordered by turn, then role, then text, nulls
first, so ties and repeated rows have one order; repeated rows are turns of their own (and, having the
same role twice, usually invalid). A null conv_id is one conversation. A conversation that the machine
rejects is still formatted, with valid false and the position of its first bad turn. An empty table
gives an empty result. Columns beyond conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """What stands around a turn, which roles bear loss, and which role may follow which."""

    open: str = "<|im_start|>"
    header_end: str = "\n"
    close: str = "<|im_end|>"
    after: str = "\n"
    control: str = "<|"
    loss_roles: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", "tool"), "tool": ("assistant",)}
    )

    def __post_init__(self) -> None:
        if not self.control or "\\" in self.control or not (self.open.startswith(self.control) and self.close.startswith(self.control)):
            raise ValueError("marks must start with the control string, which holds no backslash")

    def escape(self, text: Column) -> Column:
        """A backslash becomes two; one goes behind the first character of a control string."""
        marked = self.control[0] + "\\" + self.control[1:]
        return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(self.control), F.lit(marked))

    def escape_role(self, role: Column) -> Column:
        return F.replace(self.escape(role), F.lit(self.header_end), F.lit("\\" + self.header_end))

    @staticmethod
    def unescape(text: Column) -> Column:
        """A backslash goes, the character behind it stays."""
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def may_follow(self, before: Column, role: Column) -> Column:
        ok = F.lit(False)
        for state, roles in self.follows.items():
            ok = ok | ((before == state) & role.isin(*roles))
        return ok


CHATML = ChatTemplate()


def format_chats(conversations: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """One row per conversation: conv_id, valid, error_at, segments, formatted.

    ``segments`` is an array of (text, loss) in order; its texts together are ``formatted``. ``error_at``
    is the 0-based position of the first turn that the machine rejects, null if there is none.
    """
    by = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turns = conversations.select(
        "conv_id", F.row_number().over(by).alias("__at"), role.alias("__role"), text.alias("__text"), F.coalesce(F.lag(role).over(by), F.lit("start")).alias("__before")
    )
    loss = F.col("__role").isin(*template.loss_roles)
    segment = lambda piece, flag: F.struct(piece.alias("text"), flag.alias("loss"))
    pieces = F.array(
        segment(F.concat(F.lit(template.open), template.escape_role(F.col("__role")), F.lit(template.header_end)), F.lit(False)),
        segment(template.escape(F.col("__text")), loss),
        segment(F.lit(template.close + template.after), F.lit(False)),
    )
    wrong = F.when(~template.may_follow(F.col("__before"), F.col("__role")), F.col("__at") - 1)
    chats = turns.groupBy("conv_id").agg(
        F.min(wrong).alias("error_at"), F.array_sort(F.collect_list(F.struct(F.col("__at").alias("at"), pieces.alias("pieces")))).alias("__turns")
    )
    segments = F.flatten(F.transform("__turns", lambda t: t["pieces"]))
    chats = chats.select("conv_id", F.col("error_at").isNull().alias("valid"), "error_at", segments.alias("segments"))
    return chats.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: ChatTemplate = CHATML) -> Column:
    """The array of (role, text) that a formatted conversation holds.

    Escaped texts hold no control string, so the marks split it exactly.
    """
    end = re.escape(template.header_end)
    head = rf"(?s)^((?:[^\\{end}]++|\\.)*+){end}(.*)$"
    parts = F.split(formatted, re.escape(template.open), -1)
    bodies = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.get(F.split(p, re.escape(template.close), 2), F.lit(0)))
    return F.transform(
        bodies, lambda b: F.struct(template.unescape(F.regexp_extract(b, head, 1)).alias("role"), template.unescape(F.regexp_extract(b, head, 2)).alias("text"))
    )


def loss_text(segments: Column, template: ChatTemplate = CHATML) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescape(s["text"])), "")
