r"""Chat formatting: conversations to training text with a loss mask.

A declarative template names the marks around a turn, the roles that may follow
each other and the roles that are trained on.  A finite-state machine over roles
reads the turns of a conversation in order: its state is the role read last, a
turn is accepted if its role may follow the state, and the machine goes on from
any role, so one bad turn does not condemn the ones behind it.  Every turn emits
three text segments (opening mark, text, closing mark) with a loss flag each;
joined in order they are the formatted conversation.

Marks that occur inside texts or roles are escaped: the escape character becomes
itself and ``0``, the marks itself and ``1``, ``2``, ``3``.  As no mark holds the
escape character, an escaped text holds no mark, and each escape character in it
starts one two-character code, so the way back is exact.

The machine runs over blocks of turn numbers: within a block the role before is a
window function away, and the first turn of a block gets the last role of the
block before from one row per block.  So a conversation of any number of turns is
spread over tasks.  Only DataFrame functions are used.

Null conversation ids form one conversation; null turns come first; a null role
counts as the empty role (never accepted, not trained on), a null text as empty.
Turns with the same number are ordered by role, then text; repeated rows stay.
An empty table gives no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START = None
BLOCK = 1024  # turn numbers per block; the result does not depend on it


@dataclass(frozen=True)
class ChatTemplate:
    """``open`` role ``after_role`` text ``close`` ``gap``, once per turn."""

    open: str = "### "
    after_role: str = ": "
    close: str = "</turn>"
    gap: str = "\n"
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)
    ends: tuple[str, ...] = ("assistant",)
    follows: dict[str | None, tuple[str, ...]] = field(
        default_factory=lambda: {START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )

    def __post_init__(self):
        marks = [self.open, self.close, self.after_role]
        if len(self.escape) != 1 or not all(marks):
            raise ValueError("the escape is one character and no mark is empty")
        if any(self.escape in m for m in marks + [self.gap]):
            raise ValueError("a mark holds the escape character")
        if any(a in b for a, b in permutations(marks, 2)):
            raise ValueError("a mark is part of another one")
        for m in marks:
            if any(m[:k] == m[-k:] for k in range(1, len(m))):
                raise ValueError(f"{m!r} begins as it ends, so its place in a text would be ambiguous")

    def escaped(self, c: Column, role: bool = False) -> Column:
        for code, what in self._codes(role):
            c = F.replace(c, F.lit(what), F.lit(self.escape + code))
        return c

    def unescaped(self, c: Column, role: bool = False) -> Column:
        for code, what in reversed(self._codes(role)):
            c = F.replace(c, F.lit(self.escape + code), F.lit(what))
        return c

    def _codes(self, role: bool) -> list[tuple[str, str]]:
        return [("0", self.escape), ("1", self.open), ("2", self.close)] + [("3", self.after_role)] * role

    def accepts(self, before: Column, role: Column) -> Column:
        """One step of the machine; a null state is the start."""
        ok = F.lit(False)
        for state, roles in self.follows.items():
            ok = ok | (before.eqNullSafe(F.lit(state)) & role.isin(*roles))
        return ok


def run_machine(turns: DataFrame, template: ChatTemplate, conv_col: str, turn_col: str, role_col: str, text_col: str, block: int = BLOCK) -> DataFrame:
    """``(conv, block, place, role, text, ok)``: every turn with its place and the machine's verdict."""
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.coalesce(F.col(conv_col).cast("string"), F.lit("")).alias("key"),
        F.col(conv_col).isNull().alias("no_key"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("block", F.coalesce(F.expr(f"turn div {int(block)}L"), F.lit(-(1 << 62))))
    keys = ["key", "no_key", "block"]
    in_block = Window.partitionBy(*keys).orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = rows.withColumns({"place": F.row_number().over(in_block), "before": F.lag("role").over(in_block)})
    # the role of a block's last row needs no text: rows are ordered by turn (null first), then role
    last = rows.groupBy(*keys).agg(F.max(F.struct("turn", "role")).getField("role").alias("last"))
    edges = last.select(*keys, F.lag("last").over(Window.partitionBy("key", "no_key").orderBy("block")).alias("edge"))
    state = F.when(F.col("place") == 1, F.col("edge")).otherwise(F.col("before"))
    return placed.join(edges, keys).select("conv", "block", "place", "role", "text", template.accepts(state, F.col("role")).alias("ok"))


def format_conversations(
    turns: DataFrame,
    template: ChatTemplate | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """Segments ``(conv, block, place, part, segment, loss, role, ok)``.

    ``block``, ``place`` and ``part`` order the segments of a conversation; ``loss``
    marks texts of the template's loss roles, ``ok`` the turns the machine accepts.
    """
    t = template or ChatTemplate()
    rows = run_machine(turns, t, conv_col, turn_col, role_col, text_col, block)
    opening = F.concat(F.lit(t.open), t.escaped(F.col("role"), role=True), F.lit(t.after_role))
    parts = [(opening, F.lit(False)), (t.escaped(F.col("text")), F.col("role").isin(*t.loss_roles)), (F.lit(t.close + t.gap), F.lit(False))]
    made = F.explode(F.array(*[F.struct(F.lit(k).alias("part"), s.alias("segment"), loss.alias("loss")) for k, (s, loss) in enumerate(parts)]))
    out = rows.select("conv", "block", "place", "role", "ok", made.alias("s"))
    return out.select("conv", "block", "place", "s.part", "s.segment", "s.loss", "role", "ok")


def joined(segments: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """``(conv, formatted, loss_texts, n_bad, valid)``, one row per conversation.

    ``loss_texts`` are the segments under the loss mask, unescaped.  The formatted
    text of a conversation is one value, so here its segments meet.
    """
    t = template or ChatTemplate()
    order = F.struct("block", "place", "part", "segment", "loss")
    per = segments.groupBy("conv").agg(
        F.sort_array(F.collect_list(order)).alias("s"),
        F.count_if(~F.col("ok") & (F.col("part") == 0)).alias("n_bad"),
        F.max(F.struct("block", "place", "role")).getField("role").alias("end"),
    )
    return per.select(
        "conv",
        F.array_join(F.transform("s", lambda x: x["segment"]), "").alias("formatted"),
        F.transform(F.filter("s", lambda x: x["loss"]), lambda x: t.unescaped(x["segment"])).alias("loss_texts"),
        "n_bad",
        ((F.col("n_bad") == 0) & F.col("end").isin(*t.ends)).alias("valid"),
    )


def read_back(formatted: Column, template: ChatTemplate | None = None) -> Column:
    """Array of ``(role, text)`` of a formatted conversation: the way back."""
    t = template or ChatTemplate()
    pieces = F.split(formatted, re.escape(t.close + t.gap), -1)

    def turn(piece: Column) -> Column:
        at = F.locate(t.after_role, piece)
        role = F.substring(piece, F.lit(len(t.open) + 1), at - F.lit(len(t.open) + 1))
        text = F.substring(piece, at + F.lit(len(t.after_role)), F.length(piece))
        return F.struct(t.unescaped(role, role=True).alias("role"), t.unescaped(text).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - F.lit(1)), turn)
