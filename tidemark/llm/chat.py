"""Chat formatting: a finite-state machine over roles, and segments with loss flags from a template.

A conversation's turns stream through the machine in order. Each gives one segment of
text from the template, marks around the escaped words of the turn, and the span of it
that a model is trained on. Turn order is checked on the way, nothing is dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Marks around the turns of a role, and the order of roles that counts as valid.

    ``marks`` gives opening and closing mark by role; turns of other roles stand
    between ``other`` marks with the role's name and ``named`` in front. ``moves`` is
    the machine: (state, role) to the next state; a conversation is valid if every
    turn has a move and the last state is in ``finals``.
    """

    marks: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("[SYS]", "[/SYS]"),
            "user": ("[INST]", "[/INST]"),
            "assistant": ("<s>", "</s>"),
        }
    )
    other: tuple[str, str] = ("[TURN]", "[/TURN]")
    named: str = "[:]"
    loss: frozenset[str] = frozenset({"assistant"})
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "told",
            ("start", "user"): "asked",
            ("told", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    start: str = "start"
    finals: frozenset[str] = frozenset({"answered"})

    def __post_init__(self) -> None:
        """Marks must not overlap: none may hold the first character of one behind its own first."""
        heads = {m[0] for m in self.controls}
        if any(heads & set(m[1:]) or ESCAPE in m for m in self.controls):
            raise ValueError("a mark holds the escape or, inside, the first character of a mark")

    @property
    def controls(self) -> tuple[str, ...]:
        return (*(m for pair in self.marks.values() for m in pair), *self.other, self.named)

    def escaper(self) -> re.Pattern:
        heads = "|".join(f"{re.escape(m[0])}(?={re.escape(m[1:])})" for m in self.controls)
        return re.compile(f"({re.escape(ESCAPE)}|{heads})")

    def segment(self, role: str, text: str, pattern: re.Pattern) -> tuple[str, int, int]:
        """The turn as text, and the span of it under the loss mask."""
        body = pattern.sub(r"\1" + ESCAPE * 2, text)
        if role in self.marks:
            left, right = self.marks[role]
        else:
            left, right = self.other[0] + pattern.sub(r"\1" + ESCAPE * 2, role) + self.named, self.other[1]
        begin, end = len(left), len(left) + len(body)
        return left + body + right, begin, end if role in self.loss else begin

    def read(self, segment: str) -> tuple[str, str]:
        """Role and text of a segment, from its marks alone."""
        for role, (left, right) in self.marks.items():
            if segment.startswith(left):
                return role, unescape(segment[len(left) : -len(right)])
        role, _, body = segment[len(self.other[0]) : -len(self.other[1])].partition(self.named)
        return unescape(role), unescape(body)


def unescape(text: str) -> str:
    return re.sub(r"(.)" + re.escape(ESCAPE), r"\1", text, flags=re.S)


def format_turns(
    turns: DataFrame,
    template: Template | None = None,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, number, segment, loss_start, loss_end, state): the segments of every turn.

    Rows of a conversation are together and in order: by turn, nulls first, then role
    and text, so ties and repeated rows have a fixed place. ``number`` counts from 0.
    ``loss_start:loss_end`` is the trained part of the segment, empty for other roles.
    ``state`` is the machine's state after the turn, ``error`` from the first turn
    that has no move. A null text or role is an empty one; rows without conv_id form
    one conversation. Ids that are no whole numbers are kept as text. Other columns are ignored; an empty table gives no rows.

    Turns stream through a task one by one: no conversation is held whole, so its
    length is not bound by memory.
    """
    template = template or Template()
    whole = isinstance(turns.schema[conv].dataType, (T.IntegralType, T.NullType))
    kind = "long" if whole else "string"
    ordered = (
        turns.select(
            F.col(f"`{conv}`").cast(kind).alias("conv_id"),
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        )
        .repartition(F.col("conv_id"))
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pattern = template.escaper()
        at, number, state = object(), 0, template.start
        for batch in batches:
            out = []
            ids = batch["conv_id"].astype("object").where(batch["conv_id"].notna(), None)
            for c, r, t in zip(ids, batch["role"], batch["text"]):
                if c != at:
                    at, number, state = c, 0, template.start
                state = template.moves.get((state, r), "error")
                out.append((c, number, *template.segment(r, t, pattern), state))
                number += 1
            yield pd.DataFrame(out, columns=["conv_id", "number", "segment", "loss_start", "loss_end", "state"]).astype(
                {"conv_id": "Int64" if whole else "object"}
            )

    return ordered.mapInPandas(
        run, f"conv_id {kind}, number long, segment string, loss_start int, loss_end int, state string"
    )


def format_conversations(turns: DataFrame, template: Template | None = None, **columns: str) -> DataFrame:
    """(conv_id, formatted, loss, valid): whole conversations, ``loss`` as spans of code points.

    For conversations that fit in a row; ``format_turns`` has no such bound.
    """
    template = template or Template()
    held = format_turns(turns, template, **columns).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("number", "segment", "loss_start", "loss_end", "state"))).alias("s")
    )
    ahead = F.transform("s", lambda x, i: F.aggregate(
        F.slice("s", F.lit(1), i), F.lit(0), lambda a, y: a + F.length(y["segment"])
    ))
    spans = F.zip_with("s", ahead, lambda x, a: F.struct(
        (a + x["loss_start"]).alias("start"), (a + x["loss_end"]).alias("end")
    ))
    last = F.element_at("s", -1)["state"]
    return held.select(
        "conv_id",
        F.array_join(F.transform("s", lambda x: x["segment"]), "").alias("formatted"),
        F.filter(spans, lambda x: x["end"] > x["start"]).alias("loss"),
        last.isin(*sorted(template.finals)).alias("valid"),
    )
