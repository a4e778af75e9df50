"""Segments: the slices of a table that rules talk about, and row membership in them.

A row may belong to several segments at once. Membership is packed into 62-bit
words, one bit per segment, so that a group of rows carries one or two longs in
place of a row per segment. Rule texts only ever enter plans as literals; the
expressions below name nothing but the plan's own columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.values import quoted

WORD_BITS = 62


@dataclass(frozen=True)
class Condition:
    """``column = value`` or ``column != value``, optionally upper-casing the column."""

    column: str
    value: str
    negated: bool = False
    upper: bool = False

    def test(self) -> Column:
        left = F.upper(self.column) if self.upper else F.col(self.column)
        return left != self.value if self.negated else left == self.value

    def text(self) -> str:
        left = f"upper({self.column})" if self.upper else self.column
        return f"{left} {'!=' if self.negated else '='} {quoted(self.value)}"


@dataclass(frozen=True)
class Segment:
    """All of ``all_of`` and, if given, every condition of one entry of ``any_of``."""

    all_of: tuple[Condition, ...] = ()
    any_of: tuple[tuple[Condition, ...], ...] = ()

    def test(self) -> Column:
        tests = [c.test() for c in self.all_of]
        if self.any_of:
            tests.insert(0, reduce(or_, [reduce(and_, [c.test() for c in g]) for g in self.any_of]))
        return reduce(and_, tests) if tests else F.lit(True)

    def text(self) -> str:
        parts = [c.text() for c in self.all_of]
        if self.any_of:
            groups = ["(" + " AND ".join(c.text() for c in g) + ")" for g in self.any_of]
            parts.insert(0, "(" + " OR ".join(groups) + ")")
        return " AND ".join(parts) if parts else "true"

    def columns(self) -> list[str]:
        listed = list(self.all_of) + [c for g in self.any_of for c in g]
        return list(dict.fromkeys(c.column for c in listed))


# Business lines that stand for the two streaming sources below.
STREAMING_LINES = ("DIRECT-NOW", "DTVNOW")
STREAMING_SOURCES = (("OTT", "QUICKPLAY"), ("ATT-OTT", "OMNITURE"))
SET_TOP_BOX = "STB"


def viewing_segment(line: str, mode: str | None, kind: str | None) -> Segment:
    """Segment of the viewing-history table.

    Any mode but the set-top box one means "not a set-top box", whatever its
    text. The rule's view type is compared as written with the upper-cased data.
    """
    if mode is None or kind is None:
        raise ValueError(f"a viewing rule needs a view mode and a view type (line {line!r})")
    tune_type = Condition("channel_tune_type", kind, upper=True)
    if line.upper() in STREAMING_LINES:
        return Segment(
            (Condition("viewing_platform", mode), tune_type),
            tuple(
                (Condition("business_line", b), Condition("source_system", s))
                for b, s in STREAMING_SOURCES
            ),
        )
    platform = Condition("viewing_platform", SET_TOP_BOX, negated=mode != SET_TOP_BOX)
    return Segment((Condition("business_line", line), platform, tune_type))


def status_segment(line: str, mode: str | None, kind: str | None) -> Segment:
    """Segment of the account and channel tables: the view mode is a status."""
    if mode is None:
        raise ValueError(f"an account or channel rule needs a status as view mode (line {line!r})")
    return Segment((Condition("business_line", line), Condition("status", mode)))


def line_segment(line: str, mode: str | None, kind: str | None) -> Segment:
    """Segment of the schedule and package tables: the business line alone."""
    return Segment((Condition("business_line", line),))


def whole_table(line: str, mode: str | None, kind: str | None) -> Segment:
    """Segment of a table without slices."""
    return Segment()


def in_any(flags: Sequence[str]) -> str:
    """True for rows of at least one segment, from one boolean column per segment."""
    return " OR ".join(flags)


def membership(flags: Sequence[str]) -> list[str]:
    """Boolean columns packed into words; bit ``i % 62`` of word ``i // 62`` is segment ``i``."""
    return [
        " | ".join(f"if({f}, {1 << i}L, 0L)" for i, f in enumerate(flags[at : at + WORD_BITS]))
        for at in range(0, len(flags), WORD_BITS)
    ]


def word_mask(ids, word: int) -> int:
    """The bits of the given segment ids that live in one word."""
    return sum(1 << (i % WORD_BITS) for i in set(ids) if i // WORD_BITS == word)


def segment_ids(words: Sequence[str], count: int) -> str:
    """Word columns back to an array of segment ids."""
    picked = [
        f"if(({words[i // WORD_BITS]} & {1 << (i % WORD_BITS)}L) != 0L, {i}, -1)" for i in range(count)
    ]
    return f"array_remove(array({', '.join(picked)}), -1)"
