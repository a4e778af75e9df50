"""Column expressions on text, and joins with sides of a checked size."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Rows up to which a side of two or three short columns is broadcast.
BROADCAST_ROWS = 200_000


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; null is empty."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def alphanumeric_words(text: Column | str) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text in lower case; null has none.

    Explode the array with an ``_outer`` function: for the others Spark adds a filter on its size,
    which splits every text twice.
    """
    return F.array_remove(F.split(lower_ascii(text), _BETWEEN_WORDS), "")


def is_small(frame: DataFrame, rows: int | None = None) -> bool:
    """Whether the frame is counted to have few rows (``BROADCAST_ROWS``).

    It should be cheap to compute twice, or materialised.
    """
    rows = BROADCAST_ROWS if rows is None else rows
    return frame.limit(rows + 1).count() <= rows


def small_side(frame: DataFrame, rows: int | None = None) -> DataFrame:
    """The frame, broadcast if it is small; else joins shuffle it."""
    return F.broadcast(frame) if is_small(frame, rows) else frame
