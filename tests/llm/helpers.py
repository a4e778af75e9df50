"""Small tables with everything that may go wrong in them, and plain counterparts of the word rules."""

from __future__ import annotations

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")

DOCUMENTS = "doc_id long, text string, id long, words array<string>, bit long, row string, fold int"


def alphanumeric(text):
    return ALPHANUMERIC.findall((text or "").translate(LOWER))


def spaced(text):
    return SPACED.findall((text or "").translate(LOWER))


def documents(spark, texts):
    """Rows of (doc_id, text) with columns whose names the operators use inside."""
    rows = [(i, text, -1, ["x"], 7, "r", 3) for i, text in texts]
    return spark.createDataFrame(rows, DOCUMENTS)


def by_id(frame, key="doc_id"):
    return {row[key]: row for row in frame.collect()}
