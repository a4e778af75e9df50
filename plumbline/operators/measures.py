"""One-pass measures over a table, for all segments and rules at once.

Each function scans its rows once (or once per disjoint set of columns) and
aggregates per day. Segment membership travels as bit words in the grouping
key, so the number of rules never multiplies the rows. The frames returned are
small: day x segment x measure.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.segments import (
    WORD_BITS,
    Segment,
    in_any,
    membership,
    segment_ids,
    word_mask,
)
from plumbline.functions.values import identifier, improper_sql

DAY = "partitionDate"

# Conditional counts, or columns, that share one scan. Beyond about 40
# the generated row loop passes 8,000 bytecodes, where the JVM stops compiling it.
COUNTERS_PER_PASS = 24
COLUMNS_PER_PASS = 24


def _passes(items: Sequence, size: int) -> list[Sequence]:
    """Items in as few, and as even, runs of at most ``size`` as possible."""
    count = math.ceil(len(items) / size)
    return [items[i * len(items) // count : (i + 1) * len(items) // count] for i in range(count)]


def _word_names(segments: Sequence[Segment]) -> list[str]:
    return [f"_word{i}" for i in range((len(segments) + WORD_BITS - 1) // WORD_BITS)]


def _in_segments(rows: DataFrame, day: Column, segments: Sequence[Segment],
                 columns: Sequence[str]) -> DataFrame:
    """Rows of any of the segments as (day, membership words, columns).

    The flags are plain comparisons, so the filter on them reaches the scan.
    """
    flags = [f"_s{i}" for i in range(len(segments))]
    names = [c.rsplit(" AS ", 1)[-1] for c in columns]
    flagged = rows.select(
        day.alias(DAY), *[s.test().alias(f) for s, f in zip(segments, flags)],
        *[F.expr(c) for c in columns],
    ).where(in_any(flags))
    words = [f"{w} AS {n}" for w, n in zip(membership(flags), _word_names(segments))]
    return flagged.selectExpr(DAY, *words, *names)


def _per_segment(frame: DataFrame, segments: Sequence[Segment]) -> DataFrame:
    """Membership words of each row to one row per segment."""
    names = _word_names(segments)
    kept = [c for c in frame.columns if c not in names]
    ids = segment_ids(names, len(segments))
    return frame.selectExpr(*[identifier(c) for c in kept], f"explode({ids}) AS segment")


def improper_counts(rows: DataFrame, day: Column, segments: Sequence[Segment],
                    counters: Sequence[tuple[str, int]],
                    per_pass: int = COUNTERS_PER_PASS) -> DataFrame:
    """Improper and total rows per (day, segment, counter).

    A counter is a (column, minimum length). Rows are first counted per day and
    membership pattern, with one conditional count per counter; map-side
    partial aggregation leaves a few rows per task to shuffle, however skewed
    the segments are. More counters than ``per_pass`` are split evenly over
    several scans; each reads its own columns, so only the narrow segment
    columns are read again.
    """
    names = _word_names(segments)
    used = list(dict.fromkeys(column for column, _ in counters))
    alias = {column: f"_c{i}" for i, column in enumerate(used)}
    types = {column: rows.schema[_field(rows, column)].dataType for column in used}
    tagged = _in_segments(rows, day, segments, [f"{identifier(c)} AS {alias[c]}" for c in used])
    measured = []
    # Counters of one column together, so that few columns are read twice.
    for chunk in _passes(sorted(enumerate(counters), key=lambda c: c[1][0]), per_pass):
        tests = [improper_sql(alias[column], types[column], length) for _, (column, length) in chunk]
        cells = ", ".join(f"{i}, _n{i}" for i, _ in chunk)
        counted = tagged.groupBy(DAY, *names).agg(
            F.expr("count(*) AS total"),
            *[F.expr(f"count_if({test}) AS _n{i}") for (i, _), test in zip(chunk, tests)],
        )
        measured.append(counted.selectExpr(
            DAY, *names, "total", f"stack({len(chunk)}, {cells}) AS (counter, improper)"
        ))
    patterns = reduce(DataFrame.unionByName, measured)
    return _per_segment(patterns, segments).groupBy(DAY, "segment", "counter").agg(
        F.sum("improper").alias("improper"), F.sum("total").alias("total")
    )


def row_counts(rows: DataFrame, day: Column, segments: Sequence[Segment]) -> DataFrame:
    """Rows per (day, segment). Days without rows are absent."""
    counted = (
        _in_segments(rows, day, segments, [])
        .groupBy(DAY, *_word_names(segments)).agg(F.count("*").alias("n"))
    )
    return _per_segment(counted, segments).groupBy(DAY, "segment").agg(F.sum("n").alias("n"))


def distinct_counts(rows: DataFrame, day: Column, segments: Sequence[Segment],
                    wanted: Iterable[tuple[str, Sequence[int]]],
                    per_pass: int = COLUMNS_PER_PASS) -> DataFrame:
    """Distinct values per (day, segment, column), where NULL is one value.

    ``wanted`` pairs a column with the segments that ask for it; the result's
    ``column`` is the pair's position.

    Every value becomes one row (day, column, value, membership), and a single
    shuffle keeps, per distinct value, the union of the segments it was seen in.
    A hot value collapses before the shuffle, and segments that share values do
    not repeat them. Values keep their own types, one slot per type. More
    columns than ``per_pass`` are split evenly over several scans.
    """
    wanted = list(wanted)
    names = _word_names(segments)
    types = [rows.schema[_field(rows, c)].dataType for c, _ in wanted]
    tagged = _in_segments(
        rows, day, segments, [f"{identifier(c)} AS _c{i}" for i, (c, _) in enumerate(wanted)]
    )
    seen = []
    # Like types together, so that a pass needs few slots.
    for chunk in _passes(sorted(range(len(wanted)), key=lambda i: types[i].simpleString()), per_pass):
        slots = list(dict.fromkeys(types[i] for i in chunk))
        slot_names = [f"_v{i}" for i in range(len(slots))]
        cells = []
        for i in chunk:
            cells.append(str(i))
            cells += [f"{n} & {word_mask(wanted[i][1], w)}L" for w, n in enumerate(names)]
            cells += [f"_c{i}" if s == types[i] else "NULL" for s in slots]
        out = ", ".join(["column", *names, *slot_names])
        values = tagged.selectExpr(
            DAY, f"stack({len(chunk)}, {', '.join(cells)}) AS ({out})"
        ).where(" OR ".join(f"{n} != 0L" for n in names))
        met = values.groupBy(DAY, "column", *slot_names).agg(*[F.bit_or(n).alias(n) for n in names])
        seen.append(met.select(DAY, "column", *names))
    return _per_segment(reduce(DataFrame.unionByName, seen), segments).groupBy(
        DAY, "segment", "column"
    ).agg(F.count("*").alias("n"))


def duplicate_counts(rows: DataFrame, day: Column, segments: Sequence[Segment],
                     keys: Sequence[str], having: Sequence[str]) -> DataFrame:
    """Duplicated keys per (day, segment, having column).

    A key is duplicated when the having column is present in more than one of
    its rows; ``having`` in the result is the position of that column. NULL key
    parts group together. Rows that no having column could count are dropped at
    the scan. Keys are counted per membership pattern first, so that only counted
    keys, not rows, are repeated for overlapping segments.
    """
    key_names = [f"_k{i}" for i in range(len(keys))]
    present = [f"{identifier(h)} IS NOT NULL" for h in having]
    tagged = _in_segments(
        rows.where(" OR ".join(present)), day, segments,
        [f"{identifier(k)} AS {n}" for k, n in zip(keys, key_names)]
        + [f"{p} AS _h{i}" for i, p in enumerate(present)],
    )
    met = tagged.groupBy(DAY, *_word_names(segments), *key_names).agg(
        *[F.expr(f"count_if(_h{i}) AS _h{i}") for i in range(len(having))]
    )
    counted = _per_segment(met, segments).groupBy(DAY, "segment", *key_names).agg(
        *[F.expr(f"sum(_h{i}) AS _h{i}") for i in range(len(having))]
    )
    groups = counted.groupBy(DAY, "segment").agg(
        *[F.expr(f"count_if(_h{i} > 1) AS _n{i}") for i in range(len(having))]
    )
    cells = ", ".join(f"{i}, _n{i}" for i in range(len(having)))
    return groups.selectExpr(DAY, "segment", f"stack({len(having)}, {cells}) AS (having, n)")


def _field(rows: DataFrame, column: str) -> str:
    """The schema's own spelling of a column name."""
    return next(f for f in rows.columns if f.lower() == column.lower())
