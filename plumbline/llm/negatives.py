"""Hard negatives by exact inner product, with LEMP's pruning by lengths and by coordinates.

Rows are kept longest first. A run of rows of about one length is a bucket, which holds for each coordinate
its rows sorted by that coordinate of their unit vectors. For an anchor and the least score that still counts,
a bucket's longest row gives the largest angle that a row in it may have to the anchor; with the anchor's own
angle to an axis, that leaves a range of that coordinate. The rows in the ranges of the anchor's largest
coordinates (its focus) are intersected, and only those are multiplied out.

The least score is the k-th best so far, and for negatives never below the bound that the positive's score
sets. Anchors are searched a bounded number at a time, against all rows; tasks return their best few per anchor.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.session import local_frame, materialise

BUCKET_ROWS, FOCUS = 2048, 4
#: Anchors that go to all tasks at once. More are searched in as many turns as they need.
ANCHORS_AT_ONCE = 16_384
#: Room for the rounding of angles and unit vectors; it only lets more rows be multiplied out.
_SLACK = 1e-9


def floored(vector: Column, scale: int) -> Column:
    """The vector times ``scale``, rounded down; null if it or a component is null or not finite."""
    def odd(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    vector = vector.cast("array<double>")
    return F.when(~F.exists(vector, odd), F.transform(vector, lambda x: F.floor(x * scale)))


class Bucket:
    """Rows of about one length: ids, labels, vectors, and the rows sorted by each coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        self.longest = float(lengths.max(initial=0))
        unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(unit, axis=0)
        self.sorted = np.take_along_axis(unit, self.order, 0)
        self.largest = int(np.abs(vectors).max(initial=0))

    @functools.cached_property
    def _floats(self) -> np.ndarray:
        return self.vectors.astype(np.float64)

    def feasible(self, anchor: Anchor, least: int | None, focus: int) -> np.ndarray | None:
        """Places of the rows that can score ``least`` or more with the anchor; None for all."""
        if least is None or least <= 0:
            return None
        most = anchor.length * self.longest
        if least > most * (1 + _SLACK):
            return np.zeros(0, np.int64)
        apart = math.acos(max(-1.0, min(1.0, least / most - _SLACK)))
        hits, used = np.zeros(len(self.ids), np.int16), 0
        for axis, angle in anchor.focus(focus):
            column = self.sorted[:, axis]
            low = np.searchsorted(column, math.cos(min(math.pi, angle + apart)) - _SLACK, "left")
            high = np.searchsorted(column, math.cos(max(0.0, angle - apart)) + _SLACK, "right")
            if high - low < len(column):
                hits[self.order[low:high, axis]] += 1
                used += 1
        return np.flatnonzero(hits == used) if used else None

    def scores(self, anchor: Anchor, places: np.ndarray) -> np.ndarray:
        """Exact scores: in floating point where no sum can pass 2**53, else in 64-bit numbers."""
        bound = self.largest * anchor.largest * max(len(anchor.vector), 1)
        if bound < 1 << 53:
            return (self._floats[places] @ anchor.floats).astype(np.int64)
        if bound >= 1 << 63:
            raise ValueError("components are too large: a score may not fit in 64 bits")
        return self.vectors[places] @ anchor.vector


@dataclass
class Anchor:
    id: int
    label: int
    vector: np.ndarray
    #: (id, score) of its positives, once they are known.
    positives: list[tuple[int, int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.floats = self.vector.astype(np.float64)
        self.length = float(np.sqrt((self.floats**2).sum()))
        self.largest = int(np.abs(self.vector).max(initial=0))

    def focus(self, size: int) -> list[tuple[int, float]]:
        """The axes of the largest coordinates, and the anchor's angle to each."""
        unit = self.floats / self.length
        axes = np.argsort(-np.abs(unit), kind="stable")[:size]
        return [(int(axis), math.acos(max(-1.0, min(1.0, unit[axis])))) for axis in axes]


class Best:
    """The k best (id, score) so far with a score from ``least`` to ``most``; ties go to smaller ids."""

    def __init__(self, k: int, least: int | None = None, most: int | None = None):
        self.k, self.least, self.most = k, least, most
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def threshold(self) -> int | None:
        """The least score that still counts; None for any."""
        return int(self.scores[-1]) if len(self.scores) == self.k else self.least

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        least = self.threshold()
        keep = np.ones(len(ids), bool) if least is None else scores >= least
        if self.most is not None:
            keep &= scores <= self.most
        if keep.any():
            ids, scores = np.concatenate([self.ids, ids[keep]]), np.concatenate([self.scores, scores[keep]])
            best = np.lexsort((ids, -scores))[: self.k]
            self.ids, self.scores = ids[best], scores[best]


def _buckets(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[Bucket]:
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            part = batch.slice(first, rows)
            ids, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
            vectors = part.column("vector")
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            for size in np.unique(sizes):  # one, but for tables with vectors of several sizes
                own = np.flatnonzero(sizes == size)
                at = (ends[own] - size)[:, None] + np.arange(size)
                yield Bucket(ids[own], labels[own], flat[at].reshape(len(own), size).astype(np.int64))


def _searched(
    rows: DataFrame, anchors: list[Anchor], wanted: list[list[Best]], same_label: bool, focus: int, bucket_rows: int,
) -> DataFrame:
    """(anchor, slot, id, score): the best rows of each task for every ``Best`` that is wanted of an anchor, by
    the numbers of both."""
    sent = rows.sparkSession.sparkContext.broadcast((anchors, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, wanted = sent.value
        found = [[Best(b.k, b.least, b.most) for b in slots] for slots in wanted]
        for bucket in _buckets(batches, bucket_rows):
            for anchor, slots in zip(anchors, found):
                if not slots or len(anchor.vector) != bucket.vectors.shape[1]:
                    continue
                thresholds = [best.threshold() for best in slots]
                least = None if None in thresholds else min(thresholds)
                places = bucket.feasible(anchor, least, focus)
                if places is None:
                    places = np.arange(len(bucket.ids))
                alike = bucket.labels[places] == anchor.label
                places = places[(alike if same_label else ~alike) & (bucket.ids[places] != anchor.id)]
                if len(places):
                    scores = bucket.scores(anchor, places)
                    for best in slots:
                        best.add(bucket.ids[places], scores)
        out = [
            (a, slot, int(i), int(score)) for a, slots in enumerate(found) for slot, best in enumerate(slots)
            for i, score in zip(best.ids, best.scores)
        ]
        if out:
            columns = [pa.array(values, kind) for values, kind in zip(zip(*out), [pa.int32(), pa.int32(), pa.int64(), pa.int64()])]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "slot", "id", "score"])

    found = rows.mapInArrow(run, "anchor int, slot int, id long, score long")
    k = max((best.k for slots in wanted for best in slots), default=0)
    in_order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchors: Column, *, positives: int = 5, negatives: int = 3, low: tuple[int, int] = (50, 100),
    high: tuple[int, int] = (95, 100), focus: int = FOCUS, bucket_rows: int = BUCKET_ROWS,
    anchors_at_once: int = ANCHORS_AT_ONCE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exact.

    ``rows`` has (id, label) as whole numbers and vector as array<long>; ``anchors`` is the condition, over
    these, that makes a row an anchor. An anchor's positives are its best other rows of its label, at most
    ``positives``; for each, its negatives are the best rows of another label whose score is at least ``low`` and
    at most ``high`` (numerator, denominator) of the positive's, at most ``negatives``. Higher scores come
    first, ties by smaller ids; ``rank`` counts from 1.

    Rows with a null in id, label or vector (or within it) take no part. Repeated rows count once. Rows that share an
    id but differ are rows of their own; none of them is a partner of an anchor of that id. Vectors of different
    size have no score with each other. A positive that no negative fits has no rows, and neither has an anchor without
    positives; a positive score below zero fits no negative. No rows or no anchors give none. Other columns are
    not read. At most about ``anchors_at_once`` anchors, and their positives, come to the driver at a time.
    """
    vector = F.col("vector").cast("array<long>")
    rows = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), vector.alias("vector"))
    rows = rows.where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
        & ~F.exists("vector", lambda x: x.isNull())).distinct()
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    rows = materialise(rows.withColumn("squares", squares).sortWithinPartitions(F.desc("squares")), "by-length")
    rows = rows.select("id", "label", "vector")
    asked = rows.where(anchors)
    turns = max(1, math.ceil(asked.count() / anchors_at_once))
    turn = F.pmod(F.xxhash64("id", "label", "vector"), F.lit(turns))
    found = [
        _of_anchors(rows, asked.where(turn == t), positives, negatives, low, high, focus, bucket_rows)
        for t in range(turns)
    ]
    return functools.reduce(DataFrame.union, found)


def _of_anchors(
    rows: DataFrame, asked: DataFrame, positives: int, negatives: int, low: tuple[int, int], high: tuple[int, int],
    focus: int, bucket_rows: int,
) -> DataFrame:
    """The result for anchors of a bounded number."""
    listed = asked.toArrow()
    anchors = [
        Anchor(i, label, np.array(vector, np.int64))
        for i, label, vector in zip(*(listed.column(c).to_pylist() for c in ("id", "label", "vector")))
    ]
    first = _searched(rows, anchors, [[Best(positives)] for _ in anchors], True, focus, bucket_rows)
    for row in first.orderBy("anchor", "rank").collect():
        anchors[row["anchor"]].positives.append((row["id"], row["score"]))
    wanted = []
    for anchor in anchors:
        bounds = [(-(-low[0] * score // low[1]), high[0] * score // high[1]) for _, score in anchor.positives]
        wanted.append([Best(negatives, least, most) for least, most in bounds])
    found = _searched(rows, anchors, wanted, False, focus, bucket_rows)
    names = [
        {"anchor": a, "slot": slot, "anchor_id": anchor.id, "positive_id": i, "positive_score": score}
        for a, anchor in enumerate(anchors) for slot, (i, score) in enumerate(anchor.positives)
    ]
    names = local_frame(rows.sparkSession, names, "anchor int, slot int, anchor_id long, positive_id long, positive_score long")
    return found.join(names, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
