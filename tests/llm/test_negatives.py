"""Hard negatives against every score multiplied out."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import negatives

SCHEMA = "id long, label long, vector array<long>, slot int, anchor string, score double"


def brute_force(rows, is_anchor, positives=5, negatives_=3, low=(50, 100), high=(95, 100)):
    rows = {(i, label, tuple(v)) for i, label, v in rows if i is not None and label is not None and v is not None and None not in v}
    found = []
    for i, label, v in rows:
        if not is_anchor(i):
            continue
        scored = sorted(
            ((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in rows if j != i and len(w) == len(v)))
        mine = [(-s, j) for s, j, other in scored if other == label][:positives]
        for p, j in mine:
            fits = [(-s, n) for s, n, other in scored
                    if other != label and low[0] * p <= low[1] * -s and high[1] * -s <= high[0] * p][:negatives_]
            found += [(i, j, rank, n, p, s) for rank, (s, n) in enumerate(fits, 1)]
    return sorted(found)


def checked(spark, rows, every=5, **options):
    frame = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], SCHEMA).repartition(4)
    got = negatives.mine(frame, F.col("id") % every == 0, **options)
    got = sorted(tuple(r) for r in got.collect())
    assert got == brute_force(rows, lambda i: i % every == 0)
    return got


def vectors(n, dims, seed, labels=4, spread=1.0):
    random_ = random.Random(seed)
    centres = [[random_.gauss(0, 60) for _ in range(dims)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = random_.randrange(labels)
        stretch = math.exp(random_.gauss(0, spread))
        rows.append((i, label, [int(stretch * (c + random_.gauss(0, 50))) for c in centres[label]]))
    return rows


@pytest.mark.parametrize("spread, bucket_rows, focus", [(0.0, 16, 4), (1.0, 16, 4), (1.0, 64, 1), (0.3, 7, 16)])
def test_pruned_search_is_exact(spark, spread, bucket_rows, focus):
    got = checked(spark, vectors(400, 16, 3, spread=spread), bucket_rows=bucket_rows, focus=focus)
    assert len(got) > 200


def test_turns(spark):
    checked(spark, vectors(200, 8, 5), anchors_at_once=7)


def test_ties_repeats_and_odd_rows(spark):
    rows = [(i, i % 3, [3, 4, 0]) for i in range(40)]  # one vector, many ids
    rows += rows[:5]
    rows += [(0, 1, [3, 4, 0]), (0, 0, [1, 0, 0]), (5, 2, [6, 8, 0]), (50, 1, [2, 2, 2]), (51, 1, [-2, -2, -2])]
    rows += [(None, 0, [3, 4, 0]), (60, None, [3, 4, 0]), (65, 0, None), (70, 0, [1, None, 2]), (75, 0, [0, 0, 0]), (80, 0, [])]
    rows += [(85, 1, []), (90, 1, [1, 2]), (91, 1, [2, 1]), (92, 2, [1, 1])]
    checked(spark, rows, bucket_rows=8)


def test_edges_of_the_bounds(spark):
    rows = [(0, 0, [10]), (1, 0, [10]), (2, 1, [5]), (3, 1, [4]), (4, 1, [9]), (6, 1, [10]), (7, 2, [-3]), (8, 2, [0])]
    got = checked(spark, rows)
    assert [(r[3], r[5]) for r in got] == [(4, 90), (2, 50)]
    assert checked(spark, [(0, 0, [10]), (1, 0, [-1]), (2, 1, [-1]), (3, 1, [1])]) == []  # a score below zero
    assert len(checked(spark, [(0, 0, [10]), (1, 0, [0]), (2, 1, [0])])) == 1  # a score of zero


def test_large_components(spark):
    big = 1 << 28
    rows = [(i, i % 2, [big - i * 999_983, i * 7 - big, big // (i + 1)]) for i in range(30)]
    checked(spark, rows, bucket_rows=8)
    far = spark.createDataFrame([(0, 0, [1 << 40]), (1, 0, [1 << 40])], "id long, label long, vector array<long>")
    with pytest.raises(Exception, match="may not fit in 64 bits"):
        negatives.mine(far, F.col("id") == 0).collect()


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(none, F.col("id") % 5 == 0).collect() == []
    few = spark.createDataFrame([(1, 1, [1], 1, "x", 2.0)], SCHEMA)
    assert negatives.mine(few, F.col("id") % 5 == 0).collect() == []


def test_feasible_ranges_prune_and_keep():
    """Rows that score enough are always within the ranges; each axis of the focus leaves others out."""
    generator = np.random.default_rng(7)
    vectors_ = (generator.normal(size=(2000, 8)) * 100).astype(np.int64)
    bucket = negatives.Bucket(np.arange(2000), np.zeros(2000, np.int64), vectors_)
    anchor = negatives.Anchor(0, 0, vectors_[0])
    scores = vectors_ @ vectors_[0]
    least = int(np.sort(scores)[-5])
    sizes = []
    for focus in (1, 2, 4, 8):
        places = bucket.feasible(anchor, least, focus)
        assert set(np.flatnonzero(scores >= least)) <= set(places)
        sizes.append(len(places))
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0] < 2000
    assert len(bucket.feasible(anchor, int(anchor.length * bucket.longest * 1.01) + 1, 4)) == 0


def test_floored(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.001, 0.0]), (2, [1.0, None]), (3, [nan]), (4, [-inf, 1.0]), (5, None), (6, [])]
    frame = spark.createDataFrame(rows, "id long, v array<float>")
    got = {r["id"]: r["f"] for r in frame.select("id", negatives.floored(F.col("v"), 256).alias("f")).collect()}
    assert got == {1: [128, -1, 0], 2: None, 3: None, 4: None, 5: None, 6: []}
