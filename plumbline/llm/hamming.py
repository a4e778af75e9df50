"""Exact top-k search of binary codes by Hamming distance, with incremental multi-index hashing.

A code is cut into m segments, and each segment is an index of its own. Radius r looks up the segment
values at distance r of the query's, one segment after the other. A code not found after radius r in the first a
segments differs by more than r in each of these and by r at least in the others, so every code within
m * r + a - 1 has been found and verified. A query is finished when its k-th verified distance is within that
bound; the others go on to the next segment. Where segments have few values at a radius, all are looked up together.
Codes farther than a query's k-th distance so far are dropped where they are found.
"""

from __future__ import annotations

import functools
import itertools
import math
import operator
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.session import materialise

BITS = 64
#: Values of a segment at one radius from which segments are looked up one by one.
MANY_VALUES = 1000


def sign_code(vector: str, bits: int = BITS) -> Column:
    """Bit i is set where element i is above zero; null unless the vector has ``bits`` elements."""
    set_bits = [
        F.when(F.get(vector, F.lit(i)) > 0, F.lit(_signed(1 << i))).otherwise(F.lit(0).cast("long"))
        for i in range(bits)
    ]
    return F.when(F.size(vector) == bits, functools.reduce(lambda a, b: a.bitwiseOR(b), set_bits))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _segments(bits: int, n_codes: int) -> list[tuple[int, int]]:
    """(first bit, width) of segments no wider than the number of codes has bits.

    In wider ones most values that are looked up would belong to no code.
    """
    count = max(1, min(bits, math.ceil(bits / math.log2(max(n_codes, 4)))))
    ends = [round(bits * k / count) for k in range(count + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(ends)]


def _part(code: Column, segment: tuple[int, int]) -> Column:
    first, width = segment
    return F.shiftrightunsigned(code, first).bitwiseAND(F.lit(_signed((1 << width) - 1)))


def _in_segments(codes: DataFrame, column: str, segments: list[tuple[int, int]]) -> DataFrame:
    """A row per segment: its number and the code's value there."""
    parts = [F.struct(F.lit(s).alias("segment"), _part(F.col(column), at).alias("value"))
             for s, at in enumerate(segments)]
    return codes.select("*", F.explode(F.array(*parts)).alias("at")).select("*", "at.segment", "at.value").drop("at")


def _steps(segments: list[tuple[int, int]]) -> Iterator[tuple[int, range]]:
    """(radius, segments that are looked up) in order."""
    widest = max(width for _, width in segments)
    for radius in range(widest + 1):
        if math.comb(widest, radius) < MANY_VALUES:
            yield radius, range(len(segments))
        else:
            yield from ((radius, range(s, s + 1)) for s in range(len(segments)))


def _probes(queries: DataFrame, segments: list[tuple[int, int]], radius: int, asked: range) -> DataFrame:
    """Every value at exactly ``radius`` of the query's in the segments that are asked."""
    placed = _in_segments(queries, "query", segments)
    found = []
    for s in asked:
        width = segments[s][1]
        masks = [_signed(sum(1 << bit for bit in bits)) for bits in itertools.combinations(range(width), radius)]
        if masks:
            flips = F.explode(F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>"))
            own = placed.where(F.col("segment") == s).withColumn("flip", flips)
            found.append(own.select("query", "bound", "segment", F.col("value").bitwiseXOR(F.col("flip")).alias("value")))
    return functools.reduce(DataFrame.union, found) if found else placed.limit(0)


def _found_here(segments: list[tuple[int, int]], radius: int) -> Column:
    """That a pair comes up first at this radius, and in this segment of those where it does."""
    apart = F.col("query").bitwiseXOR(F.col("code"))
    distances = [F.bit_count(_part(apart, at)) for at in segments]
    before = [F.lit(True)]
    for distance in distances:
        before.append(before[-1] & (distance > radius))
    least = functools.reduce(operator.and_, [distance >= radius for distance in distances])
    return least & F.element_at(F.array(*before), F.col("segment") + 1)


def top_k(
    rows: DataFrame, queries: DataFrame, k: int = 10, *, bits: int = BITS,
) -> DataFrame:
    """(query_id, rank, neighbour_id, distance): the k nearest rows of each query, its own id left out.

    ``rows`` and ``queries`` have (id, code) with codes of ``bits`` bits, at most 64, as a long. Equal
    distances go by the smaller id. Rows without an id or a code cannot be found, and such queries have
    no answer; repeated rows count once; an id with several codes counts at its nearest, and a query id with
    several codes asks for each. Fewer than k rows in all give fewer neighbours. Rows with
    equal codes beyond the k + 1 smallest ids cannot be among the k nearest of any query, so a code that
    many rows share is searched with those alone.
    """
    rows = rows.where("id IS NOT NULL AND code IS NOT NULL").select("id", "code")
    queries = queries.where("id IS NOT NULL AND code IS NOT NULL").select(
        F.col("id").alias("query_id"), F.col("code").alias("query")
    ).distinct()
    per_code = Window.partitionBy("code").orderBy("id")
    # Ids are ranked after copies of one row are gone, so that these take no rank.
    few = rows.distinct().withColumn("place", F.row_number().over(per_code)).where(F.col("place") <= k + 1)
    few = materialise(few.drop("place"), "codes")
    codes = few.select("code").distinct()
    segments = _segments(bits, codes.count())
    index = materialise(_in_segments(codes, "code", segments), "segment-index")

    # Every side of these joins may grow with the tables, however small its files are: none is broadcast.
    by_query = Window.partitionBy("query_id", "query")
    active = materialise(queries, "queries")
    asking = active.select("query", F.lit(bits).alias("bound")).distinct()
    best, finished = None, []
    for radius, asked in _steps(segments):
        apart = F.bit_count(F.col("query").bitwiseXOR(F.col("code")))
        pairs = _probes(asking, segments, radius, asked).hint("merge").join(
            index.hint("merge"), ["segment", "value"]
        ).where(_found_here(segments, radius) & (apart <= F.col("bound"))).select(
            "query", "code", apart.alias("distance")
        )
        found = active.hint("merge").join(pairs.hint("merge"), "query").join(few.hint("merge"), "code")
        found = found.where("id <> query_id").select("query_id", "query", F.col("id").alias("neighbour_id"), "distance")
        if best is not None:
            found = found.union(best)
        nearest = found.groupBy("query_id", "query", "neighbour_id").agg(F.min("distance").alias("distance"))
        in_order = by_query.orderBy("distance", "neighbour_id")
        nearest = nearest.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= k)
        covered = len(segments) * radius + asked.stop - 1
        full = (F.col("rank") == k) & (F.col("distance") <= covered)
        last = F.when(F.col("rank") == k, F.col("distance"))
        nearest = nearest.withColumn("done", F.max(full).over(by_query)).withColumn("bound", F.max(last).over(by_query))
        # The one write of a step: the nearest rows of each query so far, and the queries without any.
        state = materialise(active.hint("merge").join(nearest.hint("merge"), ["query_id", "query"], "left"), "round")
        finished.append(state.where("done").drop("done", "bound"))
        open_ = state.where("done IS NULL OR NOT done")
        active = open_.select("query_id", "query").distinct()
        # Ids with one code share its probes: the largest bound holds for all of them.
        asking = open_.groupBy("query").agg(F.max(F.coalesce("bound", F.lit(bits))).alias("bound"))
        best = open_.where("neighbour_id IS NOT NULL").select("query_id", "query", "neighbour_id", "distance")
        if not open_.limit(1).count():
            break
    finished.append(open_.where("neighbour_id IS NOT NULL").drop("done", "bound"))  # fewer than k rows to find
    found = functools.reduce(DataFrame.unionByName, finished)
    return found.select("query_id", "rank", "neighbour_id", F.col("distance").cast("int").alias("distance"))
