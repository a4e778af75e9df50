"""How filters interact: what each removes in every order, by contractions of a contingency tensor.

Documents are counted per part and per set of filters that they fail. A part's counts, reshaped to an axis
of two (pass, fail) per filter, are all that any order needs: what a step keeps or removes is the tensor
contracted with a vector per axis that selects pass, fail or all.

Nothing as large as the documents meets anywhere: texts are reduced to a digest and a few flags where they
are read, equal texts are summed before they are compared, and a part has one row per set of filters.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_BETWEEN_WORDS = r"[\x20\x09-\x0D]+"
#: Bits of the filters on a text alone, and of the one on repeated texts.
TEXT_FILTERS, REPEATED = "ABCD", "E"
FILTERS = TEXT_FILTERS + REPEATED
MEASURES = ("documents", "good", "toxic")
#: Tasks that rows without an id, which no label fits, are dealt out to.
SALTS = 1024

_PASS, _FAIL, _ALL = (1, 0), (0, 1), (1, 1)


def text_failures(text: Column, words: Column) -> Column:
    """Bits of the filters A to D that a text with these words fails."""
    fails = [
        F.size(words) < 100,
        100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))


def failure_counts(
    documents: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    part_column: str = "lang",
) -> DataFrame:
    """(part, fails, documents, good, toxic): documents per part and set of failed filters, as bits from A on.

    Filter E is failed by a text that a row with a smaller id has too. A null text is empty and a null part is
    the empty one. Each repeated row counts; rows that share an id and a text do not fail E by each other; rows
    without an id never fail E, cause no other's failure and have no labels. ``labels`` may repeat ids: a document
    is good (toxic) when any of its labels has quality (toxic) 1; null labels are none. Other columns are not read.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    read = documents.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        text.alias("text"), F.array_remove(F.split(text, _BETWEEN_WORDS), "").alias("words"),
    )
    own = read.select(
        "id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), text_failures(F.col("text"), F.col("words")).alias("fails"))
    own = own.withColumn("salt", F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(SALTS))).otherwise(F.lit(0)))
    # The salt here is a minimum of zeros, not a constant, which would leave the join no salt to deal rows by.
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("marked")).agg(
        F.min(F.lit(0).cast("long")).alias("no_salt"), *(
            F.max(F.coalesce(F.col(column) == 1, F.lit(False))).alias(mark)
            for column, mark in (("quality", "good"), ("toxic", "toxic"))))
    marked = own.join(marks, (F.col("id") == F.col("marked")) & (F.col("salt") == F.col("no_salt")), "left").select(
        "id", "part", "digest", "fails",
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))

    kind = ["digest", "part", "fails", "good", "toxic"]
    rows = marked.groupBy(*kind, "id").agg(F.count(F.lit(1)).alias("n"))
    named = F.col("id").isNotNull()
    kinds = rows.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("unnamed"),
        F.min(F.when(named, F.struct("id", "n"))).alias("first"))
    # A digest has a row per part, filters of its text and labels by now, however many documents hold it.
    kinds = kinds.withColumn("smallest", F.min("first.id").over(Window.partitionBy("digest")))
    is_first = F.col("first.id") == F.col("smallest")
    passing = F.col("unnamed") + F.when(is_first, F.col("first.n")).otherwise(F.lit(0))
    repeated = F.lit(1 << FILTERS.index(REPEATED))
    both = F.array(
        F.struct(F.col("fails").alias("fails"), passing.alias("documents")),
        F.struct((F.col("fails") + repeated).alias("fails"), (F.col("n") - passing).alias("documents")))
    split = kinds.select("part", "good", "toxic", F.explode(both).alias("side")).select("part", "good", "toxic", "side.*")
    return split.where("documents > 0").groupBy("part", "fails").agg(
        F.sum("documents").alias("documents"),
        *(F.sum(F.when(F.col(mark), F.col("documents")).otherwise(F.lit(0))).alias(mark) for mark in ("good", "toxic")))


def _selections(n: int) -> tuple[list[tuple[int, ...]], dict[str, np.ndarray]]:
    """All orders of n filters, and for each of their steps a vector per axis (step x axis x 2)."""
    orders = list(itertools.permutations(range(n)))
    chosen: dict[str, list] = {"kept": [], "removed": [], "failing": [], "alone": []}
    for order in orders:
        for step, this in enumerate(order):
            before = order[:step]
            chosen["kept"].append([_PASS if f in before or f == this else _ALL for f in range(n)])
            chosen["removed"].append([_PASS if f in before else _FAIL if f == this else _ALL for f in range(n)])
            chosen["failing"].append([_FAIL if f == this else _ALL for f in range(n)])
            chosen["alone"].append([_FAIL if f == this else _PASS for f in range(n)])
    return orders, {name: np.array(vectors, np.int64) for name, vectors in chosen.items()}


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of
    every order of the filters and each of its steps, from counts as ``failure_counts`` gives them.

    There are n! orders of n filters. A part has a row per order and step, zeros included; no parts give none.
    ``shapley`` is what the step's filter removes, summed over all orders.
    """
    n = len(filters)
    tensors = counts.groupBy("part").agg(F.collect_list(F.struct("fails", *MEASURES)).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, selections = _selections(n)
        axes = string.ascii_lowercase[:n]
        contraction = f"p{axes}m,{','.join('s' + axis for axis in axes)}->psm"
        filter_of = np.array(orders).ravel()
        for batch in batches:
            for first in range(0, batch.num_rows, 64):  # some parts at a time
                some = batch.slice(first, 64)
                parts = some.column("part").to_pylist()
                flat = np.zeros((len(parts), 1 << n, len(MEASURES)), np.int64)
                for p, cells in enumerate(some.column("cells").to_pylist()):
                    for cell in cells:
                        flat[p, cell["fails"]] += [cell[measure] for measure in MEASURES]
                # The first filter is the lowest bit, and so the last axis before they are turned round.
                tensor = flat.reshape(len(parts), *[2] * n, len(MEASURES))
                tensor = tensor.transpose(0, *range(n, 0, -1), n + 1)
                got = {
                    name: np.einsum(contraction, tensor, *(vectors[:, axis] for axis in range(n)), optimize="greedy")
                    for name, vectors in selections.items()
                }
                removed = got["removed"]
                shapley = np.stack([removed[:, filter_of == f, 0].sum(1) for f in range(n)], 1)
                yield pa.RecordBatch.from_pydict({
                    "part": np.repeat(np.array(parts, object), len(filter_of)),
                    "filter_order": [name for name in _names(orders, filters)] * len(parts),
                    "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders) * len(parts)),
                    "kept": got["kept"][:, :, 0].ravel(),
                    "removed": removed[:, :, 0].ravel(),
                    "redundant": (got["failing"] - removed)[:, :, 0].ravel(),
                    "unique_fails": got["alone"][:, :, 0].ravel(),
                    "good_lost": removed[:, :, MEASURES.index("good")].ravel(),
                    "toxic_lost": removed[:, :, MEASURES.index("toxic")].ravel(),
                    "shapley": shapley[:, filter_of].ravel(),
                })

    names = "kept removed redundant unique_fails good_lost toxic_lost shapley"
    schema = "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in names.split())
    return tensors.mapInArrow(run, schema)


def _names(orders: list[tuple[int, ...]], filters: str) -> Iterator[str]:
    for order in orders:
        name = "".join(filters[f] for f in order)
        yield from [name] * len(order)


def audit(documents: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """``interactions`` of the five filters over all documents; see ``failure_counts`` for rows of all kinds."""
    return interactions(failure_counts(documents, labels, **columns))
