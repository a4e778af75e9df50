"""Near-duplicate documents by minhash with tensored banding, every link confirmed on whole sets.

A document has two small collections of keys, each key made of a few minhashes. The keys of the
tables are all pairs of one key from either collection, so ``keys`` x ``keys`` tables need only
2 x ``keys`` minhash keys. Two documents of similarity s share a table with probability
(1 - (1 - s ** hashes) ** keys) ** 2: with 2 and 10 that is 0.9999 at 0.8.

Texts with equal sets are one class from the start. Classes that share a table are candidates, but
pairs within a table are not all formed: first every class is compared with the smallest and the
largest of each of its tables, and then only classes that lie in different components so far. Most
of those are ruled out by the parities of their shingles' counts in a fixed number of buckets: sets
differ in at least as many shingles as parities.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.components import components
from plumbline.llm.words import Words, distinct, mixed, shingles, slices, words_of
from plumbline.session import materialise

HASHES, KEYS = 2, 10
#: Bits of the table that tells most documents without candidates apart; its size never changes.
FILTER_BITS = 1 << 22
PARITY_WORDS = 16


def _sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(texts that have shingles, start of each, distinct shingles)."""
    text, values = distinct(*shingles(words, size))
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    return text[starts], starts, values


def _lists(values: np.ndarray, starts: np.ndarray, texts: np.ndarray, n: int) -> pa.Array:
    """A list per text; texts not named have an empty one."""
    lengths = np.zeros(n + 1, np.int64)
    lengths[texts + 1] = np.diff(np.append(starts, len(values)))
    offsets = np.cumsum(lengths).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _minhash_keys(values: np.ndarray, starts: np.ndarray, hashes: int, keys: int, side: int) -> np.ndarray:
    """(sets, keys) keys; the number of a key is mixed in."""
    found = np.empty((len(starts), keys), np.uint64)
    for key in range(keys):
        joined = np.full(len(starts), (side * keys + key) * 2 + 1, np.uint64)
        for k in range(hashes):
            number = (side * keys + key) * hashes + k
            factor = mixed(np.array([number], np.uint64), 11)[0] | np.uint64(1)
            joined = mixed(joined + np.minimum.reduceat((values * factor) >> np.uint64(20), starts), 12)
        found[:, key] = joined
    return found


def _parities(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(sets, PARITY_WORDS): whether the shingles in each of 64 buckets a word are odd in number."""
    bits = mixed(values, 23)
    word = (bits & np.uint64(PARITY_WORDS - 1)).astype(np.int64)
    bit = np.uint64(1) << (bits >> np.uint64(58))
    own = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(values))))
    found = np.zeros(len(starts) * PARITY_WORDS, np.uint64)
    np.bitwise_xor.at(found, own * PARITY_WORDS + word, bit)
    return found.reshape(len(starts), PARITY_WORDS)


def signatures(documents: DataFrame, shingle_words: int, hashes: int, keys: int) -> DataFrame:
    """Of each document (id, text): size, 128-bit fingerprint and parities of its set, its minhash keys.

    Columns other than id and text are carried along.
    """
    own = [field for field in documents.schema.fields if field.name != "text"]
    schema = T.StructType([
        *[T.StructField(field.name, field.dataType) for field in own], T.StructField("n_shingles", T.LongType()),
        T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()),
        *[T.StructField(name, T.ArrayType(T.LongType())) for name in ("left", "right", "parity")],
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n = part.num_rows
                texts, starts, values = _sets(words_of(part.column("text")), shingle_words)
                sizes, a, b = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                sides = [np.zeros((0, 1), np.uint64)] * 3
                if len(starts):
                    sizes[texts] = np.diff(np.append(starts, len(values)))
                    a[texts] = np.add.reduceat(mixed(values, 21), starts)
                    b[texts] = np.add.reduceat(mixed(values, 22), starts)
                    sides = [_minhash_keys(values, starts, hashes, keys, side) for side in (0, 1)]
                    sides.append(_parities(values, starts))
                lists = [
                    _lists(side.reshape(-1), np.arange(len(texts)) * side.shape[1], texts, n) for side in sides
                ]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(field.name) for field in own], pa.array(sizes), pa.array(a.view(np.int64)),
                     pa.array(b.view(np.int64)), *lists],
                    schema.names,
                )

    return documents.mapInArrow(run, schema)


def _filter_bits(ids: DataFrame) -> np.ndarray:
    """A table of ``FILTER_BITS`` bits with those of the ids set, collected as fixed-size pieces."""
    bit = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)) + 1  # these functions count from 1
    pieces = ids.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in pieces.collect():  # at most FILTER_BITS / 32768 rows of 4 KB
        piece = np.frombuffer(row["bits"], np.uint8)
        at = (row["piece"] - 1) * 4096
        bits[at: at + len(piece)] = piece
    return np.unpackbits(bits, bitorder="little").astype(bool)


def whole_sets(documents: DataFrame, ids: DataFrame, shingle_words: int) -> DataFrame:
    """(id, shingles) of documents whose id may be in ``ids``; few others pass the bit table."""
    wanted = _filter_bits(ids)
    id_type = documents.schema["id"].dataType
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("shingles", T.ArrayType(T.LongType()))
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(wanted[batch.column("bit").to_numpy()]))
            for part in slices(batch, "text"):
                texts, starts, values = _sets(words_of(part.column("text")), shingle_words)
                lists = _lists(values, starts, texts, part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("id"), lists], schema.names)

    bit = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    return documents.where("id IS NOT NULL").withColumn("bit", bit).mapInArrow(run, schema)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets are alike enough: 100 * |intersection| >= percent * |union|."""
    for end in ("a", "b"):
        own = sets.select(F.col("id").alias(end), F.col("shingles").alias(f"set_of_{end}"))
        pairs = pairs.join(own, end)
    n_a, n_b = F.size("set_of_a"), F.size("set_of_b")
    near = pairs.where(100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b))
    both = F.size(F.array_intersect("set_of_a", "set_of_b"))
    return near.where(100 * both >= percent * (n_a + n_b - both)).select("a", "b")


def _pairs(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def near_duplicates(
    documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    shingle_words: int = 5, percent: int = 80, hashes: int = HASHES, keys: int = KEYS,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Of each row: its id, n_shingles, component_id (the smallest id reachable by links), kept.

    A document's set holds the distinct shingles of ``shingle_words`` words ``[^\\x20\\x09-\\x0D]+`` of
    its text with A-Z lower-cased; with fewer words, all of them as one. Documents are linked when
    100 * |intersection| >= ``percent`` * |union|. Null and empty texts have no set, are linked with
    nothing and are kept. A row with a null id gets the component of equal texts that have one, else
    null; it is kept only in the latter case. Rows that share an id are one document with several
    texts. Repeated rows come back as often as they occur. Ties cannot occur, as components are named
    by their smallest id. The columns ``carried`` follow, so that rows can be told apart; others are not
    read. Sets hold 64-bit hashes of shingles.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"),
        *[F.col(name).alias(f"carried_{k}") for k, name in enumerate(carried)],
    )
    documents = rows.select("id", "text")
    signed = materialise(signatures(rows, shingle_words, hashes, keys), "signatures")

    fingerprint = ["set_a", "set_b", "n_shingles"]
    classes = signed.where("n_shingles > 0").groupBy(fingerprint).agg(F.min("id").alias("class"))
    classes = materialise(classes, "classes")
    keyed = signed.where("n_shingles > 0").join(classes, fingerprint).where("id = class")

    members = keyed.select("id", F.explode("left").alias("left_key"), "right").select(
        "id", "left_key", F.explode("right").alias("right_key")
    ).select("id", F.xxhash64("left_key", "right_key").alias("key"))
    shared = members.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    members = materialise(members.join(shared, "key").distinct(), "members")

    stars = members.select(*_pairs("id", "low")).union(members.select(*_pairs("id", "high")))
    stars = materialise(stars.where("a < b").distinct(), "pairs")
    ends = stars.select(F.col("a").alias("id")).union(stars.select("b")).distinct()
    sets = materialise(whole_sets(documents, ends, shingle_words).join(ends, "id", "left_semi"), "sets")
    links = materialise(confirmed(stars, sets, percent), "links")
    found = components(links)

    rest = _between_components(members, found, keyed, percent)
    rest = rest.join(stars, ["a", "b"], "left_anti")
    more = materialise(confirmed(rest, sets, percent), "links")
    if more.limit(1).count():
        found = components(links.union(more))

    group = F.coalesce("component", "class")
    own = signed.join(classes, fingerprint, "left").join(
        found.withColumnRenamed("node", "class"), "class", "left"
    )
    component = F.when(F.col("n_shingles") > 0, group).otherwise(F.col("id"))
    return own.select(
        F.col("id").alias(id_column), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.col("id").isNull() & component.isNull()).alias("kept"),
        *[F.col(f"carried_{k}").alias(name) for k, name in enumerate(carried)],
    )


def _between_components(members: DataFrame, found: DataFrame, keyed: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a table, lie in different components and may be linked by size and parities.

    One of the two lies outside the table's largest component, so only such members are joined with all
    members of their table.
    """
    placed = members.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    by_component = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    several = by_component.groupBy("key").agg(
        F.max(F.struct("n", "component"))["component"].alias("main"), F.count("*").alias("n_components")
    ).where("n_components > 1").drop("n_components")
    sets = keyed.select("id", F.col("n_shingles").alias("size"), "parity").dropDuplicates(["id"])
    placed = materialise(placed.join(several, "key").join(sets, "id"), "placed")
    x, y = placed.where("component <> main").alias("x"), placed.alias("y")

    different = F.col("x.component") != F.col("y.component")
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.id") < F.col("y.id"))
    sizes = F.col("x.size") + F.col("y.size")
    near = 100 * F.least("x.size", "y.size") >= percent * F.greatest("x.size", "y.size")
    odd = [
        F.bit_count(F.get("x.parity", F.lit(i)).bitwiseXOR(F.get("y.parity", F.lit(i))))
        for i in range(PARITY_WORDS)
    ]
    # |x and y| >= percent / (100 + percent) of both sizes, so they differ in no more than the rest.
    close = (100 + percent) * functools.reduce(operator.add, odd) <= (100 - percent) * sizes
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & different & once & near & close)
    return pairs.select(*_pairs("x.id", "y.id")).distinct()
