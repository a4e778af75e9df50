"""Byte-level byte-pair encoding and decoding.

A word (a match of the tokenizer's pattern) starts as the array of its bytes. A fold merges the neighbours
whose joined bytes have the lowest rank, the leftmost of equal ones, until no joined bytes have a rank. The
ranks of pairs are a scalar, cut into buckets by a checksum, as a lookup reads a bucket from its start. They are no
literal, as Spark writes literals out in every description of a plan, which the driver keeps.

Spark cuts and counts the words, folds the known ones and looks every word up. Distinct words are folded once each
as far as memory has a bound: those that the corpus holds most often, counted over all of it, are encoded by one
job of higher-order functions into a map of known size, also in buckets. Every other word stays in its place as its
bytes, and a helper over Arrow batches folds it, then gives the numbers and the bytes of all ids. Both folds give
the same ids.

Inside, an array of ids is a text with one character per id (code point id + 1), because Spark cuts, joins
and compares short texts far faster than arrays; ids must lie below the surrogates. Bytes are ISO 8859-1 text.
"""

from __future__ import annotations

import base64
import functools
import itertools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.words import slices
from plumbline.session import discard, local_frame, materialise

BYTES = "ISO-8859-1"
#: Words beyond the vocabulary whose ids are kept, and the longest of them in bytes.
KEPT_WORDS, KEPT_BYTES = 500_000, 64
#: Private characters above all ids: beside the ids of a word, in place of a rank, before a pair and beside the bytes
#: of a word that is not known.
EDGE, NO_RANK, ENTRY = "\ue000", "\uf8ff", "\ue001"
LARGEST_ID = 0xD7FF - 2

#: From an array of pairs, each behind ``ENTRY``, to a text of their ranks.
Find = Callable[[Column], Column]


@functools.cache
def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by bytes, of a file with a line for each: base64 bytes, space, rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(part): int(rank) for part, rank in map(bytes.split, lines)}


def _char(token: int) -> str:
    return chr(token + 1)


def _is_text(part: bytes) -> bool:
    try:
        part.decode()
    except UnicodeDecodeError:
        return False
    return True


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _bucket(text: Column, buckets: int) -> Column:
    return (F.crc32(text.cast("binary")) % buckets).cast("int")


def _state(parts: Column, ranks: Column) -> Column:
    """The ids of a word between edges, and the rank of each of these with the next."""
    return F.struct(parts.alias("parts"), ranks.alias("ranks"))


def _merged(state: Column, best: Column, ranks_of: Find) -> Column:
    """The state after the leftmost pair of the best rank is joined. A joined pair's id is its rank."""
    parts, ranks = state["parts"], state["ranks"]

    def after(place: Column) -> Column:
        left, right = F.substring(parts, place - 1, F.lit(1)), F.substring(parts, place + 2, F.lit(1))
        beside = ranks_of(F.array(F.concat(F.lit(ENTRY), left, best), F.concat(F.lit(ENTRY), best, right)))
        return _state(F.overlay(parts, best, place, F.lit(2)), F.overlay(ranks, beside, place - 1, F.lit(3)))

    return _let(F.instr(ranks, best), after)


def folded(byte_ids: Column, ranks_of: Find) -> Column:
    """The ids of a word, given as those of its bytes, by merging them pair by pair."""
    def step(state: Column, _: Column) -> Column:
        lowest = F.array_min(F.split(state["ranks"], ""))
        return _let(lowest, lambda best: F.when(best == NO_RANK, state).otherwise(_merged(state, best, ranks_of)))

    def fold(parts: Column) -> Column:
        size = F.length(parts)
        pairs = F.transform(
            F.sequence(F.lit(1), size - 1), lambda i: F.concat(F.lit(ENTRY), F.substring(parts, i, F.lit(2))))
        return F.aggregate(
            F.sequence(F.lit(4), F.greatest(size, F.lit(4))), _state(parts, ranks_of(pairs)), step,
            lambda state: F.substring(state["parts"], F.lit(2), F.length(state["parts"]) - 2),
        )

    return _let(F.concat(F.lit(EDGE), byte_ids, F.lit(EDGE)), fold)


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word, as ``folded`` gives them."""
    none = LARGEST_ID + 1
    parts = [word[i: i + 1] for i in range(len(word))]
    pairs = [ranks.get(word[i: i + 2], none) for i in range(len(word) - 1)]
    while pairs and (best := min(pairs)) < none:
        place = pairs.index(best)
        parts[place: place + 2] = [parts[place] + parts[place + 1]]
        del pairs[place]
        if place:
            pairs[place - 1] = ranks.get(parts[place - 1] + parts[place], none)
        if place < len(pairs):
            pairs[place] = ranks.get(parts[place] + parts[place + 1], none)
    return [ranks[part] for part in parts]


class Decoder:
    """The bytes of ids, given as an array."""

    #: Ids that are decoded together.
    TOGETHER = 1 << 18

    def __init__(self, ranks: dict[bytes, int]):
        parts = sorted(ranks, key=ranks.get)
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.array([len(part) for part in parts])
        places = [ranks[part] for part in parts]
        self.sizes, self.starts = np.zeros((2, places[-1] + 1), np.int64)
        self.sizes[places], self.starts[places] = sizes, np.cumsum(sizes) - sizes

    def of(self, ids: np.ndarray) -> bytes:
        return b"".join(
            self._some(ids[first: first + self.TOGETHER]) for first in range(0, len(ids), self.TOGETHER))

    def _some(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.bytes[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()


class BytePairs:
    """Encoding and decoding by the ranks in a file that the driver can read.

    ``pattern`` cuts texts into words. Ranks must name every single byte.
    """

    def __init__(self, path: str, pattern: str):
        self.ranks = ranks = read_ranks(path)
        if max(ranks.values()) > LARGEST_ID or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError(f"{path}: a byte has no rank, or a rank is over {LARGEST_ID}")
        # With this flag Java's \s is all white space, as in the libraries that read such patterns, not ASCII's.
        self.pattern = f"(?U){pattern}"
        pairs = [
            (ENTRY + _char(ranks[part[:cut]]) + _char(ranks[part[cut:]]), _char(rank))
            for part, rank in ranks.items() for cut in range(1, len(part))
            if part[:cut] in ranks and part[cut:] in ranks
        ]
        self.buckets = 1 << max(len(pairs) // 2, 1).bit_length()
        # A bucket is one text. What stands in it behind a pair starts with the pair's rank; without the pair, all of
        # it does with NO_RANK.
        self.table = [NO_RANK] * self.buckets
        for pair, rank in pairs:
            self.table[zlib.crc32(pair.encode()) % self.buckets] += pair + rank
        self.bytes_to_ids = "".join(map(chr, range(256))), "".join(_char(ranks[bytes([b])]) for b in range(256))

    def words(self, text: Column) -> Column:
        """The words of a text; null has none."""
        return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit(self.pattern), F.lit(0))

    def _with(self, frame: DataFrame, name: str, texts: list[str]) -> DataFrame:
        """The frame with the texts as a scalar; used in one place, no row carries a copy."""
        one = local_frame(frame.sparkSession, [{"texts": texts}], "texts array<string>")
        return frame.withColumn(name, one.scalar())

    def _ranked(self, inside: Callable[[Find], Column]) -> Column:
        """``inside`` of the function that gives the ranks of pairs, for rows with the scalar ``__ranks``."""
        def find(table: Column) -> Find:
            def rank(pair: Column) -> Column:
                own = F.get(table, _bucket(pair, self.buckets))
                return F.substring(F.call_function("substring_index", own, pair, F.lit(-1)), 1, 1)
            return lambda pairs: F.array_join(F.transform(pairs, rank), "")

        return _let(F.col("__ranks"), lambda table: inside(find(table)))

    def _fold(self, word: Column, ranks_of: Find) -> Column:
        return folded(F.translate(F.decode(word.cast("binary"), BYTES), *self.bytes_to_ids), ranks_of)

    def known_words(self, texts: DataFrame, column: str, limit: int = KEPT_WORDS, longest: int = KEPT_BYTES) -> DataFrame:
        """(word, ids) of the vocabulary and of the words beyond it that occur most often in all texts: of as
        many counts, from the highest on, as have at most ``limit`` words in all, once written."""
        spark = texts.sparkSession
        vocabulary = [
            {"word": part.decode(), "ids": _char(rank)} for part, rank in self.ranks.items() if _is_text(part)]
        vocabulary = local_frame(spark, vocabulary, "word string, ids string")
        words = texts.select(F.explode(self.words(F.col(column))).alias("word")).groupBy("word").count()
        words = words.where((F.col("count") > 1) & (F.octet_length("word") <= longest))
        words = materialise(words.join(vocabulary, "word", "left_anti"), "words")
        at_least, total = None, 0
        per_count = words.groupBy("count").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("count"))
        for row in per_count.limit(limit).collect():
            total += row["n"]
            if total > limit:
                break
            at_least = row["count"]
        ids = self._ranked(lambda ranks_of: self._fold(F.col("word"), ranks_of))
        own = words.where(F.col("count") >= at_least) if at_least is not None else words.limit(0)
        own = self._with(own, "__ranks", self.table).select("word", ids.alias("ids"))
        known = materialise(own.union(vocabulary), "known-words")
        discard(words)
        return known

    def encoded(self, texts: DataFrame, column: str, known: DataFrame, name: str = "encoded") -> DataFrame:
        """The texts with the ids of their words in order, as text; null is empty. A word that is not known stands
        between two ``ENTRY`` as its bytes."""
        buckets = 1 << known.count().bit_length()

        def ids(find: Column) -> Column:
            def of(word: Column) -> Column:
                own = F.element_at(F.get(find, _bucket(word, buckets)), word)
                return F.coalesce(own, F.concat(F.lit(ENTRY), F.decode(word.cast("binary"), BYTES), F.lit(ENTRY)))
            return F.transform(self.words(F.col(column)), of)

        # The map is a scalar, computed once; it is used in one place, so that no row carries a copy.
        with_map = texts.withColumn("__known", _in_buckets(known, buckets).scalar())
        found = _let(F.col("__known"), ids)
        return with_map.withColumn(name, F.array_join(found, "")).drop("__known")

    def ids_and_bytes(self, rows: DataFrame, id_column: str, encoded: str) -> DataFrame:
        """(the id column, ids array<int>, decoded binary) of rows with encoded texts. Words not yet known are
        folded, and the bytes are those of the ids."""
        ranks = self.ranks
        names = [id_column, "ids", "decoded"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            decoder = Decoder(ranks)

            def whole(text: str) -> str:
                pieces = text.split(ENTRY)
                pieces[1::2] = ["".join(map(_char, merged(word.encode(BYTES), ranks))) for word in pieces[1::2]]
                return "".join(pieces)

            for batch in batches:
                for part in slices(batch, encoded):
                    texts = [whole(text) for text in part.column(encoded).to_pylist()]
                    numbers = np.frombuffer("".join(texts).encode("utf-16-le"), "<u2").astype(np.int32) - 1
                    bounds = np.cumsum([0, *map(len, texts)])
                    ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(numbers))
                    found = decoder.of(numbers)
                    cuts = np.append(0, np.cumsum(decoder.sizes[numbers]))[bounds]
                    decoded = pa.array([found[a:b] for a, b in itertools.pairwise(cuts.tolist())], pa.binary())
                    yield pa.RecordBatch.from_arrays([part.column(id_column), ids, decoded], names)

        kinds = [rows.schema[id_column].dataType, T.ArrayType(T.IntegerType()), T.BinaryType()]
        fields = [T.StructField(column, kind) for column, kind in zip(names, kinds)]
        return rows.select(id_column, encoded).mapInArrow(run, T.StructType(fields))


def _in_buckets(known: DataFrame, buckets: int) -> DataFrame:
    """One row: an array with the map from word to ids of every bucket."""
    entries = known.groupBy(_bucket(F.col("word"), buckets).cast("long").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("word", "ids"))).alias("entries"))
    all_buckets = known.sparkSession.range(buckets).join(entries, "id", "left")
    empty = F.array().cast("array<struct<word:string,ids:string>>")
    in_order = all_buckets.agg(F.sort_array(F.collect_list(
        F.struct("id", F.coalesce("entries", empty).alias("entries")))).alias("all"))
    return in_order.select(F.transform("all", lambda bucket: F.map_from_entries(bucket["entries"])).alias("found"))


def encode(
    documents: DataFrame, path: str, pattern: str, *, id_column: str = "doc_id", text_column: str = "text",
    kept_words: int = KEPT_WORDS,
) -> DataFrame:
    """(the id column, ids array<int>, decoded binary) of every row.

    A null or empty text has no ids and no bytes. Ids are those of each word by itself, without special
    tokens; ``decoded`` is made from them, not from the text. Repeated rows and shared or null document ids give
    a row each. No documents give no rows. Other columns are not read, whatever their names. The work grows with a
    text's length, but with the square of the length of a single word. At most ``kept_words`` words and the
    vocabulary are sent to all tasks.
    """
    pairs = BytePairs(path, pattern)
    texts = documents.select(F.col(id_column).alias("__id"), F.col(text_column).cast("string").alias("__text"))
    known = pairs.known_words(texts, "__text", kept_words)
    found = pairs.encoded(texts, "__text", known, "__encoded")
    return pairs.ids_and_bytes(found, "__id", "__encoded").withColumnRenamed("__id", id_column)
