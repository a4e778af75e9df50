"""Language-model scores from class-based bigrams: exchange clustering, class transitions, word emissions.

Every word belongs to a unit: the most frequent words are units of their own, all others share units by
their last letters. Exchange clustering moves units between classes as long as the likelihood of the
class bigrams grows. A text's probability is the product of the transitions between the classes of
neighbouring words and of each word's share in its class, both smoothed.

Word counts cover the whole corpus and stay a table. What comes to the driver is bounded by parameters:
counts between units, and the counts of the most frequent words, which scoring looks up in the task; the counts of
all other words are joined. Words are told apart by 64-bit hashes: of n distinct words about n ** 2 / 2 ** 65
pairs share one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.words import Words, mixed, slices, words_of
from plumbline.session import materialise

#: Units for frequent words (the end included) and for endings; classes that they are exchanged between.
FREQUENT_UNITS, ENDING_UNITS, CLASSES = 1536, 512, 64
UNITS = FREQUENT_UNITS + ENDING_UNITS
#: Most frequent words whose counts every task holds, at most.
HELD_WORDS = 1 << 18
SWEEPS = 10
#: What every class is given on top of a transition's count, shared out by how often classes occur.
TRANSITION_PRIOR = 5.0
#: Words that a task gathers before it counts them.
GATHERED = 4_000_000

#: Stands for the end of a text; no hash of a word is known to be equal to it.
END = np.uint64(0x0E0D0E0D0E0D0E0D)
END_UNIT = 0


def is_held_out(document_id: Column, parts: int = 7, part: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``part`` on division by ``parts``; a null id is empty."""
    text = F.coalesce(document_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts == part


def _ending_units(words: Words) -> np.ndarray:
    key = np.zeros(len(words.start), np.uint64)
    for back in (1, 2, 3):
        at = words.end - back
        letter = np.where(at >= words.start, words.data[np.maximum(at, 0)].astype(np.uint64) + np.uint64(1), 0)
        key = key * np.uint64(257) + letter.astype(np.uint64)
    return FREQUENT_UNITS + (mixed(key, 41) % np.uint64(ENDING_UNITS)).astype(np.int64)


@dataclass
class Vocabulary:
    """Hashes of the held words, sorted, with their counts and units; -1 goes by the ending."""

    hashes: np.ndarray
    counts: np.ndarray
    units: np.ndarray

    def find(self, value: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 for words not held."""
        if not len(self.hashes):
            return np.full(len(value), -1)
        at = np.minimum(np.searchsorted(self.hashes, value), len(self.hashes) - 1)
        return np.where(self.hashes[at] == value, at, -1)

    def tokens(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, hash, unit, place) of all tokens in order, ends included."""
        sizes = words.counts + 1
        text = np.repeat(np.arange(words.n), sizes)
        is_word = np.ones(len(text), bool)
        is_word[np.cumsum(sizes) - 1] = False
        value = np.full(len(text), END)
        value[is_word] = words.hash
        place = self.find(value)
        unit = np.full(len(text), END_UNIT)
        unit[is_word] = _ending_units(words)
        own = np.where(place >= 0, np.append(self.units, -1)[place], -1)
        return text, value, np.where(own >= 0, own, unit), place


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, ending, n): how often each word and the end occur, and a word's unit by its ending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[tuple[np.ndarray, np.ndarray]] = []

        def counted() -> Iterator[pa.RecordBatch]:
            if gathered:
                value, ending = (np.concatenate(parts) for parts in zip(*gathered))
                keys, first, n = np.unique(value, return_index=True, return_counts=True)
                gathered.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(ending[first].astype(np.int32)), pa.array(n)],
                    ["word", "ending", "n"],
                )

        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"))
                gathered.append((words.hash, _ending_units(words)))
                gathered.append((np.full(words.n, END), np.full(words.n, END_UNIT)))
                if sum(len(value) for value, _ in gathered) > GATHERED:
                    yield from counted()
        yield from counted()

    counted = texts.mapInArrow(run, "word long, ending int, n long")
    return counted.groupBy("word", "ending").agg(F.sum("n").alias("n"))


def held_vocabulary(counts: DataFrame, limit: int = HELD_WORDS) -> Vocabulary:
    """The most frequent words, at most ``limit``: whole steps of a logarithmic scale of counts."""
    step = F.floor(F.log2("n") * 8).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect()
    least, total = None, 0
    for row in steps:  # at most 8 * 64 rows
        total += row["words"]
        if total > limit:
            break
        least = row["step"]
    rows = counts.where(F.lit(False) if least is None else step >= least).select("word", "n")
    held = rows.toArrow()
    hashes = held.column("word").to_numpy().view(np.uint64)
    n = held.column("n").to_numpy()
    rank = np.lexsort((hashes, -n))
    rank = rank[hashes[rank] != END][: FREQUENT_UNITS - 1]
    units = np.full(len(n), -1)
    units[rank] = np.arange(1, len(rank) + 1)
    units[hashes == END] = END_UNIT
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], n[order], units[order])


def unit_bigrams(texts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """(UNITS, UNITS): how often one unit follows another; every text begins and ends with the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(UNITS * UNITS, np.int64)
        gathered: list[np.ndarray] = []
        for batch in batches:
            for part in slices(batch, "text"):
                _, _, unit, _ = vocabulary.tokens(words_of(part.column("text")))
                if len(unit):
                    before = np.append(END_UNIT, unit[:-1])  # behind an end the next text begins
                    gathered.append(before * UNITS + unit)
                if sum(map(len, gathered)) > GATHERED:
                    table += np.bincount(np.concatenate(gathered), minlength=len(table))
                    gathered.clear()
        if gathered:
            table += np.bincount(np.concatenate(gathered), minlength=len(table))
        found = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(table[found])], ["pair", "n"])

    counted = texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # at most UNITS ** 2 rows
    table = np.zeros(UNITS * UNITS, np.int64)
    table[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return table.reshape(UNITS, UNITS)


def _plogp(n: np.ndarray) -> np.ndarray:
    return n * np.log(np.maximum(n, 1))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit. The end keeps class 0 to itself; the others start dealt out by frequency.

    Units are visited by frequency, and each moves to the class where the log likelihood of the class
    bigrams is highest, of equal ones the first, until a sweep moves none.
    """
    n = len(bigrams)
    order = np.lexsort((np.arange(n), -(bigrams.sum(axis=1) + bigrams.sum(axis=0))))
    order = order[order != END_UNIT]
    of = np.zeros(n, np.int64)
    of[order] = 1 + np.arange(n - 1) % (classes - 1)
    onto = np.zeros((n, classes))
    onto[np.arange(n), of] = 1
    table = onto.T @ bigrams @ onto
    columns = np.ascontiguousarray(bigrams.T)
    used = order[(bigrams[order].sum(axis=1) + columns[order].sum(axis=1)) > 0]
    own = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for unit in used:
            after = np.bincount(of, bigrams[unit], minlength=classes)
            before = np.bincount(of, columns[unit], minlength=classes)
            itself = bigrams[unit, unit]
            old = of[unit]
            after[old] -= itself
            before[old] -= itself
            table[old] -= after
            table[:, old] -= before
            table[old, old] -= itself
            rows = _plogp(table + after) - _plogp(table)
            cols = _plogp(table + before[:, None]) - _plogp(table)
            diagonal = table[own, own]
            both = _plogp(diagonal + after + before + itself) - _plogp(diagonal)
            gain = rows.sum(axis=1) - rows[own, own] + cols.sum(axis=0) - cols[own, own] + both
            for margin, more in ((table.sum(axis=1), after.sum() + itself), (table.sum(axis=0), before.sum() + itself)):
                gain -= _plogp(margin + more) - _plogp(margin)
            gain[of[END_UNIT]] = -np.inf
            new = old if gain[old] >= gain.max() - 1e-9 else int(np.argmax(gain))
            table[new] += after
            table[:, new] += before
            table[new, new] += itself
            of[unit] = new
            moved += new != old
        if not moved:
            break
    return of


@dataclass
class ClassModel:
    """``counts`` is the table of all words' counts; the rest is bounded by the parameters above."""

    counts: DataFrame
    train_tokens: int
    n_words: int
    vocabulary: Vocabulary
    unit_class: np.ndarray
    transitions: np.ndarray
    emissions: np.ndarray

    @property
    def base_denominator(self) -> float:
        return float(np.log10(self.train_tokens + self.n_words + 1))


def train(texts: DataFrame) -> ClassModel:
    """A model of the texts (one column, text). Without texts every word is unknown."""
    counts = materialise(word_counts(texts), "word-counts")
    total = counts.agg(F.count("*").alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    vocabulary = held_vocabulary(counts)
    bigrams = unit_bigrams(texts, vocabulary)
    of = exchange(bigrams)

    onto = np.zeros((UNITS, CLASSES))
    onto[np.arange(UNITS), of] = 1
    table = onto.T @ bigrams @ onto
    share = (table.sum(axis=0) + 1) / (table.sum() + CLASSES)
    transitions = np.log10((table + TRANSITION_PRIOR * share) / (table.sum(axis=1, keepdims=True) + TRANSITION_PRIOR))

    # A held word's unit is its own, any other's is that of its ending.
    endings = counts.groupBy("ending").agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).toArrow()
    units = np.zeros((UNITS, 2))  # at most UNITS rows of endings
    units[endings.column("ending").to_numpy()] = np.column_stack(
        [endings.column("words").to_numpy(), endings.column("tokens").to_numpy()]
    ) if endings.num_rows else 0
    own = vocabulary.units > 0
    frequent = F.col("word").isin(vocabulary.hashes[own].view(np.int64).tolist())
    moved = counts.where(frequent).select("word", "ending", "n").toArrow()
    place = vocabulary.find(moved.column("word").to_numpy().view(np.uint64))
    n = moved.column("n").to_numpy()
    np.subtract.at(units, moved.column("ending").to_numpy(), np.column_stack([np.ones(len(n)), n]))
    np.add.at(units, vocabulary.units[place], np.column_stack([np.ones(len(n)), n]))
    per_class = onto.T @ units
    emissions = -np.log10(per_class.sum(axis=1) + 1)
    return ClassModel(counts, int(total["tokens"]), int(total["words"]), vocabulary, of, transitions, emissions)


def score(
    documents: DataFrame, model: ClassModel, *, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Of each row: its id, n_tokens, n_known, base_score, score, perplexity.

    Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and one end. ``n_known`` counts those that
    the training texts have. ``base_score`` is the log10 probability by counts alone with one added to
    each word's and to one unknown word's; ``score`` is the class model's. Null and empty texts are
    one end. Repeated rows come back as often as they occur, and other columns are not read. No documents
    give no rows.
    """
    id_type = documents.schema[id_column].dataType
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("id", id_type), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("log_counts", T.DoubleType()),
        T.StructField("classes", T.DoubleType()), T.StructField("rare", T.ArrayType(T.LongType())),
    ])
    vocabulary, unit_class = model.vocabulary, model.unit_class
    transitions, emissions = model.transitions, model.emissions
    log_counts = np.append(np.log10(vocabulary.counts + 1.0), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text"):
                n = part.num_rows
                text, value, unit, place = vocabulary.tokens(words_of(part.column("text")))
                of = unit_class[unit]
                before = np.append(unit_class[END_UNIT], of[:-1])
                held = place >= 0
                classes = np.bincount(text, transitions[before, of] + emissions[of], minlength=n)
                offsets = np.append(0, np.cumsum(np.bincount(text, ~held, minlength=n))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(n)), part.column("id"),
                        pa.array(np.bincount(text, minlength=n)),
                        pa.array(np.bincount(text, held, minlength=n).astype(np.int64)),
                        pa.array(np.bincount(text, log_counts[place], minlength=n)), pa.array(classes),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(value[~held].view(np.int64))),
                    ],
                    schema.names,
                )
                row += n

    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = materialise(rows.mapInArrow(run, schema), "class-scores")
    rare = rows.select("row", F.explode("rare").alias("word"))
    looked_up = rare.join(model.counts.select("word", "n"), "word").groupBy("row").agg(
        F.count("*").alias("more_known"), F.sum(F.log10(F.col("n") + 1)).alias("more_counts")
    )
    log_count = F.col("log_counts") + F.coalesce("more_counts", F.lit(0.0))
    found = log_count + F.col("classes")
    return rows.drop("rare").join(looked_up, "row", "left").select(
        F.col("id").alias(id_column), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (log_count - F.col("n_tokens") * F.lit(model.base_denominator)).alias("base_score"),
        found.alias("score"), F.pow(F.lit(10.0), -found / F.col("n_tokens")).alias("perplexity"),
    )
