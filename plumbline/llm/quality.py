"""Document quality from weak labels: overlapping heuristics, their accuracies, and a hashed linear scorer.

Each heuristic says good, bad or nothing of a document. How often every combination of votes occurs is
counted over all documents; expectation-maximisation over those counts, whose number is bounded by the
number of heuristics, gives the share of good documents and how often each heuristic errs. The
posterior of a combination is a document's weak label. A linear model on hashed words and word shapes
learns the weak labels of a bounded sample and scores every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.linear import Linear, Sparse, at_most, fit, sample_by_id
from plumbline.llm.toxicity import rows_where
from plumbline.llm.words import Words, distinct, mixed, slices, text_bytes, words_of

#: Documents that the scorer is fitted on, at most, and its hashed columns.
SAMPLE_ROWS, COLUMNS = 5000, 1 << 14
THRESHOLD = 0.5

BAD, GOOD, NOTHING = 0, 1, 2
#: How often a heuristic may call good documents bad, and must call those of its own class so.
RARELY, MOSTLY = 0.01, 0.8

STOP_WORDS = (
    "the of and to in is that it for with on as by a "
    "der die das und ist nicht ein eine mit von zu auf den dem "
    "le la les de des et un une du que est pour dans en "
    "el los las y del por con se no lo su para"
).split()
#: name: (least number of words, bad at least or at most, good at most or at least). The first of two
#: bounds is the bad one; a statistic between them says nothing.
HEURISTICS = {
    "symbols": (1, 0.05, 0.01),
    "repeated_words": (10, 0.2, 0.05),
    "top_word": (20, 0.25, 0.12),
    "repeated_lines": (1, 0.4, 0.1),
    "digits": (20, 0.3, 0.1),
    "long_words": (20, 0.1, 0.02),
    "stop_words": (20, 0.01, 0.04),
    "sentence_ends": (20, 0.001, 0.02),
    "capitals": (5, 0.4, 0.2),
    "piled_marks": (5, 0.3, 0.1),
}
#: Those whose low values are bad.
LOW_IS_BAD = {"stop_words", "sentence_ends"}

_bytes = np.arange(256)
_DIGIT = (_bytes >= 0x30) & (_bytes <= 0x39)
_LETTER = ((_bytes >= 0x61) & (_bytes <= 0x7A)) | (_bytes >= 0x80)
_END = np.isin(_bytes, list(b".!?"))
_MARK = np.isin(_bytes, list(b",;:'\"()-")) | _END
_VISIBLE = (_bytes > 0x20) & (_bytes != 0x7F)
_SYMBOL = _VISIBLE & ~_DIGIT & ~_LETTER & ~_MARK
_CLASS = np.select([_LETTER, _DIGIT, _END, _MARK, _SYMBOL], [0, 1, 2, 3, 4], 5)
_CAPITAL = (_bytes >= 0x41) & (_bytes <= 0x5A)
_LINE = _bytes != 0x0A


def _stop_hashes() -> np.ndarray:
    return np.sort(words_of(pa.array(STOP_WORDS)).hash)


def _per_text(where: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(where)])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(float)


def statistics(texts: pa.Array, words: Words) -> np.ndarray:
    """(texts, heuristics): the shares that the heuristics look at."""
    n, data = words.n, words.data
    count = np.maximum(words.counts, 1).astype(float)
    visible = np.maximum(_per_text(_VISIBLE[data], words.bounds), 1)
    same = np.zeros(len(words.text), bool)
    same[1:] = (words.text[1:] == words.text[:-1]) & (words.hash[1:] == words.hash[:-1])
    order = np.lexsort((words.hash, words.text))
    text, value = words.text[order], words.hash[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    starts = np.flatnonzero(new)
    top = np.zeros(n)
    np.maximum.at(top, text[starts], np.diff(np.append(starts, len(text))))
    lines = words_of(texts, _LINE)
    n_lines = lines.counts.astype(float)
    distinct_lines = np.bincount(distinct(lines.text, lines.hash)[0], minlength=n)
    length = words.end - words.start
    last, before = data[words.end - 1], data[np.maximum(words.end - 2, words.start)]
    piled = (length > 2) & _MARK[last] & _MARK[before]
    letters = np.maximum(_per_text(_LETTER[data], words.bounds), 1)
    found = {
        "symbols": _per_text(_SYMBOL[data], words.bounds) / visible,
        "repeated_words": np.bincount(words.text, same, minlength=n) / count,
        "top_word": top / count,
        "repeated_lines": (n_lines - distinct_lines) / np.maximum(n_lines, 1),
        "digits": _per_text(_DIGIT[data], words.bounds) / visible,
        "long_words": np.bincount(words.text, length > 40, minlength=n) / count,
        "stop_words": np.bincount(words.text, np.isin(words.hash, _stop_hashes()), minlength=n) / count,
        "sentence_ends": np.bincount(words.text, _END[last], minlength=n) / count,
        "capitals": _per_text(_CAPITAL[text_bytes(texts)[0]], words.bounds) / letters,
        "piled_marks": np.bincount(words.text, piled, minlength=n) / count,
    }
    return np.column_stack([found[name] for name in HEURISTICS])


def votes(shares: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """(texts, heuristics) of BAD, GOOD or NOTHING."""
    found = np.full(shares.shape, NOTHING)
    for k, (name, (least, bad, good)) in enumerate(HEURISTICS.items()):
        sign = -1 if name in LOW_IS_BAD else 1
        own = np.where(sign * shares[:, k] >= sign * bad, BAD, NOTHING)
        own = np.where(sign * shares[:, k] <= sign * good, GOOD, own)
        found[:, k] = np.where(n_words >= least, own, NOTHING)
    return found


def pattern(found: np.ndarray) -> np.ndarray:
    return found @ (3 ** np.arange(found.shape[1]))


@dataclass
class WeakLabels:
    """Shares of the classes, and P(BAD or GOOD | class, not NOTHING) as (class, heuristic, vote).

    Class 0 is good; each other class is a kind of bad documents, named after one heuristic. That a
    heuristic says nothing is no evidence.
    """

    shares: np.ndarray
    votes: np.ndarray

    def classes(self, found: np.ndarray) -> np.ndarray:
        """(texts, classes): posterior of each class."""
        heuristics = np.arange(found.shape[1])
        log = np.log(self.votes[:, heuristics[None, :], found]).sum(axis=2) + np.log(self.shares)[:, None]
        weight = np.exp(log - log.max(axis=0))
        return (weight / weight.sum(axis=0)).T

    def posterior(self, found: np.ndarray) -> np.ndarray:
        return self.classes(found)[:, 0]

    @property
    def accuracies(self) -> dict[str, float]:
        """Of each heuristic, how often it is right when it says something."""
        right = np.concatenate([self.votes[:1, :, GOOD], self.votes[1:, :, BAD]])
        return dict(zip(HEURISTICS, (self.shares[:, None] * right).sum(axis=0)))


def expectation_maximisation(found: np.ndarray, counts: np.ndarray, rounds: int = 200) -> WeakLabels:
    """From combinations of votes and how often each occurs.

    Kinds of bad documents exclude each other, so that most heuristics find nothing wrong with most of
    them. There is therefore a class for each, which starts with the documents its heuristic calls bad
    and in which that heuristic goes on saying so mostly; of good documents each says so rarely.
    """
    counts = counts.astype(float)
    n = found.shape[1]
    bad = found == BAD
    posterior = np.column_stack([~bad.any(axis=1), bad / np.maximum(bad.sum(axis=1, keepdims=True), 1)])
    labels = WeakLabels(np.full(n + 1, 1 / (n + 1)), np.ones((n + 1, n, 3)))
    for _ in range(rounds):
        before = posterior
        weight = (counts[:, None] * posterior).T
        said_bad, said_good = weight @ bad + 0.01, weight @ (found == GOOD) + 0.01
        share = said_bad / (said_bad + said_good)
        share[0] = np.minimum(share[0], RARELY)
        own = np.arange(n)
        share[own + 1, own] = np.maximum(share[own + 1, own], MOSTLY)
        total = weight.sum(axis=1) + 0.01
        labels = WeakLabels(total / total.sum(), np.stack([share, 1 - share, np.ones_like(share)], axis=2))
        posterior = labels.classes(found)
        if np.abs(posterior - before).max(initial=0) < 1e-6:
            break
    return labels


def features(shares: np.ndarray, words: Words) -> Sparse:
    """Hashed words, word shapes and levels of the shares; words and shapes weigh by their share."""
    data, length = words.data, words.end - words.start
    first, last = _CLASS[data[words.start]], _CLASS[data[np.maximum(words.end - 1, 0)]]
    before = _CLASS[data[np.maximum(words.end - 3, words.start)]]
    same = np.zeros(len(length), np.int64)
    same[1:] = (words.text[1:] == words.text[:-1]) & (words.hash[1:] == words.hash[:-1])
    shape = (((first * 6 + before) * 6 + last) * 16 + np.minimum(length, 15)) * 2 + same
    level = np.floor(np.sqrt(np.clip(shares, 0, 1)) * 10).astype(np.int64)
    least = np.array([bounds[0] for bounds in HEURISTICS.values()])
    level[words.counts[:, None] < least] = 15
    level = level + 16 * np.arange(shares.shape[1])
    text = np.concatenate([words.text, words.text, np.repeat(np.arange(words.n), shares.shape[1])])
    column = np.concatenate([
        words.hash, mixed(shape.astype(np.uint64), 31), mixed(level.reshape(-1).astype(np.uint64), 32)
    ]) % np.uint64(COLUMNS)
    count = np.maximum(words.counts, 1)[words.text]
    value = np.concatenate([1 / count, 1 / count, np.full(level.size, 0.3)])
    key = text * COLUMNS + column.astype(np.int64)
    keys, at = np.unique(key, return_inverse=True)
    sums = np.sqrt(np.bincount(at, value, minlength=len(keys)))
    return Sparse(keys // COLUMNS, keys % COLUMNS, sums, words.n)


@dataclass
class Quality:
    labels: WeakLabels
    scorer: Linear
    threshold: float

    def judged(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(weak label, score) of each text."""
        words = words_of(texts)
        shares = statistics(texts, words)
        found = features(shares, words)
        weak = self.labels.posterior(votes(shares, words.counts))
        return weak, self.scorer.probability(found, np.zeros((words.n, 0)))


def train(
    documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD,
) -> Quality:
    """Vote counts over all documents; a scorer fitted on at most ``sample_rows`` of them.

    The sample is chosen by the hash of the id, of rows that share ids by that of id and text, and its rows have at
    most ``COLUMNS`` numbers each.
    Repeated rows count as often as they occur. Without documents every text scores the prior of one half.
    """
    documents = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"))
                found = pattern(votes(statistics(part.column("text"), words), words.counts))
                keys, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pattern", "n"])

    counted = documents.select("text").mapInArrow(count, "pattern long, n long")
    # At most 3 ** len(HEURISTICS) rows.
    counts = counted.groupBy("pattern").agg(F.sum("n").alias("n")).toPandas()
    places = 3 ** np.arange(len(HEURISTICS))
    combinations = counts["pattern"].to_numpy()[:, None] // places % 3
    labels = expectation_maximisation(combinations.reshape(-1, len(HEURISTICS)), counts["n"].to_numpy())

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"))
                shares = statistics(part.column("text"), words)
                rows = features(shares, words)
                weak = labels.posterior(votes(shares, words.counts))
                bounds = pa.array(np.searchsorted(rows.row, np.arange(rows.n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(bounds, pa.array(rows.column.astype(np.int32))),
                     pa.ListArray.from_arrays(bounds, pa.array(rows.value.astype(np.float32))),
                     pa.array(weak)],
                    ["columns", "shares", "weak"],
                )

    ids = sample_by_id(documents.select("id"), sample_rows).distinct()
    chosen = at_most(documents.join(F.broadcast(ids), "id"), sample_rows).select("text")
    found = chosen.mapInArrow(sampled, "columns array<int>, shares array<float>, weak double").toArrow()
    columns = found.column("columns").combine_chunks()
    lengths = columns.value_lengths().to_numpy()
    sparse = Sparse(
        np.repeat(np.arange(len(lengths)), lengths), columns.flatten().to_numpy(),
        found.column("shares").combine_chunks().flatten().to_numpy().astype(float), len(lengths),
    )
    weak = found.column("weak").to_numpy()
    scorer = fit(sparse, np.zeros((sparse.n, 0)), weak, COLUMNS) if sparse.n else Linear(
        np.zeros(COLUMNS), np.zeros(0), 0.0
    )
    return Quality(labels, scorer, threshold)


def score(
    documents: DataFrame, model: Quality, *, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Of each row: its id, weak_label and score (probabilities of good) and ``keep``.

    Null and empty texts have no words: heuristics that need words say nothing of them. Equal texts get
    equal results, at every repetition; a score equal to the threshold is kept. Whole texts count, however
    long. No documents give no rows. Other columns are not read.
    """
    schema = T.StructType([
        T.StructField("id", documents.schema[id_column].dataType),
        T.StructField("weak_label", T.DoubleType()), T.StructField("score", T.DoubleType()),
        T.StructField("keep", T.BooleanType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                weak, found = model.judged(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(weak), pa.array(found), pa.array(found >= model.threshold)],
                    schema.names,
                )

    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def of_quality(documents: DataFrame, model: Quality, *, text_column: str = "text") -> DataFrame:
    """The rows of documents that ``score`` keeps, all columns unchanged."""
    return rows_where(documents, text_column, lambda texts: model.judged(texts)[1] >= model.threshold)
