"""Toxicity categories predicted one after another by a chain of linear models on hashed words.

Every model sees which of the selected words a text has, and the probabilities of the categories before
its own. For training these come from models that did not see the row (out of fold); for scoring,
from models fitted on all rows of the sample. The last category is the label itself.

The labels say only whether a document is toxic. A row of the sample belongs to a category when it is
labelled toxic and has one of the category's seed words; the words a model uses beyond the seeds are
those of the sample that go with the label too often for chance.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.linear import Linear, Sparse, at_most, fit, sample_by_id
from plumbline.llm.words import ALPHANUMERIC, distinct, slices, words_of

#: Labelled rows that the models are fitted on, at most.
SAMPLE_ROWS = 20_000
#: Words that the models use beyond the seeds, at most, and the words' least log-likelihood ratio.
SELECTED_WORDS, LEAST_RATIO = 1024, 30.0
FOLDS = 4
L1, L2, ROUNDS = 5e-5, 1e-6, 1000

CATEGORIES: dict[str, tuple[str, ...]] = {
    "insult": ("idiot", "moron", "stupid", "fool", "dumb", "imbecile", "clown", "loser"),
    "contempt": ("pathetic", "worthless", "disgusting", "trash", "scum", "garbage", "filth", "vermin"),
    "threat": ("kill", "murder", "strangle", "stab", "shoot", "lynch"),
}


def hashed(words: list[str]) -> np.ndarray:
    return words_of(pa.array(words, pa.string()), ALPHANUMERIC).hash


@dataclass
class Chain:
    """Hashes of the words used, sorted, and a model per category in order."""

    keys: np.ndarray
    names: list[str]
    models: list[Linear]
    threshold: float

    def rows(self, texts: pa.Array) -> Sparse:
        """Which of the words each text has."""
        words = words_of(texts, ALPHANUMERIC)
        if not len(self.keys):
            none = np.zeros(0, np.int64)
            return Sparse(none, none, np.zeros(0), words.n)
        low = np.zeros(1 << 16, bool)
        low[(self.keys & np.uint64(0xFFFF)).astype(np.int64)] = True
        maybe = low[(words.hash & np.uint64(0xFFFF)).astype(np.int64)]
        text, value = words.text[maybe], words.hash[maybe]
        at = np.minimum(np.searchsorted(self.keys, value), len(self.keys) - 1)
        known = self.keys[at] == value
        text, at = distinct(text[known], at[known])
        return Sparse(text, at, np.ones(len(at)), words.n)

    def probabilities(self, sparse: Sparse) -> np.ndarray:
        found = np.zeros((sparse.n, 0))
        for model in self.models:
            found = np.column_stack([found, model.probability(sparse, found)])
        return found


def fit_chain(sparse: Sparse, categories: np.ndarray, folds: np.ndarray, columns: int) -> tuple[list[Linear], np.ndarray]:
    """Models of the categories (a column each) in order, and the out-of-fold probabilities."""
    held_out = np.zeros((sparse.n, 0))
    models = []
    for target in categories.T:
        models.append(fit(sparse, held_out, target, columns, l1=L1, l2=L2, rounds=ROUNDS))
        own = np.zeros(sparse.n)
        for fold in np.unique(folds):
            out = folds == fold
            model = fit(sparse.take(~out), held_out[~out], target[~out], columns, l1=L1, l2=L2, rounds=ROUNDS)
            own[out] = model.probability(sparse.take(out), held_out[out])
        held_out = np.column_stack([held_out, own])
    return models, held_out


def best_threshold(probability: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the gap at which F1 is highest, of equal ones the higher; at least one half."""
    order = np.argsort(-probability, kind="stable")
    sorted_p, hits = probability[order], np.cumsum(toxic[order])
    if not len(order) or not hits[-1]:
        return 1.1
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + hits[-1])
    f1[:-1][sorted_p[:-1] == sorted_p[1:]] = -1  # equal scores fall on the same side
    k = int(np.argmax(f1))
    below = sorted_p[k + 1] if k + 1 < len(order) else 0.0
    return max(0.5, float((sorted_p[k] + below) / 2))


def _labelled(documents: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic, fold) of the sample; its ids are few by its bound and so are broadcast."""
    sample = sample_by_id(labels, rows).withColumn("fold", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(FOLDS)))
    return at_most(documents.join(F.broadcast(sample), "id"), rows).select("text", "toxic", "fold")


def _word_counts(labelled: DataFrame) -> DataFrame:
    """(word, n_toxic, n_clean): rows of the sample that have the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = words_of(part.column("text"), ALPHANUMERIC)
                text, value = distinct(words.text, words.hash)
                toxic = part.column("toxic").to_numpy()[text]
                keys, at = np.unique(value, return_inverse=True)
                n_toxic = np.bincount(at, toxic, minlength=len(keys)).astype(np.int64)
                n = np.bincount(at, minlength=len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(n_toxic), pa.array(n - n_toxic)],
                    ["word", "n_toxic", "n_clean"],
                )

    counted = labelled.mapInArrow(run, "word long, n_toxic long, n_clean long")
    return counted.groupBy("word").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))


def _selected(counts: DataFrame, n_toxic: int, n_clean: int) -> np.ndarray:
    """The words that go with the label most, by log-likelihood ratio."""
    share = n_toxic / (n_toxic + n_clean)
    a, n = F.col("n_toxic"), F.col("n_toxic") + F.col("n_clean")

    def part(count, expected):
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    ratio = 2 * (part(a, n * share) + part(n - a, n * (1 - share)))
    best = counts.where(a > n * share).withColumn("ratio", ratio).where(F.col("ratio") >= LEAST_RATIO)
    rows = best.orderBy(F.desc("ratio"), "word").limit(SELECTED_WORDS).select("word").collect()
    return np.array([row["word"] for row in rows], np.int64).view(np.uint64)


def train(
    documents: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", categories: dict[str, tuple[str, ...]] | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> Chain:
    """The chain, fitted on at most ``sample_rows`` labelled documents chosen by the hash of the id, of rows
    that share ids by that of id and text.

    Labels other than 0 and 1 and rows without an id are left out; an id with several labels is
    toxic if one says so. Without labelled rows, or with labels of one kind only, nothing is toxic.
    """
    categories = CATEGORIES if categories is None else categories
    names = [*categories, label_column]
    documents = documents.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )
    labels = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("toxic"))
    labels = labels.where("toxic IN (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    labelled = _labelled(documents, labels, sample_rows)

    counts = {row["toxic"]: row["n"] for row in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Chain(np.zeros(0, np.uint64), names, [Linear(np.zeros(0), np.zeros(k), -30.0) for k in range(len(names))], 1.1)
    seeds = {name: hashed(list(words)) for name, words in categories.items()}
    keys = np.unique(np.concatenate([*seeds.values(), _selected(_word_counts(labelled), counts[1], counts[0])]))
    chain = Chain(keys, names, [], 1.1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = chain.rows(part.column("text"))
                bounds = np.searchsorted(rows.row, np.arange(rows.n + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(rows.column.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [lists, part.column("toxic"), part.column("fold")], ["columns", "toxic", "fold"]
                )

    # At most sample_rows rows of at most as many numbers as there are words in use.
    found = labelled.mapInArrow(run, "columns array<int>, toxic int, fold long").toArrow()
    bounds = found.column("columns").combine_chunks()
    lengths = bounds.value_lengths().to_numpy()
    row = np.repeat(np.arange(len(lengths)), lengths)
    column = bounds.flatten().to_numpy()
    sparse = Sparse(row, column, np.ones(len(row)), len(lengths))
    toxic = found.column("toxic").to_numpy().astype(float)
    has = np.zeros((len(categories), sparse.n))
    for k, words in enumerate(seeds.values()):
        has[k][row[np.isin(keys[column], words)]] = 1
    targets = np.column_stack([*(has * toxic), toxic])
    chain.models, held_out = fit_chain(sparse, targets, found.column("fold").to_numpy(), len(keys))
    chain.threshold = best_threshold(held_out[:, -1], toxic)
    return chain


def score(
    documents: DataFrame, chain: Chain, *, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Of each row: its id, a probability per category (``p_<category>``) and ``is_toxic``.

    Null and empty texts have no words and get the probabilities of such; they are toxic only if the
    threshold lies below them. Equal texts get equal results, at every repetition. A probability equal to
    the threshold is toxic. Whole texts count, however long. No documents give no rows. Other columns
    are not read.
    """
    columns = [f"p_{name}" for name in chain.names]
    schema = T.StructType(
        [T.StructField("id", documents.schema[id_column].dataType)]
        + [T.StructField(name, T.DoubleType()) for name in columns]
        + [T.StructField("is_toxic", T.BooleanType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = chain.probabilities(chain.rows(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *map(pa.array, found.T), pa.array(found[:, -1] >= chain.threshold)],
                    schema.names,
                )

    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def rows_where(
    documents: DataFrame, text_column: str, keep: Callable[[pa.Array], np.ndarray],
) -> DataFrame:
    """The rows of documents, all columns unchanged, whose text passes; nothing is shuffled.

    Columns may have any names. Equal texts pass or fail together; a null text is judged as an empty one is.
    """
    names = documents.columns
    numbered = documents.toDF(*[f"column_{number}" for number in range(len(names))])
    text = f"column_{[name.lower() for name in names].index(text_column.lower())}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(pa.array(keep(part.column(text))))

    return numbered.mapInArrow(run, numbered.schema).toDF(*names)


def without_toxic(documents: DataFrame, chain: Chain, *, text_column: str = "text") -> DataFrame:
    """The rows of documents that ``score`` does not call toxic."""
    return rows_where(
        documents, text_column,
        lambda texts: chain.probabilities(chain.rows(texts))[:, -1] < chain.threshold,
    )
