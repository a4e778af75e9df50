import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import by_id, documents, spaced

from plumbline.llm import classlm
from plumbline.llm.words import words_of

END = "\n"


def texts_of(n):
    rng = np.random.default_rng(3)
    nouns, verbs = [f"noun{i}" for i in range(200)], [f"verb{i}" for i in range(150)]
    return [(i, " ".join(f"The {rng.choice(nouns)} {rng.choice(verbs)}." for _ in range(rng.integers(0, 30)))) for i in range(n)]


def scored(spark, texts):
    frame = documents(spark, texts)
    model = classlm.train(frame.where(~classlm.is_held_out(frame["doc_id"])).select("text"))
    return by_id(classlm.score(frame, model)), model


@pytest.mark.parametrize("held", [classlm.HELD_WORDS, 20, 0])
def test_counts_like_brute_force(spark, monkeypatch, held):
    default = classlm.held_vocabulary
    monkeypatch.setattr(classlm, "held_vocabulary", lambda counts: default(counts, held))
    texts = texts_of(200) + [(900, None), (901, ""), (902, "unheard-of words"), (903, "The " * 30_000)]
    found, model = scored(spark, texts)
    tokens = {i: spaced(text) + [END] for i, text in texts}
    counts = Counter(t for i, own in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for t in own)
    total, distinct = sum(counts.values()), len(counts)
    assert (model.train_tokens, model.n_words) == (total, distinct)
    for i, own in tokens.items():
        base = sum(np.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        row = found[i]
        assert np.isclose(row["base_score"], base)
        assert (row["n_tokens"], row["n_known"]) == (len(own), sum(counts[t] > 0 for t in own))
        assert np.isclose(row["perplexity"], 10 ** (-row["score"] / len(own)))


def test_class_model_beats_counts_on_held_out_texts(spark):
    found, _ = scored(spark, texts_of(400))
    held = [i for i in found if zlib.crc32(str(i).encode()) % 7 == 2]
    assert sum(found[i]["score"] for i in held) > sum(found[i]["base_score"] for i in held) + len(held)


def test_probabilities_add_up_to_one(spark):
    _, model = scored(spark, texts_of(100))
    assert np.allclose((10 ** model.transitions).sum(axis=1), 1)
    rows = model.counts.toPandas()
    vocabulary = model.vocabulary
    place = vocabulary.find(rows["word"].to_numpy().view(np.uint64))
    own = np.where(place >= 0, np.append(vocabulary.units, -1)[place], -1)
    of = model.unit_class[np.where(own >= 0, own, rows["ending"])]
    sums = np.bincount(of, (rows["n"] + 1) * 10 ** model.emissions[of], minlength=classlm.CLASSES)
    assert np.allclose(sums + 10 ** model.emissions, 1)  # the rest is one unknown word per class


def test_exchange_ends_where_no_single_move_helps():
    rng = np.random.default_rng(0)
    kinds = np.arange(40) % 4
    kinds[0] = 0
    follow = np.array([[0, 9, 1, 1], [1, 0, 9, 1], [1, 1, 0, 9], [9, 1, 1, 0]])
    bigrams = rng.poisson(follow[kinds][:, kinds] * 5)

    def likelihood(of, classes):
        onto = np.eye(classes)[of]
        table = onto.T @ bigrams @ onto
        log = lambda n: (n * np.log(np.maximum(n, 1))).sum()
        return log(table) - log(table.sum(axis=0)) - log(table.sum(axis=1))

    values = [likelihood(classlm.exchange(bigrams, 5, sweeps), 5) for sweeps in (0, 1, 2, 10)]
    assert values == sorted(values) and values[-1] > values[0]
    of = classlm.exchange(bigrams, 5, 20)
    assert of[0] == 0 and (of[1:] > 0).all()
    for unit in range(1, 40):
        for kind in range(1, 5):
            moved = of.copy()
            moved[unit] = kind
            assert likelihood(moved, 5) <= likelihood(of, 5) + 1e-6


def test_without_training_texts(spark):
    frame = documents(spark, [(1, "a b"), (2, None)])
    found = by_id(classlm.score(frame, classlm.train(frame.limit(0).select("text"))))
    assert found[1]["base_score"] == 0 and found[1]["n_known"] == 0
    assert classlm.score(frame.limit(0), classlm.train(frame.select("text"))).collect() == []


def test_repeated_rows_and_null_ids(spark):
    rows = documents(spark, [(1, "a b b"), (1, "a b b"), (1, "b"), (None, "a")])
    found = classlm.score(rows, classlm.train(rows.select("text"))).collect()
    assert sorted(str((r["doc_id"], r["n_tokens"])) for r in found) == ["(1, 2)", "(1, 4)", "(1, 4)", "(None, 2)"]
    assert [r[0] for r in rows.select(classlm.is_held_out(rows["doc_id"])).collect()][3] is False


def test_endings_share_units():
    units = classlm._ending_units(words_of(pa.array(["walking", "talking", "ng", "x", "é"])))
    assert units[0] == units[1] != units[2] and (units >= classlm.FREQUENT_UNITS).all()
