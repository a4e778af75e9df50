import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import by_id, documents

from plumbline.llm import toxicity
from plumbline.llm.linear import Sparse, fit

LABELS = "doc_id long, toxic int, quality int, text string, fold string"
WORDS = [f"w{i}" for i in range(2000)]


def labelled(n, seed):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.choice([5, 40, 300]))
        toxic = rng.random() < 0.2
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["Idiot,", "SCUM", "grobian!", "vermin"]))
        texts.append((i, " ".join(words)))
        labels.append((i, int(toxic), 1, "x", "y"))
    return texts, labels


@pytest.fixture(scope="module")
def trained(spark):
    texts, labels = labelled(1500, 1)
    return toxicity.train(documents(spark, texts), spark.createDataFrame(labels, LABELS))


def test_held_out_accuracy(spark, trained):
    texts, labels = labelled(800, 2)
    found = by_id(toxicity.score(documents(spark, texts), trained))
    wrong = [i for i, toxic, *_ in labels if found[i]["is_toxic"] != bool(toxic)]
    assert len(wrong) <= 4
    assert set(found[0].asDict()) == {"doc_id", "p_insult", "p_contempt", "p_threat", "p_toxic", "is_toxic"}


def test_special_rows(spark, trained):
    texts = [(1, None), (2, ""), (2, ""), (None, "you IDIOT scum grobian"), (3, "w1 " * 100_000 + "idiot scum vermin"), (4, "idiotic")]
    rows = toxicity.score(documents(spark, texts), trained).collect()
    assert sorted((str(r["doc_id"]), r["is_toxic"]) for r in rows) == [
        ("1", False), ("2", False), ("2", False), ("3", True), ("4", False), ("None", True)]
    kept = toxicity.without_toxic(documents(spark, texts), trained)
    assert kept.columns == documents(spark, []).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 2, 4]
    assert toxicity.score(documents(spark, []), trained).collect() == []


@pytest.mark.parametrize("rows", [[], [(1, None, 1, "", ""), (None, 1, 1, "", "")], [(1, 0, 1, "", ""), (2, 0, 0, "", "")]])
def test_without_both_kinds_of_labels_nothing_is_toxic(spark, rows):
    chain = toxicity.train(documents(spark, [(1, "idiot"), (2, "scum")]), spark.createDataFrame(rows, LABELS))
    found = toxicity.score(documents(spark, [(1, "idiot"), (2, None)]), chain)
    assert [r["is_toxic"] for r in found.collect()] == [False, False]


def test_later_models_see_earlier_probabilities():
    rng = np.random.default_rng(0)
    n = 600
    first = rng.random(n) < 0.5
    sparse = Sparse(np.flatnonzero(first), np.zeros(first.sum(), int), np.ones(first.sum()), n)
    targets = np.column_stack([first, first & (rng.random(n) < 0.9)]).astype(float)
    models, held_out = toxicity.fit_chain(sparse, targets, np.arange(n) % 4, 1)
    assert [len(m.dense) for m in models] == [0, 1]
    assert models[1].dense[0] > 0
    assert ((held_out[:, 0] > 0.5) == first).all()


def test_fit_finds_the_least_loss():
    rng = np.random.default_rng(1)
    dense = rng.normal(size=(4000, 2))
    target = (rng.random(4000) < 1 / (1 + np.exp(-(1.5 * dense[:, 0] - dense[:, 1] + 0.5)))).astype(float)
    none = np.zeros(0, int)
    model = fit(Sparse(none, none, np.zeros(0), 4000), dense, target, 0, l2=0)
    assert np.allclose([*model.dense, model.bias], [1.5, -1, 0.5], atol=0.2)


def test_threshold_ties_fall_on_one_side():
    p, toxic = np.array([0.9, 0.7, 0.7, 0.2]), np.array([1.0, 1, 0, 0])
    assert toxicity.best_threshold(p, toxic) == 0.5 or 0.5 <= toxicity.best_threshold(p, toxic) < 0.9
    assert toxicity.best_threshold(p[:0], toxic[:0]) > 1


def test_words_inside_others_do_not_count(trained):
    assert len(trained.rows(pa.array(["scummy ascum", "scum-bag"])).row) == 1
