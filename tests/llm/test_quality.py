import random

import numpy as np
import pyarrow as pa
from helpers import by_id, documents

from plumbline.llm import quality

STOP = ["the", "of", "and", "to", "in", "is", "that"]


def sentence(rng):
    words = [rng.choice(STOP) if rng.random() < 0.3 else "".join(rng.choices("abcdefghij", k=rng.randint(3, 9)))
             for _ in range(rng.randint(6, 14))]
    return (" ".join(words) + ".").capitalize()


def good(rng):
    return "\n".join(sentence(rng) for _ in range(rng.randint(5, 30)))


def bad(rng):
    kind = rng.randrange(3)
    if kind == 0:
        return " ".join(w + rng.choice(["$$$", "&&&", "###"]) for w in good(rng).split())
    if kind == 1:
        return " ".join(w for w in good(rng).split()[:30] for _ in range(12))
    return " | ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(80))


def corpus(n, seed):
    rng = random.Random(seed)
    kinds = [rng.random() < 0.85 for _ in range(n)]
    return [(i, good(rng) if kind else bad(rng)) for i, kind in enumerate(kinds)], kinds


def test_held_out_accuracy(spark):
    texts, _ = corpus(800, 1)
    model = quality.train(documents(spark, texts))
    texts, kinds = corpus(400, 2)
    found = by_id(quality.score(documents(spark, texts), model))
    agree = [found[i]["keep"] == kind for i, kind in enumerate(kinds)]
    assert np.mean(agree) > 0.98
    assert all(0.5 < a <= 1 for a in model.labels.accuracies.values())

    special = [(1, None), (2, ""), (2, ""), (3, "a word"), (None, texts[0][1]), (4, good(random.Random(9)) * 300)]
    rows = quality.score(documents(spark, special), model).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 and 0 <= r["weak_label"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 2}) == 1
    kept = quality.of_quality(documents(spark, special), model)
    assert kept.columns == documents(spark, []).columns
    assert kept.count() == sum(r["keep"] for r in rows)
    assert quality.score(documents(spark, []), model).collect() == []


def test_without_documents(spark):
    model = quality.train(documents(spark, []))
    assert quality.score(documents(spark, [(1, "x")]), model).first()["score"] == 0.5


def test_expectation_maximisation_recovers_what_made_the_votes():
    rng = np.random.default_rng(4)
    n = len(quality.HEURISTICS)
    kind = np.where(rng.random(20_000) < 0.8, 0, rng.integers(1, n + 1, 20_000))
    found = np.where(rng.random((20_000, n)) < 0.005, quality.BAD, quality.GOOD)
    found[kind > 0, kind[kind > 0] - 1] = quality.BAD
    found[rng.random((20_000, n)) < 0.1] = quality.NOTHING
    combinations, counts = np.unique(found, axis=0, return_counts=True)
    labels = quality.expectation_maximisation(combinations, counts)
    assert abs(labels.shares[0] - 0.8) < 0.05  # one good document in 20 has a false alarm
    # Even the true model errs on 5 %: single false alarms, and kinds whose own heuristic says nothing.
    assert ((labels.posterior(found) > 0.5) == (kind == 0)).mean() > 0.94
    assert (quality.pattern(combinations)[:, None] // 3 ** np.arange(n) % 3 == combinations).all()


def test_statistics_are_shares():
    texts = pa.array(["a b a a", "X!! Y!!", "l\nl\nm", "", None, "#$ a"])
    words = quality.words_of(texts)
    found = quality.statistics(texts, words)
    names = list(quality.HEURISTICS)
    assert found[0, names.index("top_word")] == 0.75 and found[0, names.index("repeated_words")] == 0.25
    assert found[1, names.index("piled_marks")] == 1 and found[1, names.index("capitals")] == 1
    assert np.isclose(found[2, names.index("repeated_lines")], 1 / 3)
    assert np.isclose(found[5, names.index("symbols")], 2 / 3)
    assert (found[3:5] == 0).all()


def test_a_sample_has_at_most_its_rows(spark):
    """Shared ids and equal rows do not bring more rows to the driver than the bound."""
    from pyspark.sql import functions as F

    from plumbline.llm.linear import at_most

    shared = spark.range(3000).selectExpr("id % 3 AS id", "concat('text ', CAST(id AS string)) AS text")
    equal = spark.range(3000).selectExpr("1 AS id", "'same' AS text")
    single = spark.range(5).selectExpr("id", "CAST(id AS string) AS text")
    for rows, size, expected in ((shared, 6, 6), (equal, 6, 1), (shared.union(equal), 50, 50), (single, 5, 5)):
        found = at_most(rows, size)
        assert found.count() == expected and found.columns == ["id", "text"]
        assert found.exceptAll(rows).count() == 0
        assert sorted(found.collect()) == sorted(at_most(rows.repartition(7), size).collect())
    seen = []
    own = quality.fit

    def fit(sparse, *rest):
        seen.append(sparse.n)
        return own(sparse, *rest)

    quality.fit = fit
    try:
        quality.train(shared.select(F.col("id").alias("doc_id"), "text"), sample_rows=5)
    finally:
        quality.fit = own
    assert seen == [5]
