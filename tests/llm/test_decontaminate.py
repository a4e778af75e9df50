import random

import pytest
from helpers import alphanumeric, by_id, documents
from pyspark.sql import functions as F

from plumbline.llm import decontaminate, text
from plumbline.llm.decontaminate import contamination

ITEMS = "item_id long, text string, id long, n int, words string"


def items_of(spark, items):
    return spark.createDataFrame([(i, text, -1, 3, "x") for i, text in items], ITEMS)


def brute_force(texts, items, size=13, one_in=20):
    windows = {}
    for i, text in items:
        words = alphanumeric(text)
        n = min(size, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[k: k + n]), set()).add(i)
    found = []
    for i, text in texts:
        words, hit, named = alphanumeric(text), set(), set()
        for n in {len(window) for window in windows}:
            for k in range(len(words) - n + 1):
                own = windows.get(tuple(words[k: k + n]))
                if own is not None:
                    hit |= set(range(k, k + n))
                    named |= own
        named = sorted(str(x) for x in named if x is not None)
        found.append((i, len(words), len(hit), len(named), tuple(named), bool(hit) and one_in * len(hit) >= len(words)))
    return sorted(found, key=repr)


def check(spark, texts, items):
    found = contamination(documents(spark, texts), items_of(spark, items)).collect()
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], tuple(r["items"]), r["contaminated"]) for r in found]
    assert sorted(got, key=repr) == brute_force(texts, items)


@pytest.fixture(params=[text.BROADCAST_ROWS, 0], ids=["broadcast", "shuffled"])
def either_form(request, monkeypatch):
    monkeypatch.setattr(text, "BROADCAST_ROWS", request.param)


def test_like_brute_force(spark, either_form):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "straße"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([2, 5, 13, 14, 40])))) for i in range(30)]
    texts = []
    for i in range(60):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 60)))]
        for _ in range(rng.choice([0, 0, 1, 3])):
            passage = rng.choice(items)[1].split()
            parts.append(", ".join(passage[rng.randint(0, 3):]).upper().replace("É", "é" if i % 2 else "É"))
        texts.append((i, ". ".join(parts)))
    check(spark, texts, items)


def test_special_rows(spark, either_form):
    items = [(1, "one"), (2, "one"), (None, "two words"), (3, None), (4, "!!"), (5, "a b c"), (5, "a b c")]
    texts = [(1, "One two"), (2, None), (3, ""), (4, "x two, words y"), (4, "x two, words y"), (4, "other"), (None, "a B c"),
             (6, "a b c a b c b c"), (7, "one " + "y " * 30_000), (8, "tw o words"), (9, "two")]
    check(spark, texts, items)
    assert contamination(documents(spark, []), items_of(spark, items)).collect() == []
    assert {r["n_hit"] for r in contamination(documents(spark, texts), items_of(spark, [])).collect()} == {0}


def test_longest_first_by_id(spark):
    found = by_id(contamination(documents(spark, [(1, "p q r s t")]), items_of(spark, [(10, "q r s"), (9, "r s t")])))
    assert found[1]["n_hit"] == 4 and found[1]["items"] == ["10", "9"]


def test_words_are_not_shuffled_with_every_place(spark, monkeypatch):
    """Where prefixes are not broadcast, the sides of their join hold no array of words."""
    monkeypatch.setattr(text, "BROADCAST_ROWS", 0)
    texts = documents(spark, [(1, "a b c d"), (2, "b c")]).select(F.col("doc_id").alias("id"), "text")
    prefixes = spark.createDataFrame([(1, 0, 2)], "shingle long, ahead int, n int")
    plan = decontaminate._candidates(texts, [2], prefixes)._jdf.queryExecution().optimizedPlan()
    nodes, sides = [plan], []
    while nodes:
        node = nodes.pop()
        children = [node.children().apply(k) for k in range(node.children().size())]
        if node.nodeName() == "Join" and "shingle" in node.condition().toString():
            sides += [child.output().mkString(",") for child in children]
        nodes += children
    assert len(sides) == 2 and not any("words#" in side.replace("n_words#", "") for side in sides)
