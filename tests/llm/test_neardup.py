import itertools
import random

import pytest
from helpers import by_id, documents, spaced

from plumbline.llm.components import components
from plumbline.llm.neardup import near_duplicates


def brute_force(texts, size, percent):
    sets = {}
    for i, text in texts:
        words = spaced(text)
        windows = {tuple(words[k: k + size]) for k in range(len(words) - size + 1)}
        sets[i] = windows or ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(own), root(i), root(i) == i) for i, own in sets.items()}


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    texts, number = [], 0
    for family in range(25):
        base = rng.choices(words, k=rng.choice([1, 2, 3, 12, 60, 200]))
        for _ in range(rng.choice([1, 2, 6, 15])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 9))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append((number, " ".join(copy)))
            number += 3
            if rng.random() < 0.1:
                base = copy  # families drift, so that chains come about
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("size,percent", [(2, 80), (5, 80), (1, 80)])
def test_same_components_as_all_pairs(spark, size, percent):
    texts = corpus()
    found = near_duplicates(documents(spark, texts), shingle_words=size, percent=percent)
    got = {row["doc_id"]: (row["n_shingles"], row["component_id"], row["kept"]) for row in found.collect()}
    assert got == brute_force(texts, size, percent)


def test_special_rows(spark):
    texts = [(5, "a b c d"), (3, "A  B\tc D"), (None, "a b c d"), (None, "alone here"), (1, None), (2, ""), (4, " \n"),
             (6, "one"), (7, "ONE"), (7, "ONE"), (8, "x " * 50_000)]
    rows = near_duplicates(documents(spark, texts), shingle_words=2).collect()
    assert len(rows) == len(texts)
    found = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert found == {
        (5, 3, 3, False), (3, 3, 3, True), (None, 3, 3, False), (None, 1, None, True), (1, 0, 1, True), (2, 0, 2, True),
        (4, 0, 4, True), (6, 1, 6, True), (7, 1, 6, False), (8, 1, 8, True),
    }


def test_empty(spark):
    assert near_duplicates(documents(spark, [])).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    chain = list(range(0, 600, 2))
    rng.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(1001, 1001 + k) for k in range(1, 300)] + [(2000, 2000), (3, None)]
    edges += [(b, a) for a, b in edges[:50]]
    rng.shuffle(edges)
    found = by_id(components(spark.createDataFrame(edges, "a long, b long")), "node")
    assert {found[i]["component"] for i in chain} == {0}
    assert {found[1001 + k]["component"] for k in range(300)} == {1001}
    assert found[2000]["component"] == 2000 and len(found) == 300 + 300 + 1
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
