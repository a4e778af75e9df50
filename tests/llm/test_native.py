"""The operators made of DataFrame functions alone."""

import itertools
import random

import pytest
from helpers import by_id, documents
from pyspark.sql import functions as F

from plumbline.llm import chat, hamming, licenses, urls

PYTHON = ("Python", "Pandas", "Arrow")


def native(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return not any(word in plan for word in PYTHON)


# ---- licences --------------------------------------------------------------

def test_licences(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    texts = [
        (1, "Licensed under CC BY 4.0. cc-by, CC BY"), (2, "GNU General Public License; all  rights\nreserved. All rights, reserved"),
        (3, mit.upper()), (4, "the rights reserved by all"), (5, None), (6, ""), (7, "x " * 30_000 + "cc by"),
        (8, "Licensed under CC BY-NC 4.0."), (8, "Licensed under CC BY-NC 4.0."), (None, "cc by"), (9, "permission granted hereby"),
        (10, "ÀLL RIGHTS RESERVED"), (10, "ccby"),
    ]
    frame = licenses.scan(documents(spark, texts))
    assert native(frame)
    rows = [(r["doc_id"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) for r in frame.collect()]
    assert sorted(rows, key=repr) == sorted([
        (1, 3, 2, 8, "cc-by", "cc-by"), (2, 3, 1, 7, "gpl,reserved", "gpl,reserved"), (3, 0, None, None, "", "mit"),
        (4, 0, None, None, "", ""), (5, 0, None, None, "", ""), (6, 0, None, None, "", ""),
        (7, 1, 30_000, 30_000, "cc-by", "cc-by"), (8, 1, 2, 2, "cc-by", "cc-by,cc-by-nc"),
        (8, 1, 2, 2, "cc-by", "cc-by,cc-by-nc"), (None, 1, 0, 0, "cc-by", "cc-by"), (9, 0, None, None, "", ""),
        (10, 0, None, None, "", ""), (10, 0, None, None, "", ""),
    ], key=repr)
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "") for r in frame.collect())
    assert licenses.scan(documents(spark, [])).collect() == []


MIT = ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
       "documentation files").split()


def test_no_notice_with_enough_words_is_lost(spark):
    """Whatever words of a notice are edited, as long as enough stand and its key phrase does."""
    rng = random.Random(8)
    editable = range(4, len(MIT))
    texts, expected = [], []
    for number in range(300):
        n_edits = rng.randint(1, 8)
        words = list(MIT)
        for place in rng.sample(editable, n_edits):
            words[place] = rng.choice(["any", "a", "zzz", "this", "of"])
        same = sum(a == b for a, b in zip(words, MIT))
        texts.append((number, " ".join(["before"] * rng.randint(0, 5) + words)))
        expected.append("mit" if same >= 0.7 * len(MIT) else "")
    assert 50 < sum(map(bool, expected)) < 300
    found = by_id(licenses.scan(documents(spark, texts)))
    assert [found[i]["labels"] for i in range(300)] == expected
    # Also where words of the notice occur nowhere.
    words = ["zzz" if word in ("associated", "charge", "hereby") and i > 4 else word for i, word in enumerate(MIT)]
    one = licenses.scan(documents(spark, [(1, " ".join(words))])).first()
    assert one["labels"] == "mit" and abs(one["score"] - 0.9) < 1e-9


# ---- URLs ------------------------------------------------------------------

CASES = [
    ("http://A.example.COM/en/x?y", "a.example.com", "/en/x", "example.com/en/"),
    ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/"),
    ("http://m.www.example.com/en/a", "m.www.example.com", "/en/a", "www.example.com/en/"),
    ("http://example.com/EN/", "example.com", "/EN/", "com/"), ("http://notexample.com/en/", "notexample.com", "/en/", "com/"),
    ("https://x.net/es/1#/fr/", "x.net", "/es/1", "net/es/"), ("net/es/", "", "", None), (None, "", "", None),
    ("http://x.com", "x.com", "", None), ("http://x.com?/en/", "x.com", "", None), ("://b.com/", "b.com", "/", "com/"),
    ("a://b://c.com/", "b:", "//c.com/", None), ("", "", "", None), ("http://É.com/\n/é", "É.com", "/\n/é", "com/"),
    ("http://" + "a" * 20_000 + ".org/", "a" * 20_000 + ".org", "/", None),
]


def test_urls(spark):
    rows = [(i, case[0], "html", "h", "p", 0.5) for i, case in enumerate(CASES)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string, score double")
    frame = urls.judge(pages)
    assert native(frame)
    found = frame.collect()
    assert len(found) == len(rows)
    for row in found:
        assert (row["host"], row["path"], row["rule"]) == CASES[row["page_id"]][1:]
        assert row["verdict"] == dict(urls.RULES).get(row["rule"], row["verdict"]) and row["verdict"] in ("allow", "block")
    assert urls.judge(pages.limit(0)).collect() == []


def test_the_whole_url_is_scored(spark):
    rng = random.Random(6)
    good = [f"http://a{rng.randint(1, 99)}.com/p?q=news{rng.randint(1, 999)}" for _ in range(150)]
    bad = [f"http://b{rng.randint(1, 99)}.net/es/p?q=casino{rng.randint(1, 999)}" for _ in range(150)]
    ask = ["http://x.org/?q=news", "http://x.org/?q=casino", "x.org/news", "x.org/casino", None, ""]
    pages = spark.createDataFrame(list(enumerate(good + bad + ask)), "page_id long, url string")
    frame = urls.judge(pages)
    assert frame.columns == ["page_id", "host", "path", "rule", "verdict", "score"]
    found = by_id(frame, "page_id")
    rows = [found[len(good + bad) + k] for k in range(len(ask))]
    assert [r["verdict"] for r in rows[:4]] == ["allow", "block", "allow", "block"]
    assert rows[0]["score"] > rows[1]["score"] and rows[2]["score"] > rows[3]["score"] and rows[4]["score"] == rows[5]["score"]


def test_model_learns_what_rules_say(spark):
    rng = random.Random(4)
    good = [f"http://{w}.com/{rng.randint(1, 999)}" for w in ("news", "books", "music") for _ in range(80)]
    bad = [f"http://{w}.net/es/{rng.randint(1, 999)}" for w in ("casino", "pills", "bets") for _ in range(80)]
    ask = ["http://musicbooks.org/5", "http://casinopills.org/es/5"]
    pages = spark.createDataFrame(list(enumerate(good + bad + ask)), "page_id long, url string")
    found = by_id(urls.judge(pages), "page_id")
    assert [found[len(good + bad) + k]["verdict"] for k in (0, 1)] == ["allow", "block"]


def test_probabilities_add_up(spark):
    texts = ["abab", "abc", "xaby"]
    counts = urls._counts(spark.createDataFrame([(t, "allow") for t in texts], "url string, verdict string"))
    letters = sorted(set("".join(texts)) | {urls.END}) + [chr(0x100 + k) for k in range(urls.ALPHABET - 6)]
    grams = spark.createDataFrame([("zab" + c,) for c in letters], "gram string")
    ratios = urls.log_ratios(counts, grams).select(F.sum(F.exp("ratio")))
    assert abs(ratios.first()[0] / urls.ALPHABET - 1) < 1e-9  # the other side has seen nothing


# ---- conversations ---------------------------------------------------------

def test_conversations(spark):
    def talk(i, *turns, start=0):
        return [(i, start + k, role, text) for k, (role, text) in enumerate(turns)]

    a, b, c = ("user", "hi"), ("assistant", "hello"), ("user", "bye")
    rows = [
        *talk(1, a), *talk(2, a, b), *talk(3, a, b, c, start=7), *talk(4, a, b, c), *talk(4, a, b, c),
        *talk(5, b), *talk(6, ("user", None)), *talk(7, ("user", "")), *talk(8, (None, "hi")), (None, None, None, None),
        *talk(9, a, ("assistant", "other")), (10, 5, "user", "b"), (10, 5, "user", "a"), (10, None, "user", "z"),
        *talk(11, *[("user", f"t{k}") for k in range(3000)]), *talk(12, *[("user", f"t{k}") for k in range(2500)]),
        *talk(13, ("user", "x" * 200_000)),
    ]
    frame = chat.collapse_and_render(spark.createDataFrame(
        [(*row, 1, 2) for row in rows], "conv_id long, turn long, role string, text string, place int, id int"))
    assert native(frame)
    found = by_id(frame, "conv_id")
    assert {i: (r["n_turns"], r["n_copies"]) for i, r in found.items()} == {
        3: (3, 2), 5: (1, 1), 6: (1, 1), 7: (1, 1), 8: (1, 1), None: (1, 1), 9: (2, 1), 10: (3, 1), 11: (3000, 1), 13: (1, 1)}
    assert found[3]["rendered"] == "<|user|>\nhi\n<|end|>\n<|assistant|>\nhello\n<|end|>\n<|user|>\nbye\n<|end|>\n"
    assert found[10]["rendered"].split("\n")[1::3] == ["z", "a", "b"]
    assert found[11]["rendered"].split("\n")[1::3] == [f"t{k}" for k in range(3000)]
    assert chat.collapse_and_render(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


# ---- binary codes ----------------------------------------------------------

def nearest(rows, queries, k):
    found = []
    for q, code in {(i, c) for i, c in queries if i is not None and c is not None}:
        distances = {}
        for i, other in rows:
            if i is not None and other is not None and i != q:
                distance = ((code ^ other) % (1 << 64)).bit_count()
                distances[i] = min(distance, distances.get(i, 99))
        best = sorted((d, i) for i, d in distances.items())[:k]
        found += [(q, rank + 1, i, d) for rank, (d, i) in enumerate(best)]
    return sorted(found)


@pytest.mark.parametrize("spread", [3, 30])
def test_search_like_brute_force(spark, spread):
    rng = random.Random(spread)
    centres = [rng.getrandbits(64) for _ in range(5)]
    rows = []
    for i in range(400):
        code = rng.choice(centres)
        for _ in range(rng.randint(0, spread)):
            code ^= 1 << rng.randrange(64)
        rows.append((i, code - (1 << 64) if code >= 1 << 63 else code))
    rows += [(400 + i, 12345) for i in range(50)] + [rows[0], rows[0], (None, 5), (7, None), (3, 77)]
    queries = [row for row in rows if row[0] is not None and row[0] % 40 == 0]
    frame = spark.createDataFrame(rows, "id long, code long")
    found = hamming.top_k(frame, spark.createDataFrame(queries, "id long, code long"), 5)
    assert sorted(tuple(r) for r in found.collect()) == nearest(rows, queries, 5)


def test_fewer_rows_than_asked_for(spark):
    rows = [(1, 0), (2, -1), (3, 5)]
    frame = spark.createDataFrame(rows, "id long, code long")
    found = hamming.top_k(frame, frame.where("id = 1"), 10)
    assert sorted(tuple(r) for r in found.collect()) == nearest(rows, rows[:1], 10)
    assert hamming.top_k(frame.limit(0), frame, 3).collect() == []
    assert hamming.top_k(frame, frame.limit(0), 3).collect() == []


def test_sign_codes(spark):
    vectors = [[1.0 if k == i else -1.0 for k in range(64)] for i in (0, 1, 63)]
    rows = spark.createDataFrame([(v,) for v in [*vectors, [0.0] * 64, [None] * 64, [1.0], None]], "e array<float>")
    codes = [r[0] for r in rows.select(hamming.sign_code("e")).collect()]
    assert codes == [1, 2, -(1 << 63), 0, 0, None, None]


def test_segments_cover_the_code():
    for n, bits in itertools.product((1, 500, 10**6, 10**10), (8, 64)):
        segments = hamming._segments(bits, n)
        assert sum(width for _, width in segments) == bits and segments[0][0] == 0
