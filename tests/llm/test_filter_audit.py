"""The filter audit against filters that are applied one after another."""

import itertools
import re

import helpers
from plumbline.llm import filter_audit

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, labels):
    """rows of (doc_id, text, lang); labels of (doc_id, quality, toxic)."""
    good = {i for i, quality, _ in labels if i is not None and quality == 1}
    toxic = {i for i, _, bad in labels if i is not None and bad == 1}
    docs = []
    for i, text, lang in rows:
        text = text or ""
        words = WORDS.findall(text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (other or "") == text for j, other, _ in rows),
        }
        docs.append((lang or "", {f for f, bad in fails.items() if bad}, i in good, i in toxic))
    found = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left, gone = own, []
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(removed)
                found[part, "".join(order), step] = (
                    len(left), len(removed), sum(f in d[1] for d in gone), sum(d[1] == {f} for d in own),
                    sum(d[2] for d in removed), sum(d[3] for d in removed))
                gone = gone + removed
        for (p, order, step), values in found.items():
            if p == part:
                found[p, order, step] = (*values[:6], shapley[order[step - 1]])
    return found


def checked(spark, rows, labels):
    documents = spark.createDataFrame(
        [(*r, 1, "x", True) for r in rows], "doc_id long, text string, lang string, fails int, part string, good boolean")
    marks = spark.createDataFrame([(*r, 5) for r in labels], "doc_id long, quality int, toxic int, id int")
    got = filter_audit.audit(documents, marks).collect()
    expected = brute_force(rows, labels)
    assert len(got) == len(expected)
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == expected
    return got


LONG = " ".join(f"word{i}" for i in range(100))


def test_every_order_and_step(spark):
    rows = [
        (1, LONG, "en"), (2, LONG, "de"), (3, LONG, "en"), (3, LONG, "en"), (4, LONG + " #", "en"),
        (5, "few words", "en"), (6, " ".join(["same"] * 120), "en"), (7, LONG.upper(), "fr"), (8, "A|B", "fr"),
        (9, LONG + " x Word1 word1", "de"), (10, None, None), (11, "", ""), (12, None, "en"), (None, LONG, "en"),
        (None, "few words", None), (0, "few words", None), (5, "other", "en"), (5, "few words", "en"), (13, "ÉÉA", "en"),
        (14, " ".join(f"\U0001f600{i}" for i in range(150)) + " WW", "fr"), (15, "\t\n\x0b\x0c\r ", "en"),
    ]
    labels = [(1, 1, 0), (3, 1, 1), (3, 0, 0), (4, None, 1), (5, 1, None), (7, 0, 1), (10, 1, 1), (99, 1, 1), (None, 1, 1)]
    checked(spark, rows, labels)


def test_edges_of_the_thresholds(spark):
    words = [f"w{i}" for i in range(80)]
    rows = [
        (1, " ".join(words + words[:20]), "en"), (2, " ".join(words[:79] + words[:21]), "en"),
        (3, "A" + "b" * 9, "en"), (4, "AA" + "b" * 17, "en"), (5, " ".join(["w"] * 99), "en"),
    ]
    checked(spark, rows, [])


def test_large_groups_of_equal_texts(spark):
    rows = [(i, LONG, "en" if i % 3 else None) for i in range(400)] + [(i, "", "en") for i in range(400, 600)]
    checked(spark, rows, [(i, i % 2, int(i % 5 == 0)) for i in range(0, 600, 7)])


def test_no_documents(spark):
    documents = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(documents, labels).collect() == []
    one = spark.createDataFrame([(1, "x", "en")], "doc_id long, text string, lang string")
    assert len(filter_audit.audit(one, labels.limit(0)).collect()) == 600


def test_very_long_text(spark):
    checked(spark, [(1, " ".join(f"w{i % 50_000}" for i in range(120_000)), "en"), (2, "x" * 300_000, "en")], [])


def test_a_marked_frame_keeps_its_salt(spark):
    """Rows without an id are dealt out by their text: the join has a second key that is no constant."""
    documents = spark.createDataFrame([(1, "x", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    plan = filter_audit.failure_counts(documents, labels)._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert "salt" in join and "no_salt" in join


def test_helper_documents_are_read(spark):
    rows = helpers.documents(spark, [(1, "some words"), (2, "some words")]).selectExpr("*", "'en' lang")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    found = {(r["fails"], r["documents"], r["good"]) for r in filter_audit.failure_counts(rows, labels).collect()}
    assert found == {(1, 1, 1), (17, 1, 0)}
