import public_tokenizers
import pytest
from pyspark.sql import functions as F
from helpers import alphanumeric, by_id, spaced
from test_decontaminate import brute_force as contaminated
from test_neardup import brute_force as components

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it returned, written as the pipeline does."""
    docs, found = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, SF_DIR).write.parquet(path)
        out = spark.read.parquet(path)
        found.append((name, docs, out))
        docs = out
    return found


def rows(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def test_stages(stages):
    assert [name for name, *_ in stages] == [
        "toxicity", "quality classifier", "MinHash near-dedup", "benchmark decontamination", "packing"]
    for _, docs, out in stages[:-1]:
        assert out.schema == docs.schema and out.exceptAll(docs).count() == 0


def test_toxicity_and_quality_follow_the_labels(spark, stages):
    labels = by_id(spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    (_, docs, kept), (_, kept_docs, good) = stages[:2]
    kept_ids, good_ids = {i for i, _ in rows(kept)}, {i for i, _ in rows(good)}
    clean = [i for i, _ in rows(docs) if i in labels and not labels[i]["toxic"]]
    assert sum(i in kept_ids for i in clean) >= 0.98 * len(clean)
    fine = [i for i, _ in rows(kept_docs) if i in labels and labels[i]["quality"]]
    assert sum(i in good_ids for i in fine) >= 0.98 * len(fine)
    junk = [i for i, _ in rows(kept_docs) if i in labels and not labels[i]["quality"]]
    assert sum(i in good_ids for i in junk) <= 0.3 * len(junk)


def test_near_duplicates_like_all_pairs(stages):
    _, docs, out = stages[2]
    expected = components(rows(docs), 5, 80)
    assert sorted(i for i, _ in rows(out)) == sorted(i for i, (_, _, kept) in expected.items() if kept)


def test_decontamination_like_brute_force(spark, stages):
    _, docs, out = stages[3]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    expected = sorted(row[0] for row in contaminated(rows(docs), items) if not row[-1])
    assert sorted(i for i, _ in rows(out)) == expected


def test_packing_keeps_every_token(stages):
    from tokenizers import Tokenizer

    _, docs, out = stages[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    pieces = {}
    for row in out.collect():
        pieces.setdefault(row["doc_id"], []).append((row["start"], bytes(row["ids"])))
    for i, text in rows(docs):
        ids = b"".join(t.to_bytes(4, "little") for t in [*tokenizer.encode(text, add_special_tokens=False).ids, 2])
        assert b"".join(p for _, p in sorted(pieces.pop(i))) == ids
    assert not pieces


NAMES = ["row", "row_of_stage", "gone", "gone_rows", "hit_rows", "text_md5", "kept", "component_id", "contaminated",
         "n_words", "id", "key", "fold", "toxic", "quality", "label", "words", "a.b", "x`y"]


@pytest.mark.parametrize("number", range(4))
def test_columns_with_the_stages_own_names(spark, number):
    """Columns named like each internal one stay as they are and change no decision."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    _, stage = corpus_pipeline.STAGES[number]
    more = docs.withColumns({name: F.concat(F.lit(name), F.col("doc_id").cast("string")) for name in NAMES})
    got = stage(spark, more, SF_DIR)
    assert got.columns == more.columns
    expected = {r["doc_id"] for r in stage(spark, docs, SF_DIR).select("doc_id").collect()}
    found = got.collect()
    assert {r["doc_id"] for r in found} == expected
    assert all(r[name] == f"{name}{r['doc_id']}" for r in found[:50] for name in NAMES)


def test_rows_that_share_an_id(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "x y z"), (None, None), (3, None)],
        "doc_id long, text string")
    out = corpus_pipeline.without_near_duplicates(spark, docs, SF_DIR)
    assert sorted(map(str, rows(out))) == sorted(map(str, [(1, "a b c d e f"), (None, "x y z"), (None, None), (3, None)]))
    assert spaced("A") == alphanumeric("A") == ["a"]


def test_near_duplicates_are_judged_by_row(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f"), (None, "A b c d e f"), (None, "only here"), (None, "and here"), (None, None),
         (2, "a b c d  e f"), (2, "another text of two"), (2, "a third text"), (4, "a third text"), (4, "a fourth text")],
        "doc_id long, text string")
    out = corpus_pipeline.without_near_duplicates(spark, docs, SF_DIR)
    assert out.schema == docs.schema
    assert sorted(map(str, rows(out))) == sorted(map(str, [
        (1, "a b c d e f"), (None, "only here"), (None, "and here"), (None, None),
        (2, "another text of two"), (2, "a third text"), (4, "a fourth text")]))


def test_near_duplicates_without_ids_are_judged_by_row(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f"), (None, "A b c d e f"), (None, "only here"), (None, None), (2, "a b c d  e f"), (3, None)],
        "doc_id long, text string")
    out = corpus_pipeline.without_near_duplicates(spark, docs, SF_DIR)
    assert sorted(map(str, rows(out))) == sorted(map(str, [
        (1, "a b c d e f"), (None, "only here"), (None, None), (3, None)]))


def test_contaminated_rows_take_no_others_along(spark):
    passage = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first()["text"]
    clean = [(None, "only here"), (None, None), (1, "another text of one"), (2, "fine"), (2, "fine")]
    docs = spark.createDataFrame([(None, passage), (1, passage), *clean], "doc_id long, text string")
    out = corpus_pipeline.without_benchmarks(spark, docs, SF_DIR)
    assert out.schema == docs.schema
    assert sorted(map(str, rows(out))) == sorted(map(str, clean))
