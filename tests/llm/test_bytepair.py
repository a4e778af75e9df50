"""Byte-pair encoding against the tiktoken library, and decoding as a round trip."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import helpers
from plumbline.llm import bytepair, queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF_DIR = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n \n", "a", "Hello World again", "it's we'll I'D 12 345", "caf\u00e9 \u00a0 na\u00efve\u2003x",
    "\u4e2d\u6587\u5b57 \ud55c\uae00 \U0001f600\U0001f469\u200d\U0001f4bb", "<|endoftext|>", "x" * 700, "ab" * 400, "-" * 300 + " " * 200,
    "\x00\x01 \x7f\ue000\ue001\uf8ff", "\t\r\n\x0b\x0c\x1c\x85\u2028 end ", " 'tis 'S \u0301\u0301",
]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def checked(spark, library, texts, **options):
    rows = helpers.documents(spark, list(enumerate(texts)))
    found = helpers.by_id(bytepair.encode(rows, PATH, public_tokenizers.PATTERN, **options))
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        assert found[i]["ids"] == library.encode_ordinary(text or ""), text
        assert bytes(found[i]["decoded"]) == (text or "").encode()


@pytest.mark.parametrize("kept_words", [0, 3, 1000])
def test_odd_texts(spark, library, kept_words):
    # Words that occur twice are among those that are folded once, if any are.
    checked(spark, library, ODD + ODD + ["zxqv wvuq zxqv wvuq wvuq"], kept_words=kept_words)


def test_very_long_text(spark, library):
    checked(spark, library, ["".join(f" word{i} gr\u00fcn{i % 97}," for i in range(60_000)), "k" * 5000])


def test_generated_texts(spark, library):
    texts = []

    @settings(max_examples=150, deadline=None, derandomize=True, database=None)
    @given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
    def gather(text):
        texts.append(text)

    gather()
    checked(spark, library, texts, kept_words=20)


def test_every_character_is_cut_as_in_the_library(spark, library):
    import pyarrow as pa

    numbers = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["a" + chr(c) + "1 " + chr(c) + chr(c) + "b" for c in numbers]
    rows = spark.createDataFrame(pa.table({"doc_id": numbers, "text": texts})).repartition(8)
    found = bytepair.encode(rows, PATH, public_tokenizers.PATTERN, kept_words=0).select("doc_id", "ids").toArrow()
    found = dict(zip(found["doc_id"].to_pylist(), found["ids"].to_pylist()))
    assert [c for c, text in zip(numbers, texts) if found[c] != library.encode_ordinary(text)] == []


def test_rows_and_columns(spark):
    rows = spark.createDataFrame(
        [(None, "some words", "a", 1), (None, "some words", "a", 1), (7, None, "b", 2), (7, "x", None, 3)],
        "doc_id long, text string, __text string, ids int")
    found = sorted((r["doc_id"] or 0, len(r["ids"])) for r in bytepair.encode(rows, PATH, public_tokenizers.PATTERN).collect())
    assert found == [(0, 2), (0, 2), (7, 0), (7, 1)]
    assert bytepair.encode(rows.limit(0), PATH, public_tokenizers.PATTERN).collect() == []


def test_no_row_carries_the_map(spark):
    """The scalar with the known words is used inside one projection and never a column of a row."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = bytepair.encode(rows, PATH, public_tokenizers.PATTERN)._jdf.queryExecution().optimizedPlan()
    assert "__known" not in plan.toString()


def test_pairs_are_built_once(spark):
    """A fold asks for ranks in two places, the first pairs and both new ones of a step, and each pair is built once."""
    asked = []

    def ranks_of(pairs):
        asked.append(pairs)
        return F.transform(pairs, lambda pair: F.lit(bytepair.NO_RANK)).cast("string")

    bytepair.folded(F.lit("abc"), ranks_of)
    assert len(asked) == 2


def test_both_folds_give_the_ids_of_the_library(spark, library):
    ranks = bytepair.read_ranks(PATH)
    words = [" grundst\u00fccksverkehr", "zzqqxxjjkk", "aaaaaaaaab", "0123456789012345", "\u4e2d\u6587\u5b57\u5bf9", "a", "ab" * 60]
    for word in words:
        assert bytepair.merged(word.encode(), ranks) == library.encode_ordinary(word), word
    assert bytepair.merged(b"", ranks) == []
    # Kept words are folded by Spark's functions, these by the helper.
    checked(spark, library, [" ".join(words)] * 2, kept_words=100)
    checked(spark, library, [" ".join(words)] * 2, kept_words=0)


def test_ids_are_decoded_in_runs(monkeypatch):
    import numpy as np

    monkeypatch.setattr(bytepair.Decoder, "TOGETHER", 3)
    decoder = bytepair.Decoder({b"a": 5, b"bc": 0, b"def": 2, b"\xff": 3})
    assert decoder.of(np.array([5, 0, 2, 3, 3, 0, 5])) == b"abcdef\xff\xffbca"
    assert decoder.of(np.array([], int)) == b""


def test_words_that_are_not_known_are_folded_by_the_helper(spark):
    """Every word is cut and looked up by Spark; the rare ones among them are no longer folded by interpreted functions."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = bytepair.encode(rows, PATH, public_tokenizers.PATTERN)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "regexp_extract_all" in plan and "aggregate(sequence" not in plan


def test_plans_are_short(spark):
    """The driver keeps descriptions of plans: none has the ranks, nor do rows carry them."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    execution = bytepair.encode(rows, PATH, public_tokenizers.PATTERN)._jdf.queryExecution()
    for plan in (execution.analyzed(), execution.optimizedPlan(), execution.executedPlan()):
        assert len(plan.toString()) < 100_000
    kept = execution.optimizedPlan().toString()
    assert "__ranks" not in kept and "__parts" not in kept


def test_other_ranks_are_refused(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError, match="no rank"):
        bytepair.BytePairs(str(path), public_tokenizers.PATTERN)


def test_query(spark, library):
    found = helpers.by_id(queries.queries()["op13_byte_pair_encoding"](spark, SF_DIR))
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(found) == len(rows)
    for row in rows:
        ids = library.encode_ordinary(row["text"])
        got = found[row["doc_id"]]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256(row["text"].encode()).hexdigest()
