"""Each operator as a query over its whole table, and the whole pipeline."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

Query = Callable[[SparkSession, str], DataFrame]

_registry: dict[str, Query] = {}


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the Python workers, once per application, as ``--py-files`` would."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="plumbline-")), "plumbline")
        spark.sparkContext.addPyFile(shutil.make_archive(target, "zip", root, "plumbline"))
        _shipped.add(application)


def query(function: Query) -> Query:
    @functools.wraps(function)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    _registry[function.__name__] = shipped
    return shipped


def queries() -> dict[str, Query]:
    return dict(_registry)


def oracles() -> dict[str, str]:
    from plumbline.llm import oracles as sql

    found = sql.oracles()
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_multi_index_hashing(spark, sf_dir):
    """The 10 nearest sign codes of every vector whose id is divisible by 20, among all vectors."""
    from plumbline.llm.hamming import sign_code, top_k

    vectors = table(spark, sf_dir, "embeddings")
    codes = vectors.select(F.col("vec_id").alias("id"), sign_code("embedding").alias("code"))
    return top_k(codes, codes.where("id % 20 = 0"), 10)


@query
def op2_sum_of_squares_packing(spark, sf_dir):
    """All documents in sequences of at most 4096 tokens, a row per piece."""
    import public_tokenizers

    from plumbline.llm.packing import pack, with_digests

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)
    return with_digests(pieces).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op3_rare_token_licenses(spark, sf_dir):
    """Licence phrases and notices in every document."""
    from plumbline.llm.licenses import scan

    found = scan(table(spark, sf_dir, "documents")).drop("places")
    return found.withColumn("score", F.round("score", 6))


@query
def op4_character_model_urls(spark, sf_dir):
    """Rule and verdict of every page's URL."""
    from plumbline.llm.urls import judge

    return judge(table(spark, sf_dir, "pages")).withColumn("score", F.round("score", 6))


@query
def op5_weak_label_quality(spark, sf_dir):
    """Weak label and score of every document."""
    from plumbline.llm import quality

    documents = table(spark, sf_dir, "documents")
    return quality.score(documents, quality.train(documents))


@query
def op6_class_language_model(spark, sf_dir):
    """Log probabilities of all documents, learned from those that are not held out."""
    from plumbline.llm import classlm

    held_out = classlm.is_held_out(F.col("doc_id"))
    documents = table(spark, sf_dir, "documents")
    model = classlm.train(documents.where(~held_out).select("text"))
    return classlm.score(documents, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity",
    )


@query
def op7_snapshot_collapse(spark, sf_dir):
    """Maximal conversations, rendered."""
    from plumbline.llm.chat import collapse_and_render

    return collapse_and_render(table(spark, sf_dir, "conversations"))


@query
def op8_prefix_filtered_decontamination(spark, sf_dir):
    """Benchmark windows in every document."""
    from plumbline.llm.decontaminate import contamination

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


@query
def op9_classifier_chain_toxicity(spark, sf_dir):
    """Toxicity categories of every document, learned from the labelled ones."""
    from plumbline.llm import toxicity

    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


@query
def op10_tensored_minhash_near_duplicates(spark, sf_dir):
    """Components of documents whose two-word shingles are alike by 0.8 or more."""
    from plumbline.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


@query
def op11_coordinate_pruned_negatives(spark, sf_dir):
    """Hard negatives of every vector whose id is divisible by 50, among all vectors."""
    from plumbline.llm.negatives import floored, mine

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), moved.alias("label"), floored(F.col("embedding"), 256).alias("vector"))
    return mine(rows, F.col("id") % 50 == 0)


@query
def op12_filter_interaction_audit(spark, sf_dir):
    """What five filters keep and remove in every order, per language."""
    from plumbline.llm.filter_audit import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_byte_pair_encoding(spark, sf_dir):
    """Ids of every document, and the bytes that they decode to."""
    import public_tokenizers

    from plumbline.llm.bytepair import encode

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def pipeline(spark, sf_dir):
    """All stages of the corpus pipeline on all documents."""
    return corpus_pipeline.run(spark, sf_dir)
