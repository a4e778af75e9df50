"""The corpus pipeline: documents in, packed token sequences out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import quality, toxicity
from plumbline.llm.decontaminate import contamination
from plumbline.llm.neardup import near_duplicates
from plumbline.llm.packing import pack, with_digests
from plumbline.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOKENIZER, END_ID = "word_bpe_49k.json", 2
SHINGLE_WORDS, PERCENT = 5, 80

# Learned models and statistics have no SQL; the stages are tested one by one.
ORACLE_SQL = None


def unused(docs: DataFrame, name: str) -> str:
    """The name, or a longer one, that no column of the documents has."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic, all columns unchanged. Equal texts, null and empty ones
    among them, stay or go together."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label scorer keeps, all columns unchanged. Equal texts stay or go together, also at
    the threshold itself, where they stay."""
    return quality.of_quality(docs, quality.train(docs))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Rows are judged one by one, also those that share an id; of equal ids in a group one row stays. Rows
    without an id stay unless a document with an id has the same words; they link no others. Rows
    without words stay.
    """
    key, gone = unused(docs, "row_of_stage"), unused(docs, "gone_rows")
    ids = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count()
    if ids.where("count > 1").limit(1).count():
        # Keys follow the ids; the other sort keys only split null and shared ids over tasks.
        rows = docs.sort("doc_id", F.xxhash64("text"), F.monotonically_increasing_id())
        number = F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())
        rows = materialise(rows.withColumn(key, number), "rows")
    else:
        rows = docs.withColumn(key, F.col("doc_id"))
    # A row is known by its key and text: rows without a key are judged by their text alone.
    md5 = F.md5("text")
    found = near_duplicates(
        rows.select(F.col(key).alias("row"), "doc_id", "text", md5.alias("text_md5")), id_column="row",
        shingle_words=SHINGLE_WORDS, percent=PERCENT, carried=("doc_id", "text_md5"))
    found = materialise(found.drop("n_shingles"), "near-duplicates")
    named = found.where("row IS NOT NULL")
    first = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "row"))["row"].alias("row"))
    others = named.join(first.select("row"), "row", "left_anti").select("row", "text_md5")
    unnamed = found.where(F.col("row").isNull() & ~F.col("kept"))
    others = others.union(unnamed.select("row", "text_md5").distinct()).select(F.struct("row", "text_md5").alias(gone))
    row = F.struct(F.col(key).alias("row"), md5.alias("text_md5"))
    return rows.join(materialise(others, "gone"), row == F.col(gone), "left_anti").select(*map(quoted, docs.columns))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by benchmark passages; each text is judged alone, whatever its id.

    Null and empty texts stay; of equal rows all stay or none does."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = unused(docs, "hit_rows")
    row = F.struct("doc_id", F.md5("text").alias("text_md5"))
    found = contamination(docs.select(row.alias("row"), "text"), items, id_column="row")
    found = materialise(found.where("contaminated").select(F.col("row").alias(hit)).distinct(), "contaminated")
    return docs.join(found, row == F.col(hit), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids and digests. A null text is empty; repeated rows are
    packed as often as they occur; other columns are left out."""
    return with_digests(pack(docs, public_tokenizers.path(TOKENIZER), END_ID))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("quality classifier", of_quality),
    ("MinHash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmarks),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return docs
