"""From raw documents to clean, encoded ones: toxicity, near duplicates, decontamination, personal data, encoding.

Every stage takes all that the one before it kept, and its decisions take effect. All but the last return the
columns of documents.
"""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlegrid.llm import toxicity as toxic
from candlegrid.llm.batches import shared_folder
from candlegrid.llm.bpe_codec import encode
from candlegrid.llm.decontamination import contamination
from candlegrid.llm.near_dedup import similar_documents
from candlegrid.llm.pii import find_pii

#: Benchmark phrases of so many words are cut out of documents.
BENCHMARK_WINDOW = 10
#: Words of a shingle, and the similarity from which on documents are near copies.
SHINGLE, SIMILARITY = 5, 0.8


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns as one, so that their names clash with none of an operator's."""
    rest = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("_none"), *rest).alias("_rest"))


def _unpacked(docs: DataFrame, rows: DataFrame, text: str = "text") -> DataFrame:
    """The columns of docs from packed rows, with the given column as the text and its length as n_chars."""

    def column(name):
        if name in ("doc_id", "text"):
            return F.col(text if name == "text" else name).alias(name)
        if name == "n_chars":
            return F.length(text).cast(docs.schema[name].dataType).alias(name)
        return F.col("_rest")[name].alias(name)

    return rows.select(*map(column, docs.columns))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under one half; learned from the labels of those given."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxic.score(_packed(docs), toxic.learn(docs, labels), keep=("_rest", "text"))
    return _unpacked(docs, scored.where(F.col("score") < 0.5))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; documents without an id come after all others.

    Near copies are those of the operator, by fingerprints within two bits, and those at SIMILARITY or more.
    """
    found = similar_documents(docs, SIMILARITY, SHINGLE, prints=True)
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), F.col("node").alias("node"))
    keepers = found.groupBy("group").agg(F.min(order).alias("k")).select(F.col("k.id").alias("_id"), F.col("k.node").alias("_node"))
    node = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = _packed(docs).withColumn("_at", node)
    kept = rows.join(keepers, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_at") == F.col("_node")), "left_semi")
    return _unpacked(docs, kept.dropDuplicates(["doc_id", "_at"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words that lie in benchmark phrases."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _unpacked(docs, contamination(_packed(docs), benchmark, BENCHMARK_WINDOW, keep=("_rest",), cut=True))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind."""
    return _unpacked(docs, find_pii(_packed(docs), keep=("_rest",), masked=True), "masked")


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token ids, with what these decode to."""
    encoded = encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("bpe", bpe),
]

#: No stage can be said in SQL as a whole; tests compare the rows with a brute-force pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = os.path.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        path = os.path.join(folder, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
