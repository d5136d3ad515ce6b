"""The corpus pipeline: quality rules, exact and near-duplicate removal, mixing, encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns
a DataFrame.  ``run`` applies them in order to the ``documents`` table.  Every stage's
result is written to the shared folder and read back as the next one's input, so a
lost executor repeats work of one stage only.  All stages but the last return the
columns of ``documents``; the last has what encoding makes of each training row.

Null, empty, very long and repeated rows, empty tables and extra columns pass through the
stages as the operators define (see each module).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import bpe_automaton, circulant_minhash, curriculum, exact_dedup, ngram_ratio
from kestrel.llm.common import written
from kestrel.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that fail the base rules or the n-gram ratio go."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return ngram_ratio.keep_good(docs, ngram_ratio.fit(docs, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one row of each text stays, the one with the smallest id."""
    return exact_dedup.keep_one(docs, keep="min")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of documents linked by five-word shingles at 0.8 or more, the smallest id stays."""
    return circulant_minhash.keep_first(docs, shingle=5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: each document as often as the mix takes it, in training order."""
    return curriculum.training_order(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: ids of every row, and digests of the ids and of the text decoded from them."""
    vocab = tokenizer_path("byte_bpe_50k.json")
    both = bpe_automaton.encode(docs.select("doc_id", "source", "text"), vocab, decoded="decoded")
    return both.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("MinHash near-dedup", near),
          ("mixing sources to target weights", mixing), ("BPE encoding and decoding", encoding)]

# Hashed n-grams, MinHash and the merges are beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
