"""The corpus pipeline: five stages over ``documents``, each by one operator of ``wardwatch.llm``.

quality filter -> one document of each near-duplicate group -> no benchmark
passages -> secrets masked -> SentencePiece ids. Every stage works on all rows
that the one before kept; all but the last return the columns of their input.
Nulls, empty and repeated rows follow the operators' rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.llm.common import table
from wardwatch.llm.decontaminate import decontaminate
from wardwatch.llm.quality import keep_good
from wardwatch.llm.queries import tokenizer_file
from wardwatch.llm.secret_scan import redact_secrets
from wardwatch.llm.sentencepiece_codec import encode_and_decode
from wardwatch.llm.simhash import keep_one
from wardwatch.session import new_work_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score 0.3 or more)."""
    return keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints, the one of the smallest doc_id."""
    return keep_one(docs, shingle=4, max_bits=4)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item, copied or edited."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return redact_secrets(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_ids, text): SentencePiece ids of every document, and the text that they decode to."""
    found = encode_and_decode(docs, tokenizer_file("piece_bpe_32k.model"))
    return found.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.col("decoded").alias("text"))


STAGES = [("quality classifier", quality), ("SimHash near-dedup", near_duplicates),
          ("benchmark decontamination", benchmark_passages), ("secret scans", secrets),
          ("SentencePiece encoding and decoding", pieces)]

# a fitted classifier and a best-path search: not expressible in SQL; tests/llm/test_pipeline.py states the rows by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; between stages the rows are written to the shared folder and read again."""
    docs, folder = table(spark, sf_dir, "documents"), new_work_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            out.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return out
