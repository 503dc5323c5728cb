"""Corpus pipeline: toxicity, exact copies, near copies, mixing, encoding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
``docs``. All stages but the last return the columns of their input.
``run`` applies them to ``documents``, writing to the session's shared
checkpoint folder. The stages have no SQL form (``ORACLE_SQL`` is None);
``tests/llm`` compares them with brute-force versions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cardiolake.llm.common import read_table
from cardiolake.llm.exact_dedup import drop_exact_copies
from cardiolake.llm.minhash_dedup import drop_near_copies
from cardiolake.llm.mixing import mix_documents
from cardiolake.llm.pieces import encode
from cardiolake.llm.toxicity import drop_toxic, fit
from cardiolake.session import ensure_checkpoint_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under the threshold; labels come from ``labels``."""
    return drop_toxic(docs, fit(docs, read_table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, shingle=5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix (one row per copy)."""
    return encode(docs, keep=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mixing", mixing), ("encoding", encoding)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{name}")
        docs = spark.read.parquet(f"{out}/{name}")
    return docs
