"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before
kept.  All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm import decontaminate, packing, pii, quality, similar
from larder.llm.common import documents, ready
from larder.llm.queries import word_bpe
from larder.sources.workspace import staged


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the classifier rejects go."""
    ready(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5, decided by whole sets: of near copies (five words, 0.8) the smallest id stays."""
    ready(spark)
    return similar.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that contain a benchmark item go."""
    ready(spark)
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: personal data give way to their kinds; no document goes."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: token sequences of 4096, a row for each piece of a document."""
    ready(spark)
    return packing.pack(docs, word_bpe())


STAGES = [
    ("quality", good_quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("pii", redacted),
    ("packing", packed),
]

# The fitted and iterative stages are beyond SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one written and read again."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
