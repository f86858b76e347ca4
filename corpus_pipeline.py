"""A training-data pipeline over the table ``documents``: five stages, each
one of the operators of ``bucketvote.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``docs``; the last adds the encoding to the documents.
SQL cannot express the stages, so ``ORACLE_SQL`` is None and the tests hold
the result against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bucketvote.llm.contamination import without_contaminated
from bucketvote.llm.pieces import with_pieces
from bucketvote.llm.quality import keep_good
from bucketvote.llm.simhash import keep_first
from bucketvote.llm.substrings import without_repeats
from bucketvote.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is too high for their language go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return keep_first(docs, shingle_words=4, radius=4)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that occur again anywhere go."""
    return without_repeats(docs, width=35)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), width=10)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the piece ids of their texts and the next best
    segmentations."""
    return with_pieces(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, from ``documents`` of ``sf_dir``;
    between them the rows lie in the shared folder of the session."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        at = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
