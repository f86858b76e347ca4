"""The registered queries: each applies its operator, with production
parameters, to the whole of its table and derives the returned columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import url_filter
from .contamination import contamination
from .filter_audit import filter_interactions
from .hard_negatives import hard_negatives, stored_vectors
from .html_text import main_text
from .language import identify
from .likelihood import likelihood
from .pieces import decode, encode
from .quality import classify
from .rules import judged
from .sharding import shard
from .simhash import near_duplicates
from .substrings import repeated_substrings


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("text_hash", F.xxhash64("text"))
    back = decode(encode(docs, carry=["doc_id", "text_hash"]))
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.element_at("nbest", 1)["score"].alias("score"),
        (F.xxhash64("decoded") == F.col("text_hash")).alias("round_trip"), "ids", "nbest",
    )


def op2_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return likelihood(_table(spark, sf_dir, "documents"))


def op3_kd_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shard(_table(spark, sf_dir, "documents"), shards=24)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_substrings(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# The rules of the query, as verdict, host and path.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_filter.judge(_table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict", "inherited")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(_table(spark, sf_dir, "documents"))
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), (~base_failed & F.col("passed")).alias("kept")
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_interactions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(stored_vectors(_table(spark, sf_dir, "embeddings"), label=moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece_nbest, op2_lattice_likelihood, op3_kd_tree_sharding, op4_benchmark_decontamination, op5_quality_classifier,
        op6_substring_dedup, op7_simhash_near_dedup, op8_url_filter, op9_quality_rules, op10_html_extraction,
        op11_language_id, op12_filter_audit, op13_hard_negatives,
    )
}
