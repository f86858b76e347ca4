"""Bindings of the store's tables to the driver's parquet tables.

Binding A (self-checking): ``customer`` -> tracks, ``orders`` -> slices with
``HashTable_i = o_orderkey % (3 + i)``, so votes(a, b) = how many of 3..27
divide ``a - b``.  Its bins have 3..27 values each: every bin is hot (a
third of all rows share bin 0 of position 0), the skew case.

Binding B (realistic): ``documents`` -> one slice per document, bins by
MinHash over the document's tokens.

Binding C (identification): ``documents`` -> tracks, each non-empty line of
a document -> one slice (SequenceNumber = line index); ``benchmark`` lines
are the query clips.

All builders are lazy DataFrame expressions over the parquet tables, except
the per-track sequence number of binding A, which is numbered by the
range-partitioned ``sequence_within`` (no hot track lands in one task).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.minhash import minhash_bins
from ..operators.ids import sequence_within
from ..schema import BIN_COLS, SLICE_COLS

# Fixed values of binding A: seconds per slice step, the modulus base of
# bin i (3 + i), the label rules, and the line-id stride of binding C.
SLICE_STEP = Decimal("0.928")
BIN_MOD_BASE = 3
LINE_STRIDE = 1 << 31  # above the lines of any text (a text has fewer bytes)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tracks_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks from customers (NULL, empty and repeated ISRC on purpose)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    isrc = (
        F.when(k % 10 == 0, F.lit(None).cast("string"))
        .when(k % 10 == 1, F.lit(""))
        .otherwise(F.concat(F.lit("ISRC"), (k % 500).cast("string")))
    )
    return c.select(
        k.cast("int").alias("Id"),
        isrc.alias("ISRC"),
        F.col("c_mktsegment").alias("Artist"),
        F.col("c_name").alias("Title"),
        F.concat(F.lit("album-"), F.col("c_nationkey").cast("string")).alias("Album"),
        (F.lit(1950) + F.col("c_nationkey")).cast("int").alias("ReleaseYear"),
        F.abs(F.col("c_acctbal")).alias("Length"),
    )


def tracks_a_raw_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``tracks_a`` but with the signed balance as Length (range checks)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return tracks_a(spark, sf_dir).drop("Length").join(
        c.select(F.col("c_custkey").cast("int").alias("Id"), F.col("c_acctbal").alias("Length")), "Id"
    )


def slice_bins_a(key) -> list:
    return [(key % (BIN_MOD_BASE + i)).cast("int").alias(c) for i, c in enumerate(BIN_COLS)]


def clusters_a():
    k = F.col("o_orderkey")
    return (
        F.when(k % 7 == 0, F.lit(""))
        .when(k % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lower(F.col("o_orderpriority")), F.lit(","), F.col("o_orderstatus")))
    )


def slices_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices from orders: one per order, numbered per customer by date."""
    return slices_a_wide(slices_a_narrow(spark, sf_dir))


def slices_a_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders with TrackId and SequenceNumber: what ``slices_a`` is made of."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    numbered = sequence_within(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], out="_seq")
    return numbered.select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("TrackId"), F.col("_seq").cast("int").alias("SequenceNumber"), "_seq", "o_orderpriority", "o_orderstatus"
    )


def slices_a_wide(numbered: DataFrame) -> DataFrame:
    """All columns of ``slices_a``, from those of ``slices_a_narrow``."""
    k = F.col("o_orderkey")
    return numbered.select(
        k.alias("Id"),
        "TrackId",
        "SequenceNumber",
        (F.col("_seq").cast("decimal(20,0)") * F.lit(SLICE_STEP)).cast("double").alias("SequenceAt"),
        *slice_bins_a(k),
        clusters_a().alias("Clusters"),
    )


def slice_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id and bins of ``slices_a``, which need no numbering."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(k.alias("Id"), *slice_bins_a(k))


def query_bins_a(key: int) -> list[int]:
    """The bins binding A gives the slice of order ``key``."""
    return [key % (BIN_MOD_BASE + i) for i in range(len(BIN_COLS))]


def signatures_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures from customers: the 16 bytes of md5(c_name)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("int").alias("Id"),
        F.unhex(F.md5(F.col("c_name"))).alias("Signature"),
        F.col("c_custkey").cast("int").alias("TrackId"),
    )


def albums_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("int").alias("Id"),
        F.col("n_name").alias("Name"),
        (F.lit(1950) + F.col("n_regionkey")).cast("int").alias("ReleaseYear"),
    )


def tracks_with_album_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("Id"), F.col("c_nationkey").cast("int").alias("AlbumId"))
    return tracks_a(spark, sf_dir).join(c, "Id")


def doc_slices_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One MinHash slice per document: (Id = doc_id, 25 bins)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash_bins(d, "doc_id", "text").withColumnRenamed("doc_id", "Id")


def doc_tracks_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("int").alias("Id"),
        F.lit(None).cast("string").alias("ISRC"),
        F.col("source").alias("Artist"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("Title"),
        F.col("lang").alias("Album"),
        F.lit(0).alias("ReleaseYear"),
        F.col("n_chars").cast("double").alias("Length"),
    )


def _lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(
        F.col(id_col).alias("_owner"), F.posexplode(F.split(F.col(text_col), "\n")).alias("_line_no", "_line")
    )


def line_slices_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One slice per non-empty line of each document (whole texts)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    lines = d.select(
        F.col("doc_id").alias("_owner"),
        F.concat(F.col("lang"), F.lit(","), F.col("source")).alias("Clusters"),
        F.posexplode(F.split(F.col("text"), "\n")).alias("_line_no", "_line"),
    ).withColumn("_lid", F.col("_owner") * F.lit(LINE_STRIDE) + F.col("_line_no"))
    bins = minhash_bins(lines, "_lid", "_line", carry=["_owner", "_line_no", "Clusters"])
    return bins.select(
        F.col("_lid").alias("Id"),
        F.col("_owner").cast("int").alias("TrackId"),
        F.col("_line_no").cast("int").alias("SequenceNumber"),
        F.col("_line_no").cast("double").alias("SequenceAt"),
        *BIN_COLS,
        "Clusters",
    ).select(*SLICE_COLS)


def query_lines_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query clips: each non-empty line of each benchmark item ->
    (set_id = item_id, qid, 25 bins)."""
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    lines = _lines(b, "item_id", "text").withColumn("qid", F.col("_owner") * F.lit(LINE_STRIDE) + F.col("_line_no"))
    bins = minhash_bins(lines.withColumnRenamed("_owner", "set_id"), "qid", "_line", carry=["set_id"])
    return bins.select("set_id", "qid", *BIN_COLS)


def query_docs_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query items: one MinHash vector per benchmark item -> (qid, 25 bins)."""
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return minhash_bins(b, "item_id", "text").withColumnRenamed("item_id", "qid")
