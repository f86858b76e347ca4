"""Posting rows kept where a vote join needs them.

``write_postings`` explodes a store once: a row for each slice and position,
with its bins and signature, bucketed and sorted on one key made of position,
bin and cell, and partitioned by position.  ``vote_join_postings`` then answers any number of
query batches that are too large to broadcast: only the queries are shuffled,
to the buckets, and the store is read where it lies, its chosen positions
only.

A (position, bin) with more store rows than ``skew_factor`` times the mean of
a bucket is cut into cells by a hash of the slice, so no bucket holds a hot
key whole; a query row is copied to the cells of its key.  These keys number
at most buckets / ``skew_factor`` a position, and lie in a small table beside.

The table is a Spark table over a folder, so its layout is known to any
session that has the catalog; ``open_postings`` names it in a session that has
not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bins import effective_threshold
from ..schema import N_BINS
from ..session import ensure_checkpoint_dir
from .batch import Q, S, VOTES, _by_position, _explode, _key_counts, _keys, _scored, least_work


def _key() -> Column:
    """(cell, pos, bin) as one long: the join has one key, which is the buckets'."""
    cell, pos = F.shiftleft(F.col("cell").cast("long"), 37), F.shiftleft(F.col("pos").cast("long"), 32)
    return cell.bitwiseOR(pos).bitwiseOR(F.col("bin").cast("long") + F.lit(1 << 31))


def write_postings(slices: DataFrame, table: str, path: str, buckets: int, skew_factor: float = 2.0, keep: list[str] | None = None) -> None:
    """Write the posting rows of ``slices`` (Id, 25 bins and the columns
    ``keep``) as the Spark table ``table`` under ``path``."""
    spark = slices.sparkSession
    ensure_checkpoint_dir(spark)
    counts = _key_counts(_keys(slices), "n").checkpoint()
    most = F.greatest(slices.select((F.count(F.lit(1)) * skew_factor / buckets).alias("m")).scalar(), F.lit(1.0))
    hot = counts.filter(F.col("n") > most).select("pos", "bin", F.ceil(F.col("n") / most).alias("cells"))
    hot.write.parquet(f"{path}/hot")
    counts.write.parquet(f"{path}/counts")
    rows = _explode(slices, "Id", list(range(N_BINS)), S, list(keep or []))
    cells = F.coalesce(F.col("cells"), F.lit(1))
    rows = rows.join(F.broadcast(spark.read.parquet(f"{path}/hot")), ["pos", "bin"], "left").withColumn("cell", F.pmod(F.xxhash64(S + "id"), cells)).withColumn("key", _key()).drop("cells", "cell", "bin")
    # one file a bucket and position, not one for each task as well
    rows.repartition(buckets, "key").write.partitionBy("pos").bucketBy(buckets, "key").sortBy("key").option("path", f"{path}/rows").saveAsTable(table)


def open_postings(spark: SparkSession, table: str, path: str, buckets: int) -> None:
    """Name posting rows that another session wrote."""
    schema = spark.read.parquet(f"{path}/rows").schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"create table if not exists {table} ({columns}) using parquet partitioned by (pos) clustered by (key) sorted by (key) into {buckets} buckets location '{path}/rows'")
    spark.sql(f"msck repair table {table}")


def vote_join_postings(queries: DataFrame, table: str, path: str, threshold: int | None, query_id: str = "qid", keep: list[str] | None = None) -> DataFrame:
    """(query id, Id, votes and the columns ``keep`` of the store): all pairs
    with at least T agreeing positions, as ``batch.vote_join`` gives them."""
    spark, keep, t = queries.sparkSession, list(keep or []), effective_threshold(threshold)
    out = [F.col(Q + "id").alias(query_id), F.col(S + "id").alias("Id"), F.col(VOTES), *[F.col(S + c).alias(c) for c in keep]]
    t_known = t is not None and t <= N_BINS
    work = spark.read.parquet(f"{path}/counts").join(_key_counts(_keys(queries), "m"), ["pos", "bin"])
    positions = least_work(_by_position(work, F.col("n").cast("double") * F.col("m"), F.col("n"))[0], t) if t_known else [0]
    sides = _explode(queries, query_id, positions, Q, []).join(F.broadcast(spark.read.parquet(f"{path}/hot")), ["pos", "bin"], "left")
    sides = sides.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("cells"), F.lit(1)) - 1))).withColumn("key", _key()).drop("cells", "cell", "bin", "pos")
    found = spark.table(table).filter(F.col("pos").isin(positions)).join(sides.hint("merge"), "key")
    if not t_known:
        return found.withColumn(VOTES, F.lit(0)).select(*out).filter(F.lit(False))
    return _scored(found, t, positions).select(*out)

