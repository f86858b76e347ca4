"""K-d tree sharding of a table by its metadata, in DataFrame operations.

Rows are points: each metadata column gives a coordinate, and a row weighs
its bytes.  The table is split at the weighted median along its widest
dimension (width relative to the whole table's), and so on until a part has
the target bytes.  All parts of a level are split together: their weighted
medians come from histograms of key prefixes, refined ten bits at a time
within the bucket that holds the median, so no part is ever gathered or
sorted.  Histograms, cuts and all else that is known of a part stay in tables
(at most 1024 rows a part), which rows meet by a join on the part: broadcast
while they have at most ``BROADCAST_PARTS`` rows, shuffled beyond.  The driver
sees only the whole table's ends and size, whatever the number of parts.

A row's key along a dimension is its coordinate, then a hash of its text,
then a hash of its id: any cut is possible, however many rows share a
coordinate, and rows with equal texts stay next to each other.

Nulls: a null text has no bytes; null metadata come first; a null id is one
like any other.  Repeated rows have equal keys and may share a shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import bounded_batches

DIMENSIONS = ("lang", "source", "n_chars")
ROW_BYTES = 8
#: Rows that are numbered together, and bits of a refinement step.
NUMBERED, STEP = 20_000, 10
_COORDINATE, _TEXT, _ID = 21, 22, 20  # bits of a key: 63
#: Most parts whose table is broadcast (some 50 bytes a row), and most alike
#: rows that are written out from one array.
BROADCAST_PARTS, REPEATED = 100_000, 10_000
#: A cut within this share of a part's bytes is not refined any more.
TOLERANCE = 1e-4


def _coordinates(docs: DataFrame, dimensions: tuple[str, ...]) -> list[Column]:
    """Each dimension in [0, 1]: numbers by their range, others by a hash."""
    numeric = [c for c in dimensions if isinstance(docs.schema[c].dataType, T.NumericType)]
    ends = docs.agg(*[f(F.col(c).cast("double")).alias(f"{c}_{i}") for c in numeric for i, f in enumerate((F.min, F.max))]).first() if numeric else {}
    out = []
    for c in dimensions:
        if c in numeric:
            low, high = ends[f"{c}_0"] or 0.0, ends[f"{c}_1"] or 0.0
            value = (F.col(c).cast("double") - low) / ((high - low) or 1.0)
        else:
            value = F.when(F.col(c).isNotNull(), F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(1_000_003)) / 1_000_002)
        out.append(F.coalesce(F.when(F.isnan(value), 0.0).otherwise(value), F.lit(0.0)))
    return out


def _bits(value: Column, bits: int) -> Column:
    return F.shiftrightunsigned(value, 64 - bits)


def points(docs: DataFrame, dimensions: tuple[str, ...]) -> DataFrame:
    """(doc_id, size, text_crc32, k0, k1, ...): the keys of each row."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    tie = F.shiftleft(_bits(F.xxhash64(text), _TEXT), _ID).bitwiseOR(_bits(F.xxhash64(F.col("doc_id"), F.lit(7)), _ID))
    keys = [
        F.shiftleft((x * ((1 << _COORDINATE) - 1)).cast("long"), _TEXT + _ID).bitwiseOR(tie).alias(f"k{i}")
        for i, x in enumerate(_coordinates(docs, dimensions))
    ]
    return docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), *keys)


def _meet(rows: DataFrame, parts: DataFrame, n_parts: int) -> DataFrame:
    """``rows`` with their part's columns."""
    return rows.join(F.broadcast(parts) if n_parts <= BROADCAST_PARTS else parts, "part")


def _cuts(rows: DataFrame, parts: DataFrame, n_parts: int) -> DataFrame:
    """(part, last): the last key of the left side of each part, which gets
    ``target`` bytes of the part's ``weight``.  The bucket that holds the cut
    is found ten bits at a time, for all parts at once."""
    left, done = 63, None
    todo = parts.select("part", "weight", "target", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    while left:
        bits = min(STEP, left)
        inside = _meet(rows, todo, n_parts).filter(F.shiftright("key", left) == F.col("prefix"))
        left -= bits
        digit = F.shiftright("key", left).bitwiseAND(F.lit((1 << bits) - 1)).alias("digit")
        seen = inside.groupBy("part", "weight", "target", "prefix", "below", digit).agg(F.sum("size").alias("w"), (F.min("key") == F.max("key")).alias("one"))
        # at most 1024 rows a part
        upto = F.col("below") + F.sum("w").over(Window.partitionBy("part").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0))
        reached = seen.withColumn("upto", upto).filter(F.col("upto") >= F.col("target"))
        at = reached.groupBy("part", "weight", "target", "prefix").agg(F.min(F.struct("digit", "upto", "w", "one")).alias("at"))
        found = at.select(
            "part", "weight", "target", F.shiftleft("prefix", bits).bitwiseOR(F.col("at.digit")).alias("prefix"),
            (F.col("at.upto") - F.col("at.w")).alias("below"), F.col("at.upto").alias("upto"), F.col("at.w").alias("w"), F.col("at.one").alias("one"),
        ).checkpoint()
        stop = F.lit(left == 0) | F.col("one") | (F.col("w") <= F.lit(TOLERANCE) * F.col("weight"))
        # the bucket goes to the side that brings the cut nearer to the share
        first = F.shiftleft("prefix", left)
        last = F.when(F.col("upto") - F.col("target") < F.col("target") - F.col("below"), first.bitwiseOR(F.lit((1 << left) - 1))).otherwise(first - 1)
        ended = found.filter(stop).select("part", last.alias("last"))
        done = ended if done is None else done.unionByName(ended)
        todo = found.filter(~stop).select("part", "weight", "target", "prefix", "below")
        if todo.isEmpty():
            break
    return done


def split(rows: DataFrame, dimensions: int, target_bytes: int | None = None, shards: int | None = None) -> DataFrame:
    """``rows`` (see ``points``) with their part: parts are split until each
    has ``target_bytes``, or into ``shards`` of an equal share.

    A part is named by the first of the leaves that it becomes, so parts stay
    in order; what is known of a part stays in a table with a row for each."""
    if shards is None:
        whole = rows.agg(F.sum("size").alias("w")).first()["w"] or 0
        shards = max(1, -(-whole // target_bytes))
    keys = [f"k{i}" for i in range(dimensions)]
    placed = rows.withColumns({"part": F.lit(0).cast("long"), "leaves": F.lit(shards).cast("long")})
    ends = rows.agg(*[(F.max(k) - F.min(k)).alias(k) for k in keys]).first()
    widest = [max(ends[k] or 0, 1) for k in keys]
    most, n_parts = shards, 1
    while most > 1:
        measures = [((F.max(k) - F.min(k)) / F.lit(w)).alias(k) for k, w in zip(keys, widest)]
        parts = placed.filter("leaves > 1").groupBy("part", "leaves").agg(F.sum("size").alias("weight"), *measures)
        small = F.floor(F.col("leaves") / 2).cast("long")
        parts = parts.select(
            "part", "weight", (F.col("weight") * small / F.col("leaves")).alias("target"),
            (F.array_position(F.array(*keys), F.array_max(F.array(*keys))) - 1).cast("int").alias("dimension"),
        ).checkpoint()
        keyed = _meet(placed, parts.select("part", "dimension"), n_parts).select("part", "size", F.get(F.array(*keys), F.col("dimension")).alias("key"))
        cuts = _cuts(keyed, parts, n_parts).join(parts.select("part", "dimension"), "part")
        cuts = F.broadcast(cuts) if n_parts <= BROADCAST_PARTS else cuts
        # a part that is a leaf already has no cut
        upper = F.coalesce(F.get(F.array(*keys), F.col("dimension")) > F.col("last"), F.lit(False))
        sides = F.when(F.col("leaves") == 1, 1).when(upper, F.col("leaves") - small).otherwise(small)
        placed = placed.join(cuts, "part", "left").select(*rows.columns, (F.col("part") + F.when(upper, small).otherwise(0)).alias("part"), sides.alias("leaves")).checkpoint()
        most, n_parts = most - most // 2, min(2 * n_parts, shards)
    return placed.select(*rows.columns, F.col("part").cast("int").alias("part"))


def shard(docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, target_bytes: int | None = None, shards: int | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, text_crc32, shard and
    slot (gapless from 0 in each shard, by a hash of the id).

    Parts are halved in proportion to the leaves they become; sizes are then
    near equal.  An empty table gives no rows."""
    bounded_batches(docs.sparkSession)
    parts = split(points(docs, dimensions).checkpoint(), len(dimensions), target_bytes, shards)
    # rows alike in all that is returned are numbered as one
    alike = parts.groupBy(F.col("part").alias("shard"), "doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("times"))
    most = alike.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    # slots: rows are numbered in groups of bounded size, which follow one another
    group = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(max(16, -(-most // NUMBERED)))).alias("bucket")
    grouped = alike.select("*", group)
    counts = grouped.groupBy("shard", "bucket").agg(F.sum("times").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    numbered = grouped.withColumn("number", F.coalesce(F.sum("times").over(own), F.lit(0)))
    slot = numbered.join(starts, ["shard", "bucket"]).withColumn("slot", F.col("start") + F.col("number"))
    # alike rows again one by one, at most REPEATED in one array
    runs = slot.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(REPEATED).cast("long"))))
    end = F.least(F.col("run") + REPEATED, "times") - 1
    return runs.select("doc_id", "size", "text_crc32", "shard", F.explode(F.sequence(F.col("slot") + F.col("run"), F.col("slot") + end)).alias("slot"))
