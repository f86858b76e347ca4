"""SimHash near-duplicates by tiled exact comparison.

A document's fingerprint has a bit set where over half of its word-shingle
hashes have it.  Equal fingerprints collapse to one row first, so a group of
copies of any size costs one fingerprint.  Distinct fingerprints are cut into
tiles by the population counts of their two halves; two tiles are compared
only when those counts can be within the radius (the distance of two
fingerprints is at least the sum of the count differences of their halves).
A pair of tiles is compared completely, with numpy exclusive-or and bit
counts, and reports a spanning forest of its links, never all pairs: the
links of a group of n near copies stay below n for each pair of tiles.

The comparison is exact and therefore grows with the square of the number of
distinct fingerprints; the pair tasks are independent and of bounded size.

Nulls: a null text is an empty one (fingerprint zero).  A null doc_id is
kept; it is never a component's id while another member has one.  Repeated
rows stay repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .text import LOWER, bounded_batches, sealed, slices, unsealed, utf8

TILE = 16384
#: Text bytes fingerprinted at a time; each needs some thirty bytes of arrays.
SLICE = 2 << 20


def _fingerprints(width: int, seed: int):
    digest = xxhash.xxh64_intdigest

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            hashes, ends = [], []
            for text in batch.column("text").to_pylist():
                words = text.translate(LOWER).split() if text else ()
                if len(words) >= width:
                    joined, at = b" ".join(words), 0
                    begin = [0]
                    for w in words:
                        at += len(w) + 1
                        begin.append(at)
                    hashes += [digest(joined[i : j - 1], seed) for i, j in zip(begin, begin[width:])]
                elif words:
                    hashes.append(digest(b" ".join(words), seed))
                ends.append(len(hashes))
            end = np.array(ends, np.int64)
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            n = np.diff(end, prepend=0)
            has = n > 0
            ones = np.zeros((len(n), 64), np.int64)
            if has.any():
                ones[has] = np.add.reduceat(bits, (end - n)[has], axis=0, dtype=np.int64)
            word = np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)
            others = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(word.view("<i8"))], names=[*others, "fp"])

    return of


def fingerprints(docs: DataFrame, shingle_words: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp) for each row; fp holds the 64 bits as a signed long."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    return texts.mapInArrow(_fingerprints(shingle_words, seed), "doc_id long, fp long")


def _forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Index pairs within ``radius`` that connect all linked members of a
    (and b); with b None, of a alone.  Indexes of b follow those of a."""
    every = a if b is None else np.concatenate((a, b))
    label = np.arange(len(every))
    offset = 0 if b is None else len(a)
    other = a if b is None else b
    links, gap, far = [], np.empty(len(other), np.uint64), np.empty(len(other), np.uint8)
    for i in range(len(a)):
        first = i + 1 if b is None else 0
        m = len(other) - first
        if not m:
            continue
        np.bitwise_xor(other[first:], a[i], out=gap[:m])
        np.bitwise_count(gap[:m], out=far[:m])
        if far[:m].min() > radius:
            continue
        near = np.flatnonzero(far[:m] <= radius) + first + offset
        roots, at = np.unique(label[near], return_index=True)
        for root, j in zip(roots.tolist(), near[at].tolist()):
            if root != label[i]:
                links.append((i, j))
                label[label == root] = label[i]
    return links


def _compare(radius: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            for x, y in zip(left, right):
                a = np.frombuffer(x, "<i8").view("<u8")
                b = None if y is None else np.frombuffer(y, "<i8").view("<u8")
                both = (a if b is None else np.concatenate((a, b))).view("<i8")
                pairs = np.array(_forest(a, b, radius), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(both[pairs[:, 0]]), pa.array(both[pairs[:, 1]])], names=["u", "v"])

    return of


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A tile's list of longs as one binary value."""
    for batch in batches:
        blobs = [np.array(x, "<i8").tobytes() for x in batch.column("fps").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("hi", "lo", "sub")), pa.array(blobs, pa.binary())], names=["hi", "lo", "sub", "fps"])


def links(fps: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """(u, v): fingerprints that connect every linked group among the
    distinct longs in ``fps.fp``."""
    spark = fps.sparkSession
    half = F.lit(0xFFFFFFFF)
    classed = fps.select(
        "fp",
        F.bit_count(F.shiftrightunsigned("fp", 32)).alias("hi"),
        F.bit_count(F.col("fp").bitwiseAND(half)).alias("lo"),
    )
    # at most 33 x 33 classes, whatever the size of the table
    sizes = {(r["hi"], r["lo"]): r["count"] for r in classed.groupBy("hi", "lo").count().collect()}
    subs = {k: -(-n // tile) for k, n in sizes.items()}
    if not subs:
        return spark.createDataFrame([], "u long, v long")
    per = F.create_map(*[F.lit(x) for (h, l), n in sorted(subs.items()) for x in (h * 64 + l, n)])
    tiles = (
        classed.withColumn("sub", F.pmod(F.xxhash64("fp"), per[F.col("hi") * 64 + F.col("lo")]).cast("int"))
        .groupBy("hi", "lo", "sub")
        .agg(F.collect_list("fp").alias("fps"))  # about `tile` longs
        .mapInArrow(_pack, "hi int, lo int, sub int, fps binary")
        .checkpoint()
    )
    # Each tile's partners: itself and later tiles whose halves' counts are near.
    key = F.struct("hi", "lo", "sub")
    near = [(h, l) for h in range(-radius, radius + 1) for l in range(-radius, radius + 1) if abs(h) + abs(l) <= radius]
    classes = F.filter(
        F.array(*[F.struct((F.col("hi") + h).alias("hi"), (F.col("lo") + l).alias("lo")) for h, l in near]),
        lambda c: F.array_contains(F.array(*[F.lit(h * 64 + l) for h, l in sorted(subs)]), c["hi"] * 64 + c["lo"]),
    )
    partner = F.flatten(
        F.transform(
            classes,
            lambda c: F.transform(
                F.sequence(F.lit(0), (per[c["hi"] * 64 + c["lo"]] - 1).cast("int")),
                lambda s: F.struct(c["hi"].alias("hi"), c["lo"].alias("lo"), s.alias("sub")),
            ),
        )
    )
    paired = tiles.withColumn("me", key).withColumn("other", F.explode(partner))
    first = paired.filter(F.col("me") < F.col("other")).select(F.col("me").alias("p"), F.col("other").alias("q"), F.col("fps").alias("a"))
    second = paired.filter(F.col("me") > F.col("other")).select(F.col("other").alias("p"), F.col("me").alias("q"), F.col("fps").alias("b"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    crossed = first.repartition(parts, "p", "q").join(second.repartition(parts, "p", "q"), ["p", "q"]).select("a", "b")
    alone = tiles.select(F.col("fps").alias("a"), F.lit(None).cast("binary").alias("b"))
    return crossed.unionByName(alone.repartition(parts)).mapInArrow(_compare(radius), "u long, v long")


def _rooted(fps: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """(node, root) of the linked ones among the distinct ``fps.fp``."""
    return components(links(fps.select("fp"), radius, tile))


def near_duplicates(docs: DataFrame, shingle_words: int = 4, radius: int = 4, seed: int = 42, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``.

    component_id is the smallest doc_id among all documents reachable over
    links of at most ``radius`` differing bits.  An empty table gives none.
    """
    prints = fingerprints(docs, shingle_words, seed).checkpoint()
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).checkpoint()
    rooted = _rooted(least, radius, tile)
    # a component's smallest doc_id, then each fingerprint's component
    named = rooted.join(least, F.col("node") == F.col("fp"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = least.join(rooted, F.col("fp") == F.col("node"), "left").join(ids, "root", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id")
    )
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle_words: int = 4, radius: int = 4) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest
    doc_id (and the smallest text hash among its rows in the group; of equal
    rows, any); in a group where no row has a doc_id, the one with the smallest
    text hash.  Of rows left that share a doc_id, the smallest text stays."""
    bounded_batches(docs.sparkSession)
    wide, names = sealed(docs)
    doc_id, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    keys = {"_key_id": doc_id.cast("long"), "_key_text": F.xxhash64(text)}
    texts = wide.select(*[c.alias(k) for k, c in keys.items()], utf8(text).alias("text"))
    prints = texts.mapInArrow(_fingerprints(shingle_words, 42), "_key_id long, _key_text long, fp long").checkpoint()
    # a group's first row by (doc_id, text hash); nulls come last
    first = F.min(F.struct(F.col("_key_id").isNull(), "_key_id", "_key_text")).alias("first")
    least = prints.groupBy("fp").agg(first).checkpoint()
    group = least.join(_rooted(least, radius), F.col("fp") == F.col("node"), "left").groupBy(F.coalesce("root", "fp").alias("group"))
    chosen = group.agg(F.min("first").alias("first")).select(F.col("first._key_id").alias("_first_id"), F.col("first._key_text").alias("_first_text")).checkpoint()
    keyed = wide.withColumns(keys)
    kept = keyed.join(chosen, F.col("_key_id").eqNullSafe(F.col("_first_id")) & (F.col("_key_text") == F.col("_first_text")), "left_semi")
    # without doc_id, rows are known by their text
    own = [F.col("_key_id"), F.when(F.col("_key_id").isNull(), F.col("_key_text")).alias("_key_alone")]
    chosen_rows = prints.join(chosen, F.col("_key_id").eqNullSafe(F.col("_first_id")) & (F.col("_key_text") == F.col("_first_text")), "left_semi")
    repeated = chosen_rows.groupBy(*own).count().filter("count > 1").drop("count").checkpoint()
    if repeated.isEmpty():
        return unsealed(kept, docs)
    repeated = repeated.select(F.col("_key_id").alias("_again_id"), F.col("_key_alone").alias("_again_alone"))
    kept = kept.withColumn("_key_alone", own[1])
    again = F.col("_key_id").eqNullSafe(F.col("_again_id")) & F.col("_key_alone").eqNullSafe(F.col("_again_alone"))
    once = kept.join(repeated, again, "left_semi").groupBy("_key_id", "_key_alone").agg(
        F.min_by(F.struct(*names), F.struct(F.coalesce(text, F.lit("")))).alias("row")
    )
    return unsealed(kept.join(repeated, again, "left_anti").select(*names).unionByName(once.select("row.*")), docs)
