"""Filter interaction audit by truth-table survival words.

Five filters give a document five failure bits.  Its *survival word* has one
bit for each of the 32 subsets of the filters, set if the document passes all
filters of the subset.  How many documents survive each subset is then the
positional popcount of the words, taken with carry-save adders: the words are
turned into 32 bit planes, three planes of one weight become one of that
weight and one of the next, and only the few planes left are counted.  All
figures of all orders of the filters follow from these 32 counts, for each
part and label class; no order is ever run.

A document that repeats an earlier one is told by the digest (SHA-256) of its
text: the smallest doc_id of each digest is found by one grouping, and a
document passes if (digest, doc_id) is among these.  Rows alike in all of this are
counted before any join, so its keys hardly repeat, however many copies a text
or a row has.

Nulls: a null text is empty, a null part an empty string; a document without
doc_id has no labels, repeats none and is repeated by none.  Of repeated
label rows one with the value is enough.  Repeated rows of ``documents`` are
documents of their own (they have the same doc_id, so neither repeats the
other).  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import bounded_batches, slices, utf8

#: The filters, by letter; bit i of a failure mask belongs to letter i.
LETTERS = "ABCDE"
#: Text bytes whose words are held at once while distinct words are counted.
PIECE = 1 << 20
#: Parts whose counts a task holds before it passes them on.
HELD_PARTS = 10_000

_UPPER = bytes(range(65, 91))
_SYMBOLS = b"#$%&*|"
_FOLLOWS = bytes(range(0x80, 0xC0))  # bytes that do not begin a code point


def text_failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails.  Its words are taken
    piece by piece, so only the distinct ones are held."""
    n, seen, tail = 0, set(), b""
    for at in range(0, len(text), PIECE):
        piece = tail + text[at : at + PIECE]
        words, tail = piece.split(), b""
        if at + PIECE < len(text) and words and not piece[-1:].isspace():
            tail = words.pop()  # it may go on in the next piece
        n += len(words)
        seen.update(words)
    points = len(text) - _count(text, _FOLLOWS)
    return (n < 200) | (100 * len(seen) < 50 * n) << 1 | (100 * _count(text, _UPPER) > 3 * points) << 2 | (_count(text, _SYMBOLS) > 0) << 3


def _count(text: bytes, of: bytes) -> int:
    return len(text) - len(text.translate(None, of))


def _failures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        masks = [text_failures(t) if t else text_failures(b"") for t in batch.column("text").to_pylist()]
        keep = [i for i, c in enumerate(batch.schema.names) if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(masks, pa.int32())], names=[*(batch.schema.names[i] for i in keep), "mask"])


def survival_words(masks: np.ndarray) -> np.ndarray:
    """The 32-bit word of each failure mask: bit s is set if no filter of the
    subset s (as a mask) is failed."""
    subsets = np.arange(32)
    table = ((subsets[None, :] & subsets[:, None]) == 0) @ (np.uint64(1) << subsets.astype(np.uint64))
    return table.astype(np.uint32)[masks]


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many words have each of the 32 bits: the words become bit planes,
    a row for each bit and a column for each 64 words."""
    full = np.zeros(-(-len(words) // 64) * 64, np.uint32)
    full[: len(words)] = words
    bits = np.unpackbits(full.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return _plane_counts(np.ascontiguousarray(np.packbits(bits.T, axis=1)).view(np.uint64))


def _plane_counts(planes: np.ndarray) -> np.ndarray:
    """Set bits of each row.  Carry-save: three columns become their sum, of
    the same weight, and their carry, of twice the weight."""
    k = planes.shape[1] // 3
    if not k:
        return np.bitwise_count(planes).sum(axis=1, dtype=np.int64)
    a, b, c = planes[:, :k], planes[:, k : 2 * k], planes[:, 2 * k : 3 * k]
    half = a ^ b
    return _plane_counts(np.concatenate((half ^ c, planes[:, 3 * k :]), axis=1)) + 2 * _plane_counts((a & b) | (half & c))


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, good, toxic, survivors): the 32 counts of this task's documents."""

    def out():
        part, good, toxic = zip(*total)
        counts = pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(good, pa.int32()), pa.array(toxic, pa.int32()), counts], names=["part", "good", "toxic", "survivors"])
        total.clear()

    total: dict[tuple[str, int, int], np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        words, times = survival_words(batch.column("mask").to_numpy()), batch.column("n").to_numpy()
        part = batch.column("part").dictionary_encode()
        names, code, label = part.dictionary.to_pylist(), part.indices.to_numpy(), batch.column("label").to_numpy()
        key = code.astype(np.int64) * 4 + label
        order = np.argsort(key, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            bits = int(label[own[0]])
            of = names[code[own[0]]], bits & 1, bits >> 1
            n = times[own]
            for k in range(int(n.max()).bit_length()):  # rows that stand for many, by the bits of their number
                total[of] = total.get(of, 0) + (positional_popcount(words[own[n >> k & 1 == 1]]) << k)
        if len(total) > HELD_PARTS:
            yield from out()
    if total:
        yield from out()


def failures(docs: DataFrame, part: str = "lang") -> DataFrame:
    """doc_id, part, mask with the bits of all five filters that a document
    fails, and n, the number of such rows of ``docs`` with one text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(utf8("text"), F.lit(b""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    # narrow rows, read twice below: the texts are scanned once
    judged = rows.mapInArrow(_failures, "doc_id long, part string, digest binary, mask int")
    seen = judged.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    known = seen.filter(F.col("doc_id").isNotNull())
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    told = known.join(first, ["digest", "doc_id"], "left")
    repeats = F.when(F.col("first").isNull(), 1 << LETTERS.index("E")).otherwise(0)
    return told.select("doc_id", "part", F.col("mask").bitwiseOR(repeats).alias("mask"), "n").unionByName(seen.filter(F.col("doc_id").isNull()).drop("digest"))


def subset_survivors(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, all, good, toxic): for each part how many of its documents, of
    its good and of its toxic ones survive each subset (arrays of 32)."""
    has = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    bits = has.agg((F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)) + 2 * F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0))).alias("label"))
    known = masks.filter(F.col("doc_id").isNotNull()).join(bits.filter("label > 0"), "doc_id", "left")
    rows = known.select("part", "mask", "n", F.coalesce("label", F.lit(0)).cast("int").alias("label"))
    rows = rows.unionByName(masks.filter(F.col("doc_id").isNull()).select("part", "mask", "n", F.lit(0).alias("label")))
    counts = rows.mapInArrow(_survivors, "part string, good int, toxic int, survivors array<long>")

    def summed(times: Column) -> Column:
        return F.array(*[F.sum(F.col("survivors")[s] * times) for s in range(32)])

    return counts.groupBy("part").agg(summed(F.lit(1)).alias("all"), summed(F.col("good")).alias("good"), summed(F.col("toxic")).alias("toxic"))


def orders() -> list[str]:
    """All orders of the letters."""
    from itertools import permutations

    return ["".join(p) for p in permutations(LETTERS)]


def audit(survivors: DataFrame) -> DataFrame:
    """The figures of every step of every order, from the subset survivors:
    part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost and shapley."""
    each = survivors.select("*", F.explode(F.split(F.lit(",".join(orders())), ",")).alias("filter_order"))
    each = each.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step"))
    letters = F.split("filter_order", "")
    before = F.aggregate(F.slice(letters, 1, F.col("step") - 1), F.lit(0), lambda m, x: m.bitwiseOR(_bit(x)))
    each = each.select("*", before.alias("_before"), _bit(F.substring(F.col("filter_order"), F.col("step"), F.lit(1))).alias("_own"))
    every = (1 << len(LETTERS)) - 1

    def left(of: str, subset) -> Column:
        return F.get(F.col(of), subset)

    after = F.col("_before").bitwiseOR(F.col("_own"))

    def lost(of: str) -> Column:
        return left(of, F.col("_before")) - left(of, after)

    failing = left("all", F.lit(0)) - left("all", F.col("_own"))
    out = each.select(
        "part", "filter_order", "step", "_own", left("all", after).alias("kept"), lost("all").alias("removed"), (failing - lost("all")).alias("redundant"),
        (left("all", F.lit(every) - F.col("_own")) - left("all", F.lit(every))).alias("unique_fails"), lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"),
    )
    # 120 rows a part and filter
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "_own"))).drop("_own")


def _bit(letter: Column) -> Column:
    """The mask of a filter's letter."""
    return F.call_function("shiftleft", F.lit(1), F.ascii(letter) - ord(LETTERS[0]))


def filter_interactions(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The audit of the five filters over whole ``docs``, a row for each part,
    order and step."""
    return audit(subset_survivors(failures(docs, part), labels))
