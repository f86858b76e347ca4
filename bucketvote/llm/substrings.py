"""Substring dedup: windows of words that occur more than once are removed.

Every window of ``width`` words gets a Rabin-Karp hash (64 bits, over mixed
64-bit word hashes; all windows of a few MB of text at a time).  Windows are
dealt to buckets by a second, independent hash, packed with compressed
positions (about ten bytes for each window), and counted in Spark: a bucket holds about
``BUCKET_WINDOWS`` hashes whatever the size of the input, since the number of
buckets follows the text bytes.  Within a slice of text, equal windows are
found at once and only one of them travels, so a window with very many
copies reaches its bucket at most once for each slice.  Repeated windows
return to their documents and merge into maximal removal intervals.

Two different windows are taken for one if they share the hash and the bucket:
with probability 2**-64 divided by the number of buckets, which grows with the
input (2**-86 at 100 TB, where 10**13 windows give 0.4 such pairs), or, within
one slice of text, 2**-64.  No further check follows.

On its way back a document is known by its doc_id and a 64-bit hash of its
text (without doc_id by two such hashes), and its places are dealt by both, so
texts that share an id, or have none, go to different tasks.  Rows that repeat
id and text are one document there: a slice and a bucket report each of its
places once, and the gathering task holds each place once.

Nulls: a null text has no words; rows without doc_id are documents by their
text.  Repeated rows are copies of one another: their windows are repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Roller, bounded_batches, flat_bytes, mix, sealed, slices, unsealed, utf8, word_spans

WINDOW = 35
BUCKET_WINDOWS = 2_500_000
SLICE = 5 << 20
#: Places held before repeated ones are dropped.
GATHERED = 2_000_000
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
#: Base and word mask of the hash that deals windows to buckets.
_DEAL_BASE, _DEAL_MASK = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


def _squeeze(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unsqueeze(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1]))) if len(sorted_values) else np.zeros(0, np.int64)


_PLACES = "target int, docs binary, checks binary, counts binary, places binary"
_SHAPE = f"{_PLACES}, hashes binary"


def _pack(target: int, doc, place, ids, checks) -> tuple:
    """Places in documents as one row; ``doc`` indexes ids and checks and is
    sorted, and so are the places of each document."""
    at = _runs(doc)
    step = np.diff(place, prepend=0)
    step[at] = place[at]  # places restart with each document
    counts = np.diff(at, append=len(doc))
    return target, _squeeze(ids[doc[at]]), _squeeze(checks[doc[at]]), _squeeze(counts.astype("<u4")), _squeeze(step.astype("<u4"))


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, checks, which of them each place is in, places)."""
    ids, checks = _unsqueeze(row["docs"], "<i8"), _unsqueeze(row["checks"], "<i8")
    counts, step = _unsqueeze(row["counts"], "<u4").astype(np.int64), _unsqueeze(row["places"], "<u4").astype(np.int64)
    total, start = np.cumsum(step), np.cumsum(counts) - counts
    return ids, checks, np.repeat(np.arange(len(ids)), counts), total - np.repeat(total[start] - step[start], counts)


def _dealt(doc, place, ids, checks, targets: int) -> Iterator[tuple]:
    """Packed rows by target, which a document's id and check decide; places
    of documents that are equal in both are there once."""
    to = (mix(ids.astype(np.uint64) ^ mix(checks.astype(np.uint64))) % np.uint64(targets)).astype(np.int64)[doc]
    order = np.lexsort((checks, ids))
    new = np.concatenate(([True], (np.diff(ids[order]) != 0) | (np.diff(checks[order]) != 0)))[: len(order)]
    first = np.empty(len(order), np.int64)
    first[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    doc = first[doc]
    order = np.lexsort((place, doc, to))
    order = order[np.concatenate(([True], (np.diff(doc[order]) != 0) | (np.diff(place[order]) != 0)))[: len(order)]]
    to, doc, place = to[order], doc[order], place[order]
    at = [*_runs(to).tolist(), len(to)]
    for a, b in zip(at, at[1:]):
        yield _pack(int(to[a]), doc[a:b], place[a:b], ids, checks)


def _batches(rows: list[tuple], shape: str) -> Iterator[pa.RecordBatch]:
    fields = [x.split() for x in shape.split(", ")]
    for i in range(0, len(rows), 256):
        columns = zip(*rows[i : i + 256])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == "int" else pa.binary()) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _hashed(width: int, buckets: int):
    """Rows of windows by bucket: their hashes, and twice their places, plus
    one where the slice has the window several times; for those, a row (by
    document, without hashes) has all places."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_byte, by_word, by_deal = Roller(_BYTE_BASE), Roller(_WORD_BASE), Roller(_DEAL_BASE)
        for batch in slices(batches, limit=SLICE):
            data, starts = flat_bytes(batch.column("text"))
            begin, end, first = word_spans(data, starts)
            word = mix(by_byte.spans(data.astype(np.uint64) + np.uint64(1), begin, end))
            doc_of = np.repeat(np.arange(batch.num_rows), np.diff(first))
            n = len(word) - width + 1
            if n <= 0:
                continue
            at = np.flatnonzero(doc_of[:n] == doc_of[width - 1 :])
            value = mix(by_word.spans(word, at, at + width))
            doc, place = doc_of[at], at - first[doc_of[at]]
            ids = batch.column("dk").to_numpy(zero_copy_only=False).astype("<i8")
            checks = batch.column("check").to_numpy(zero_copy_only=False).astype("<i8")
            order = np.argsort(value, kind="stable")
            run = _runs(value[order])
            size = np.diff(run, append=len(order))
            several = np.zeros(len(order), bool)
            several[order] = np.repeat(size > 1, size)
            rows = [(*r, None) for r in _dealt(doc[several], place[several], ids, checks, buckets)]
            alone = np.zeros(len(order), bool)
            alone[order[run]] = True  # one of each
            alone = np.flatnonzero(alone)
            own = mix(by_deal.spans(mix(word ^ np.uint64(_DEAL_MASK)), at[alone], at[alone] + width))
            target = ((own >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            by_target = np.argsort(target, kind="stable")
            cut = np.searchsorted(target[by_target], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cut)).tolist():
                own = alone[by_target[cut[b] : cut[b + 1]]]
                rows.append((*_pack(b, doc[own], place[own] * 2 + several[own], ids, checks), value[own].tobytes()))
            yield from _batches(rows, _SHAPE)

    return of


def _found(buckets: int):
    """Places of the repeated windows of one bucket, dealt by document."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        docs = 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["hashes"] is None:
                    yield from _batches([tuple(row[x.split()[0]] for x in _PLACES.split(", "))], _PLACES)
                    continue
                ids, checks, doc, place = _unpack(row)
                held.append([ids, checks, (doc + docs).astype(np.int32), place.astype(np.uint32), np.frombuffer(row["hashes"], "<u8")])
                docs += len(ids)
        if not held:
            return
        ids, checks, doc, place, value = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order = np.argsort(value, kind="stable")
        run = _runs(value[order])
        size = np.diff(run, append=len(order))
        hit = np.zeros(len(order), bool)
        hit[order] = np.repeat(size > 1, size)
        hit &= (place & 1) == 0  # else its slice has reported it
        yield from _batches(list(_dealt(doc[hit], (place[hit] >> 1).astype(np.int64), ids, checks, buckets)), _PLACES)

    return of


def _distinct(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (id, check, place), sorted; empties ``held``."""
    ids, checks, place = (np.concatenate(x) for x in zip(*held))
    held.clear()
    order = np.lexsort((place, checks, ids))
    ids, checks, place = ids[order], checks[order], place[order]
    new = np.concatenate(([True], (ids[1:] != ids[:-1]) | (checks[1:] != checks[:-1]) | (place[1:] != place[:-1])))[: len(ids)]
    return ids[new], checks[new], place[new]


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document with repeated windows: all their places."""
    held, n, most = [], 0, GATHERED
    for batch in batches:
        for row in batch.to_pylist():
            ids, checks, doc, place = _unpack(row)
            held.append((ids[doc], checks[doc], place.astype("<i4")))
            n += len(doc)
            if n > most:  # what came more than once is held once
                held = [_distinct(held)]
                n = len(held[0][0])
                most = 2 * n + GATHERED
    if not held:
        return
    ids, checks, place = _distinct(held)
    at = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (checks[1:] != checks[:-1]))))
    offsets = np.concatenate((at, [len(ids)])).astype("<i4") * 4
    blobs = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(place.tobytes())])
    for i in range(0, len(at), 1000):
        own = at[i : i + 1000]
        yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(checks[own]), blobs.slice(i, 1000)], names=["dk", "check", "places"])


def _cut(width: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_llm_text"):
            rest = [i for i, c in enumerate(batch.schema.names) if c not in ("_llm_text", "_llm_places")]
            words, removed, spans, kept = [], [], [], []
            for text, places in zip(batch.column("_llm_text").to_pylist(), batch.column("_llm_places").to_pylist()):
                own = text.split() if text else []
                words.append(len(own))
                if not places:
                    removed.append(0)
                    spans.append([])
                    kept.append(b" ".join(own))
                    continue
                edge = np.zeros(len(own) + 1, np.int32)
                at = np.unique(np.frombuffer(places, "<i4"))
                np.add.at(edge, at, 1)
                np.add.at(edge, at + width, -1)
                gone = np.cumsum(edge[:-1]) > 0
                flips = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                removed.append(int(gone.sum()))
                spans.append([{"first": int(a), "words": int(b - a)} for a, b in zip(flips[::2], flips[1::2])])
                kept.append(b" ".join([own[i] for i in np.flatnonzero(~gone).tolist()]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in rest), pa.array(words, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32())]))),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=[*(batch.schema.names[i] for i in rest), "n_words", "n_removed", "removed", "kept"],
            )

    return of


def repeated_substrings(docs: DataFrame, width: int = WINDOW, carry: list[str] | None = None) -> DataFrame:
    """One row for each row of ``docs``: the ``carry`` columns (doc_id unless
    named), n_words, n_removed, removed (maximal intervals: first word and
    length), kept (the remaining words, joined by one space).

    A word goes if a window of ``width`` words over it has a word sequence
    that also starts anywhere else in the table.  An empty table gives none.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    carry = ["doc_id"] if carry is None else carry
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(spark.sparkContext.defaultParallelism, -(-size // (6 * BUCKET_WINDOWS)))
    dk = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit(1), "text"))
    check = F.xxhash64(F.col("doc_id").isNull(), "text")
    rows = docs.select(dk.alias("dk"), check.alias("check"), utf8("text").alias("text")).mapInArrow(_hashed(width, buckets), _SHAPE)
    # one bucket to a partition: its rows meet in one task of bounded size; then one row a document
    places = (
        rows.repartitionById(buckets, F.col("target"))
        .mapInArrow(_found(buckets), _PLACES)
        .repartitionById(buckets, F.col("target"))
        .mapInArrow(_by_document, "dk long, check long, places binary")
    )
    keyed = docs.select(*carry, utf8("text").alias("_llm_text"), dk.alias("_llm_dk"), check.alias("_llm_check"))
    joined = keyed.join(
        places.select(F.col("dk").alias("_llm_dk"), F.col("check").alias("_llm_check"), F.col("places").alias("_llm_places")), ["_llm_dk", "_llm_check"], "left"
    ).drop("_llm_dk", "_llm_check")
    shape = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema), "n_words long, n_removed long, removed array<struct<first:int,words:int>>, kept string"])
    return joined.mapInArrow(_cut(width), shape)


def without_repeats(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` with repeated substrings removed from ``text``; a text that
    loses nothing is unchanged, any other becomes its kept words joined by one
    space.  ``n_chars``, if there is one, follows the text."""
    wide, names = sealed(docs, "doc_id", "text")
    found = repeated_substrings(wide, width, names)
    cut = F.col("n_removed") > 0
    text = F.col(names[docs.columns.index("text")])
    changed = {"text": F.when(cut, F.col("kept")).otherwise(text)}
    if "n_chars" in docs.columns:
        own = F.col(names[docs.columns.index("n_chars")])
        changed["n_chars"] = F.when(cut, F.char_length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(own)
    return unsealed(found, docs, **changed)
