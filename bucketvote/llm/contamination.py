"""Benchmark decontamination by a broadcast set of test n-grams.

Test items are normalised to words (ASCII lower case; runs of ASCII letters,
digits and any non-ASCII characters).  Their windows go into a hash set that
is broadcast; training texts are scanned window by window, hash hits are
verified word by word, and every word inside an occurrence is a hit.

The set is broadcast in blocks of about ``BLOCK_WORDS`` words, so its size is
bounded however many items there are and however long they are: items are cut
into pieces of ``PIECE_WORDS`` that overlap by a window less one word.  A word
of a block takes about 150 bytes where it is new, and 30 for its window.  Each
block is one pass over the rows, without any shuffle, adding to what the
passes before found.

Nulls: a null text has no words; an item without an id is named by an empty
string.  Repeated items count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Roller, bounded_batches, sealed, slices, unsealed, utf8

WINDOW = 10
BLOCK_WORDS, PIECE_WORDS = 1_000_000, 20_000

#: Bytes of words to themselves or their lower case, all others to a space.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_BASE = 0x9E3779B97F4A7C15


class Windows(NamedTuple):
    """The distinct windows of one length, by hash: where each begins in the
    words of the block, and whose it is (``owners`` from ``own`` on)."""

    value: np.ndarray
    begin: np.ndarray
    own: np.ndarray
    owners: np.ndarray


def _same(a: np.ndarray, at: np.ndarray, b: np.ndarray, to: np.ndarray, length: int) -> np.ndarray:
    """Whether ``length`` words of a and b are equal, place by place."""
    out = np.ones(len(at), bool)
    for j in range(length):
        out &= a[at + j] == b[to + j]
    return out


def _windows(words: np.ndarray, begin: np.ndarray, owner: np.ndarray, length: int, roller: Roller) -> Windows:
    value = roller.spans(words, begin, begin + length)
    order = np.argsort(value, kind="stable")
    value, begin, owner = value[order], begin[order], owner[order]
    first, todo = np.empty(len(value), np.int64), np.arange(len(value))
    while len(todo):  # once, unless different windows share a hash
        new = np.concatenate(([True], value[todo][1:] != value[todo][:-1]))
        leader = todo[np.flatnonzero(new)][np.cumsum(new) - 1]
        same = _same(words, begin[todo], words, begin[leader], length)
        first[todo[same]] = leader[same]
        todo = todo[~same]
    several = int(owner.max()) + 1
    pairs = np.unique(first * several + owner)  # a window repeated in an item is there once
    leaders, own = np.unique(pairs // several, return_index=True)
    return Windows(value[leaders], begin[leaders], np.append(own, len(pairs)), (pairs % several).astype(np.int32))


def item_windows(items: list[tuple[str, bytes]], width: int) -> tuple[dict, np.ndarray, list, dict]:
    """Word ids, the words of a block of items, the items' names, and by
    window length the windows."""
    ids: dict[bytes, int] = {}
    names: dict[str, int] = {}
    words, at, spans = [], 0, {}
    for name, text in items:
        own = np.array([ids.setdefault(w, len(ids) + 1) for w in text.translate(_WORDS).split()], np.int32)
        if len(own):
            length = min(width, len(own))
            begin = np.arange(at, at + len(own) - length + 1)
            spans.setdefault(length, []).append((begin, np.full(len(begin), names.setdefault(name, len(names)), np.int64)))
            words.append(own)
            at += len(own)
    flat, roller = np.concatenate([*words, np.zeros(0, np.int32)]), Roller(_BASE)
    return ids, flat, [*names], {k: _windows(flat, *(np.concatenate(x) for x in zip(*spans[k])), k, roller) for k in sorted(spans)}


def _pieces(width: int, piece: int):
    """Items in pieces: every window of an item is in just one of them."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                words = text.translate(_WORDS).split()
                for i in range(0, max(1, len(words) - width + 1) if words else 0, piece):
                    own = words[i : i + piece + width - 1]
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b" ".join(own)], pa.binary()), pa.array([len(own)], pa.int64())], names=["name", "text", "n"])

    return of


def _matches(block: tuple, words: np.ndarray, roller: Roller) -> Iterator[tuple[int, np.ndarray, np.ndarray, Windows]]:
    """For each length: begins of verified windows, and which window."""
    unknown = np.concatenate(([0], np.cumsum(words == 0)))
    for length, windows in block[3].items():
        n = len(words) - length + 1
        if n <= 0:
            continue
        at = np.flatnonzero(unknown[length:] == unknown[:n])
        if not len(at):
            continue
        own = roller.spans(words, at, at + length)
        low, high = np.searchsorted(windows.value, own), np.searchsorted(windows.value, own, "right")
        while (some := low < high).any():
            at, low, high = at[some], low[some], high[some]
            same = _same(words, at, block[1], windows.begin[low], length)
            if same.any():
                yield length, at[same], low[same], windows
            low = low + 1


def _scan(windows, first: bool):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, roller = windows.value, Roller(_BASE)
        known, names = block[0], block[2]
        get = known.get
        for batch in slices(batches, "_llm_text"):
            ids: list[int] = []
            ends = []
            for text in batch.column("_llm_text").to_pylist():
                if text:
                    ids += [get(w, 0) for w in text.translate(_WORDS).split()]
                ends.append(len(ids))
                ids.append(0)  # no window crosses texts
            words, end = np.array(ids, np.int64), np.array(ends)
            edge = np.zeros(len(words) + 1, np.int64)
            items: dict[int, set[str]] = {}
            for length, at, which, own in _matches(block, words, roller):
                np.add.at(edge, at, 1)
                np.add.at(edge, at + length, -1)
                for doc, w in set(zip(np.searchsorted(end, at, "right").tolist(), which.tolist())):
                    items.setdefault(doc, set()).update(names[i] for i in own.owners[own.own[w] : own.own[w + 1]].tolist())
            hit = np.cumsum(edge[:-1]) > 0
            begin = np.concatenate(([0], end[:-1] + 1))
            spans, found, n = [], [], batch.num_rows
            old = [[[]] * n] * 2 if first else [batch.column(c).to_pylist() for c in ("_llm_spans", "_llm_items")]
            for i, (a, b) in enumerate(zip(begin.tolist(), end.tolist())):
                if i not in items and not old[1][i]:
                    spans.append([])
                    found.append([])
                    continue
                own = hit[a:b].copy()
                for s in old[0][i]:
                    own[s["first"] : s["first"] + s["words"]] = True
                flips = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0)).tolist()
                spans.append([{"first": x, "words": y - x} for x, y in zip(flips[::2], flips[1::2])])
                found.append(sorted(items.get(i, set()).union(old[1][i])))
            rest = [i for i, c in enumerate(batch.schema.names) if c not in ("_llm_spans", "_llm_items", "_llm_words")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in rest), pa.array(end - begin, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32())]))), pa.array(found, pa.list_(pa.string()))],
                names=[*(batch.schema.names[i] for i in rest), "_llm_words", "_llm_spans", "_llm_items"],
            )

    return of


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, carry: list[str] | None = None, block_words: int = BLOCK_WORDS, piece_words: int = PIECE_WORDS) -> DataFrame:
    """One row for each row of ``docs``: the ``carry`` columns (doc_id unless
    named), n_words, hits (intervals of hit words: first word and length) and
    items (ids of the items with occurring windows, sorted as strings).

    A window is ``width`` consecutive words of an item; an item of fewer, but
    not none, is one window.  An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    carry = ["doc_id"] if carry is None else carry
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), utf8(F.coalesce("text", F.lit(""))).alias("text")).distinct()
    pieces = items.mapInArrow(_pieces(width, piece_words), "name string, text binary, n long").checkpoint()
    size = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-2 * size // block_words))  # dealt by a hash: half full each, about
    now = docs.select(*carry, utf8("text").alias("_llm_text"))
    kept = docs.select(*carry).schema
    shape = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "_llm_text binary, _llm_words long, _llm_spans array<struct<first:int,words:int>>, _llm_items array<string>"])
    for b in range(blocks):
        own = pieces if blocks == 1 else pieces.filter(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == b)
        block = item_windows([(r["name"], bytes(r["text"])) for r in own.collect()], width)
        now = now.mapInArrow(_scan(spark.sparkContext.broadcast(block), not b), shape)
    return now.select(*carry, F.col("_llm_words").alias("n_words"), F.col("_llm_spans").alias("hits"), F.col("_llm_items").alias("items"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no test window occurs."""
    wide, names = sealed(docs, "text")
    return unsealed(contamination(wide, benchmark, width, names).filter(F.size("items") == 0), docs)
