"""SentencePiece encoding and decoding with N-best segmentations.

Texts become piece ids by the best path over the piece lattice of an existing
vocabulary, with its N-1 next best segmentations.  No piece crosses a space,
so a text's lattice is a row of independent chunks: every distinct chunk is
solved once for each few MB of text (all chunks side by side), and the N best
of a text differ from its best only in the N-1 chunks whose second best costs
least; only these are searched by backward A* and combined, best first.  This
is exact.

Encoding follows SentencePiece without normalisation: one space is put before
the text, spaces become U+2581, characters without a piece are spelt in byte
pieces, and so is a U+2581 of the text itself.  Decoding gives the text back
unchanged.

Nulls: a null text has null ids and no segmentations; an empty text has the
single space's piece.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lattice import MARK, SCALE, Lattice, Vocabulary, chunks_of, load_vocabulary
from .text import bounded_batches, sealed, slices, utf8

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
NBEST = 4
#: Solved chunks that a task keeps (more begin anew; the results are the same),
#: chunks solved side by side, and text bytes handled at a time.
MEMORY, AT_ONCE, SLICE = 200_000, 20_000, 1 << 20

_EDIT = pa.struct([("first", pa.int32()), ("pieces", pa.int32()), ("ids", pa.list_(pa.int32()))])
_BEST = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(_EDIT))]))


class _Solved:
    """Chunks solved so far: numbers by chunk, and arrays by number."""

    def __init__(self, lattice: Lattice):
        self.lattice = lattice
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.score, self.gap = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.several: dict[str, list[tuple[int, list[int]]]] = {}

    def add(self, texts: list[list[str]]) -> None:
        if len(self.number) > MEMORY:
            self.clear()
        known = self.number
        new = list(set().union(*texts).difference(known))
        if not new:
            return
        known.update(zip(new, range(len(known), len(known) + len(new))))
        for i in range(0, len(new), AT_ONCE):
            flat, offsets, score, gap = self.lattice.best(new[i : i + AT_ONCE])
            self.offsets = np.concatenate((self.offsets, offsets[1:] + self.offsets[-1]))
            self.flat = np.concatenate((self.flat, flat))
            self.score, self.gap = np.concatenate((self.score, score)), np.concatenate((self.gap, gap))

    def nbest(self, chunk: str, n: int) -> list[tuple[int, list[int]]]:
        got = self.several.get(chunk)
        if got is None:
            if len(self.several) >= AT_ONCE:
                self.several.clear()
            got = self.several[chunk] = self.lattice.nbest(chunk, n)
        return got


def _combine(solved: _Solved, chunks: list[str], numbers: np.ndarray, begins: np.ndarray, n: int):
    """(score, edits) of a text's n best segmentations."""
    gap = solved.gap[numbers]
    near = [i for i in np.argsort(gap, kind="stable")[: n - 1].tolist() if gap[i] < 1 << 59]
    near.sort(reverse=True)  # ties go by the last chunk first
    choices = [solved.nbest(chunks[i], n) for i in near]
    heap, out = [(0, (0,) * len(near))], []
    total = int(solved.score[numbers].sum())
    while heap and len(out) < n:
        cost, ranks = heapq.heappop(heap)
        edits = [
            {"first": int(begins[i]), "pieces": len(c[0][1]), "ids": c[r][1]}
            for i, r, c in sorted(zip(near, ranks, choices), key=lambda x: x[0]) if r
        ]
        out.append({"score": (total - cost) / SCALE, "edits": edits})
        last = max((j for j, r in enumerate(ranks) if r), default=0)
        for j in range(last, len(near)):
            r, c = ranks[j], choices[j]
            if r + 1 < len(c):
                heapq.heappush(heap, (cost + c[r][0] - c[r + 1][0], (*ranks[:j], r + 1, *ranks[j + 1 :])))
    return out


def _encode(vocabulary, n: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solved = _Solved(Lattice(Vocabulary(*vocabulary.value)))
        for batch in slices(batches, "_llm_text", SLICE):
            rest = [i for i, c in enumerate(batch.schema.names) if c != "_llm_text"]
            texts = [None if t is None else chunks_of(t.decode()) for t in batch.column("_llm_text").to_pylist()]
            solved.add([t for t in texts if t is not None])
            get, count = solved.number.__getitem__, np.diff(solved.offsets)
            ids, ends, best, total = [], [0], [], 0
            for chunks in texts:
                if chunks is not None:
                    numbers = np.fromiter(map(get, chunks), np.int64, len(chunks))
                    size = count[numbers]
                    end = np.cumsum(size)
                    begin = end - size
                    ids.append(solved.flat[np.repeat(solved.offsets[numbers] - begin, size) + np.arange(end[-1])])
                    total += int(end[-1])
                    best.append(_combine(solved, chunks, numbers, begin, n))
                else:
                    best.append(None)
                ends.append(total)
            missing = np.array([t is None for t in texts])
            offsets = pa.array(ends, pa.int32(), mask=np.concatenate((missing, [False])))
            values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in rest), pa.ListArray.from_arrays(offsets, values), pa.array(best, _BEST)],
                names=[*(batch.schema.names[i] for i in rest), "ids", "nbest"],
            )

    return of


def piece_bytes(vocabulary: Vocabulary) -> list[bytes]:
    """What each id decodes to (nothing for control pieces)."""
    out = [p.replace(MARK, " ").encode() if p else b"" for p in vocabulary.pieces]
    for b, i in enumerate(vocabulary.byte_ids.tolist()):
        out[i] = bytes([b])
    return out


def _decode(table):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelt = table.value
        for batch in batches:
            rest = [i for i, c in enumerate(batch.schema.names) if c != "_llm_ids"]
            column = batch.column("_llm_ids")
            texts = []
            for i in range(batch.num_rows):
                if not column[i].is_valid:
                    texts.append(None)
                    continue
                raw = b"".join([spelt[x] for x in column[i].values.to_numpy(zero_copy_only=False).tolist()])
                texts.append((raw[1:] if raw[:1] == b" " else raw).decode(errors="replace"))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in rest), pa.array(texts, pa.string())], names=[*(batch.schema.names[i] for i in rest), "decoded"])

    return of


def _shape(df: DataFrame, columns: list[str], more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema), more])


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, n: int = NBEST, carry: list[str] | None = None) -> DataFrame:
    """One row for each row of ``docs``: the ``carry`` columns (doc_id unless
    named), ids (the best segmentation) and nbest: up to ``n`` segmentations,
    best first, each with its score (natural log) and its edits of ids: the
    ``pieces`` ids from index ``first`` are replaced by ``ids``."""
    bounded_batches(docs.sparkSession)
    carry = ["doc_id"] if carry is None else carry
    shared = docs.sparkSession.sparkContext.broadcast(tuple(load_vocabulary(vocabulary)))  # the vocabulary's size
    out = _shape(docs, carry, "ids array<int>, nbest array<struct<score:double,edits:array<struct<first:int,pieces:int,ids:array<int>>>>>")
    return docs.select(*carry, utf8("text").alias("_llm_text")).mapInArrow(_encode(shared, n), out)


def edited(ids: F.Column, edits: F.Column) -> F.Column:
    """The ids of a segmentation given by its edits of the best one."""
    state = F.aggregate(
        edits,
        F.struct(F.slice(ids, 1, 0).alias("done"), F.lit(0).alias("at")),
        lambda s, e: F.struct(
            F.concat(s["done"], F.slice(ids, s["at"] + 1, e["first"] - s["at"]), e["ids"]).alias("done"),
            (e["first"] + e["pieces"]).alias("at"),
        ),
    )
    return F.concat(state["done"], F.slice(ids, state["at"] + 1, F.size(ids)))


def decode(pieces: DataFrame, vocabulary: str = VOCABULARY, column: str = "ids", carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (all unless named) and decoded, the text of the
    ids in ``column``; null ids decode to null."""
    carry = pieces.columns if carry is None else carry
    shared = pieces.sparkSession.sparkContext.broadcast(piece_bytes(load_vocabulary(vocabulary)))
    out = _shape(pieces, carry, "decoded string")
    return pieces.select(*carry, F.col(column).alias("_llm_ids")).mapInArrow(_decode(shared), out)


def with_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, n: int = NBEST) -> DataFrame:
    """``docs`` with n_pieces, ids and nbest (which replace columns that have
    these names)."""
    wide, names = sealed(docs, "text")
    found = encode(wide, vocabulary, n, names)
    old = [F.col(x).alias(c) for c, x in zip(docs.columns, names) if c not in ("n_pieces", "ids", "nbest")]
    return found.select(*old, F.size("ids").cast("long").alias("n_pieces"), "ids", "nbest")
