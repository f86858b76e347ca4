"""Helpers shared by the text operators: Arrow batches of bounded size, and
words of many texts at once as numpy arrays.

Texts travel as UTF-8 bytes.  ``SPACE`` words are runs of bytes other than
0x20 and 0x09-0x0D, so ``bytes.split()`` yields exactly them; a null text has
no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Rows the JVM puts in one Arrow batch (whose bytes Spark bounds at 64 MB), and
#: text bytes handled at a time in a Python worker (a longer single text is
#: still handled whole).
BATCH_ROWS = 1000
SLICE_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes.translate table that lower-cases A-Z only.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small; texts may be very long.  The
    session's settings stay lowered, as the batches are made when the result
    is computed."""
    ensure_checkpoint_dir(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def utf8(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("binary")


def slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column in one byte array, each followed by one space,
    and where each text begins (with the total length at the end)."""
    texts = [t or b"" for t in column.to_pylist()]
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    data = np.frombuffer(b" ".join(texts) + b" " if texts else b"", np.uint8)
    return data, starts


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word in ``flat_bytes`` data, and for each text
    the index of its first word (with the total at the end)."""
    edge = np.diff(np.concatenate(([True], _SPACE[data], [True])).view(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return begin, end, np.searchsorted(begin, starts)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Roller:
    """Rabin-Karp sums modulo 2**64 over any spans of a sequence."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def spans(self, values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """sum(values[k] * base**(k - begin)) for k in [begin, end)."""
        n = len(values)
        if len(self.up) < n + 1:
            self.up, self.down = powers(self.base, n + 1), powers(self.inverse, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(values.astype(np.uint64) * self.up[:n], out=total[1:])
        return (total[end] - total[begin]) * self.down[begin]


class KeyTable:
    """Looks up many 64-bit keys (none of them zero) at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(3 * len(keys)).bit_length())
        self.keys, self.values = np.zeros(1 << self.bits, np.uint64), np.empty(1 << self.bits, values.dtype)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot] == 0
            first = np.zeros(len(todo), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.values[slot[put]] = keys[todo[put]], values[todo[put]]
            todo, slot = todo[~put], (slot[~put] + ~free[~put]) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray, missing) -> np.ndarray:
        out, todo, slot = np.full(len(keys), missing, self.values.dtype), np.arange(len(keys)), self._slot(keys)
        while len(todo):
            got = self.keys[slot]
            hit = got == keys[todo]
            out[todo[hit]] = self.values[slot[hit]]
            go = ~hit & (got != 0)
            todo, slot = todo[go], (slot[go] + 1) & ((1 << self.bits) - 1)
        return out


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def sealed(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[str]]:
    """All columns under names that clash with none of an operator's, next to
    the ``needed`` columns under their own; and these names, in order."""
    names = [f"_llm_{i}" for i in range(len(docs.columns))]
    return docs.select(*[column(c).alias(n) for c, n in zip(docs.columns, names)], *needed), names


def unsealed(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again, some of them changed."""
    return rows.select(*[changed.get(c, F.col(f"_llm_{i}")).alias(c) for i, c in enumerate(docs.columns)])
