"""Hard-negative mining with segment summaries.

A vector is cut into segments; of each the mean and the deviation are stored.
With n components in a segment, the inner product of two segments lies within
n * (mean * mean' -+ deviation * deviation'), so the sums over all segments
bound the score of a pair.  Segments are refined level by level (32, 8, 2
components): at each level all pairs left of a tile of anchors and rows are
bounded at once, and only those whose bounds still reach a wanted range go on.
What is left after the last level is scored exactly, on integers.

Anchors are dealt into blocks of bounded size; a block is broadcast and all
rows pass it twice.  First each anchor's best rows of its own label: a task
keeps the best so far, whose last score is the range's lower end.  Then, for
each positive, the best rows of other labels in the range that the positive's
score sets.  A task passes on at most the asked number for each anchor (and
positive), which are merged by rank.  Blocks, so memory and the driver's
share, are bounded; the work is the stated one, all anchors against all rows.

Components: floor(256 * x), x as double, kept within +-2**27, so that a score
of up to 512 components fits a long.  Rows with a null label, a null or empty
vector, or a null or non-finite component take no part, and neither do rows
without id.  Vectors of different lengths are compared as if the shorter one
ended in zeros.  A row is known by its id: rows with an anchor's own id are
never its positives or negatives, and of rows alike in id and score one
counts.  Repeated anchors count once; anchors that share an id but differ in
label or vector are mined each.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .text import bounded_batches

#: Components of a segment by level, coarse to fine, each a multiple of the next.
LEVELS = (32, 8, 2)
#: Component bytes of a block of anchors, and anchors of a tile.
BLOCK_BYTES, TILE = 4 << 20, 256
#: Pairs scored exactly at a time.
AT_ONCE = 1 << 16

SCALE, LIMIT = 256.0, 1 << 27
#: Widens the bounds, as a share of the product of both lengths: far more than
#: rounding takes (the stored summaries have 24 bits).
_SLACK = 1e-6


def _scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors whose components are all finite, as integers with summaries."""
    for batch in batches:
        column = batch.column("vector")
        offsets, x = column.offsets.to_numpy(), column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null is nan
        bad = np.concatenate(([0], np.cumsum(~np.isfinite(x))))
        size = np.where(bad[offsets[1:]] == bad[offsets[:-1]], np.diff(offsets), 0)
        whole = np.clip(np.floor(np.where(np.isfinite(x), np.clip(x, -LIMIT, LIMIT), 0) * SCALE), -LIMIT, LIMIT).astype(np.int32)
        for n in np.unique(size[size > 0]).tolist():
            own = np.flatnonzero(size == n)
            grid = whole[offsets[own][:, None] + np.arange(n)]
            mean, deviation = summaries(grid, LEVELS[-1])
            rest = batch.select(["vec_id", "label"]).take(pa.array(own))
            yield pa.RecordBatch.from_arrays([rest.column(0), rest.column(1), _lists(grid), _lists(mean.astype(np.float32)), _lists(deviation.astype(np.float32))], names=_STORED)


_STORED = ["vec_id", "label", "x", "mean", "deviation"]


def _lists(grid: np.ndarray) -> pa.Array:
    offsets = np.arange(0, grid.size + 1, max(grid.shape[1], 1), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(grid.reshape(-1)))


def summaries(grid: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of each vector's segments of ``width`` components
    (zeros fill the last one)."""
    parts = _padded(grid, -(-grid.shape[1] // width) * width).reshape(len(grid), -1, width).astype(np.float64)
    mean = parts.mean(axis=2)
    return mean, np.sqrt(((parts - mean[:, :, None]) ** 2).mean(axis=2))


def _padded(grid: np.ndarray, size: int) -> np.ndarray:
    return grid if grid.shape[1] >= size else np.pad(grid, ((0, 0), (0, size - grid.shape[1])))


def coarser(mean: np.ndarray, deviation: np.ndarray, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of segments of ``times`` joined ones."""
    size = -(-mean.shape[1] // times) * times
    mean, deviation = _padded(mean, size).reshape(len(mean), -1, times), _padded(deviation, size).reshape(len(mean), -1, times)
    whole = mean.mean(axis=2)
    return whole, np.sqrt((deviation**2 + (mean - whole[:, :, None]) ** 2).mean(axis=2))


class Side:
    """Vectors of one size with their summaries, scaled so that plain inner
    products of ``middle`` and of ``spread`` bound the scores."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, mean: np.ndarray, deviation: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.levels, fine = [], LEVELS[-1]
        mean, deviation = mean.astype(np.float64), deviation.astype(np.float64)
        length = np.sqrt(fine * (mean**2 + deviation**2).sum(axis=1))
        for width in LEVELS:
            m, d = coarser(mean, deviation, width // fine)
            spread = np.concatenate((d * np.sqrt(width), (length * np.sqrt(_SLACK))[:, None]), axis=1)
            self.levels.append((m * np.sqrt(width), spread))
        self.longest = float(length.max(initial=0.0))

    def part(self, a: int, b: int) -> Side:
        out = object.__new__(Side)
        out.ids, out.labels, out.x, out.longest = self.ids[a:b], self.labels[a:b], self.x[a:b], self.longest
        out.levels = [(m[a:b], s[a:b]) for m, s in self.levels]
        return out


def _side(batch: pa.RecordBatch, size: int) -> Iterator[Side]:
    """The rows of a batch as sides of one vector size each, at least ``size``."""
    x, mean, deviation = (batch.column(c) for c in _STORED[2:])
    length = np.diff(x.offsets.to_numpy())
    for n in np.unique(length):
        own = np.flatnonzero(length == n)

        def grid(column, own=own):
            k = len(column[int(own[0])])
            return column.values.to_numpy()[column.offsets.to_numpy()[own][:, None] + np.arange(k)]

        to = max(int(n), size)
        fine = -(-to // LEVELS[-1])
        yield Side(
            batch.column("vec_id").to_numpy()[own], batch.column("label").to_numpy()[own], _padded(grid(x), to), _padded(grid(mean), fine), _padded(grid(deviation), fine)
        )


def wider(side: Side, size: int) -> Side:
    """The same vectors with zeros up to ``size`` components."""
    if side.x.shape[1] >= size:
        return side
    x = _padded(side.x, size)
    return Side(side.ids, side.labels, x, *summaries(x, LEVELS[-1]))


def survivors(anchors: Side, rows: Side, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) indexes of the wanted pairs (a mask) whose bounds, at
    every level, reach the anchor's range [low, high]."""
    left = np.flatnonzero(wanted.any(axis=0))
    wanted = wanted[:, left]
    for (am, ad), (rm, rd) in zip(anchors.levels, rows.levels):
        middle, spread = am @ rm[left].T, ad @ rd[left].T
        wanted &= (middle + spread + 1e-3 >= low[:, None]) & (middle - spread - 1e-3 <= high[:, None])
        some = wanted.any(axis=0)
        left, wanted = left[some], wanted[:, some]
        if not len(left):
            break
    a, r = np.nonzero(wanted)
    return a, left[r]


def scores(anchors: Side, rows: Side, a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Exact inner products of pairs, as integers."""
    kind = np.float64 if anchors.longest * rows.longest < 1 << 50 else np.int64  # doubles are exact below 2**53
    out = np.empty(len(a), np.int64)
    x, y = anchors.x.astype(kind), rows.x.astype(kind)
    for i in range(0, len(a), AT_ONCE):
        out[i : i + AT_ONCE] = np.einsum("ij,ij->i", x[a[i : i + AT_ONCE]], y[r[i : i + AT_ONCE]])
    return out


class Best:
    """The best ``k`` (score, id) of each of many lists: higher scores first,
    then smaller ids; alike ones count once."""

    def __init__(self, lists: int, k: int):
        self.k = k
        self.of, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.last = np.full(lists, -np.inf)  # the k-th score so far

    def add(self, of: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        some = score >= self.last[of]
        if not some.any():
            return
        of, score, ids = np.concatenate((self.of, of[some])), np.concatenate((self.score, score[some])), np.concatenate((self.id, ids[some]))
        order = np.lexsort((ids, -score, of))
        of, score, ids = of[order], score[order], ids[order]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        of, score, ids = of[new], score[new], ids[new]
        first = np.flatnonzero(np.diff(of, prepend=-1))
        rank = np.arange(len(of)) - np.repeat(first, np.diff(first, append=len(of)))
        top = rank < self.k
        self.of, self.score, self.id, rank = of[top], score[top], ids[top], rank[top]
        full = rank == self.k - 1
        self.last[self.of[full]] = self.score[full]


def _tiles(block, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Side, Side]]:
    """Tiles of the block's anchors with each batch's rows: first anchor's
    number, anchors, rows."""
    ids, labels, x = block
    if not len(ids):
        return
    anchors = Side(ids, labels, x, *summaries(x, LEVELS[-1]))
    for batch in batches:
        if not batch.num_rows:
            continue
        for rows in _side(batch, anchors.x.shape[1]):
            own = wider(anchors, rows.x.shape[1])
            for a in range(0, len(ids), TILE):
                yield a, own.part(a, a + TILE), rows


def _positives(block, k: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(block.value[0]), k)
        for first, anchors, rows in _tiles(block.value, batches):
            wanted = (anchors.labels[:, None] == rows.labels) & (anchors.ids[:, None] != rows.ids)
            low = best.last[first : first + len(anchors.ids)]
            a, r = survivors(anchors, rows, wanted, low, np.full(len(low), np.inf))
            best.add(first + a, scores(anchors, rows, a, r), rows.ids[r])
        yield pa.RecordBatch.from_arrays([pa.array(best.of), pa.array(best.id), pa.array(best.score)], names=["anchor", "id", "score"])

    return of


def _negatives(block, positives, k: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = positives.value  # by anchor and place; -1 where there is none
        n, places = score.shape
        floor = score - score // 5  # the least score of at least 80 % of the positive's
        best = Best(n * places, k)
        for first, anchors, rows in _tiles(block.value, batches):
            own = slice(first, first + len(anchors.ids))
            high = score[own].max(axis=1)
            low = np.where(score[own] >= 0, np.maximum(floor[own], best.last.reshape(n, places)[own]), np.inf).min(axis=1)
            wanted = (anchors.labels[:, None] != rows.labels) & (anchors.ids[:, None] != rows.ids) & (high >= 0)[:, None]
            a, r = survivors(anchors, rows, wanted, low, high)
            got = scores(anchors, rows, a, r)
            for p in range(places):
                fits = (got >= floor[first + a, p]) & (got <= score[first + a, p]) & (score[first + a, p] >= 0)
                best.add((first + a[fits]) * places + p, got[fits], rows.ids[r[fits]])
        yield pa.RecordBatch.from_arrays([pa.array(best.of), pa.array(best.id), pa.array(best.score)], names=["anchor", "id", "score"])

    return of


_FOUND = "anchor long, id long, score long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each list, of what all tasks found."""
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= k).dropDuplicates(["anchor", "rank"])


def stored_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: Column | str = "label") -> DataFrame:
    """(vec_id, label, x, mean, deviation) of the rows that take part: the
    components as integers and the summaries of the finest segments."""
    bounded_batches(rows.sparkSession)
    label = F.col(label) if isinstance(label, str) else label
    own = rows.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).alias("vector"))
    own = own.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    return own.mapInArrow(_scaled, "vec_id long, label long, x array<int>, mean array<float>, deviation array<float>")


def hard_negatives(stored: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score, of ``stored_vectors``: for each anchor and each of its
    first ``positives`` rows of its label, the first ``negatives`` rows of
    other labels that score at least 80 % of and at most the positive's score."""
    spark = stored.sparkSession
    stored = stored.checkpoint()  # read twice for each block of anchors
    anchors = stored.filter(is_anchor).select("vec_id", "label", "x").distinct()
    size = anchors.agg(F.sum(4 * F.size("x") + 16)).first()[0] or 0
    blocks = max(1, -(-size * 5 // (4 * block_bytes)))
    out = scratch_path(spark, "negatives")
    for b in range(blocks):
        own = anchors.filter(F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(blocks)) == b)
        got = own.toArrow()  # bounded by block_bytes
        if b and not got.num_rows:
            continue
        ids, labels, vectors = (got.column(c).combine_chunks() for c in ("vec_id", "label", "x"))
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False) if len(vectors) else np.zeros(0, np.int64)
        x = np.zeros((len(ids), int(lengths.max(initial=1))), np.int32)
        if len(ids):
            x[np.arange(x.shape[1]) < lengths[:, None]] = vectors.flatten().to_numpy()
        block = spark.sparkContext.broadcast((ids.to_numpy(), labels.to_numpy(), x))
        found = _ranked(stored.mapInArrow(_positives(block, positives), _FOUND), positives).select("anchor", "rank", "id", "score").collect()  # `positives` an anchor
        score, who = np.full((len(ids), positives), -1, np.int64), np.zeros((len(ids), positives), np.int64)
        for r in found:
            score[r["anchor"], r["rank"] - 1], who[r["anchor"], r["rank"] - 1] = r["score"], r["id"]
        shared = spark.sparkContext.broadcast(score)
        best = _ranked(stored.mapInArrow(_negatives(block, shared, negatives), _FOUND), negatives)
        named = best.mapInArrow(_named(spark.sparkContext.broadcast((ids.to_numpy(), who, score))), _RESULT)
        named.write.parquet(f"{out}/block={b}")
    return spark.read.schema(_RESULT).parquet(out).drop("block")


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _named(of_block):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, who, score = of_block.value
        for batch in batches:
            a, p = np.divmod(batch.column("anchor").to_numpy(), who.shape[1])
            columns = [pa.array(ids[a]), pa.array(who[a, p]), batch.column("rank").cast(pa.int32()), batch.column("id"), pa.array(score[a, p]), batch.column("score")]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _RESULT.split(", ")])

    return of
