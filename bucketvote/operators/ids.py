"""Row numbering that scales: generated ids and per-group sequence numbers.

``row_number()`` over a global order funnels every row into one task, and a
window partitioned by a key puts a hot key (say a third of all rows) into
one task.  Both are replaced here by a range-partitioned numbering, with
built-in functions only, so that no value of any column is touched:

1. ``repartitionByRange`` on (keys, order) and sort within partitions, so a
   hot key is spread over many partitions in order;
2. ``spark_partition_id()`` and the low bits of
   ``monotonically_increasing_id()`` give each row its partition and its
   place in it; the result is checkpointed (reliable, in the session's
   checkpoint folder), which fixes both;
3. without keys, rank = place + rows of earlier partitions; with keys, rows
   are numbered within (partition, key), a group no larger than a range
   partition, and the rows of the same key in earlier partitions are added.

A key continues into another partition at most once per partition boundary,
so the offsets have at most two rows per partition and are broadcast.  The
numbering is ``row_number() over (partition by keys order by order)`` when
(keys, order) is unique.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, parts_for

_PID = "_bv_pid"
_PLACE = "_bv_place"
_PRIOR = "_bv_prior"


def sequence_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "seq",
    start: int = 0,
    num_partitions: int | None = None,
    kept: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add ``out`` = start + 0-based rank of each row within its key group by
    ``order`` (ascending).  (keys, order) should be unique for a
    deterministic result.  With no keys the rank is global; NULL keys form
    one group.  ``kept`` may keep the placed rows elsewhere than in a checkpoint."""
    keys, order = list(keys), list(order)
    ensure_checkpoint_dir(df.sparkSession)
    sort_cols = [*keys, *order]
    # AQE may merge adjacent range partitions; a merged one is still one range
    n = num_partitions or parts_for(df.sparkSession, df.count())
    ranged = df.repartitionByRange(n, *sort_cols)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = ranged.sortWithinPartitions(*sort_cols).withColumns({_PID: F.spark_partition_id(), _PLACE: place})
    placed = kept(placed) if kept else placed.checkpoint(eager=True)
    counts = placed.groupBy(_PID, *keys).agg(F.count(F.lit(1)).alias("_bv_n"))
    earlier = Window.partitionBy(*keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    prior = counts.withColumn(_PRIOR, F.sum("_bv_n").over(earlier)).filter(F.col(_PRIOR).isNotNull())
    small = prior.select(F.col(_PID).alias("_bv_p"), *[F.col(k).alias(f"_bv_k{i}") for i, k in enumerate(keys)], _PRIOR)
    if keys:
        own = Window.partitionBy(_PID, *keys).orderBy(_PLACE)
        placed = placed.withColumn(_PLACE, F.row_number().over(own) - 1)
    same = [F.col(_PID) == F.col("_bv_p"), *[F.col(k).eqNullSafe(F.col(f"_bv_k{i}")) for i, k in enumerate(keys)]]
    joined = placed.join(F.broadcast(small), reduce(lambda a, b: a & b, same), "left")
    rank = F.col(_PLACE) + F.coalesce(F.col(_PRIOR), F.lit(0)) + F.lit(start)
    return joined.select(*df.columns, rank.cast("long").alias(out))


def assign_ids(
    df: DataFrame,
    order: Sequence[str],
    start: int | DataFrame = 0,
    out: str = "Id",
    dtype: str = "long",
    kept: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Generated unique ids ``start + 1, start + 2, ...`` in the total order of
    ``order`` (identity-column semantics).  ``start`` may be a DataFrame whose
    first column holds the offset (for example ``max(Id)`` of the existing
    table); it is read as a scalar subquery, with no driver round trip."""
    numbered = sequence_within(df, [], order, out="_bv_rank", kept=kept)
    if isinstance(start, DataFrame):
        base = F.coalesce(start.select(F.max(F.col(start.columns[0])).cast("long")).scalar(), F.lit(0))
    else:
        base = F.lit(int(start))
    return numbered.withColumn(out, (base + F.col("_bv_rank") + 1).cast(dtype)).drop("_bv_rank")
