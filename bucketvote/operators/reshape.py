"""Layout changes of the bins and schema evolution, as DataFrame jobs.

Long layout: one row per (slice, position), ``(HashTable, HashBin,
SubFingerprintId)`` with 1-based positions and bigint bins (historical).
Wide layout: one row per slice with ``HashTable_0 .. HashTable_24`` (int).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import BIN_COLS, N_BINS, SLICE_COLS
from ..session import parts_for

#: Ids (of 8 bytes) that are broadcast.
BROADCAST_IDS = 1_000_000
#: Rows with columns of their own that are.
BROADCAST_ROWS = 100_000


def by_ids(rows: DataFrame, ids: DataFrame, on: str, how: str) -> DataFrame:
    """``rows`` whose ``on`` is (``left_semi``) or is not (``left_anti``) among
    ``ids``.  Ids that are few are broadcast and no row moves; else both sides
    are dealt by the id, into tasks of bounded rows.  Ids that repeat are
    taken once."""
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        return rows.join(F.broadcast(ids), on, how)
    n = parts_for(rows.sparkSession, rows.count())
    return rows.repartition(n, on).join(ids.distinct().repartition(n, on), on, how)


def bins_to_long(slices: DataFrame, base: int = 1, keep: Sequence[str] = (), position: int | None = None) -> DataFrame:
    """Wide -> long.  One row per (slice, position), with the columns
    ``keep`` of the slice.  With ``position`` the rows of this one (from 0)."""
    if position is not None:
        bin_ = F.col(BIN_COLS[position]).cast("long").alias("HashBin")
        return slices.select(F.lit(position + base).alias("HashTable"), bin_, F.col("Id").alias("SubFingerprintId"), *keep)
    return slices.select(
        F.col("Id").alias("SubFingerprintId"),
        *keep,
        F.posexplode(F.array(*[F.col(c) for c in BIN_COLS])).alias("_pos", "_bin"),
    ).select(
        (F.col("_pos") + F.lit(base)).cast("int").alias("HashTable"),
        F.col("_bin").cast("long").alias("HashBin"),
        F.col("SubFingerprintId"),
        *keep,
    )


def bins_to_wide(
    bins_long: DataFrame,
    slices: DataFrame,
    track_id: int | None = None,
    on_duplicate: str = "error",
    base: int = 1,
) -> DataFrame:
    """Long -> wide, joined to the slice rows for their other columns.

    Same rows as the 25-way inner join of the position tables (plus the
    slice table): a slice that lacks any position is dropped.  Built as one
    grouping by slice with 25 conditional aggregates instead of 25 joins.  The
    long rows are dealt by slice as they are, into tasks of bounded rows, and
    grouped there: their layout is by position, so a task that reads them
    holds a slice once and has nothing to group.  When a position holds two
    bins for one slice the join multiplies rows; ``on_duplicate="error"``
    raises, ``"expand"`` reproduces the multiplication.
    Returns the wide slice layout (bins as int, ANSI casts raise on overflow).
    """
    meta = slices.select([c for c in SLICE_COLS if c not in BIN_COLS])
    if track_id is not None:
        meta = meta.filter(F.col("TrackId") == F.lit(int(track_id)))
        bins_long = by_ids(bins_long, meta.select(F.col("Id").alias("SubFingerprintId")), "SubFingerprintId", "left_semi")
    n = parts_for(bins_long.sparkSession, bins_long.count())
    bins_long = bins_long.select("HashTable", "HashBin", "SubFingerprintId").repartition(n, "SubFingerprintId")
    pos = F.col("HashTable") - F.lit(base)
    if on_duplicate == "error":
        aggs = []
        for i, c in enumerate(BIN_COLS):
            hit = pos == F.lit(i)
            aggs.append(F.min(F.when(hit, F.col("HashBin"))).alias(c))
            aggs.append(F.count(F.when(hit, F.lit(1))).alias(f"_n{i}"))
        g = bins_long.groupBy(F.col("SubFingerprintId").alias("Id")).agg(*aggs)
        dup = None
        for i in range(N_BINS):
            d = F.col(f"_n{i}") > 1
            dup = d if dup is None else (dup | d)
        complete = None
        for i in range(N_BINS):
            d = F.col(f"_n{i}") >= 1
            complete = d if complete is None else (complete & d)
        g = g.withColumn(
            "_chk", F.when(dup, F.raise_error(F.lit("bins_to_wide: a slice has two bins at one position")))
        ).filter(complete & F.col("_chk").isNull())
        wide = g.select("Id", *[F.col(c).cast("int").alias(c) for c in BIN_COLS])
    elif on_duplicate == "expand":
        aggs = [F.collect_list(F.when(pos == F.lit(i), F.col("HashBin"))).alias(c) for i, c in enumerate(BIN_COLS)]
        g = bins_long.groupBy(F.col("SubFingerprintId").alias("Id")).agg(*aggs)
        nonempty = None
        for c in BIN_COLS:
            d = F.size(F.col(c)) > 0
            nonempty = d if nonempty is None else (nonempty & d)
        wide = g.filter(nonempty)
        for c in BIN_COLS:
            wide = wide.withColumn(c, F.explode(F.col(c)))
        wide = wide.select("Id", *[F.col(c).cast("int").alias(c) for c in BIN_COLS])
    else:
        raise ValueError("on_duplicate must be 'error' or 'expand'")
    return meta.repartition(n, "Id").join(wide, "Id").select(*SLICE_COLS)


def split_bins_by_table(bins_long: DataFrame, path: str) -> DataFrame:
    """S3: one folder per position (``HashTable=k``), rows sorted by bin in
    each file so posting-list reads skip row groups.  Range partitioning on
    (HashTable, HashBin) keeps the write balanced (no task per position).
    Returns the table read back."""
    spark = bins_long.sparkSession
    (
        bins_long.repartitionByRange("HashTable", "HashBin")
        .sortWithinPartitions("HashTable", "HashBin")
        .write.mode("errorifexists")
        .partitionBy("HashTable")
        .parquet(path)
    )
    return spark.read.parquet(path).select("HashTable", "HashBin", "SubFingerprintId")


def rebase_bins(bins_long: DataFrame, base: int = 1) -> DataFrame:
    """1-based bigint position tables -> 0-based int (ANSI casts raise
    on a bin that does not fit an int)."""
    return bins_long.select(
        (F.col("HashTable") - F.lit(base)).cast("int").alias("HashTable"),
        F.col("HashBin").cast("int").alias("HashBin"),
        F.col("SubFingerprintId"),
    )


def backfill_by_join(
    target: DataFrame,
    source: DataFrame,
    target_key: str,
    source_key: str,
    columns: Mapping[str, str],
) -> DataFrame:
    """Update-from-join.  For each target row with a matching source row,
    set ``target[t] = source[s]`` for every (t -> s) in ``columns`` (even
    when the source value is NULL); unmatched rows keep their old values.
    A source key that repeats never adds rows: one of its rows is used (the
    least by the used columns, in their order).  A source of many keys is dealt
    with the target by the key into tasks of bounded rows; target rows without
    a key match nothing and stay where they are."""
    src = (
        source.groupBy(F.col(source_key).alias("_bv_key"))
        .agg(F.min(F.struct(*[F.col(s).alias(f"_bv_src_{t}") for t, s in columns.items()])).alias("_bv_row"))
        .select("_bv_key", F.lit(True).alias("_bv_hit"), "_bv_row.*")
    )
    if source.select(source_key).limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        n = parts_for(target.sparkSession, target.count())
        rest = target.filter(F.col(target_key).isNull())
        keyed, src = target.filter(F.col(target_key).isNotNull()).repartition(n, target_key), src.repartition(n, "_bv_key")
        joined = keyed.join(src, keyed[target_key] == src["_bv_key"], "left").unionByName(rest, allowMissingColumns=True)
    else:
        joined = target.join(F.broadcast(src), target[target_key] == src["_bv_key"], "left")
    out = joined
    for t in columns:
        if t in target.columns:
            out = out.withColumn(t, F.when(F.col("_bv_hit"), F.col(f"_bv_src_{t}")).otherwise(F.col(t)))
        else:
            out = out.withColumn(t, F.col(f"_bv_src_{t}"))
    cols = list(target.columns) + [t for t in columns if t not in target.columns]
    return out.select(*cols)


def denormalise_albums(tracks: DataFrame, albums: DataFrame) -> DataFrame:
    """Fold album Name and ReleaseYear into tracks by AlbumId."""
    return backfill_by_join(tracks, albums, "AlbumId", "Id", {"Album": "Name", "ReleaseYear": "ReleaseYear"})


def backfill_track_id(bins_long: DataFrame, slices: DataFrame) -> DataFrame:
    """J4 on the long layout: add the owning TrackId to each bin row."""
    return backfill_by_join(bins_long, slices, "SubFingerprintId", "Id", {"TrackId": "TrackId"})


def evolve_schema(
    df: DataFrame,
    add: Mapping[str, str] | None = None,
    drop: Sequence[str] | None = None,
    rename: Mapping[str, str] | None = None,
    cast: Mapping[str, str] | None = None,
) -> DataFrame:
    """Idempotent schema changes: add a column if absent (NULL of the
    given type), drop if present, rename if present, retype.  Every column
    of the result is nullable (NOT NULL relaxed).

    Names are compared without case, as the session resolves them, and a
    column that the same call renames or drops is not added again, so
    running the same changes twice equals running them once."""
    out = df
    rename, add, gone = dict(rename or {}), dict(add or {}), {c.lower() for c in drop or []}
    renamed = {old.lower(): new.lower() for old, new in rename.items()}

    def has(name: str) -> bool:
        return name.lower() in {c.lower() for c in out.columns}

    for name, typ in add.items():
        if not has(name) and name.lower() not in gone and not has(renamed.get(name.lower(), name)):
            out = out.withColumn(name, F.lit(None).cast(typ))
    out = out.drop(*[c for c in out.columns if c.lower() in gone])
    for old, new in rename.items():
        if has(old) and (old.lower() == new.lower() or not has(new)):
            out = out.select(*[F.col(c).alias(new if c.lower() == old.lower() else c) for c in out.columns])
    for name, typ in (cast or {}).items():
        if has(name):
            own = next(c for c in out.columns if c.lower() == name.lower())
            out = out.withColumn(own, F.col(own).cast(typ))
    # a CASE with a NULL branch is nullable; the optimizer removes it
    return out.select(*[F.when(F.lit(False), F.lit(None)).otherwise(F.col(c)).alias(c) for c in out.columns])
