"""Deletes as complement filters.

These compute the remaining rows of each table with an anti-join, and the
removed-row counts with aggregates; ``sources.ingest.delete_tracks`` deletes
in a store.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .reshape import by_ids


def ids_frame(spark, ids: DataFrame | Sequence[int], col: str = "Id") -> DataFrame:
    if isinstance(ids, DataFrame):
        return ids.select(F.col(ids.columns[0]).cast("int").alias(col))
    return spark.createDataFrame([(int(i),) for i in ids], f"{col} int")


def delete_tracks(
    tracks: DataFrame,
    slices: DataFrame,
    ids: DataFrame | Sequence[int],
    signatures: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """D2 (and D1 for one id): remaining tables after removing the tracks,
    their slices, and (cascade) their signatures.

    Returns ``{"tracks", "slices", "signatures"?, "counts"}``; ``counts`` has
    one row per table (``table``, ``removed``) and a ``total`` row, the
    store's affected-row total (1 + n for one track with n slices).
    """
    spark = tracks.sparkSession
    ids_df = ids_frame(spark, ids, "Id").distinct()
    track_ids = ids_df.withColumnRenamed("Id", "TrackId")
    out = {
        "tracks": tracks.join(ids_df, "Id", "left_anti"),
        "slices": slices.join(track_ids, "TrackId", "left_anti"),
    }
    counts = [
        tracks.join(ids_df, "Id", "left_semi").agg(F.count(F.lit(1)).alias("removed")).select(F.lit("tracks").alias("table"), "removed"),
        slices.join(track_ids, "TrackId", "left_semi").agg(F.count(F.lit(1)).alias("removed")).select(F.lit("slices").alias("table"), "removed"),
    ]
    if signatures is not None:
        out["signatures"] = signatures.join(track_ids, "TrackId", "left_anti")
        counts.append(
            signatures.join(track_ids, "TrackId", "left_semi").agg(F.count(F.lit(1)).alias("removed")).select(F.lit("signatures").alias("table"), "removed")
        )
    per_table = counts[0]
    for c in counts[1:]:
        per_table = per_table.unionByName(c)
    total = per_table.agg(F.sum("removed").alias("removed")).select(F.lit("total").alias("table"), "removed")
    out["counts"] = per_table.unionByName(total)
    return out


def delete_track(tracks: DataFrame, slices: DataFrame, track_id: int, signatures: DataFrame | None = None) -> dict[str, DataFrame]:
    """One track; cascades to signatures when they are given (the store's
    own procedure would fail on the signature foreign key instead)."""
    return delete_tracks(tracks, slices, [track_id], signatures)


def delete_bins_by_track(bins_long: DataFrame, slices: DataFrame, track_ids: DataFrame | Sequence[int]) -> DataFrame:
    """D3: remove the long-layout rows of the slices of some tracks (rows of
    one table chosen by a join with another)."""
    spark = bins_long.sparkSession
    tids = ids_frame(spark, track_ids, "TrackId")
    gone = slices.join(tids, "TrackId", "left_semi").select(F.col("Id").alias("SubFingerprintId"))
    return by_ids(bins_long, gone, "SubFingerprintId", "left_anti")


def delete_cascade(
    tracks: DataFrame,
    slices: DataFrame,
    signatures: DataFrame,
    bins_long: DataFrame,
    track_ids: DataFrame | Sequence[int],
) -> dict[str, DataFrame]:
    """The full cascade: long bins, slices, signatures, then tracks."""
    spark = tracks.sparkSession
    res = delete_tracks(tracks, slices, track_ids, signatures)
    res["bins_long"] = delete_bins_by_track(bins_long, slices, track_ids)
    tids = ids_frame(spark, track_ids, "TrackId")
    gone = slices.join(tids, "TrackId", "left_semi").select(F.col("Id").alias("SubFingerprintId"))
    n_bins = by_ids(bins_long, gone, "SubFingerprintId", "left_semi").agg(F.count(F.lit(1)).alias("removed")).select(
        F.lit("bins_long").alias("table"), "removed"
    )
    per_table = res["counts"].filter(F.col("table") != "total").unionByName(n_bins)
    total = per_table.agg(F.sum("removed").alias("removed")).select(F.lit("total").alias("table"), "removed")
    res["counts"] = per_table.unionByName(total)
    return res
