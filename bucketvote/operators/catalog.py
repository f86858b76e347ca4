"""Catalog work on tracks, slices and signatures: keyed lookups, reads by
track, and bulk appends with generated ids.

Lookups are filters that Catalyst pushes into the parquet scan.  Appends are
one bulk job (the store inserts one row per call): ids come from
``assign_ids`` (range-partitioned numbering after ``max(Id)``), bins are
spread to 25 columns, labels are joined to comma text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bins import decode_clusters, encode_clusters, spread_bins
from ..schema import BIN_COLS, SLICE_COLS, TRACK_FIELDS
from .ids import assign_ids


# ---- tracks -------------------------------------------------------------
def read_tracks(tracks: DataFrame) -> DataFrame:
    """Full scan; no order promised."""
    return tracks


def insert_tracks(tracks: DataFrame, new: DataFrame, order: Sequence[str]) -> DataFrame:
    """The new track rows with generated Ids after ``max(Id)``, in the
    order of ``order``.  All six fields are taken from ``new``."""
    rows = new.select(*order, *[F.col(c) for c in TRACK_FIELDS if c not in order])
    with_ids = assign_ids(rows, order, start=tracks.select("Id"), out="Id", dtype="int")
    return with_ids.select("Id", *TRACK_FIELDS)


def track_by_id(tracks: DataFrame, track_id: int | None) -> DataFrame:
    """L1: zero or one row."""
    if track_id is None:
        return tracks.filter(F.lit(False))
    return tracks.filter(F.col("Id") == F.lit(int(track_id)))


def tracks_by_ids(
    tracks: DataFrame, ids: DataFrame, id_col: str = "Id", ordinal: str = "ordinal", ordered: bool = False
) -> DataFrame:
    """L2: one output row per *input* id (repeats kept, input order in
    ``ordinal``); a missing id gives NULL track fields.  A left join: Catalyst
    broadcasts the side that its size estimate puts under the threshold.
    With ``ordered`` the rows come back in input order (a range-partitioned
    global sort)."""
    req = ids.select(F.col(ordinal), F.col(id_col).alias("_bv_req"))
    out = req.join(tracks, req["_bv_req"] == tracks["Id"], "left").select(
        ordinal, F.col("_bv_req").alias("RequestedId"), *tracks.columns
    )
    return out.orderBy(ordinal) if ordered else out


def text_eq(col: str, value: str, collation: str | None = None):
    """Text equality; ``collation`` (for example ``UTF8_LCASE`` for a
    case-insensitive compare, ``UTF8_BINARY_RTRIM`` to ignore trailing
    blanks) replaces Spark's default binary compare."""
    if collation is None:
        return F.col(col) == F.lit(value)
    return F.collate(F.col(col), collation) == F.collate(F.lit(value), collation)


def tracks_by_artist_title(
    tracks: DataFrame, artist: str | None, title: str | None, collation: str | None = None
) -> DataFrame:
    """L3: rows with both equal; a NULL argument matches nothing."""
    if artist is None or title is None:
        return tracks.filter(F.lit(False))
    return tracks.filter(text_eq("Artist", artist, collation) & text_eq("Title", title, collation))


def track_by_isrc(tracks: DataFrame, isrc: str | None, collation: str | None = None) -> DataFrame:
    """L4: the first track with this ISRC (ISRC is not unique: we take the
    smallest Id), or no row."""
    if isrc is None:
        return tracks.filter(F.lit(False))
    return first_or_none(tracks.filter(text_eq("ISRC", isrc, collation)), ["Id"])


def first_track_per_isrc(tracks: DataFrame) -> DataFrame:
    """L4 for all ISRCs at once: per ISRC the row with the smallest Id
    (an aggregate with map-side partial step: a hot ISRC stays cheap)."""
    cols = [c for c in tracks.columns if c != "ISRC"]
    best = tracks.filter(F.col("ISRC").isNotNull()).groupBy("ISRC").agg(
        F.min_by(F.struct(*cols), F.col("Id")).alias("_bv_t")
    )
    return best.select("ISRC", "_bv_t.*").select(*tracks.columns)


def first_or_none(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """M7: the first row in ``order``, or no row (a top-1: the limit is the
    feature)."""
    return df.orderBy(*order).limit(1)


# ---- slices ---------------------------------------------------------------
def insert_hashes(
    slices: DataFrame,
    hashed: DataFrame,
    order: Sequence[str],
    track_id: int | None = None,
    kept: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Append hashed slices given as (TrackId, bins array<int>,
    SequenceNumber, SequenceAt, clusters array<string>).  Bins are spread to
    25 columns (a row whose array is not 25 long raises), labels joined with
    ',', Ids generated after ``max(Id)``.  With ``track_id`` every row goes
    to that track (the single-track call of the store)."""
    rows = hashed
    if track_id is not None:
        rows = rows.withColumn("TrackId", F.lit(int(track_id)))
    rows = spread_bins(rows, "bins")
    rows = rows.withColumn("Clusters", encode_clusters(F.col("clusters")))
    with_ids = assign_ids(rows, order, start=slices.select("Id"), out="Id", dtype="long", kept=kept)
    return with_ids.select(
        "Id",
        F.col("TrackId").cast("int").alias("TrackId"),
        F.col("SequenceNumber").cast("int").alias("SequenceNumber"),
        F.col("SequenceAt").cast("double").alias("SequenceAt"),
        *BIN_COLS,
        "Clusters",
    ).select(*SLICE_COLS)


def hashes_by_track(slices: DataFrame, track_id: int | None) -> DataFrame:
    """The slices of one track as (Id, bins array, SequenceNumber,
    StartsAt as float, clusters array); NULL or '' labels -> empty list.
    No track (None): no rows."""
    own = F.lit(False) if track_id is None else F.col("TrackId") == F.lit(int(track_id))
    return slices.filter(own).select(
        "Id",
        F.array(*[F.col(c) for c in BIN_COLS]).alias("bins"),
        "SequenceNumber",
        F.col("SequenceAt").cast("float").alias("StartsAt"),
        decode_clusters("Clusters").alias("clusters"),
    )


def slice_by_id(slices: DataFrame, slice_id: int) -> DataFrame:
    """One slice by its (long) Id."""
    return slices.filter(F.col("Id") == F.lit(int(slice_id)).cast("long"))


# ---- signatures -------------------------------------------------------------
def insert_signatures(signatures: DataFrame, new: DataFrame, order: Sequence[str]) -> DataFrame:
    """I4: append (Signature, TrackId) with generated Ids."""
    with_ids = assign_ids(new, order, start=signatures.select("Id"), out="Id", dtype="int")
    return with_ids.select("Id", F.col("Signature").cast("binary").alias("Signature"), F.col("TrackId").cast("int").alias("TrackId"))


def signatures_by_track(signatures: DataFrame, track_id: int) -> DataFrame:
    """All signatures of a track."""
    return signatures.filter(F.col("TrackId") == F.lit(int(track_id)))


def track_by_signature_id(tracks: DataFrame, signatures: DataFrame, signature_id: int) -> DataFrame:
    """The track owning a signature (inner equi-join, projected)."""
    sig = signatures.filter(F.col("Id") == F.lit(int(signature_id))).select(F.col("TrackId"))
    return tracks.join(sig, tracks["Id"] == sig["TrackId"], "inner").select(*tracks.columns)


# ---- long layout sink --------------------------------------------------------
def append_bins_routed(bins_long: DataFrame, path: str) -> DataFrame:
    """Append (HashTable, HashBin, SubFingerprintId) rows routed to the
    folder of their position (``HashTable=k``).  Range partitioning keeps the
    write balanced.  Returns the table read back."""
    spark = bins_long.sparkSession
    (
        bins_long.select("HashTable", "HashBin", "SubFingerprintId")
        .repartitionByRange("HashTable", "HashBin")
        .sortWithinPartitions("HashTable", "HashBin")
        .write.mode("append")
        .partitionBy("HashTable")
        .parquet(path)
    )
    return spark.read.parquet(path).select("HashTable", "HashBin", "SubFingerprintId")
