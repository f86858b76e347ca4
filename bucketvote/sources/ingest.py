"""The write paths of a store: rows are numbered, checked, and then written.

Slices and their posting rows go out in one write, so no reader sees the one
without the other.  Ids come from a range that the writer claims once its rows
are counted; with a batch name (a stream's micro-batch), a repeated call
claims the same range and replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog as C
from ..operators.constraints import enforce
from ..operators.reshape import bins_to_long
from ..schema import BINS_LONG, N_BINS, SIGNATURES, SLICES, TRACKS
from . import files
from .store import PART, PARTS, Store


def create_tables(store: Store, parts: int = PARTS) -> None:
    """The tables of a vote store, where they are not there yet.  Slices and
    signatures are dealt by their track, the inverted layout by position and
    by its slices' track."""
    store.create("tracks", TRACKS, key="Id", parts=parts)
    store.create("slices", SLICES, key="TrackId", sort_within=["TrackId", "SequenceNumber"], parts=parts)
    store.create("signatures", SIGNATURES, key="TrackId", parts=parts)
    store.create("bins_long", BINS_LONG, sort_within=["HashBin", "SubFingerprintId"], parts=parts)


def _none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "Id long")


def _numbered(store: Store, name: str, ranked: DataFrame, batch: str | None) -> DataFrame:
    """``ranked`` rows, whose Ids are 1, 2, ..., with Ids that no other writer
    has."""
    first = store.reserve(name, ranked.count(), batch)
    return ranked.withColumn("Id", (F.col("Id") + F.lit(first)).cast(ranked.schema["Id"].dataType))


def _parents(store: Store) -> DataFrame | None:
    return store.read("tracks") if store.has("tracks") else None


def insert_tracks(store: Store, tracks: DataFrame, order: Sequence[str], batch: str | None = None) -> DataFrame:
    """I2 on a store; returns the new rows."""
    ranked = enforce("tracks", C.insert_tracks(_none(store.spark), tracks, order).checkpoint())
    new = _numbered(store, "tracks", ranked, batch)
    store.append("tracks", new, batch)
    return new


def insert_slices(store: Store, hashed: DataFrame, order: Sequence[str], track_id: int | None = None, batch: str | None = None) -> DataFrame:
    """I3 and I5 on a store: hashed slices (TrackId unless ``track_id`` names
    it, bins, SequenceNumber, SequenceAt, clusters) and their posting rows.
    Returns the new slices.  Slices that break a constraint raise
    ``ConstraintError``; nothing is written then."""
    aside = []

    def kept(placed: DataFrame) -> DataFrame:
        aside.append(store.aside(placed))
        return aside[-1][0]

    # the numbering lies in files: what follows it is the same each time it is read
    own = {c.split(".")[0].strip("`").lower() for c in ["TrackId", "bins", "SequenceNumber", "SequenceAt", "clusters", *order]}
    try:
        ranked = C.insert_hashes(_none(store.spark), hashed.select(*[F.col(f"`{c}`") for c in hashed.columns if c.lower() in own]), list(order), track_id=track_id, kept=kept)
        new = store.arranged("slices", _numbered(store, "slices", enforce("slices", ranked, _parents(store)), batch))
    finally:
        for _, at in aside:
            files.remove(store.spark, at)
    together = {"slices": [new]}
    if store.has("bins_long"):
        # the slices move, a position's long rows are made where their slices lie
        together["bins_long"] = [bins_to_long(new, keep=[PART], position=p) for p in range(N_BINS)]
    store.append_arranged(together, batch)
    return new.drop(PART)


def insert_signatures(store: Store, signatures: DataFrame, order: Sequence[str], batch: str | None = None) -> DataFrame:
    """I4 on a store; returns the new rows."""
    ranked = C.insert_signatures(_none(store.spark), signatures, order).checkpoint()
    new = _numbered(store, "signatures", enforce("signatures", ranked, _parents(store)), batch)
    store.append("signatures", new, batch)
    return new


def import_rows(store: Store, name: str, rows: DataFrame, batch: str | None = None) -> None:
    """Rows that bring their own keys, as from another store.  A key that
    repeats among them or is in the table raises ``ConstraintError``, as does
    any other broken constraint; nothing is written then.  Two imports of one
    key at the same time are not told.  Later claims of Ids start above what
    the table holds only if none was claimed before: import first."""
    rows = rows.checkpoint()
    parents = _parents(store) if name in ("slices", "signatures") else None
    store.append(name, enforce(name, rows, parents, store.read(name)), batch)


def delete_tracks(store: Store, track_ids: DataFrame | Sequence[int]) -> DataFrame:
    """D1, D2 and D4 on a store: the slices of the tracks with their posting
    rows by one write, then signatures, then the tracks.  Returns (table,
    removed) rows and a ``total`` row."""
    from ..operators.deletes import ids_frame

    spark = store.spark
    tracks = ids_frame(spark, track_ids, "TrackId").distinct().checkpoint()
    own = {"slices": (tracks, "TrackId")}
    if store.has("bins_long"):
        gone = store.rows("slices").join(tracks, "TrackId", "left_semi").select(F.col("Id").alias("SubFingerprintId"), PART)
        own = {"bins_long": (gone.checkpoint(), "SubFingerprintId"), **own}
    removed = store.delete_together(own)
    if store.has("signatures"):
        removed["signatures"] = store.delete_rows("signatures", tracks, "TrackId")
    removed["tracks"] = store.delete_rows("tracks", tracks.withColumnRenamed("TrackId", "Id"), "Id")
    rows = [*removed.items(), ("total", sum(removed.values()))]
    return spark.createDataFrame(rows, "table string, removed long")
