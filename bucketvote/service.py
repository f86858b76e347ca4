"""A service object over a store: the calls a user of the store makes, each a
DataFrame job over the store's tables.

Writes go through ``sources.ingest``: rows are checked against the table's
constraints, numbered and written.  Reads return lazy DataFrames.  Bulk forms
take DataFrames; the single-row forms exist for parity with one-call-per-item
clients and return the one generated id.  Any number of writers may add rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import batch as BT
from .operators import catalog as C
from .operators import lookup as L
from .operators.constraints import enforce
from .plans.strategy import DEFAULT_PLAN, VoteJoinPlan
from .schema import TRACK_FIELDS, TRACKS
from .sources import ingest as IN
from .sources.store import PARTS, Store

# Fixed value: the threshold used when the caller gives none (two of the
# store's golden cases need <= 4).
DEFAULT_THRESHOLD = 4


class VoteStore:
    def __init__(self, spark: SparkSession, root: str | None = None, plan: VoteJoinPlan = DEFAULT_PLAN, parts: int = PARTS):
        self.spark = spark
        self.store = Store(spark, root)
        self.plan = plan
        IN.create_tables(self.store, parts)

    # ---- tracks -------------------------------------------------------------
    def add_tracks(self, tracks: DataFrame, order: Sequence[str]) -> DataFrame:
        """Bulk insert; returns the inserted rows with their new Ids.  Rows
        that break a constraint raise and nothing is written."""
        return IN.insert_tracks(self.store, tracks, order)

    def add_track(self, isrc, artist, title, album, release_year, length) -> int:
        """One track; returns its Id."""
        row = self.spark.createDataFrame([(0, isrc, artist, title, album, release_year, None if length is None else float(length))], TRACKS)
        enforce("tracks", row)
        track_id = self.store.reserve("tracks", 1) + 1
        self.store.append("tracks", row.withColumn("Id", F.lit(track_id)))
        return track_id

    def tracks(self) -> DataFrame:
        return C.read_tracks(self.store.read("tracks"))

    def track(self, track_id: int) -> DataFrame:
        return C.track_by_id(self.store.read("tracks"), track_id)

    def tracks_for(self, ids: DataFrame) -> DataFrame:
        return C.tracks_by_ids(self.store.read("tracks"), ids)

    def tracks_with_isrc(self, isrc: str) -> DataFrame:
        return C.track_by_isrc(self.store.read("tracks"), isrc)

    def tracks_titled(self, artist: str, title: str) -> DataFrame:
        return C.tracks_by_artist_title(self.store.read("tracks"), artist, title)

    def remove_track(self, track_id: int) -> int:
        """Removes the track, its slices (with their inverted rows) and its
        signatures; returns the number of rows removed (1 + slices +
        signatures)."""
        counts = {r["table"]: r["removed"] for r in IN.delete_tracks(self.store, [track_id]).collect()}
        return int(counts["total"] - counts["bins_long"])

    # ---- slices ---------------------------------------------------------------
    def add_slices(self, hashed: DataFrame, track_id: int | None = None, order: Sequence[str] = ("SequenceNumber",)) -> DataFrame:
        """``hashed``: (bins array<int>, SequenceNumber, SequenceAt, clusters
        array<string>), all of one track, or with a TrackId column.  The slices
        and their rows in the inverted layout are written together.  Slices of
        an unknown track or with a NULL bin raise and nothing is written."""
        return IN.insert_slices(self.store, hashed, order, track_id)

    def slices_of(self, track_id: int) -> DataFrame:
        return C.hashes_by_track(self.store.read("slices"), track_id)

    def candidates(
        self, bins: Sequence[int], threshold: int | None = DEFAULT_THRESHOLD, clusters: Sequence[str] = (), collation: str | None = None, dialect: str = "spark"
    ) -> DataFrame:
        """Candidates of one query vector: (Id, TrackId, SequenceNumber,
        SequenceAt as float, bins) — no labels, as the store returns them."""
        if threshold and threshold > 0:
            # posting lists of the inverted layout, then the slices they name
            ids = L.vote_lookup_inverted(self.store.read("bins_long"), bins, threshold).select("Id")
            rows = self.store.read("slices").join(ids, "Id", "left_semi")
            wanted = L.cluster_predicate(list(clusters), "text", collation, dialect)
            return self._candidates(rows if wanted is None else rows.filter(wanted))
        return self._candidates(L.vote_lookup(self.store.read("slices"), bins, threshold, clusters=list(clusters), collation=collation, dialect=dialect))

    def candidates_of_all(
        self, queries: DataFrame, threshold: int | None = DEFAULT_THRESHOLD, clusters: Sequence[str] = (), collation: str | None = None, dialect: str = "spark"
    ) -> DataFrame:
        """Distinct candidates of many query vectors (qid + 25 bins)."""
        hits = BT.vote_lookup_batch(self.store.read("slices"), queries, threshold, clusters=list(clusters), plan=self.plan, collation=collation, dialect=dialect)
        return self._candidates(hits)

    @staticmethod
    def _candidates(hits: DataFrame) -> DataFrame:
        from .functions.bins import pack_bins

        return pack_bins(hits).select(
            "Id", "TrackId", "SequenceNumber", F.col("SequenceAt").cast("float").alias("SequenceAt"), "bins"
        )

    def identify(self, queries: DataFrame, threshold: int = DEFAULT_THRESHOLD, set_id: str = "set_id") -> DataFrame:
        """Matched tracks per query clip (``set_id``, ``qid`` + 25 bins), one
        entry per track, with the best one flagged."""
        from .operators.identify import identify_tracks

        return identify_tracks(self.store.read("slices"), queries, threshold, set_id=set_id, plan=self.plan)

    # ---- signatures ------------------------------------------------------------
    def add_signatures(self, signatures: DataFrame, order: Sequence[str]) -> DataFrame:
        return IN.insert_signatures(self.store, signatures, order)

    def signatures_of(self, track_id: int) -> DataFrame:
        return C.signatures_by_track(self.store.read("signatures"), track_id)


__all__ = ["VoteStore", "DEFAULT_THRESHOLD", "TRACK_FIELDS"]
