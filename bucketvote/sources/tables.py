"""Builders of the store's tables from the driver's parquet tables.

Each builder returns (DataFrame, layout options for ``Store.write``).  The
long bin layout is written partitioned by position and sorted by bin, so a
posting-list read prunes to one folder and skips row groups by bin; slices
are clustered by (TrackId, SequenceNumber).
"""

from __future__ import annotations

from . import bindings as B


def _plain(fn):
    return lambda spark, d: (fn(spark, d), {})


def _by_track(fn, then):
    """Slices clustered by track: range-partitioned and sorted by (TrackId,
    SequenceNumber), so by-track reads and deletes touch few row groups.  Rows
    move as ``fn`` makes them; ``then`` adds the columns that follow from them."""

    def build(spark, d):
        narrow = fn(spark, d)
        return then(narrow), {"sort_within": ["TrackId", "SequenceNumber"], "moved": narrow, "then": then}

    return build


#: The long layout: ranges cut a bin that many slices share by slice.
_LONG = {"partition_by": ["HashTable"], "sort_within": ["HashBin"], "cut_by": ["SubFingerprintId"]}


def _bins_long(spark, d):
    from ..operators.reshape import bins_to_long

    return bins_to_long(B.slice_bins(spark, d)), _LONG


def _doc_bins_long(spark, d):
    from ..operators.reshape import bins_to_long
    from .store import testdata_store

    return bins_to_long(testdata_store(spark, d).get("doc_slices")), _LONG


BUILDERS = {
    "tracks": _plain(B.tracks_a),
    "tracks_raw": _plain(B.tracks_a_raw_length),
    "tracks_album": _plain(B.tracks_with_album_id),
    "slices": _by_track(B.slices_a_narrow, B.slices_a_wide),
    "signatures": _plain(B.signatures_a),
    "albums": _plain(B.albums_a),
    "bins_long": _bins_long,
    "doc_slices": _plain(B.doc_slices_b),
    "doc_bins_long": _doc_bins_long,
    "doc_tracks": _plain(B.doc_tracks_c),
    "line_slices": lambda spark, d: (B.line_slices_c(spark, d).checkpoint(), {"sort_within": ["TrackId", "SequenceNumber"]}),
    "query_lines": _plain(B.query_lines_c),
    "query_docs": _plain(B.query_docs_b),
}
