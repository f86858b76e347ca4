"""Table schemas of the store and the names shared by every operator.

The store keeps three live tables (tracks, slices, signatures) and one
historical long layout of the bins.  Slices carry their 25 hash bins as 25
integer columns (``HashTable_0`` .. ``HashTable_24``); user-facing code may
also see them packed into one ``array<int>`` column named ``bins``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The number of bins per slice, and the text limits of the
# stored columns (ISRC 50, other track texts 255, clusters 255, signature
# 4096 bytes).
N_BINS = 25
ISRC_MAX = 50
TEXT_MAX = 255
CLUSTERS_MAX = 255
SIGNATURE_MAX = 4096

BIN_COLS = [f"HashTable_{i}" for i in range(N_BINS)]

TRACKS = T.StructType(
    [
        T.StructField("Id", T.IntegerType(), False),
        T.StructField("ISRC", T.StringType(), True),
        T.StructField("Artist", T.StringType(), True),
        T.StructField("Title", T.StringType(), True),
        T.StructField("Album", T.StringType(), True),
        T.StructField("ReleaseYear", T.IntegerType(), True),
        T.StructField("Length", T.DoubleType(), True),
    ]
)

TRACK_FIELDS = ["ISRC", "Artist", "Title", "Album", "ReleaseYear", "Length"]

SLICES = T.StructType(
    [
        T.StructField("Id", T.LongType(), False),
        T.StructField("TrackId", T.IntegerType(), False),
        T.StructField("SequenceNumber", T.IntegerType(), False),
        T.StructField("SequenceAt", T.DoubleType(), False),
    ]
    + [T.StructField(c, T.IntegerType(), False) for c in BIN_COLS]
    + [T.StructField("Clusters", T.StringType(), True)]
)

SLICE_COLS = [f.name for f in SLICES.fields]

SIGNATURES = T.StructType(
    [
        T.StructField("Id", T.IntegerType(), False),
        T.StructField("Signature", T.BinaryType(), False),
        T.StructField("TrackId", T.IntegerType(), False),
    ]
)

# Historical long layout: one row per (slice, position); HashTable is 1-based.
BINS_LONG = T.StructType(
    [
        T.StructField("HashTable", T.IntegerType(), False),
        T.StructField("HashBin", T.LongType(), False),
        T.StructField("SubFingerprintId", T.LongType(), False),
    ]
)

ALBUMS = T.StructType(
    [
        T.StructField("Id", T.IntegerType(), False),
        T.StructField("Name", T.StringType(), True),
        T.StructField("ReleaseYear", T.IntegerType(), True),
    ]
)

# Columns that the store declares NOT NULL, per table.
REQUIRED = {
    "tracks": ["Id"],
    "slices": ["Id", "TrackId", "SequenceNumber", "SequenceAt", *BIN_COLS],
    "signatures": ["Id", "Signature", "TrackId"],
    "bins_long": ["HashTable", "HashBin", "SubFingerprintId"],
}

# Keys that are unique, per table.
KEYS = {"tracks": ["Id"], "slices": ["Id"], "signatures": ["Id"], "bins_long": ["HashTable", "HashBin", "SubFingerprintId"]}

# Text limits per table (characters for text, bytes for binary).
LENGTH_LIMITS = {
    "tracks": {"ISRC": ISRC_MAX, "Artist": TEXT_MAX, "Title": TEXT_MAX, "Album": TEXT_MAX},
    "slices": {"Clusters": CLUSTERS_MAX},
    "signatures": {"Signature": SIGNATURE_MAX},
    "bins_long": {},
}
