"""Small in-memory fixtures for the golden cases (the store's own tests)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bucketvote.schema import BIN_COLS, SLICES, TRACKS

# A query and three stored vectors that agree with it in a stated number of
# positions (elsewhere every stored bin differs from the query's).
PROBE = [101 + 7 * i for i in range(25)]


def agreeing(votes: int, shift: int) -> list[int]:
    """A vector that agrees with PROBE in the first ``votes`` positions."""
    return [b if i < votes else b + shift for i, b in enumerate(PROBE)]


SIX, THREE = agreeing(6, 1000), agreeing(3, 2000)
PLAIN = [500 + 3 * i for i in range(25)]


def slices_df(spark, rows):
    """rows: (Id, TrackId, seq, at, bins, clusters-text)."""
    data = [(i, t, s, float(a), *b, c) for (i, t, s, a, b, c) in rows]
    return spark.createDataFrame(data, SLICES)


def tracks_df(spark, rows):
    return spark.createDataFrame(rows, TRACKS)


def queries_df(spark, vectors, id_col="qid"):
    return spark.createDataFrame([(i, *v) for i, v in enumerate(vectors)], [id_col, *BIN_COLS])


def ids(df, col="Id"):
    return sorted(r[col] for r in df.select(col).collect())
