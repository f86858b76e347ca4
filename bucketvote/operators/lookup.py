"""Single-query vote lookups (one query vector of 25 bins against the store).

A stored slice is a candidate when it agrees with the query in at least T
positions (position i of the slice against position i of the query).
Instead of 25 posting-list reads glued by UNION ALL and a GROUP BY, the
lookup is one scan with a codegen'd filter: the sum of 25 equality flags.
An OR of the equalities on the pigeonhole positions is added in front; it is
implied by the vote rule and reaches the parquet reader as a pushed filter,
so row groups whose bin statistics exclude the query are skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bins import (
    any_agree_literal,
    check_query_bins,
    decode_clusters,
    effective_threshold,
    pigeonhole_positions,
    votes_vs_literal,
)
from ..functions.like import like
from ..schema import BIN_COLS, N_BINS

VOTES = "votes"


def cluster_predicate(clusters: Sequence[str] | None, mode: str = "text", collation: str | None = None, dialect: str = "spark"):
    """Label restriction, or None when no labels are given.

    ``mode="text"`` (default) is the store's rule: the stored comma text
    must contain the labels joined by ',' as a LIKE pattern (labels must be
    adjacent and in that order; ``%``/``_`` in a label are wildcards; NULL
    never matches).  ``mode="any"`` is a true set test: some label of the
    slice equals some given label.  ``collation`` and ``dialect`` apply to the
    text mode: with ``dialect="tsql"`` brackets are character classes, as in
    the store's own LIKE (``functions.like``).
    """
    labels = list(clusters or [])
    if not labels:
        return None
    if mode == "text":
        if dialect == "tsql":
            return like(F.col("Clusters"), "%" + ",".join(labels) + "%", collation)
        if dialect != "spark":
            raise ValueError(f"unknown LIKE dialect {dialect!r}")
        pattern = F.lit("%" + ",".join(labels) + "%")
        if collation is None:
            return F.like(F.col("Clusters"), pattern)
        return F.like(F.collate("Clusters", collation), F.collate(pattern, collation))
    if mode == "any":
        return F.arrays_overlap(decode_clusters("Clusters"), F.array(*[F.lit(x) for x in labels]))
    raise ValueError(f"unknown cluster mode {mode!r}")


def vote_lookup(
    slices: DataFrame,
    bins: Sequence[int],
    threshold: int | None,
    clusters: Sequence[str] | None = None,
    mode: str = "text",
    with_votes: bool = False,
    collation: str | None = None,
    dialect: str = "spark",
) -> DataFrame:
    """Stored slices with >= T positional agreements with ``bins`` (V1/V2/V4).

    T <= 0 acts as 1 (a slice with no agreement is never a candidate); NULL T
    gives no rows; T > 25 gives no rows.  Full rows are returned, plus a
    ``votes`` column when ``with_votes``.
    """
    bins = check_query_bins(bins)
    t = effective_threshold(threshold)
    if t is None or t > N_BINS:
        out = slices.filter(F.lit(False))
        return out.withColumn(VOTES, F.lit(0)) if with_votes else out
    pre = any_agree_literal(bins, pigeonhole_positions(t))
    votes = votes_vs_literal(bins)
    cond = pre & (votes >= F.lit(t))
    cp = cluster_predicate(clusters, mode, collation, dialect)
    if cp is not None:
        cond = cond & cp
    out = slices.filter(cond)
    if with_votes:
        out = out.withColumn(VOTES, votes)
    return out


def vote_lookup_clusters(slices, bins, threshold, clusters, mode="text", collation=None, dialect="spark"):
    """V2: vote lookup restricted by cluster labels (empty list -> V1)."""
    return vote_lookup(slices, bins, threshold, clusters=clusters, mode=mode, collation=collation, dialect=dialect)


def vote_lookup_votes(slices, bins, threshold, clusters=None, mode="text"):
    """V4: as V1 and keep the number of votes."""
    return vote_lookup(slices, bins, threshold, clusters=clusters, mode=mode, with_votes=True)


def vote_lookup_group(
    slices: DataFrame,
    tracks: DataFrame,
    bins: Sequence[int],
    threshold: int | None,
    group: str | None,
    group_col: str = "GroupId",
    collation: str | None = None,
) -> DataFrame:
    """V5: V1 restricted to slices whose track has ``group_col`` equal to
    ``group`` (exact text equality; NULL group matches nothing).

    The candidate set is a semi-join against the tracks of that group;
    Catalyst broadcasts the group's track ids when their size estimate is
    under the broadcast threshold, else it shuffles.
    """
    hits = vote_lookup(slices, bins, threshold)
    if group is None:
        return hits.filter(F.lit(False))
    from .catalog import text_eq

    ids = tracks.filter(text_eq(group_col, group, collation)).select(F.col("Id").alias("TrackId"))
    return hits.join(ids, "TrackId", "left_semi")


def vote_lookup_inverted(bins_long: DataFrame, bins: Sequence[int], threshold: int | None, base: int = 1) -> DataFrame:
    """V6: the vote over the long (inverted) layout.

    25 posting-list reads, one per (position, bin): with the long table
    partitioned by ``HashTable`` and sorted by ``HashBin``, each read is
    pruned to one position folder and pushes one bin equality to parquet, so
    it touches only the row groups whose bin range holds the query bin.
    Hits are counted per slice (partial then final hash aggregate) and kept
    when >= T.  Returns (Id, votes).
    """
    bins = check_query_bins(bins)
    t = effective_threshold(threshold)
    if t is None or t > N_BINS:
        return bins_long.select(F.col("SubFingerprintId").alias("Id"), F.lit(0).cast("long").alias(VOTES)).filter(F.lit(False))
    hits = None
    for i, b in enumerate(bins):
        one = bins_long.filter((F.col("HashTable") == F.lit(i + base)) & (F.col("HashBin") == F.lit(int(b)))).select(
            "SubFingerprintId"
        )
        hits = one if hits is None else hits.unionAll(one)
    return (
        hits.groupBy(F.col("SubFingerprintId").alias("Id"))
        .agg(F.count(F.lit(1)).alias(VOTES))
        .filter(F.col(VOTES) >= F.lit(t))
    )


def union_posting_lists(slices: DataFrame, bins: Sequence[int]) -> DataFrame:
    """The bag union of the 25 posting lists: one row (Id, position) per
    agreeing position.  Rows that agree nowhere are dropped by a pushed OR
    filter before the 25-way explode."""
    bins = check_query_bins(bins)
    q = F.array(*[F.lit(int(b)) for b in bins])
    return (
        slices.filter(any_agree_literal(bins))
        .select("Id", F.posexplode(F.array(*[F.col(c) for c in BIN_COLS])).alias("position", "bin"))
        .filter(F.col("bin") == F.element_at(q, F.col("position") + 1))
        .select("Id", F.col("position").cast("int").alias("position"))
    )


def posting_list(slices: DataFrame, position: int, bin_value: int) -> DataFrame:
    """Ids whose bin at one (0-based) position equals a value."""
    if not 0 <= position < N_BINS:
        raise ValueError(f"position must be in 0..{N_BINS - 1}")
    return slices.filter(F.col(BIN_COLS[position]) == F.lit(int(bin_value))).select("Id")


def candidates_join_back(slices: DataFrame, ids: DataFrame) -> DataFrame:
    """Slices whose Id is in a voted id set (semi-join; no duplicate Id)."""
    return slices.join(ids.select("Id"), "Id", "left_semi")
