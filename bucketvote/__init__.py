"""bucketvote: bucket-vote similarity search and its catalog, on Spark.

Main entry points (all take and return DataFrames):

* ``vote_lookup`` / ``vote_lookup_votes`` / ``vote_lookup_group`` /
  ``vote_lookup_inverted`` — one query vector of 25 bins;
* ``vote_lookup_batch`` / ``vote_join`` / ``similar_pairs`` — many vectors;
* ``identify_tracks`` — best matching track per query clip;
* ``minhash_bins`` — 25 MinHash bins per text;
* ``VoteStore`` — the store's calls over a folder of parquet tables.
"""

from .functions.minhash import minhash_bins
from .operators.batch import similar_pairs, vote_join, vote_lookup_batch, vote_lookup_batch_votes
from .operators.identify import identify_tracks
from .operators.lookup import (
    union_posting_lists,
    vote_lookup,
    vote_lookup_clusters,
    vote_lookup_group,
    vote_lookup_inverted,
    vote_lookup_votes,
)
from .plans.strategy import VoteJoinPlan
from .service import VoteStore

__all__ = [
    "VoteJoinPlan",
    "VoteStore",
    "identify_tracks",
    "minhash_bins",
    "similar_pairs",
    "union_posting_lists",
    "vote_join",
    "vote_lookup",
    "vote_lookup_batch",
    "vote_lookup_batch_votes",
    "vote_lookup_clusters",
    "vote_lookup_group",
    "vote_lookup_inverted",
    "vote_lookup_votes",
]
