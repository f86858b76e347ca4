"""Properties: strategies agree, T <= 0 acts as 1, batch = union of single
lookups, layout round trips, and the scalable numbering equals the window
form (including a key holding a third of all rows)."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bucketvote.operators import batch as BT
from bucketvote.operators import ids as IDS
from bucketvote.operators import lookup as L
from bucketvote.operators import reshape as S
from bucketvote.plans.strategy import VoteJoinPlan
from bucketvote.schema import BIN_COLS, SLICE_COLS
from bucketvote.sources.bindings import query_bins_a
from bucketvote.sources.store import testdata_store as open_store

from .fixtures import ids, queries_df


@pytest.fixture(scope="module")
def store(spark, smoke_dir):
    return open_store(spark, smoke_dir)


def test_t_le_zero_is_one(store):
    s = store.get("slices")
    q = query_bins_a(77)
    assert ids(L.vote_lookup(s, q, 0)) == ids(L.vote_lookup(s, q, 1)) == ids(L.vote_lookup(s, q, -3))


def test_votes_bounded(store):
    s = store.get("slices")
    v = L.vote_lookup_votes(s, query_bins_a(77), 1).agg(F.min("votes"), F.max("votes")).collect()[0]
    assert 1 <= v[0] <= v[1] <= 25


def test_inverted_equals_wide(store):
    s, bl = store.get("slices"), store.get("bins_long")
    for t in (1, 4, 8, 25):
        q = query_bins_a(123)
        a = {(r["Id"], r["votes"]) for r in L.vote_lookup_votes(s, q, t).collect()}
        b = {(r["Id"], r["votes"]) for r in L.vote_lookup_inverted(bl, q, t).collect()}
        assert a == b


@pytest.mark.parametrize(
    "plan",
    [
        VoteJoinPlan(strategy="broadcast"),
        VoteJoinPlan(strategy="shuffle"),
        VoteJoinPlan(strategy="shuffle", skew_factor=0.01),
        VoteJoinPlan(strategy="count", skew_factor=0.01),
    ],
)
def test_batch_is_union_of_singles(spark, store, plan):
    s = store.get("slices")
    keys = [3, 50, 700, 1499]
    q = queries_df(spark, [query_bins_a(k) for k in keys])
    for t in (4, 8):
        want = set()
        for k in keys:
            want |= set(ids(L.vote_lookup(s, query_bins_a(k), t)))
        got = set(ids(BT.vote_lookup_batch(s, q, t, plan=plan)))
        assert got == want


def test_batch_pairs_equal_singles_with_votes(spark, store):
    s = store.get("doc_slices")
    q = store.get("query_docs")
    pairs = {(r["qid"], r["Id"], r["votes"]) for r in BT.vote_lookup_batch_votes(s, q, 3).collect()}
    want = set()
    for row in q.collect():
        vec = [row[c] for c in BIN_COLS]
        for r in L.vote_lookup_votes(s, vec, 3).collect():
            want.add((row["qid"], r["Id"], r["votes"]))
    assert pairs == want


def test_wide_long_wide_identity(store):
    s = store.get("slices")
    back = S.bins_to_wide(S.bins_to_long(s), s)
    assert back.select(*SLICE_COLS).exceptAll(s.select(*SLICE_COLS)).count() == 0
    assert back.count() == s.count()


def test_bins_to_wide_drops_incomplete_and_checks_duplicates(spark, store):
    s = store.get("slices")
    bl = S.bins_to_long(s)
    one = s.agg(F.min("Id")).collect()[0][0]
    missing = bl.filter(~((F.col("SubFingerprintId") == one) & (F.col("HashTable") == 3)))
    assert S.bins_to_wide(missing, s).filter(F.col("Id") == one).count() == 0
    dup = bl.unionByName(bl.filter((F.col("SubFingerprintId") == one) & (F.col("HashTable") == 3)).withColumn("HashBin", F.lit(999).cast("long")))
    with pytest.raises(Exception):
        S.bins_to_wide(dup, s).collect()
    assert S.bins_to_wide(dup, s, on_duplicate="expand").filter(F.col("Id") == one).count() == 2


@pytest.mark.parametrize("parts", [7, None])
def test_sequence_within_equals_window_with_hot_key(spark, parts):
    rnd = random.Random(3)
    def key():
        r = rnd.random()
        return 0 if r < 0.34 else (None if r < 0.40 else rnd.randrange(1, 50))

    rows = [(key(), rnd.randrange(10_000), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t int, u int")
    got = IDS.sequence_within(df, ["k"], ["t", "u"], out="seq", num_partitions=parts)
    w = Window.partitionBy("k").orderBy("t", "u")
    want = df.withColumn("seq", F.row_number().over(w) - 1)
    assert got.select("u", "seq").exceptAll(want.select("u", "seq")).count() == 0
    assert got.count() == 3000


def test_assign_ids_dense_and_ordered(spark):
    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "k int")
    base = spark.createDataFrame([(41,)], "m int")
    out = IDS.assign_ids(df, ["k"], start=base).orderBy("k").collect()
    assert [r["Id"] for r in out] == list(range(42, 143))


def test_inverted_batch_equals_wide_batch(store):
    q, s = store.get("query_docs"), store.get("doc_slices")
    for t in (1, 3, 5):
        a = {(r["qid"], r["Id"], r["votes"]) for r in BT.vote_lookup_batch_votes(s, q, t).collect()}
        b = {(r["qid"], r["Id"], r["votes"]) for r in BT.vote_join_inverted(q, S.bins_to_long(s), t).collect()}
        assert a == b
