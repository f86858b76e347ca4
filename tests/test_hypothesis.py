"""Random small stores: every plan of the vote join equals brute force."""

from __future__ import annotations

import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bucketvote.operators import batch as BT
from bucketvote.operators import lookup as L
from bucketvote.plans.strategy import VoteJoinPlan

from .fixtures import queries_df, slices_df

vec = st.lists(st.integers(min_value=0, max_value=3), min_size=25, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(store=st.lists(vec, min_size=1, max_size=12), queries=st.lists(vec, min_size=1, max_size=4), t=st.integers(-1, 26))
def test_vote_join_equals_brute_force(spark, store, queries, t):
    s = slices_df(spark, [(i, 1, i, 0.0, v, None) for i, v in enumerate(store)])
    q = queries_df(spark, queries)
    tt = max(t, 1)
    want = {
        (qi, si, sum(a == b for a, b in zip(qv, sv)))
        for qi, qv in enumerate(queries)
        for si, sv in enumerate(store)
        if sum(a == b for a, b in zip(qv, sv)) >= tt
    }
    for plan in (
        VoteJoinPlan(strategy="broadcast"),
        VoteJoinPlan(strategy="shuffle", skew_factor=0.01),
        VoteJoinPlan(strategy="count", skew_factor=0.01),
    ):
        got = {(r["qid"], r["Id"], r["votes"]) for r in BT.vote_join(q, s, t, plan=plan).collect()}
        assert got == want
    single = {(0, r["Id"], r["votes"]) for r in L.vote_lookup_votes(s, queries[0], t).collect()}
    assert single == {w for w in want if w[0] == 0}
    want_pairs = {
        (a, b) for a, b in itertools.combinations(range(len(store)), 2) if sum(x == y for x, y in zip(store[a], store[b])) >= tt
    }
    for plan in (VoteJoinPlan(), VoteJoinPlan(strategy="count"), VoteJoinPlan(strategy="shuffle")):
        pairs = {(r["a_id"], r["b_id"]) for r in BT.similar_pairs(s, t, plan=plan).collect()}
        assert pairs == want_pairs


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(store=st.lists(vec, min_size=1, max_size=10), queries=st.lists(vec, min_size=1, max_size=4), t=st.integers(0, 25))
def test_inverted_batch_equals_brute_force(spark, store, queries, t):
    from bucketvote.operators.reshape import bins_to_long

    s = slices_df(spark, [(i, 1, i, 0.0, v, None) for i, v in enumerate(store)])
    q = queries_df(spark, queries)
    tt = max(t, 1)
    want = {
        (qi, si, sum(a == b for a, b in zip(qv, sv)))
        for qi, qv in enumerate(queries)
        for si, sv in enumerate(store)
        if sum(a == b for a, b in zip(qv, sv)) >= tt
    }
    plan = VoteJoinPlan(skew_factor=0.01)
    got = {(r["qid"], r["Id"], r["votes"]) for r in BT.vote_join_inverted(q, bins_to_long(s), t, plan=plan).collect()}
    assert got == want
