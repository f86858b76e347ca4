"""Cases of the findings of round 3."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from bucketvote import session
from bucketvote.operators import batch as BT
from bucketvote.operators import deletes as D
from bucketvote.operators import quality as Q
from bucketvote.operators import reshape as S
from bucketvote.plans.strategy import JoinFacts, VoteJoinPlan, costs, couples_cost
from bucketvote.schema import BIN_COLS

from .fixtures import queries_df, slices_df, tracks_df


def _vectors(n: int) -> list[list]:
    rnd = random.Random(11)
    vecs = [[rnd.choice((0, 0, 1, -5, rnd.randrange(9))) for _ in range(25)] for _ in range(n)]
    vecs += [list(vecs[0]) for _ in range(9)]  # copies
    vecs += [[None if i % 3 else v for i, v in enumerate(vecs[1])]] * 2  # bins that agree with nothing
    return vecs


def _agreeing(a: list, b: list) -> int:
    return sum(x is not None and x == y for x, y in zip(a, b))


@pytest.mark.parametrize("t,plan", [(1, VoteJoinPlan()), (5, VoteJoinPlan(strategy="couples", skew_factor=0.1)), (14, VoteJoinPlan(strategy="couples"))])
def test_similar_pairs_on_couples_of_positions(spark, t, plan):
    vecs = _vectors(40)
    s = spark.createDataFrame([(i, 1, i, 0.0, *v, None) for i, v in enumerate(vecs)], _nullable())
    votes = {(a, b): _agreeing(vecs[a], vecs[b]) for a, b in itertools.combinations(range(len(vecs)), 2)}
    want = sorted((*p, n) for p, n in votes.items() if n >= t)
    assert sorted(tuple(r) for r in BT.similar_pairs(s, t, plan=plan).collect()) == want
    links = [sum(n >= t for p, n in votes.items() if i in p) for i in range(len(vecs))]
    same = [[j for j, v in enumerate(vecs) if v == vecs[i]] for i in range(len(vecs))]
    got = sorted(tuple(r) for r in BT.similar_classes(s, t, plan=plan).collect())
    assert got == [(i, min(same[i]), len(same[i]), links[i]) for i in range(len(vecs))]


def _nullable():
    from pyspark.sql import types as T

    from bucketvote.schema import SLICES

    return T.StructType([T.StructField(f.name, f.dataType, True) for f in SLICES.fields])


def test_what_a_side_carries_goes_with_its_id(spark):
    s = slices_df(spark, [(i, 10 * i, 0, 0.0, [3] * 25, None) for i in range(1, 8)])
    for plan in (VoteJoinPlan(strategy="shuffle", skew_factor=0.01), VoteJoinPlan(strategy="couples", skew_factor=0.01)):
        pairs = BT.vote_join(s, s, 5, query_id="Id", store_id="Id", keep_query=["TrackId"], keep_store=["TrackId"], self_pairs=True, plan=plan)
        rows = [tuple(r) for r in pairs.collect()]
        assert len(rows) == 21 and all(r[3] == 10 * r[0] and r[4] == 10 * r[1] for r in rows)


def test_common_bins_are_joined_on_couples():
    facts = JoinFacts(n_store=300_000, n_queries=300_000, query_bytes=None, positions=21, work=5e9, work_everywhere=9e9)
    assert couples_cost(facts, 66, 1e9) < min(costs(facts).values())


def test_quality_model_counts_every_trusted_document_of_its_fold(spark):
    from bucketvote.llm import quality as QU

    n = 41_000  # more than 20,000 in the fold that the model is fitted on
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("x"), F.col("id")).alias("text"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    fitted = QU.Classifier(docs, labels, order=7, all_scores=False)
    ends = fitted.model.filter("size = 7 and p is not null")
    mine = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    text = F.substring(F.concat("text", F.lit("\u00fe")), -7, 7)
    # every text of five digits has a last 7-gram of its own
    wanted = mine.filter("doc_id >= 10000").select(text.alias("t")).distinct().count()
    last = ends.filter(F.col("gram").bitwiseAND(F.lit(255)) == F.lit(QU._END)).filter(F.shiftright("gram", 48).bitwiseAND(F.lit(255)) == F.lit(ord("x")))
    assert last.count() == wanted > 15_000


def _exchanges(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def short_tasks(monkeypatch):
    """Tasks of 1,000 rows; more than ten ids are many."""
    monkeypatch.setattr(session, "ROWS_DEALT", 1000)
    monkeypatch.setattr(S, "BROADCAST_IDS", 10)
    monkeypatch.setattr(S, "BROADCAST_ROWS", 10)


def test_long_rows_are_dealt_by_their_number(spark, short_tasks):
    rnd = random.Random(5)
    s = slices_df(spark, [(i, i % 3, i, 0.5 * i, [rnd.randrange(4) for _ in range(25)], None) for i in range(600)]).checkpoint()
    long = S.bins_to_long(s).checkpoint()  # 15,000 rows: 15 tasks
    rows = {tuple(r) for r in s.collect()}
    wide = S.bins_to_wide(long, s)
    assert ", 15)" in _exchanges(wide) and {tuple(r) for r in wide.collect()} == rows
    own = S.bins_to_wide(long, s, track_id=1)
    assert {tuple(r) for r in own.collect()} == {r for r in rows if r[1] == 1}
    filled = S.backfill_track_id(long, s)
    assert ", 15)" in _exchanges(filled) and {(r["SubFingerprintId"], r["TrackId"]) for r in filled.collect()} == {(i, i % 3) for i in range(600)}
    left = D.delete_bins_by_track(long, s, [1])
    assert ", 15)" in _exchanges(left) and left.count() == 400 * 25
    twice = long.unionByName(long.filter("SubFingerprintId = 7"))
    found = Q.check_unique(twice, ["HashTable", "HashBin", "SubFingerprintId"], rare=True)
    assert ", 16)" in _exchanges(found) and {(r["SubFingerprintId"], r["n"]) for r in found.collect()} == {(7, 2)}


def test_backfill_keeps_rows_without_a_key(spark, short_tasks):
    target = spark.createDataFrame([(None, "old")] * 3 + [(i, "old") for i in range(40)], "k long, v string")
    source = spark.createDataFrame([(i, None if i == 5 else f"new{i}", i) for i in range(20) for _ in range(2)], "Id long, w string, x long")
    got = sorted(S.backfill_by_join(target, source, "k", "Id", {"v": "w", "x": "x"}).collect(), key=str)
    want = [(None, "old", None)] * 3 + [(i, "old" if i > 19 else None if i == 5 else f"new{i}", i if i < 20 else None) for i in range(40)]
    assert [tuple(r) for r in got] == [tuple(r) for r in sorted([Row(k=a, v=b, x=c) for a, b, c in want], key=str)]


def test_long_rows_that_a_query_has_are_dealt_by_slice(spark, short_tasks):
    rnd = random.Random(6)
    vecs = [[rnd.randrange(6) for _ in range(25)] for _ in range(100)]
    s = slices_df(spark, [(i, 1, i, 0.0, v, None) for i, v in enumerate(vecs)])
    found = BT.vote_join_inverted(queries_df(spark, vecs[:5]), S.bins_to_long(s).checkpoint(), 5)
    assert ", 10)" in _exchanges(found)  # four times 2,500 rows
    assert sorted(tuple(r) for r in found.collect()) == sorted((q, i, n) for q in range(5) for i, v in enumerate(vecs) if (n := _agreeing(vecs[q], v)) >= 5)


def test_rows_of_several_tables_move_as_one_column(spark, tmp_path, short_tasks):
    from bucketvote.service import VoteStore

    svc = VoteStore(spark, str(tmp_path / "store"), parts=2)
    svc.store.append("tracks", tracks_df(spark, [(i, None, "a", "t", None, 2000, 1.0) for i in range(1, 5)]))
    hashed = [(1 + i % 4, [i % 7] * 25, i, 0.5 * i, ["x"]) for i in range(90)]
    svc.add_slices(spark.createDataFrame(hashed, "TrackId int, bins array<int>, SequenceNumber int, SequenceAt double, clusters array<string>"), order=["TrackId", "SequenceNumber"])
    slices = svc.store.read("slices")
    assert sorted((r["TrackId"], [r[c] for c in BIN_COLS], r["SequenceNumber"], r["SequenceAt"], r["Clusters"]) for r in slices.collect()) == sorted((t, b, q, a, "x") for t, b, q, a, _ in hashed)
    assert {tuple(r) for r in S.bins_to_long(slices).collect()} == {tuple(r) for r in svc.store.read("bins_long").select("HashTable", "HashBin", "SubFingerprintId").collect()}


def test_common_bins_are_cut_by_slice_when_tables_are_built(spark, short_tasks, tmp_path):
    from bucketvote.sources.store import TestdataStore

    orders = spark.range(2000).selectExpr("id * 12 as o_orderkey")  # bin 0 of positions 1, 2 and 4 has all 2,000 rows
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    st = TestdataStore(spark, str(tmp_path))
    files = st.get("bins_long").filter("HashTable = 1").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == 2000 and max(r["count"] for r in files) < 1600
