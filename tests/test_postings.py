"""Bucketed posting rows, the LIKE dialect, the cost rule, map pieces and
imports with own keys."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from bucketvote.functions.like import like, like_regex
from bucketvote.functions.records import map_pieces, to_unique_map
from bucketvote.operators import batch as BT
from bucketvote.operators.constraints import ConstraintError
from bucketvote.operators.postings import open_postings, vote_join_postings, write_postings
from bucketvote.plans.strategy import JoinFacts, VoteJoinPlan, choose
from bucketvote.schema import BIN_COLS
from bucketvote.service import VoteStore
from bucketvote.session import scratch_path
from bucketvote.sources.ingest import import_rows

from .fixtures import PLAIN, ids, slices_df, tracks_df


def _vectors(rng, n, hot=0):
    return [[7] * 25 if i < hot else [rng.randint(0, 9) for _ in range(25)] for i in range(n)]


def test_bucketed_postings_join_without_moving_the_store(spark):
    rng = random.Random(3)
    store = slices_df(spark, [(i, i % 7, i, 0.0, v, None) for i, v in enumerate(_vectors(rng, 200, hot=70))])
    queries = spark.createDataFrame([(i, *v) for i, v in enumerate(_vectors(rng, 60, hot=3))], ["qid", *BIN_COLS])
    table, path = f"postings_{uuid.uuid4().hex[:8]}", scratch_path(spark, "postings")
    write_postings(store, table, path, 4, keep=["TrackId"])
    for t in (0, 6, 25, 26):
        got = {tuple(r) for r in vote_join_postings(queries, table, path, t, keep=["TrackId"]).collect()}
        want = BT.vote_join(queries, store, t, keep_store=["TrackId"])
        assert got == {tuple(r) for r in want.collect()}, t
    again = f"postings_{uuid.uuid4().hex[:8]}"
    open_postings(spark, again, path, 4)
    assert vote_join_postings(queries, again, path, 6).count() == vote_join_postings(queries, table, path, 6).count()
    plan = vote_join_postings(queries, table, path, 6)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("SortMergeJoin")[1].split("Bucketed: true")[0]  # the join's store side comes first
    assert "Exchange" not in above and f"{table}[" in plan and "pos#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    for name in (table, again):
        spark.sql(f"drop table {name}")


@pytest.mark.parametrize(
    "pattern,yes,no",
    [
        ("%ab_c%", ["abxc", "zabécz"], ["abc", "ab"]), ("[a-c]x", ["ax", "cx"], ["dx", "x", "[a-c]x"]), ("[^a-c]x", ["dx", "^x"], ["ax", "x"]), ("[[]%]", ["[]", "[a]"], ["a]"]),
        ("100[%]", ["100%"], ["1000"]), ("[_]x", ["_x"], ["ax"]), ("a]", ["a]"], ["a"]), ("[", [], ["["]), ("x[", [], ["x[", "x"]), ("[]x", [], ["x", "[]x"]), ("[^]", ["^"], ["a"]),
        ("[a-]", ["a", "-"], ["b"]), ("[-a]", ["-", "a"], ["b"]), ("[z-a]", [], ["z", "a", "-"]), ("a.b*", ["a.b*"], ["axb", "a.bb"]), ("a%b", ["a\nb", "ab"], ["a\nb\n"]), ("", [""], ["a"]),
        ("[&&]\\\\^$", ["&\\\\^$"], ["&"]), ("_", ["\U0001f600", "\n"], ["", "ab"]), ("[\u00e9-\u00fc]", ["\u00eb"], ["e"]),
    ],
)
def test_like_dialect(spark, pattern, yes, no):
    df = spark.createDataFrame([(x,) for x in [*yes, *no, None]], "v string")
    got = [(r["v"], r["hit"]) for r in df.select("v", like(F.col("v"), pattern).alias("hit")).collect()]
    assert got == [*((x, True) for x in yes), *((x, False) for x in no), (None, None)], like_regex(pattern)


def test_like_with_collations(spark):
    df = spark.createDataFrame([("ABC  ",)], "v string")
    value = F.col("v")
    assert df.filter(like(value, "a[b-d]c%", "UTF8_LCASE")).count() == 1 and df.filter(like(value, "a[b]c", "UTF8_LCASE")).count() == 0
    assert df.filter(like(value, "a[b]c", "UTF8_LCASE_RTRIM")).count() == 1 and df.filter(like(value, "abc%")).count() == 0
    with pytest.raises(ValueError):
        like(value, "a", "UNICODE_CI")


def test_labels_with_brackets_through_the_store(spark):
    svc = VoteStore(spark, parts=2)
    t = svc.add_track("a", "x", "y", "z", 2001, 240)
    rows = [(PLAIN, 0, 0.0, ["set-a1"]), (PLAIN, 1, 1.0, ["SET-b2"]), (PLAIN, 2, 2.0, ["set-[x]"])]
    svc.add_slices(spark.createDataFrame(rows, "bins array<int>, SequenceNumber int, SequenceAt double, clusters array<string>"), t)
    q = spark.createDataFrame([(0, *PLAIN)], ["qid", *BIN_COLS])
    for threshold in (25, 0):
        found = lambda labels, **kw: sorted(r["SequenceNumber"] for r in svc.candidates(PLAIN, threshold, labels, **kw).collect())  # noqa: B023, E731
        assert found(["set-[a-c][0-9]"], dialect="tsql") == [0] and found(["set-[a-c][0-9]"]) == []
        assert found(["set-[a-c][0-9]"], dialect="tsql", collation="UTF8_LCASE") == [0, 1] and found(["set-"], collation="UTF8_LCASE") == [0, 1, 2]
    assert svc.candidates_of_all(q, 4, ["[[]x]"], dialect="tsql").count() == 1


def test_cost_rule():
    few = JoinFacts(n_store=10**9, n_queries=300, query_bytes=900_000, positions=21, work=1e8, work_everywhere=2e8, copies=1000)
    assert choose(VoteJoinPlan(), few) == "broadcast"
    assert choose(VoteJoinPlan(broadcast_bytes=1000), few) == "count"
    many = JoinFacts(n_store=10**9, n_queries=10**8, query_bytes=10**12, positions=21, work=1e12, work_everywhere=2e12)
    assert choose(VoteJoinPlan(), many) == "shuffle"
    assert choose(VoteJoinPlan(strategy="broadcast"), JoinFacts(10, 10, None, 21, 1e3, 1e4)) in ("shuffle", "count")
    with pytest.raises(ValueError):
        choose(VoteJoinPlan(strategy="other"), few)


def test_any_choice_of_positions_is_exact(spark):
    rng = random.Random(8)
    # the last positions are selective, the first hold one value
    rows = [(i, 1, i, 0.0, [1] * 12 + [rng.randint(0, 3 + k) for k in range(13)], None) for i in range(120)]
    s = slices_df(spark, rows)
    want = {(a[0], b[0], v) for a in rows for b in rows if a[0] < b[0] and (v := sum(x == y for x, y in zip(a[4], b[4]))) >= 15}
    assert BT.least_work({p: 100.0 - p for p in range(25)}, 15) == list(range(24, 13, -1))
    for how in ("shuffle", "count", "auto"):
        assert {tuple(r) for r in BT.similar_pairs(s, 15, plan=VoteJoinPlan(strategy=how)).collect()} == want


def test_map_pieces_of_a_large_group(spark):
    big = spark.range(50_000).select(F.lit("big").alias("g"), F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id")).alias("v"))
    df = big.unionByName(spark.createDataFrame([("small", 5, "x"), ("small", 2, "y"), (None, 1, "z")], "g string, k long, v string"))
    got = map_pieces(df, "k", "v", ["g"], piece_rows=7_000)
    rows = {(r["g"], r["piece"]): r for r in got.collect()}
    assert len(rows) == 8 + 2 and max(r["n"] for r in rows.values()) == 7_000
    assert [rows["big", i]["first_key"] for i in range(8)] == list(range(0, 50_000, 7_000)) and rows["big", 7]["last_key"] == 49_999
    whole = {k: v for (g, _), r in rows.items() if g == "big" for k, v in r["map"].items()}
    assert whole == {i: f"v{i}" for i in range(50_000)}
    assert rows["small", 0]["map"] == to_unique_map(df.filter("g = 'small'"), "k", "v", ["g"]).first()["map"]
    with pytest.raises(Exception, match="a key repeats"):
        map_pieces(df.unionByName(df.limit(1)), "k", "v", ["g"]).collect()


def test_imports_with_their_own_keys(spark):
    svc = VoteStore(spark, parts=2)
    st, row = svc.store, (1, "i", "a", "t", "rec", 1999, 181.0)
    import_rows(st, "tracks", tracks_df(spark, [(i, *row[1:]) for i in (3, 4)]))
    for bad in ([3], [9, 9]):
        with pytest.raises(ConstraintError, match="unique Id"):
            import_rows(st, "tracks", tracks_df(spark, [(i, *row[1:]) for i in bad]))
    import_rows(st, "slices", slices_df(spark, [(10, 3, 0, 0.0, PLAIN, None)]))
    for bad in ((10, 3), (11, 77)):
        with pytest.raises(ConstraintError):
            import_rows(st, "slices", slices_df(spark, [(*bad, 0, 0.0, PLAIN, None)]))
    bins = spark.createDataFrame([(1, 5, 10), (2, 5, 10)], "HashTable int, HashBin long, SubFingerprintId long")
    import_rows(st, "bins_long", bins)
    with pytest.raises(ConstraintError, match="unique HashTable"):
        import_rows(st, "bins_long", bins.limit(1))
    assert svc.add_track("b", "x", "y", "z", 2001, 240) == 5 and ids(st.read("tracks")) == [3, 4, 5]
