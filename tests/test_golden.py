"""Golden cases of the store's own tests, re-run on DataFrames."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bucketvote.functions.bins import decode_clusters, encode_clusters
from bucketvote.operators import batch as BT
from bucketvote.operators import catalog as C
from bucketvote.operators import deletes as D
from bucketvote.operators import identify as ID
from bucketvote.operators import lookup as L
from bucketvote.plans.strategy import VoteJoinPlan
from bucketvote.schema import BIN_COLS

from .fixtures import PLAIN, PROBE, SIX, THREE, ids, queries_df, slices_df, tracks_df


@pytest.fixture(scope="module")
def two(spark):
    return slices_df(
        spark,
        [
            (1, 1, 0, 0.0, SIX, "north-set"),
            (2, 2, 0, 0.0, THREE, "south-set"),
        ],
    )


@pytest.mark.parametrize("t,expected", [(-1, [1, 2]), (0, [1, 2]), (1, [1, 2]), (3, [1, 2]), (4, [1]), (6, [1]), (7, []), (25, []), (None, [])])
def test_threshold_case(two, t, expected):
    assert ids(L.vote_lookup(two, PROBE, t)) == expected


def test_votes_by_position(two):
    got = {r["Id"]: r["votes"] for r in L.vote_lookup_votes(two, PROBE, 1).collect()}
    assert got == {1: 6, 2: 3}


def test_positional_not_set_membership(spark):
    # 2 and 5 swap places: equal values at different positions give no vote
    s = slices_df(spark, [(1, 1, 0, 0.0, [2, 5] + [0] * 23, None)])
    q = [5, 2] + [0] * 23
    assert L.vote_lookup_votes(s, q, 1).collect()[0]["votes"] == 23
    assert ids(L.vote_lookup(s, q, 24)) == []


def test_wrong_length_raises(two):
    with pytest.raises(ValueError):
        L.vote_lookup(two, PROBE[:24], 1)


@pytest.mark.parametrize(
    "labels,expected",
    [(["north-set"], [1]), ([], [1, 2]), (None, [1, 2]), (["-set"], [1, 2]), (["north-set", "x"], [])],
)
def test_cluster_case(spark, labels, expected):
    s = slices_df(spark, [(1, 1, 0, 0.0, SIX, "north-set"), (2, 2, 0, 0.0, SIX, "south-set")])
    assert ids(L.vote_lookup(s, PROBE, 4, clusters=labels)) == expected


def test_cluster_text_rules(spark):
    s = slices_df(
        spark,
        [(1, 1, 0, 0.0, PLAIN, "a,b"), (2, 1, 1, 0.0, PLAIN, "b,a"), (3, 1, 2, 0.0, PLAIN, None), (4, 1, 3, 0.0, PLAIN, "")],
    )
    assert ids(L.vote_lookup(s, PLAIN, 25, clusters=["a", "b"])) == [1]
    assert ids(L.vote_lookup(s, PLAIN, 25, clusters=["a", "b"], mode="any")) == [1, 2]
    assert ids(L.vote_lookup(s, PLAIN, 25, clusters=["%"])) == [1, 2, 4]


def test_cluster_case_full_threshold(spark):
    a = list(range(100, 125))
    b = list(range(200, 225))
    s = slices_df(spark, [(1, 1, 0, 0.0, a, "l1"), (2, 2, 0, 0.0, a, "l2"), (3, 1, 1, 0.0, b, "l1"), (4, 2, 1, 0.0, b, "l2")])
    assert ids(L.vote_lookup(s, a, 25, clusters=["l1"])) == [1]
    assert ids(L.vote_lookup(s, a, 25)) == [1, 2]


def test_clusters_round_trip(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,), (["x,y"],), (["a", ""],)], "c array<string>")
    out = df.select(encode_clusters("c").alias("t")).select("t", decode_clusters("t").alias("d")).collect()
    assert [r["t"] for r in out] == ["a,b", "", "", "x,y", "a,"]
    assert [r["d"] for r in out] == [["a", "b"], [], [], ["x", "y"], ["a", ""]]


def test_insert_unique_ids_and_empty_strings(spark):
    tracks = tracks_df(spark, [(1, "code", "singer", "song", "record", 1999, 181.0)])
    new = spark.createDataFrame(
        [(i, "code" + str(i), "singer", "song", "record", 1999, 181.0) for i in range(100)] + [(100, "", "", "", "", 1999, 181.0)],
        "k int, ISRC string, Artist string, Title string, Album string, ReleaseYear int, Length double",
    )
    out = C.insert_tracks(tracks, new, ["k"]).collect()
    got = [r["Id"] for r in out]
    assert len(got) == len(set(got)) == 101 and min(got) == 2 and max(got) == 102
    assert any(r["ISRC"] == "" for r in out)


def test_hundred_slices_round_trip(spark):
    slices = slices_df(spark, [(1, 9, 0, 0.0, PLAIN, None)])
    hashed = spark.createDataFrame(
        [(PLAIN, i, float(i * 0.75), []) for i in range(100)],
        "bins array<int>, SequenceNumber int, SequenceAt double, clusters array<string>",
    )
    ins = C.insert_hashes(slices, hashed, ["SequenceNumber"], track_id=7)
    back = sorted(C.hashes_by_track(ins, 7).collect(), key=lambda r: r["SequenceNumber"])
    assert len(back) == 100
    for i, r in enumerate(back):
        assert r["bins"] == PLAIN and r["SequenceNumber"] == i
        assert abs(r["StartsAt"] - i * 0.75) < 1e-4 and r["clusters"] == []


def test_insert_wrong_bin_count_raises(spark):
    slices = slices_df(spark, [(1, 9, 0, 0.0, PLAIN, None)])
    hashed = spark.createDataFrame([(PLAIN[:24], 0, 0.0, [])], "bins array<int>, SequenceNumber int, SequenceAt double, clusters array<string>")
    with pytest.raises(Exception):
        C.insert_hashes(slices, hashed, ["SequenceNumber"], track_id=1).collect()


def test_delete_case(spark):
    tracks = tracks_df(spark, [(1, "i", "a", "t", "rec", 1999, 181.0), (2, "j", "a", "t", "rec", 1999, 181.0)])
    slices = slices_df(spark, [(10 + i, 1, i, 0.0, PLAIN, None) for i in range(7)] + [(99, 2, 0, 0.0, THREE, None)])
    res = D.delete_track(tracks, slices, 1)
    counts = {r["table"]: r["removed"] for r in res["counts"].collect()}
    assert counts["total"] == 1 + 7
    assert ids(res["tracks"]) == [2]
    assert ids(L.vote_lookup(res["slices"], PLAIN, 25)) == []


def test_delete_cascades_signatures(spark):
    tracks = tracks_df(spark, [(1, "i", "a", "t", "rec", 1999, 181.0)])
    slices = slices_df(spark, [(10, 1, 0, 0.0, PLAIN, None)])
    sigs = spark.createDataFrame([(1, bytes(100), 1)], "Id int, Signature binary, TrackId int")
    res = D.delete_track(tracks, slices, 1, sigs)
    counts = {r["table"]: r["removed"] for r in res["counts"].collect()}
    assert counts == {"tracks": 1, "slices": 1, "signatures": 1, "total": 3}
    assert res["signatures"].count() == 0


def test_identification_case(spark):
    mine = [[(i * 31 + j * 7) % 1000 for j in range(25)] for i in range(20)]
    other = [[(i * 17 + j * 13) % 1000 + 5000 for j in range(25)] for i in range(20)]
    rows = [(100 + i, 1, i, i * 1.0, b, None) for i, b in enumerate(mine)] + [(200 + i, 2, i, i * 1.0, b, None) for i, b in enumerate(other)]
    slices = slices_df(spark, rows)
    q = queries_df(spark, mine).withColumn("set_id", F.lit(0))
    out = ID.identify_tracks(slices, q, 5).collect()
    assert len(out) == 1 and out[0]["TrackId"] == 1 and out[0]["is_best"]


def test_similar_pairs_matches_brute_force(spark):
    import itertools
    import random

    rnd = random.Random(7)
    vecs = [[rnd.randrange(3) for _ in range(25)] for _ in range(60)]  # every bin hot
    s = slices_df(spark, [(i, 1, i, 0.0, v, None) for i, v in enumerate(vecs)])
    for t in (1, 8, 12):
        want = {
            (a, b)
            for a, b in itertools.combinations(range(60), 2)
            if sum(x == y for x, y in zip(vecs[a], vecs[b])) >= t
        }
        for plan in (
            VoteJoinPlan(),
            VoteJoinPlan(strategy="shuffle", skew_factor=0.01),
            VoteJoinPlan(strategy="count", skew_factor=0.01),
        ):
            got = {(r["a_id"], r["b_id"]) for r in BT.similar_pairs(s, t, plan=plan).collect()}
            assert got == want, (t, plan)


def test_collations(spark):
    tracks = tracks_df(spark, [(1, "AbC ", "Artist", "Title", "rec", 1999, 181.0), (2, "abc", "artist", "title", "rec", 1999, 181.0)])
    assert ids(C.track_by_isrc(tracks, "abc")) == [2]
    assert ids(C.track_by_isrc(tracks, "ABC", collation="UTF8_LCASE")) == [2]
    assert ids(C.tracks_by_artist_title(tracks, "ARTIST", "TITLE", collation="UTF8_LCASE")) == [1, 2]
    assert ids(C.tracks_by_artist_title(tracks, "Artist", "Title")) == [1]
    assert ids(C.track_by_isrc(tracks, "AbC", collation="UTF8_BINARY_RTRIM")) == [1]


def test_null_bins_do_not_vote(spark):
    v = list(range(25))
    s = spark.createDataFrame(
        [(1, 1, 0, 0.0, *([None] + v[1:]), None)],
        "Id long, TrackId int, SequenceNumber int, SequenceAt double, "
        + ", ".join(f"{c} int" for c in BIN_COLS)
        + ", Clusters string",
    )
    q = spark.createDataFrame([(0, *([None] + v[1:]))], "qid long, " + ", ".join(f"{c} int" for c in BIN_COLS))
    for plan in (VoteJoinPlan(strategy="broadcast"), VoteJoinPlan(strategy="shuffle"), VoteJoinPlan(strategy="count")):
        got = [(r["Id"], r["votes"]) for r in BT.vote_join(q, s, 1, plan=plan).collect()]
        assert got == [(1, 24)], plan
    assert L.vote_lookup_votes(s, [0] + v[1:], 1).collect()[0]["votes"] == 24


def test_integrity_checks(spark):
    from bucketvote.operators import quality as Q

    tracks = tracks_df(
        spark,
        [
            (1, "a", "x", "t", "al", 1986, -0.5),
            (2, "a", "x", "t", "al", 1986, -1.0),
            (3, None, "x", "t", "al", None, None),
            (4, "", "x", "t", "al", -1, 10.0),
        ],
    )
    bad = {r["Id"]: r["rule"] for r in Q.check_ranges(tracks).collect()}
    assert bad == {2: "Length", 4: "ReleaseYear"}  # -0.5 and NULL pass
    assert {r["ISRC"]: r["n"] for r in Q.check_unique(tracks, ["ISRC"]).collect()} == {"a": 2}
    assert [r["Id"] for r in Q.check_required(tracks, ["ISRC"]).collect()] == [3]
    assert [r["Id"] for r in Q.check_isrc_not_empty(tracks).collect()] == [4]
    slices = slices_df(spark, [(10, 1, 0, 0.0, PLAIN, None), (11, 9, 0, 0.0, PLAIN, None)])
    assert [r["Id"] for r in Q.check_orphans(slices, tracks).collect()] == [11]
    long_title = tracks_df(spark, [(5, "i" * 51, "x", "t" * 256, "al", 1986, 1.0)])
    assert Q.check_lengths(long_title, {"ISRC": 50, "Title": 255}).collect()[0]["rule"] == "too long ISRC,Title"
    fitted = Q.fit_lengths(long_title, {"ISRC": 50, "Title": 255}).collect()[0]
    assert len(fitted["ISRC"]) == 50 and len(fitted["Title"]) == 255


def test_record_functions(spark):
    from bucketvote.functions import records as R

    df = spark.createDataFrame(
        [(1, ("a", (2, "x")), None, None), (2, ("b", (3, None)), "view", 7)],
        "k int, rec struct<name string, inner struct<n int, s string>>, kind string, num int",
    )
    flat = R.flatten_record(df, "rec")
    assert set(flat.columns) == {"k", "kind", "num", "rec_name", "rec_inner_n", "rec_inner_s"}
    assert R.flatten_record(df, "rec", ignore=["inner.s"]).columns.count("rec_inner_s") == 0
    back = R.nest_record(flat, "rec", depth=2).select("k", "rec.name", "rec.inner.n").orderBy("k").collect()
    assert [tuple(r) for r in back] == [(1, "a", 2), (2, "b", 3)]
    d = R.default_nulls(flat).orderBy("k").collect()
    assert d[0]["kind"] == "" and d[0]["num"] == 0 and d[1]["rec_inner_s"] == ""
    names = df.select(R.enum_from_name("kind", ["Click", "View"]).alias("e")).orderBy("e").collect()
    assert [r["e"] for r in names] == ["Click", "View"]  # NULL -> first member; case-insensitive
    with pytest.raises(Exception):
        spark.createDataFrame([("nope",)], "kind string").select(R.enum_from_name("kind", ["Click"])).collect()
    ords = df.select(R.enum_from_ordinal("num", {0: "None", 7: "Seven"}).alias("o")).orderBy("o").collect()
    assert [r["o"] for r in ords] == ["None", "Seven"]
    assert spark.createDataFrame([(9,)], "num int").select(R.enum_from_ordinal("num", {0: "None"})).collect()[0][0] == "9"
    m = R.to_unique_map(spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], "g int, k string, v string"), "k", "v", ["g"])
    assert m.collect()[0]["map"] == {"a": "x", "b": "y"}
    with pytest.raises(Exception):
        R.to_unique_map(spark.createDataFrame([(1, "a", "x"), (1, "a", "y")], "g int, k string, v string"), "k", "v", ["g"]).collect()
    first = C.first_or_none(spark.createDataFrame([(3,), (1,), (2,)], "x int"), ["x"]).collect()
    assert [r["x"] for r in first] == [1]
    assert C.first_or_none(spark.createDataFrame([], "x int"), ["x"]).count() == 0


def test_reshape_rules(spark):
    from bucketvote.operators import reshape as S

    tracks = spark.createDataFrame(
        [(1, "old1", 1900, 10), (2, "old2", 1901, 20), (3, "old3", 1902, 99)], "Id int, Album string, ReleaseYear int, AlbumId int"
    )
    albums = spark.createDataFrame([(10, "A", 1986), (20, None, None)], "Id int, Name string, ReleaseYear int")
    got = {r["Id"]: (r["Album"], r["ReleaseYear"]) for r in S.denormalise_albums(tracks, albums).collect()}
    assert got == {1: ("A", 1986), 2: (None, None), 3: ("old3", 1902)}  # matched NULL overwrites; unmatched keeps
    once = S.evolve_schema(tracks, add={"GroupId": "string"}, drop=["AlbumId"], rename={"Album": "AlbumName"})
    twice = S.evolve_schema(once, add={"GroupId": "string"}, drop=["AlbumId"], rename={"Album": "AlbumName"})
    assert once.columns == twice.columns == ["Id", "AlbumName", "ReleaseYear", "GroupId"]
    big = spark.createDataFrame([(1, 2**40, 5)], "HashTable int, HashBin long, SubFingerprintId long")
    with pytest.raises(Exception):
        S.rebase_bins(big).collect()  # ANSI: a bin that does not fit an int raises
    ok = S.rebase_bins(spark.createDataFrame([(25, 7, 5)], "HashTable int, HashBin long, SubFingerprintId long")).collect()[0]
    assert (ok["HashTable"], ok["HashBin"]) == (24, 7)


def test_keyed_lookups(spark):
    tracks = tracks_df(
        spark,
        [(5, "dup", "a", "t", "al", 1986, 1.0), (2, "dup", "a", "t", "al", 1986, 1.0), (7, "x", "b", "u", "al", 1986, 1.0)],
    )
    req = spark.createDataFrame([(0, 7), (1, 7), (2, 99), (3, 2)], "ordinal int, Id int")
    got = [(r["ordinal"], r["RequestedId"], r["Id"]) for r in C.tracks_by_ids(tracks, req).orderBy("ordinal").collect()]
    assert got == [(0, 7, 7), (1, 7, 7), (2, 99, None), (3, 2, 2)]  # repeats kept, missing -> NULL track
    in_order = [r["RequestedId"] for r in C.tracks_by_ids(tracks, req, ordered=True).collect()]
    assert in_order == [7, 7, 99, 2]
    assert C.tracks_by_artist_title(tracks, None, "t").count() == 0
    assert ids(C.tracks_by_artist_title(tracks, "a", "t")) == [2, 5]
    assert ids(C.track_by_isrc(tracks, "dup")) == [2]
    assert C.track_by_isrc(tracks, "none").count() == 0 and C.track_by_id(tracks, None).count() == 0
    sigs = spark.createDataFrame([(1, bytes([1, 2]), 7)], "Id int, Signature binary, TrackId int")
    assert ids(C.track_by_signature_id(tracks, sigs, 1)) == [7]
    assert C.signatures_by_track(sigs, 7).collect()[0]["Signature"] == bytearray([1, 2])


def test_generated_ids_leave_values_alone(spark):
    import datetime as dt

    rows = [
        (2, 9007199254740993, float("nan"), dt.datetime(1, 1, 1), None),
        (1, None, 1.5, dt.datetime(9999, 12, 31), b"\x00"),
        (3, -(1 << 63), None, None, b""),
    ]
    df = spark.createDataFrame(rows, "k int, big bigint, x double, at timestamp_ntz, raw binary")
    from bucketvote.operators.ids import assign_ids

    got = {r["k"]: r for r in assign_ids(df, ["k"], start=10).collect()}
    assert [got[k]["Id"] for k in (1, 2, 3)] == [11, 12, 13]
    assert got[2]["big"] == 9007199254740993 and got[1]["big"] is None and got[3]["big"] == -(1 << 63)
    assert got[2]["x"] != got[2]["x"] and got[3]["x"] is None
    assert got[2]["at"].year == 1 and got[1]["at"].year == 9999 and got[1]["raw"] == b"\x00"


def test_numbering_of_a_hot_key_and_null_keys(spark):
    from bucketvote.operators.ids import sequence_within

    rows = [(None if i % 3 == 0 else i % 7, i) for i in range(600)]
    got = sequence_within(spark.createDataFrame(rows, "k int, o int"), ["k"], ["o"], num_partitions=9).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["o"]):
        by.setdefault(r["k"], []).append(r["seq"])
    assert all(v == list(range(len(v))) for v in by.values()) and len(by[None]) == 200


def test_schema_changes_twice_are_the_same_as_once(spark):
    from bucketvote.operators.reshape import evolve_schema

    df = tracks_df(spark, [(1, "I1", "a", "b", "c", 1990, 1.0)])
    change = dict(add={"GroupId": "string", "isrc": "string", "Extra": "int"}, drop=["LENGTH"], rename={"ISRC": "Isrc", "Extra": "More"}, cast={"releaseyear": "bigint"})
    once = evolve_schema(df, **change)
    twice = evolve_schema(once, **change)
    assert once.schema == twice.schema and once.collect() == twice.collect()
    assert once.collect()[0]["Isrc"] == "I1" and "More" in once.columns and "Extra" not in once.columns
    assert all(f.nullable for f in once.schema.fields)


def test_backfill_with_a_repeated_key_adds_no_rows(spark):
    from bucketvote.operators.reshape import backfill_by_join

    target = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (1, "a"), (None, "z")], "key int, value string")
    got = backfill_by_join(target, source, "k", "key", {"v": "value"}).collect()
    assert sorted(tuple(r) for r in got) == [(1, "a"), (2, "old")]


def test_a_hot_key_is_split_on_both_sides(spark):
    # a third of all rows share every bin; the join's cells stay small
    hot = [(i, 1, i, 0.0, [7] * 25, None) for i in range(200)]
    cold = [(1000 + i, 1, i, 0.0, [100 * i + j for j in range(25)], None) for i in range(400)]
    s = slices_df(spark, hot + cold)
    qx, sx = BT._explode(s, "Id", [0], "q_", []), BT._explode(s, "Id", [0], "s_", [])
    for self_pairs in (True, False):
        work = BT._pair_work(s, s, self_pairs).filter("pos = 0")
        q, t = BT._salted(qx, sx, work, VoteJoinPlan(), 16, self_pairs)
        most = 2 * max(r["count"] for d in (q, t) for r in d.groupBy("pos", "bin", "_sn", "_qn").count().collect())
        assert most <= 200  # of 200 hot rows on each side
    pairs = BT.similar_pairs(s, 25, plan=VoteJoinPlan(partitions=16))
    assert pairs.count() == 200 * 199 // 2
    assert pairs.filter("a_id >= b_id").count() == 0 and pairs.distinct().count() == pairs.count()


def test_votes_follow_similarity(spark):
    from bucketvote.functions.minhash import minhash_bins

    import random

    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows, true = [], {}
    for k, swapped in enumerate((0, 20, 60, 100)):
        for rep in range(30):
            own = [f"{w}r{rep}" for w in base]
            other = own[: 200 - swapped] + [f"x{i}r{rep}s{k}" for i in range(swapped)]
            rng.shuffle(other)
            rows += [(1000 * k + rep, " ".join(own)), (100_000 + 1000 * k + rep, " ".join(other))]
        true[k] = (200 - swapped) / (200 + swapped)
    bins = {r["id"]: r for r in minhash_bins(spark.createDataFrame(rows, "id int, text string"), "id", "text").collect()}
    for k in true:
        votes = [sum(bins[1000 * k + rep][c] == bins[100_000 + 1000 * k + rep][c] for c in BIN_COLS) for rep in range(30)]
        assert abs(sum(votes) / 30 / 25 - true[k]) < 0.06


def test_label_text_with_a_collation(spark):
    s = slices_df(spark, [(1, 1, 0, 0.0, PLAIN, "North,x"), (2, 1, 1, 0.0, PLAIN, "south"), (3, 1, 2, 0.0, PLAIN, None)])
    assert ids(s.filter(L.cluster_predicate(["NORTH"], collation="UTF8_LCASE"))) == [1]
    assert ids(s.filter(L.cluster_predicate(["NORTH"]))) == []


def test_writing_side_of_enums_and_unique_pairs(spark):
    from bucketvote.functions import records as R

    df = spark.createDataFrame([("View", 1), (None, None), ("CLICK", 9)], "name string, n int")
    got = df.select(R.enum_to_ordinal("name", ["Click", "View"]).alias("o"), R.enum_to_name("n", {1: "One"}).alias("m")).collect()
    assert [tuple(r) for r in got] == [(1, "One"), (None, None), (0, "9")]
    with pytest.raises(Exception):
        spark.createDataFrame([("x",)], "name string").select(R.enum_to_ordinal("name", ["Click"])).collect()
    pairs = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "a", "z")], "g int, k string, v string")
    assert sorted(tuple(r) for r in R.unique_pairs(pairs, "k", "v", ["g"]).collect()) == [(1, "a", "x"), (1, "b", "y"), (2, "a", "z")]
    with pytest.raises(Exception):
        R.unique_pairs(pairs.union(pairs), "k", "v", ["g"]).collect()
