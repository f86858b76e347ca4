"""The store: tables written together are seen together, deletes rewrite only
the folders they touch, ids are never shared, schemas evolve without a rewrite."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from bucketvote.operators.constraints import ConstraintError
from bucketvote.schema import BINS_LONG, SLICES, TRACKS
from bucketvote.service import VoteStore
from bucketvote.session import scratch_path
from bucketvote.sources import files
from bucketvote.sources.ingest import create_tables, delete_tracks, insert_slices
from bucketvote.sources.store import Store
from bucketvote.streaming.lookups import stream_insert_hashes

from .fixtures import PLAIN, SIX, ids, slices_df, tracks_df

HASHED = "TrackId int, bins array<int>, SequenceNumber int, SequenceAt double, clusters array<string>"


def track(spark, i):
    return tracks_df(spark, [(i, "i", "a", "t", "rec", 1999, 181.0)])


def store(spark, tracks=(), **kw) -> Store:
    st = Store(spark, **kw)
    create_tables(st, parts=4)
    for i in tracks:
        st.append("tracks", track(spark, i))
    return st


def hashed(spark, n, track_id=7, bins=PLAIN):
    return spark.createDataFrame([(track_id, bins, i, float(i), ["x"]) for i in range(n)], HASHED)


def data_files(st: Store, name: str) -> dict[str, int]:
    """Data files of a table with their times of change."""
    found = {}
    for folder, _, names in os.walk(st._at(name).removeprefix("file:")):
        found.update({os.path.join(folder, f): os.stat(os.path.join(folder, f)).st_mtime_ns for f in names if f.endswith(".parquet") and "schema" not in folder})
    return found


def test_two_writers_lose_nothing(spark):
    st = store(spark, [1])
    other = Store(spark, st.root)
    create_tables(other, parts=9)  # is there already
    st.append("tracks", track(spark, 2))
    other.append("tracks", track(spark, 3))
    assert ids(st.read("tracks")) == ids(other.read("tracks")) == ids(Store(spark, st.root).read("tracks")) == [1, 2, 3]


def test_missing_is_not_empty(spark):
    st = Store(spark)
    with pytest.raises(KeyError):
        st.read("tracks")
    assert not st.has("tracks")
    st.create("tracks", TRACKS, key="Id")
    assert st.read("tracks").count() == 0 and st.read("tracks").columns == TRACKS.names
    for f in os.listdir(st._at("tracks", 0, 0, 0, "schema").removeprefix("file:")):
        os.truncate(os.path.join(st._at("tracks", 0, 0, 0, "schema").removeprefix("file:"), f), 0)
    with pytest.raises(Exception, match="(?i)footer"):
        Store(spark, st.root).read("tracks")


def test_paths_and_folders(spark):
    st = store(spark, [5], root=scratch_path(spark, "a store") + "/with a space")
    insert_slices(st, hashed(spark, 3, 5), ["SequenceNumber"])
    assert st.read("bins_long").count() == 75 and st.read("slices").columns == SLICES.names
    assert st.read("bins_long").columns == BINS_LONG.names
    plan = st.read("bins_long").filter("HashTable = 3 and HashBin = 9")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(HashTable" in plan and "EqualTo(HashBin,9)" in plan


def test_slices_and_posting_rows_come_together(spark, monkeypatch):
    """A job that dies while it writes leaves neither table's rows visible."""
    svc = VoteStore(spark, parts=4)
    t = svc.add_track("a", "x", "y", "z", 2001, 240)
    svc.add_slices(hashed(spark, 2, t).drop("TrackId"), t)
    real = Store._write

    def dies(self, laid):
        broken = [(df.withColumn("SequenceAt", F.when(F.col("HashTable") >= 0, F.raise_error(F.lit("executor gone"))).cast("double")) if "TrackId" in df.columns else df, sort) for df, sort in laid]
        return real(self, broken)

    monkeypatch.setattr(Store, "_write", dies)
    with pytest.raises(Exception, match="executor gone"):
        svc.add_slices(hashed(spark, 3, t, SIX).drop("TrackId"), t)
    monkeypatch.setattr(Store, "_write", real)
    assert svc.slices_of(t).count() == 2 and svc.store.read("bins_long").count() == 50
    assert svc.candidates(SIX, 20).count() == 0 and svc.candidates(PLAIN, 25).count() == 2
    svc.add_slices(hashed(spark, 3, t, SIX).drop("TrackId"), t)
    assert svc.candidates(SIX, 25).count() == svc.candidates(SIX, 0).filter(F.array_contains("bins", SIX[0])).count() == 3


def test_streamed_slices_are_found_and_checked(spark):
    svc = VoteStore(spark, parts=4)
    t = svc.add_track("a", "x", "y", "z", 2001, 240)
    svc.add_slices(hashed(spark, 1, t).drop("TrackId"), t)
    src = scratch_path(spark, "ingest-src")
    hashed(spark, 5, t).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    stream_insert_hashes(stream, svc.store, ["SequenceNumber"], scratch_path(spark, "ingest-ckpt")).awaitTermination(300)
    assert svc.candidates(PLAIN, 4).count() == svc.candidates(PLAIN, 0).count() == 6
    assert ids(svc.store.read("slices")) == [1, 2, 3, 4, 5, 6]
    # a replayed batch has the same ids and replaces its rows
    for n in (3, 3):
        insert_slices(svc.store, hashed(spark, n, t), ["SequenceNumber"], batch="again")
    assert ids(svc.store.read("slices")) == list(range(1, 10)) and svc.store.read("bins_long").count() == 9 * 25
    # an unknown track ends the stream
    bad = scratch_path(spark, "ingest-bad")
    hashed(spark, 2, 999).write.parquet(bad)
    stream = spark.readStream.schema(spark.read.parquet(bad).schema).parquet(bad)
    query = stream_insert_hashes(stream, svc.store, ["SequenceNumber"], scratch_path(spark, "bad-ckpt"))
    with pytest.raises(PySparkException, match="foreign key"):
        query.awaitTermination(300)
    assert svc.store.read("slices").count() == 9
    with pytest.raises(ConstraintError):
        insert_slices(svc.store, hashed(spark, 2, 999), ["SequenceNumber"])


def test_deletes_rewrite_only_what_they_touch(spark):
    st = store(spark, range(1, 9))
    for i in range(1, 9):
        insert_slices(st, hashed(spark, 5, i), ["SequenceNumber"])
    before = {n: data_files(st, n) for n in ("tracks", "slices", "bins_long")}
    part = {r["TrackId"]: r["bv_part"] for r in st.rows("slices").select("TrackId", "bv_part").distinct().collect()}
    counts = {r["table"]: r["removed"] for r in delete_tracks(st, [3, 3, 77]).collect()}
    assert counts == {"bins_long": 125, "slices": 5, "signatures": 0, "tracks": 1, "total": 131}
    assert st.read("slices").count() == 35 and st.read("slices").filter("TrackId = 3").count() == 0
    assert st.read("bins_long").count() == 35 * 25 and ids(st.read("tracks")) == [1, 2, 4, 5, 6, 7, 8]
    for name in ("slices", "bins_long"):
        after = data_files(st, name)
        kept = {f for f in after if before[name].get(f) == after[f]}
        gone = set(before[name]) - kept
        assert gone and all(f"bv_part={part[3]}/" in f for f in gone) and set(after) == kept  # its batch held no other track
    assert delete_tracks(st, [3]).filter("table = 'total'").first()["removed"] == 0
    # one batch with rows of several tracks of a part: only its own folders are written anew
    st.append_together({"slices": slices_df(spark, [(500 + i, 20 + i, 0, 0.0, PLAIN, None) for i in range(12)])}, "many")
    before = data_files(st, "slices")
    assert st.delete_rows("slices", spark.createDataFrame([(20,), (21,)], "TrackId int"), "TrackId") == 2
    after = data_files(st, "slices")
    assert {f for f in before if before[f] != after.get(f)} and all("bv_batch=many" in f for f in before if before[f] != after.get(f))
    assert st.delete_rows("slices", spark.createDataFrame([(i,) for i in range(22, 32)], "TrackId int"), "TrackId") == 10
    # the read has no join, and a key that is added again is read again
    assert "Join" not in st.read("slices")._jdf.queryExecution().optimizedPlan().toString()
    st.append("tracks", track(spark, 3))
    insert_slices(st, hashed(spark, 2, 3), ["SequenceNumber"])
    assert st.read("slices").filter("TrackId = 3").count() == 2 and ids(st.read("tracks")) == list(range(1, 9))
    assert ids(st.read("slices"))[-2:] == [41, 42]  # ids of removed rows are not used again
    assert {r["table"]: r["removed"] for r in delete_tracks(st, list(range(1, 9))).collect()}["total"] == 37 * 26 + 8
    assert all(st.read(n).count() == 0 for n in ("tracks", "slices", "bins_long"))


def test_single_key_deletes(spark):
    st = Store(spark)
    st.create("slices", SLICES)  # no key: one part
    st.append("slices", slices_df(spark, [(100 * t + i, t, i, 0.0, PLAIN, None) for t in range(1, 4) for i in range(5)]))
    st.append("slices", slices_df(spark, [(900, 1, 0, 0.0, PLAIN, None)]), batch="b")
    assert st.delete_rows("slices", spark.createDataFrame([(3,), (3,), (77,), (None,)], "TrackId int"), "TrackId") == 5
    assert st.delete_rows("slices", spark.createDataFrame([(3,)], "TrackId int"), "TrackId") == 0
    assert st.delete_rows("slices", spark.createDataFrame([(101,), (900,)], "Id long"), "Id") == 2
    assert ids(st.read("slices")) == [100, 102, 103, 104, 200, 201, 202, 203, 204]


def test_writers_at_once_share_no_id(spark):
    st = store(spark, [7])
    others = [st, Store(spark, st.root), Store(spark, st.root)]
    with ThreadPoolExecutor(12) as pool:
        starts = list(pool.map(lambda k: (others[k % 3].reserve("tracks", 1 + k % 4), 1 + k % 4), range(36)))
    used = [first + i for first, n in starts for i in range(1, n + 1)]
    assert len(set(used)) == len(used) and min(used) == 8  # after the row that was there
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda s: insert_slices(s, hashed(spark, 20), ["SequenceNumber"]), others))
    assert ids(st.read("slices")) == list(range(1, 61))
    assert st.reserve("slices", 5, "t") == st.reserve("slices", 5, "t") == 60 and st.reserve("slices", 1) == 65


def test_claimed_files(spark):
    at = scratch_path(spark, "claims")
    assert files.names(spark, at) == [] and files.read_text(spark, f"{at}/x") is None
    assert files.create_new(spark, f"{at}/x", "one") and not files.create_new(spark, f"{at}/x", "two")
    assert files.read_text(spark, f"{at}/x") == "one" and files.names(spark, at)[-1] == "x"


def test_a_stored_table_evolves(spark):
    st = store(spark, [1, 2])
    first = data_files(st, "tracks")
    assert st.evolve("tracks", add={"GroupId": "string"}, rename={"ISRC": "Isrc"}, cast={"ReleaseYear": "bigint"}) == 1
    assert st.evolve("tracks", add={"GroupId": "string"}, rename={"ISRC": "Isrc"}, cast={"ReleaseYear": "bigint"}) == 1  # no change
    assert data_files(st, "tracks") == first
    names = ["Id", "Isrc", "Artist", "Title", "Album", "ReleaseYear", "Length", "GroupId"]
    assert st.read("tracks").columns == names and dict(st.read("tracks").dtypes)["ReleaseYear"] == "bigint"
    st.append("tracks", spark.createDataFrame([(3, "k", "a", "t", "r", 1 << 40, 1.0, "g")], st.schema("tracks")))
    got = {r["Id"]: (r["Isrc"], r["ReleaseYear"], r["GroupId"]) for r in st.read("tracks").collect()}
    assert got == {1: ("i", 1999, None), 2: ("i", 1999, None), 3: ("k", 1 << 40, "g")}
    # a name that is dropped and added again starts empty
    assert st.evolve("tracks", drop=["Album", "GroupId"]) == 2 and st.evolve("tracks", add={"Album": "int"}, rename={"Isrc": "Code"}, cast={"ReleaseYear": "string"}) == 3
    st.append("tracks", spark.createDataFrame([(4, "m", "a", "t", "2024", 1.0, 5)], "Id int, Code string, Artist string, Title string, ReleaseYear string, Length double, Album int"))
    got = {r["Id"]: (r["Code"], r["ReleaseYear"], r["Album"]) for r in st.read("tracks").collect()}
    assert got == {1: ("i", "1999", None), 2: ("i", "1999", None), 3: ("k", str(1 << 40), None), 4: ("m", "2024", 5)}
    # rows of all versions are removed, by a renamed column too
    assert st.delete_rows("tracks", spark.createDataFrame([("i",)], "Code string"), "Code") == 2
    assert ids(Store(spark, st.root).read("tracks")) == [3, 4]
    with pytest.raises(ValueError):
        st.evolve("tracks", drop=["Id"])
    copy = st.copy_to(scratch_path(spark, "copy"), ["tracks"])
    assert ids(copy.read("tracks")) == [3, 4] and copy.read("tracks").columns == st.read("tracks").columns
