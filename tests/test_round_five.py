"""Cases of the findings of round 4."""

from __future__ import annotations

import itertools
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bucketvote.operators import batch as BT
from bucketvote.plans.oracle import ORACLE
from bucketvote.plans.registry import BATCH_THRESHOLD, QUERIES
from bucketvote.plans.strategy import VoteJoinPlan
from bucketvote.operators import reshape as S
from bucketvote.schema import BIN_COLS, SLICES
from bucketvote.service import VoteStore
from bucketvote.sources import files
from bucketvote.sources import ingest as IN
from bucketvote.sources import store as ST

from .fixtures import tracks_df


def _agreeing(a, b) -> int:
    return sum(x is not None and x == y for x, y in zip(a, b))


def test_similar_pairs_are_pairs_of_documents(spark, tmp_path):
    """Every pair of documents with its votes, as in the SQL: copies too."""
    rnd = random.Random(8)
    words = ["w%d" % i for i in range(30)]
    texts = [" ".join(rnd.sample(words, 12)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate([*texts, *texts[:3], texts[0], "", None])] + [(None, texts[0])]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["similar_pairs"](spark, str(tmp_path))
    assert got.columns == ["a_id", "b_id", "votes"]
    found = sorted(tuple(r) for r in got.collect())
    bins = {r["Id"]: [r[c] for c in BIN_COLS] for r in ST.testdata_store(spark, str(tmp_path)).get("doc_slices").collect() if r["Id"] is not None}
    want = [(a, b, n) for a, b in itertools.combinations(sorted(bins), 2) if (n := _agreeing(bins[a], bins[b])) >= BATCH_THRESHOLD]
    assert found == want and (0, 30, 25) in found and (30, 33, 25) in found
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(db.execute(ORACLE["similar_pairs"].replace("benchmark", "documents")).fetchall()) == want


def test_a_row_without_an_id_is_in_no_pair(spark):
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in SLICES.fields])
    s = spark.createDataFrame([(i if i % 4 else None, 1, i, 0.0, *[7] * 25, None) for i in range(24)], schema)
    ids = [i for i in range(24) if i % 4]
    for how in ("shuffle", "couples", "count"):
        got = BT.similar_pairs(s, 5, plan=VoteJoinPlan(strategy=how, skew_factor=0.01))
        assert sorted(tuple(r) for r in got.collect()) == [(a, b, 25) for a, b in itertools.combinations(ids, 2)]


def _filled(spark, path, tracks: int = 12, each: int = 20) -> VoteStore:
    svc = VoteStore(spark, str(path), parts=3)
    svc.store.append("tracks", tracks_df(spark, [(i, None, "a", "t", None, 2000, 1.0) for i in range(1, tracks + 1)]))
    rnd = random.Random(3)
    rows = [(t, [rnd.randrange(5) for _ in range(25)], i, 0.5 * i, ["x"]) for t in range(1, tracks + 1) for i in range(each)]
    svc.add_slices(spark.createDataFrame(rows, "TrackId int, bins array<int>, SequenceNumber int, SequenceAt double, clusters array<string>"), order=["TrackId", "SequenceNumber"])
    return svc


def _stored(svc: VoteStore) -> tuple[set, set]:
    return {tuple(r) for r in svc.store.read("slices").collect()}, {tuple(r) for r in svc.store.read("bins_long").select("HashTable", "HashBin", "SubFingerprintId").collect()}


def _long_files(svc: VoteStore) -> list[str]:
    top = svc.store._at("bins_long").removeprefix("file:")
    return [os.path.join(d, f) for d, _, names in os.walk(top) for f in names if f.endswith(".parquet") and "bv_batch=schema" not in d]


def _shuffled(spark, run) -> int:
    """Bytes of shuffle files that are there after ``run`` and were not before."""
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def held() -> dict[str, int]:
        return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for top in local for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    before = held()
    run()
    return sum(n for f, n in held().items() if f not in before)


@pytest.mark.parametrize("words", [ST.BROADCAST_WORDS, 0])  # 0: keys are joined, rows are dealt anew
def test_a_delete_leaves_the_other_rows_in_order(spark, tmp_path, monkeypatch, words):
    monkeypatch.setattr(ST, "BROADCAST_WORDS", words)
    svc = _filled(spark, tmp_path / "store")
    slices, long = _stored(svc)
    assert len(slices) == 240 and long == {tuple(r) for r in S.bins_to_long(svc.store.read("slices")).collect()}
    gone = [2, 5, 6]
    counts = {r["table"]: r["removed"] for r in IN.delete_tracks(svc.store, gone).collect()}
    assert counts == {"bins_long": 1500, "slices": 60, "signatures": 0, "tracks": 3, "total": 1563}
    ids = {r[0] for r in slices if r[1] in gone}
    assert _stored(svc) == ({r for r in slices if r[1] not in gone}, {r for r in long if r[2] not in ids})
    for f in _long_files(svc):
        rows = [tuple(r) for r in spark.read.parquet(f).select("HashBin", "SubFingerprintId").collect()]
        assert rows == sorted(rows)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_files_of_few_long_rows_are_small(spark, tmp_path):
    """Before, filters of 2 MB lay in each file, most of the store's bytes."""
    files = _long_files(_filled(spark, tmp_path / "store"))
    assert files and max(os.path.getsize(f) for f in files) < 200_000


def test_long_rows_do_not_move(spark, tmp_path):
    """Slices are dealt, twice; the 25 times as many long rows are not, neither
    where they are written nor where a part of them is removed."""
    rnd = random.Random(4)
    svc = VoteStore(spark, str(tmp_path / "store"), parts=2)
    svc.store.append("tracks", tracks_df(spark, [(i, None, "a", "t", None, 2000, 1.0) for i in range(1, 5)]))
    rows = [(1 + i % 4, [rnd.randrange(1 << 30) for _ in range(25)], i, 0.5 * i, ["x"]) for i in range(4000)]
    hashed = spark.createDataFrame(rows, "TrackId int, bins array<int>, SequenceNumber int, SequenceAt double, clusters array<string>").coalesce(1)
    assert _shuffled(spark, lambda: svc.add_slices(hashed, order=["SequenceNumber"])) < 2 * 4000 * 160
    assert _shuffled(spark, lambda: IN.delete_tracks(svc.store, [3])) < 4000 * 25
    assert svc.store.read("bins_long").count() == 75_000


def test_keys_as_bits_of_words(spark):
    keys = [-(1 << 63), -65, -64, -1, 0, 63, 64, (1 << 63) - 1, None]
    rows = spark.createDataFrame([(k,) for k in [*keys, -66, 1, 62, 65, 128]], "k long")
    for wanted in (keys, keys[:-1], [None], []):
        gone = ST._Gone(spark.createDataFrame([(k,) for k in wanted], "_bv_gone long"))
        got = {r["k"] for r in gone(rows, "k").filter("_bv_gone").collect()}
        assert gone.in_place and got == {k for k in wanted if k is not None}
    assert not ST._Gone(spark.createDataFrame([("a",)], "_bv_gone string")).in_place
    assert gone(rows, "k").filter(~F.col("_bv_gone")).count() == rows.count()


def test_small_files_have_no_checksum_beside_them(spark, tmp_path):
    """A second writer's checksum beside the first one's file made reads fail."""
    at = tmp_path / "claims"
    assert files.create_new(spark, f"file:{at}/x", "one") and not files.create_new(spark, f"file:{at}/x", "two")
    assert os.listdir(at) == ["x"] and files.read_text(spark, f"file:{at}/x") == "one"
