"""Plan assertions: the single lookup is one scan with pushed filters and no
shuffle; column pruning reaches the scan; the broadcast batch plan does not
shuffle the store; the library never collects in operator code."""

from __future__ import annotations

import pathlib
import pytest

from bucketvote.operators import batch as BT
from bucketvote.operators import lookup as L
from bucketvote.plans.strategy import VoteJoinPlan
from bucketvote.sources.bindings import query_bins_a
from bucketvote.sources.store import testdata_store as open_store


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def store(spark, smoke_dir):
    return open_store(spark, smoke_dir)


def test_single_lookup_one_scan_no_shuffle(store):
    p = plan_of(L.vote_lookup(store.get("slices"), query_bins_a(5), 4))
    assert p.count("FileScan parquet") == 1
    assert "Exchange" not in p
    assert "PushedFilters: [Or(" in p


def test_projection_pruned_to_scan(store):
    df = L.vote_lookup(store.get("slices"), query_bins_a(5), 4).select("Id")
    scan = [line for line in plan_of(df).splitlines() if "FileScan parquet" in line][0]
    assert "Clusters" not in scan and "SequenceAt" not in scan and "TrackId" not in scan and "HashTable_0" in scan


def test_broadcast_batch_keeps_store_unshuffled(spark, store):
    s = store.get("doc_slices")
    q = store.get("query_docs")
    p = plan_of(BT.vote_join(q, s, 5, plan=VoteJoinPlan(strategy="broadcast")))
    assert "BroadcastHashJoin" in p
    assert "Exchange hashpartitioning" not in p


def test_shuffle_batch_partitions_on_keys(spark, store):
    s = store.get("doc_slices")
    p = plan_of(BT.similar_pairs(s, 5))
    assert "hashpartitioning(pos" in p


def test_no_collect_or_cross_join_in_operators():
    root = pathlib.Path(__file__).resolve().parents[1] / "bucketvote"
    for f in (root / "operators").glob("*.py"):
        text = f.read_text()
        assert "crossJoin" not in text, f
        assert "localCheckpoint" not in text, f
        if f.name != "deletes.py":  # apply_to_store reads its per-table counts
            assert ".collect()" not in text, f


def test_no_cross_join_in_any_registered_query(spark, smoke_dir):
    from __spark_entry__ import queries

    from bucketvote.plans.registry import QUERIES

    for key, fn in queries().items():
        if key not in QUERIES:
            continue
        p = plan_of(fn(spark, smoke_dir))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key


def test_split_by_position_prunes_folders(spark, store):
    import os

    from bucketvote.operators import reshape as S
    from bucketvote.session import scratch_path

    path = scratch_path(spark, "split-test")
    out = S.split_bins_by_table(S.bins_to_long(store.get("slices")), path)
    local = path.replace("file:", "")
    if os.path.isdir(local):
        assert sorted(d for d in os.listdir(local) if d.startswith("HashTable=")) == sorted(f"HashTable={i}" for i in range(1, 26))
    p = plan_of(out.filter("HashTable = 3 AND HashBin = 2"))
    assert "PartitionFilters: [isnotnull(HashTable" in p and "(HashTable" in p and "EqualTo(HashBin,2)" in p
