"""Streaming lookups equal the batch lookups over the same query vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from bucketvote.operators import batch as BT
from bucketvote.schema import BIN_COLS
from bucketvote.session import scratch_path
from bucketvote.sources.store import testdata_store as open_store
from bucketvote.streaming.lookups import stream_vote_lookups


def test_stream_equals_batch(spark, smoke_dir):
    st = open_store(spark, smoke_dir)
    slices = st.get("doc_slices")
    q = st.get("query_docs")
    src = scratch_path(spark, "stream-src")
    q.repartition(3).write.parquet(src)  # three files: a stream of requests
    stream = spark.readStream.schema(q.schema).option("maxFilesPerTrigger", 1).parquet(src)
    sink = scratch_path(spark, "stream-sink")
    h = stream_vote_lookups(stream, slices, 4, sink, scratch_path(spark, "stream-ckpt"))
    h.awaitTermination(300)
    got = {(r["qid"], r["Id"], r["votes"]) for r in spark.read.parquet(sink).collect()}
    want = {(r["qid"], r["Id"], r["votes"]) for r in BT.vote_lookup_batch_votes(slices, q, 4).collect()}
    assert got == want
    assert spark.read.parquet(sink).select("batch_id").distinct().count() >= 1
