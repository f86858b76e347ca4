"""Vote lookups and slice ingest over a stream of requests.

The store answers lookups one call at a time; here the calls arrive as a
stream.  Each micro-batch of query vectors is vote-joined against the
static slice table with the same batch plan as ``vote_lookup_batch``
(broadcast of the batch's queries when their measured size allows, else a
salted shuffle join), and the matches are appended to a parquet table.
``foreachBatch`` with the batch id written alongside the rows gives
exactly-once results on restart from the checkpoint: a replayed batch
overwrites its own folder instead of appending twice.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.batch import vote_join
from ..plans.strategy import DEFAULT_PLAN, VoteJoinPlan
from ..sources.ingest import insert_slices


def stream_vote_lookups(
    queries: DataFrame,
    slices: DataFrame,
    threshold: int,
    sink_path: str,
    checkpoint: str,
    query_id: str = "qid",
    plan: VoteJoinPlan = DEFAULT_PLAN,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a streaming query: every micro-batch of ``queries`` (qid + 25
    bins) yields (qid, Id, votes, batch_id) rows in ``sink_path``, one folder
    per batch (``batch_id=<n>``)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        pairs = vote_join(batch, slices, threshold, query_id=query_id, plan=plan)
        (
            pairs.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}")
        )

    w = queries.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def stream_insert_hashes(
    hashed: DataFrame,
    store,
    order: list[str],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append hashed slices arriving on a stream to a store: each micro-batch
    goes through ``sources.ingest.insert_slices``, as any other insert, so its
    slices are checked, and found by lookups as soon as they are there.  The
    batch is named after the stream's checkpoint and the batch id: a replayed
    micro-batch has the same Ids and replaces its rows.  Rows that break a
    constraint end the stream with ``ConstraintError``."""
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def run(batch: DataFrame, batch_id: int) -> None:
        insert_slices(store, batch, order, batch=f"stream-{stream}-{batch_id}")

    w = hashed.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
