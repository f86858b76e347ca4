"""Plan choices for the batch vote join.

``broadcast``: the exploded query side is shipped to every executor (its
bytes are measured first, so the bound is checked, not assumed); the store is
streamed once through a broadcast hash join, with no shuffle of the store.

``shuffle``: both exploded sides are hash-partitioned on (position, bin,
cell).  The pair work of a key is (query rows) x (store rows) with that
(position, bin), from exact counts.  Hot keys — for example a bin shared by a
third of all slices — become grids of cells, so that both sides of a hot key
are spread and no task holds more than about ``skew_factor`` times the mean
work; copies grow with the square root of the cells.

``count``: the shuffle plan on narrow rows — all 25 positions as (position,
bin, id), agreements counted per pair.  It shuffles a row for each agreeing
(pair, position), but no bins.

``couples``: the shuffle plan of a store with itself, on couples of positions
in place of single ones: more rows move and far fewer are joined.

``auto`` takes the plan of least cost (``costs``): bytes that it moves, plus
what it does to each joined row, in bytes that could be moved in that time.
The rows and the pair work it uses are exact counts, not estimates.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class VoteJoinPlan:
    # "auto" (by cost) | "broadcast" | "shuffle" (carry bin vectors, pigeonhole keys)
    # | "count" (narrow rows on all 25 positions, count agreements per pair)
    # | "couples" (of a self-join: pigeonhole keys of two positions; others: "shuffle")
    strategy: str = "auto"
    # the exploded query side may be broadcast when its measured bytes (ids,
    # bins, signature, key) fit in this
    broadcast_bytes: int = 128 << 20
    # a (position, bin) key whose pair work (query rows x store rows) is more
    # than ``skew_factor`` times the mean work per partition is split
    skew_factor: float = 2.0
    # partitions of the shuffle join (None: spark.sql.shuffle.partitions);
    # set explicitly so that AQE does not merge partitions whose bytes are
    # small but whose pair work is large
    partitions: int | None = None
    # physical join of the shuffle strategy: both sides stay partitioned by
    # (position, bin, cell) so the cells spread the work
    join_hint: str = "merge"


DEFAULT_PLAN = VoteJoinPlan()


#: Bytes of a (position, bin, id) row, and of the bins and signature of a row
#: that carries them, with row overhead.
NARROW_ROW_BYTES, VECTOR_BYTES = 40, 25 * 4 + 16 + 4 * 8
#: Cost of a joined row that the signature test drops, and of one that is
#: counted by pair (shuffled, then grouped), in bytes moved.
TESTED, COUNTED = 5.0, 60.0


def exploded_row_bytes() -> int:
    return NARROW_ROW_BYTES + VECTOR_BYTES


@dataclass(frozen=True)
class JoinFacts:
    """What the cost rule knows of one join.  ``work`` is the number of joined
    rows over the chosen positions, ``work_everywhere`` over all 25."""

    n_store: int
    n_queries: int
    query_bytes: int | None  # exploded; None: the queries are the store itself
    positions: int
    work: float
    work_everywhere: float
    carried_bytes: int = 8
    copies: int = 1


def costs(facts: JoinFacts) -> dict[str, float]:
    """The cost of each plan, in bytes moved."""
    rows = facts.n_store + facts.n_queries
    out = {
        "shuffle": rows * facts.positions * (exploded_row_bytes() + facts.carried_bytes) + facts.work * TESTED,
        "count": rows * 25 * (NARROW_ROW_BYTES + facts.carried_bytes) + facts.work_everywhere * (COUNTED + facts.carried_bytes),
    }
    if facts.query_bytes is not None:
        out["broadcast"] = facts.query_bytes * facts.copies + facts.work * TESTED
    return out


def couples_cost(facts: JoinFacts, couples: int, work: float) -> float:
    """The cost of the join on couples of positions, ``work`` joined rows."""
    return (facts.n_store + facts.n_queries) * couples * (exploded_row_bytes() + facts.carried_bytes) + work * TESTED


def choose(plan: VoteJoinPlan, facts: JoinFacts) -> str:
    if plan.strategy == "couples":
        return "shuffle"
    if plan.strategy in ("shuffle", "count") or plan.strategy == "broadcast" and facts.query_bytes is not None:
        return plan.strategy
    if plan.strategy not in ("auto", "broadcast"):
        raise ValueError(f"unknown strategy {plan.strategy!r}")
    cost = costs(facts)
    if facts.query_bytes is not None and facts.query_bytes > plan.broadcast_bytes:
        del cost["broadcast"]
    return min(cost, key=cost.get)
