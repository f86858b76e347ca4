"""Batch vote join: many query vectors against many stored slices.

A (query, slice) pair is a match when the two agree in >= T of the 25
positions.  Plan:

1. *Pigeonhole*: a matching pair agrees somewhere among any 25 - T + 1
   positions, so each side is exploded to one row per such position only.
   Any choice is exact; the positions with the least pair work (query rows
   times store rows of each key, counted exactly) are taken.
2. Equi-join on (position, bin) — broadcast when the query side is small
   (bytes measured) and the cost rule prefers it, else a shuffle join whose
   hot keys are split on both sides (``_salted``).  The narrow *count* plan
   (``_count_join``: all 25 positions as (position, bin, id) rows, votes
   counted per pair) wins when keys are selective.
3. A joined row carries both sides' signatures: a byte of each bin, seven to
   a long.  Counting unequal bytes takes a few integer operations a row, and a
   pair with more than 25 - T of them is no match, so nearly all joined rows
   are dropped in generated code.  Only what is left compares the 25 bins
   (``_scored``), and a pair is kept only in the row of its *first* agreeing
   position, in the order of the choice.  Every matching pair therefore comes
   out exactly once: no ``distinct`` and no second shuffle of pairs.
4. The all-pairs join of a store with itself may join on *two* positions: the
   25 are dealt into T - 1 groups, of which one holds two of any T agreeing
   positions, and a row is exploded to the couples of positions within each
   group.  More rows move, but far fewer are joined (the cost rule decides, by
   exact counts).  Copies, rows with equal bins, are joined once, as a class
   (``similar_classes``).
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bins import effective_threshold
from ..plans.strategy import DEFAULT_PLAN, NARROW_ROW_BYTES, JoinFacts, VoteJoinPlan, choose, costs, couples_cost, exploded_row_bytes
from ..session import ROWS_DEALT, ensure_checkpoint_dir, parts_for
from ..schema import BIN_COLS, N_BINS
from .lookup import VOTES, cluster_predicate

Q = "q_"
S = "s_"

#: Bins in one long of a signature: a byte each, and the sign bit stays free.
_PER_LONG = 7
_SIGNATURES = [f"v{i}" for i in range(-(-N_BINS // _PER_LONG))]
#: A store of fewer rows than this a task is dealt out anew before it is exploded.
ROWS_A_TASK = 50_000
#: Rows that a long row counts for, where its hits are grouped by query and slice.
_COUNTED_A_ROW = 4


def _byte(c: str) -> Column:
    b = F.col(c)
    folded = b.bitwiseXOR(F.shiftright(b, 16))
    return F.coalesce(folded.bitwiseXOR(F.shiftright(folded, 8)).bitwiseAND(255).cast("long"), F.lit(0).cast("long"))


def signatures() -> list[Column]:
    """A byte of every bin, seven to a long.  Equal bins have equal bytes."""
    out = []
    for i in range(0, N_BINS, _PER_LONG):
        parts = [F.shiftleft(_byte(c), 8 * k) for k, c in enumerate(BIN_COLS[i : i + _PER_LONG])]
        out.append(reduce(lambda a, b: a.bitwiseOR(b), parts))
    return out


def _unequal() -> Column:
    """Positions whose bytes differ: at most those whose bins differ."""
    low = sum(0x7F << 8 * k for k in range(_PER_LONG))
    high = sum(0x80 << 8 * k for k in range(_PER_LONG))
    total = None
    for v in _SIGNATURES:
        x = F.col(Q + v).bitwiseXOR(F.col(S + v))
        # a byte that is not zero sets its high bit
        set_ = (x.bitwiseAND(F.lit(low)) + F.lit(low)).bitwiseOR(x).bitwiseAND(F.lit(high))
        n = F.bit_count(set_)
        total = n if total is None else total + n
    return total


def _couples(order: list[int], t: int) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """``order`` dealt into T - 1 groups, and the couples of positions within
    them: T agreeing positions have two in one group."""
    groups = [order[g :: t - 1] for g in range(t - 1)]
    return groups, [c for g in groups for c in combinations(g, 2)]


def _couple_keys(couples: list[tuple[int, int]]) -> Column:
    """(number of the couple, its two bins as one long); NULL bins give none."""
    low = [F.col(BIN_COLS[j]).cast("long").bitwiseAND(F.lit((1 << 32) - 1)) for _, j in couples]
    both = [F.shiftleft(F.col(BIN_COLS[i]).cast("long"), 32).bitwiseOR(x) for (i, _), x in zip(couples, low)]
    return F.array(*[F.struct(F.lit(k).alias("pos"), b.alias("bin")) for k, b in enumerate(both)])


def _explode(df: DataFrame, id_col: str, positions: list[int], prefix: str, keep: list[str], couples: list[tuple[int, int]] | None = None) -> DataFrame:
    """One row for each of the positions (or couples of them), with the bins
    as one array.  A NULL bin has no row: it never agrees."""
    keys = F.array(*[F.struct(F.lit(p).alias("pos"), F.col(BIN_COLS[p]).alias("bin")) for p in positions]) if couples is None else _couple_keys(couples)
    # bins and signature are made below the generator: once a row, not once a key
    rows = df.select(
        F.col(id_col).alias(prefix + "id"),
        F.array(*[F.col(c) for c in BIN_COLS]).alias(prefix + "bins"),
        *[v.alias(prefix + n) for v, n in zip(signatures(), _SIGNATURES)],
        *[F.col(c).alias(prefix + c) for c in keep],
        keys.alias("_ks"),
    )
    rows = rows.withColumn("_k", F.explode("_ks")).drop("_ks")
    return rows.select("*", F.col("_k.pos").alias("pos"), F.col("_k.bin").alias("bin")).drop("_k").filter("bin is not null")


def _scored(joined: DataFrame, threshold: int, order: list[int]) -> DataFrame:
    """The joined rows that are matches and in their pair's first agreeing
    position of ``order``, with the votes.  The agreeing positions are found
    once a row: the generator keeps the optimizer from repeating it."""
    near = joined.filter(_unequal() <= F.lit(N_BINS - threshold))
    rest = [p for p in range(N_BINS) if p not in order]
    agreeing = F.filter(F.array(*[F.lit(p) for p in [*order, *rest]]), lambda p: F.get(F.col(Q + "bins"), p) == F.get(F.col(S + "bins"), p))
    match = F.filter(F.array(agreeing), lambda c: (F.size(c) >= threshold) & (F.get(c, F.lit(0)) == F.col("pos")))
    return near.select("*", F.explode(match).alias("_hit")).withColumn(VOTES, F.size("_hit")).drop("_hit")


def _scored_couples(joined: DataFrame, threshold: int, groups: list[list[int]], couples: list[tuple[int, int]]) -> DataFrame:
    """As ``_scored``, for rows joined on couples: a match is kept in the row
    of the first couple that agrees: the two first agreeing positions of the
    first group that has two.  The agreeing positions are the bits of a number."""
    near = joined.filter(_unequal() <= F.lit(N_BINS - threshold))
    agree = reduce(Column.bitwiseOR, [F.when(F.get(F.col(Q + "bins"), p) == F.get(F.col(S + "bins"), p), F.lit(1 << p)).otherwise(F.lit(0)) for p in range(N_BINS)])
    bits = [sum(1 << p for p in g) for g in groups]
    of = {c: n for n, g in enumerate(groups) for c in combinations(g, 2)}

    def by_couple(value) -> Column:
        return F.get(F.array(*[F.lit(value(c)) for c in couples]), F.col("pos"))

    upto = by_couple(lambda c: sum(1 << p for p in groups[of[c]][: groups[of[c]].index(c[1]) + 1]))
    first = F.col("_hit").bitwiseAND(upto) == by_couple(lambda c: 1 << c[0] | 1 << c[1])
    hits = near.select("*", F.explode(F.array(agree)).alias("_hit")).withColumn(VOTES, F.bit_count("_hit")).filter((F.col(VOTES) >= threshold) & first)
    group = by_couple(of.get)
    for n, own in enumerate(bits[:-1]):  # an earlier group has one agreeing position at most
        x = F.col("_hit").bitwiseAND(F.lit(own))
        hits = hits.filter((group <= n) | (x.bitwiseAND(x - 1) == 0))
    return hits.drop("_hit")


def _keys(df: DataFrame, couples: list[tuple[int, int]] | None = None) -> DataFrame:
    """(pos, bin) of every row and position, or couple of positions."""
    if couples is not None:
        return df.select(F.explode(_couple_keys(couples)).alias("_k")).select("_k.pos", "_k.bin").filter("bin is not null")
    keys = F.array(*[F.struct(F.lit(p).alias("pos"), F.col(c).alias("bin")) for p, c in enumerate(BIN_COLS)])
    return df.select(F.explode(keys).alias("_k")).select("_k.pos", "_k.bin").filter("bin is not null")


def _key_counts(x: DataFrame, name: str) -> DataFrame:
    """Rows of each (pos, bin): a partial count in each task, so the shuffle
    has one row a key and task."""
    return x.groupBy("pos", "bin").agg(F.count(F.lit(1)).alias(name))


def _pair_work(queries: DataFrame, store: DataFrame, self_pairs: bool, couples: list[tuple[int, int]] | None = None) -> DataFrame:
    """(pos, bin, _ns, _nq, _w): store rows, query rows and their product for
    every key of both sides.  Checkpointed: the choice of positions and the
    hot keys both read it."""
    ensure_checkpoint_dir(queries.sparkSession)
    cs = _key_counts(_keys(store, couples), "_ns")
    work = cs.withColumn("_nq", F.col("_ns")) if self_pairs else cs.join(_key_counts(_keys(queries), "_nq"), ["pos", "bin"])
    return work.withColumn("_w", F.col("_ns").cast("double") * F.col("_nq")).checkpoint(eager=True)


def _broadcast_work(queries: DataFrame, store: DataFrame) -> tuple[dict[int, float], int]:
    """The pair work of each position and the rows of the store, for queries
    small enough to broadcast: one pass over the store, no row of it moves."""
    cq = F.broadcast(_key_counts(_keys(queries), "_nq"))
    return _by_position(_keys(store).join(cq, ["pos", "bin"], "left"), F.col("_nq"), F.lit(1))


def _by_position(keys: DataFrame, work: Column, rows: Column) -> tuple[dict[int, float], int]:
    """The work of each position, and the rows of the fullest one; one row
    reaches the driver."""
    own = [F.col("pos") == p for p in range(N_BINS)]
    r = keys.agg(*[F.sum(F.when(at, work).cast("double")) for at in own], *[F.sum(F.when(at, rows)) for at in own]).first()
    return {p: r[p] or 0.0 for p in range(N_BINS)}, max(r[N_BINS + p] or 0 for p in range(N_BINS))


def least_work(work: dict[int, float], threshold: int) -> list[int]:
    """The 25 - T + 1 positions with the least pair work, least first."""
    return sorted(range(N_BINS), key=lambda p: (work.get(p, 0.0), p))[: N_BINS - threshold + 1]


def _salted(qx: DataFrame, sx: DataFrame, work: DataFrame, plan: VoteJoinPlan, n_parts: int, self_pairs: bool) -> tuple[DataFrame, DataFrame]:
    """Split hot (pos, bin) keys by pair work, on both sides.

    A key with more than ``skew_factor`` times the mean pair work of a
    partition becomes a grid of ``a x b`` cells: a store row has one of ``a``
    numbers and is copied to the b cells of it, a query row one of ``b``
    numbers and to the a cells of it, so every pair meets in one cell.  a and
    b follow the rows of each side, which keeps copies near the square root of
    the cells.  Keys with more than the mean times the factor number at most
    ``n_parts / skew_factor`` whatever the data, so their table is broadcast.

    With ``self_pairs`` both sides are one table and number their rows alike;
    only the cells on and above the diagonal are made, so that a pair of a
    split key meets once (``_ordered`` keeps one of the two on the diagonal).
    """
    target = F.greatest(work.select((F.sum("_w") / F.lit(n_parts)).alias("m")).scalar() * F.lit(plan.skew_factor), F.lit(1.0))
    cells = F.ceil(F.col("_w") / target)
    a = F.greatest(F.lit(1), F.least(F.col("_ns"), F.ceil(F.sqrt(cells * F.col("_ns") / F.col("_nq")))))
    hot = work.filter(F.col("_w") > target).select("pos", "bin", a.alias("_a"), F.greatest(F.lit(1), F.ceil(cells / a)).alias("_b"))
    if self_pairs:
        hot = hot.withColumn("_b", F.col("_a"))

    def number(of: str, parts: str):
        return F.pmod(F.xxhash64(F.col(of)), F.coalesce(F.col(parts), F.lit(1)))

    def to(last: str):
        return F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(last), F.lit(1)) - 1)

    sx = sx.join(F.broadcast(hot), ["pos", "bin"], "left").withColumn("_sn", number(S + "id", "_a"))
    qx = qx.join(F.broadcast(hot), ["pos", "bin"], "left").withColumn("_qn", number(Q + "id", "_b"))
    if self_pairs:
        sx = sx.withColumn("_qn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_sn"))))
        qx = qx.withColumn("_sn", F.explode(F.sequence(F.col("_qn"), F.coalesce(F.col("_a"), F.lit(1)) - 1)))
    else:
        sx = sx.withColumn("_qn", F.explode(to("_b")))
        qx = qx.withColumn("_sn", F.explode(to("_a")))
    return qx.drop("_a", "_b"), sx.drop("_a", "_b")


def _ordered(joined: DataFrame) -> DataFrame:
    """Of a self-join's rows each unordered pair once, the smaller id first."""
    kept = joined.filter((F.col("_sn") != F.col("_qn")) | (F.col(Q + "id") < F.col(S + "id")))
    sides = [c[len(Q) :] for c in joined.columns if c.startswith(Q) and c not in (Q + "bins", *(Q + v for v in _SIGNATURES))]
    swap = F.col(Q + "id") > F.col(S + "id")  # what a side carries goes with its id
    return kept.withColumns({a + c: F.when(swap, F.col(b + c)).otherwise(F.col(a + c)) for a, b in ((Q, S), (S, Q)) for c in sides})


_CELL = ["pos", "bin", "_sn", "_qn"]


def _cell_join(qx: DataFrame, sx: DataFrame, work: DataFrame, plan: VoteJoinPlan, n_parts: int, self_pairs: bool) -> DataFrame:
    """Both sides joined by cell.  The explicit hash partitioning is reused by
    the join (no further exchange), and AQE keeps the partition count."""
    qs, ss = _salted(qx, sx, work, plan, n_parts, self_pairs)
    joined = ss.repartition(n_parts, *_CELL).join(qs.repartition(n_parts, *_CELL).hint(plan.join_hint), _CELL)
    return _ordered(joined) if self_pairs else joined


def _count_join(
    queries: DataFrame,
    store: DataFrame,
    t: int,
    query_id: str,
    store_id: str,
    keep_query: list[str],
    keep_store: list[str],
    self_pairs: bool,
    plan: VoteJoinPlan,
    work: DataFrame,
) -> DataFrame:
    """The narrow plan: explode all 25 positions as (pos, bin, id) rows,
    join on (pos, bin, salt), and count agreeing positions per pair
    (partial then final aggregate).  Shuffles ~16-byte rows instead of rows
    carrying the bin vectors, but also shuffles one row per agreeing
    (pair, position)."""
    all_pos = list(range(N_BINS))

    def narrow(df, id_col, prefix, keep):
        keys = F.array(*[F.struct(F.lit(p).alias("pos"), F.col(BIN_COLS[p]).alias("bin")) for p in all_pos])
        return df.select(
            F.col(id_col).alias(prefix + "id"), *[F.col(c).alias(prefix + c) for c in keep], F.explode(keys).alias("_k")
        ).select("*", F.col("_k.pos").alias("pos"), F.col("_k.bin").alias("bin")).drop("_k")

    qx = narrow(queries, query_id, Q, keep_query)
    sx = narrow(store, store_id, S, keep_store)
    spark = queries.sparkSession
    n_parts = plan.partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = _cell_join(qx, sx, work, plan, n_parts, self_pairs)
    group = [Q + "id", S + "id", *[Q + c for c in keep_query], *[S + c for c in keep_store]]
    return (
        joined.groupBy(*group)
        .agg(F.count(F.lit(1)).cast("int").alias(VOTES))
        .filter(F.col(VOTES) >= F.lit(t))
    )


def vote_join(
    queries: DataFrame,
    store: DataFrame,
    threshold: int | None,
    query_id: str = "qid",
    store_id: str = "Id",
    keep_query: list[str] | None = None,
    keep_store: list[str] | None = None,
    self_pairs: bool = False,
    plan: VoteJoinPlan = DEFAULT_PLAN,
) -> DataFrame:
    """All (query, slice) pairs with >= T positional agreements.

    Returns ``(query_id, store_id, votes, *keep_query, *keep_store)``.  With
    ``self_pairs`` the two sides are the same table and only pairs with
    ``query id < store id`` are returned (each unordered pair once).
    """
    keep_query, keep_store = list(keep_query or []), list(keep_store or [])
    t = effective_threshold(threshold)
    out_cols = [
        F.col(Q + "id").alias(query_id),
        F.col(S + "id").alias(store_id if store_id != query_id else store_id + "_2"),
        F.col(VOTES),
        *[F.col(Q + c).alias(c) for c in keep_query],
        *[F.col(S + c).alias(c) for c in keep_store],
    ]
    if t is None or t > N_BINS:
        empty = queries.select(
            F.col(query_id).alias(Q + "id"), F.col(query_id).alias(S + "id"), F.lit(0).alias(VOTES),
            *[F.col(c).alias(Q + c) for c in keep_query],
        ).filter(F.lit(False))
        for c in keep_store:
            empty = empty.withColumn(S + c, F.lit(None).cast(dict(store.dtypes)[c]))
        return empty.select(*out_cols)
    spark = queries.sparkSession
    n_parts = plan.partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    carried = [query_id, *keep_query]
    n_queries, query_bytes = (None, None) if self_pairs else _measured(queries, carried)
    work, how = None, plan.strategy
    if not self_pairs and how in ("auto", "broadcast") and (how == "broadcast" or query_bytes * (N_BINS - t + 1) <= plan.broadcast_bytes):
        by_position, n_store = _broadcast_work(queries, store)
    else:
        work = _pair_work(queries, store, self_pairs)
        by_position, n_store = _by_position(work, F.col("_w"), F.col("_ns"))
    positions = least_work(by_position, t)
    facts = JoinFacts(
        n_store=n_store, n_queries=n_store if n_queries is None else n_queries, query_bytes=None if query_bytes is None else query_bytes * len(positions), positions=len(positions),
        work=sum(by_position.get(p, 0.0) for p in positions) / (1 + self_pairs), work_everywhere=sum(by_position.values()) / (1 + self_pairs),
        carried_bytes=8 + 8 * len(keep_query) + 8 * len(keep_store), copies=_executors(spark),
    )
    how, couples = choose(plan, facts), None
    if self_pairs and t > 1 and plan.strategy in ("auto", "couples"):
        groups, couples = _couples(least_work(by_position, 1), t)
        joined_rows = None
        if plan.strategy == "couples" or couples_cost(facts, len(couples), 0.0) < costs(facts)[how]:
            by_couple = _pair_work(queries, store, True, couples)
            joined_rows = (by_couple.agg(F.sum("_w")).first()[0] or 0.0) / 2
        if joined_rows is None or plan.strategy == "auto" and couples_cost(facts, len(couples), joined_rows) >= costs(facts)[how]:
            couples = None
    if self_pairs and not plan.partitions:  # a task's rows stay bounded, whatever the setting
        n_parts = max(n_parts, -(-n_store * (len(positions) if couples is None else len(couples)) // ROWS_DEALT))
    if couples is not None:
        qx, sx = (_explode(df, i, [], side, keep, couples) for df, i, side, keep in ((queries, query_id, Q, keep_query), (store, store_id, S, keep_store)))
        return _scored_couples(_cell_join(qx, sx, by_couple, plan, n_parts, True), t, groups, couples).select(*out_cols)
    if how != "broadcast" and work is None:
        work = _pair_work(queries, store, self_pairs)
    if how == "count":
        return _count_join(queries, store, t, query_id, store_id, keep_query, keep_store, self_pairs, plan, work).select(*out_cols)
    qx = _explode(queries, query_id, positions, Q, keep_query)
    if how == "broadcast":
        dealt = store.repartition(n_parts) if n_store < ROWS_A_TASK * n_parts else store
        joined = _explode(dealt, store_id, positions, S, keep_store).join(F.broadcast(qx), ["pos", "bin"])
    else:
        sx = _explode(store, store_id, positions, S, keep_store)
        joined = _cell_join(qx, sx, work.filter(F.col("pos").isin(positions)), plan, n_parts, self_pairs)
    return _scored(joined, t, positions).select(*out_cols)


def _executors(spark) -> int:
    """Copies that a broadcast makes, at most."""
    cores = int(spark.conf.get("spark.executor.cores", "1"))
    return 1 if (spark.sparkContext.master or "").startswith("local[") else max(1, spark.sparkContext.defaultParallelism // cores)


def _measured(queries: DataFrame, carried: list[str], row_bytes: int = exploded_row_bytes()) -> tuple[int, int]:
    """Rows, and measured bytes of their rows in one position: bins, signature
    and key by type, and the carried columns as they are."""
    wide = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in carried), F.lit(row_bytes))
    r = queries.agg(F.count(F.lit(1)).alias("n"), F.sum(wide).alias("b")).first()
    return r["n"], r["b"] or 0


def vote_join_inverted(
    queries: DataFrame,
    bins_long: DataFrame,
    threshold: int | None,
    query_id: str = "qid",
    base: int = 1,
    plan: VoteJoinPlan = DEFAULT_PLAN,
) -> DataFrame:
    """V6 for many queries: (query id, Id, votes) over the long layout
    (HashTable, HashBin, SubFingerprintId).  The long table already is the
    exploded store, so only the queries are exploded; the join on
    (HashTable, HashBin) is a broadcast of the measured queries, else a shuffle
    split by cells; a count per pair follows."""
    t = effective_threshold(threshold)
    keys = F.array(
        *[F.struct(F.lit(i + base).alias("pos"), F.col(c).cast("long").alias("bin")) for i, c in enumerate(BIN_COLS)]
    )
    qx = queries.select(F.col(query_id).alias(Q + "id"), F.explode(keys).alias("_k")).select(
        Q + "id", F.col("_k.pos").alias("pos"), F.col("_k.bin").alias("bin")
    )
    sx = bins_long.select(
        F.col("SubFingerprintId").alias(S + "id"), F.col("HashTable").alias("pos"), F.col("HashBin").alias("bin")
    )
    if t is None or t > N_BINS:
        return qx.select(F.col(Q + "id").alias(query_id), F.lit(0).cast("long").alias("Id"), F.lit(0).alias(VOTES)).filter(F.lit(False))
    query_bytes = _measured(qx, [Q + "id"], NARROW_ROW_BYTES)[1]
    if plan.strategy == "broadcast" or plan.strategy == "auto" and query_bytes <= plan.broadcast_bytes:
        # only long rows that a query has are dealt by their slice, to be counted in tasks of bounded rows
        met = sx.join(F.broadcast(qx.select("pos", "bin").distinct()), ["pos", "bin"], "left_semi")
        joined = met.repartition(parts_for(queries.sparkSession, _COUNTED_A_ROW * bins_long.count()), S + "id").join(F.broadcast(qx), ["pos", "bin"])
    else:
        ensure_checkpoint_dir(queries.sparkSession)
        n_parts = plan.partitions or int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        work = _key_counts(sx, "_ns").join(_key_counts(qx, "_nq"), ["pos", "bin"])
        work = work.withColumn("_w", F.col("_ns").cast("double") * F.col("_nq")).checkpoint(eager=True)
        joined = _cell_join(qx, sx, work, plan, n_parts, False)
    return (
        joined.groupBy(Q + "id", S + "id")
        .agg(F.count(F.lit(1)).cast("int").alias(VOTES))
        .filter(F.col(VOTES) >= F.lit(t))
        .select(F.col(Q + "id").alias(query_id), F.col(S + "id").alias("Id"), VOTES)
    )


def vote_lookup_batch(
    slices: DataFrame,
    queries: DataFrame,
    threshold: int | None,
    clusters=None,
    mode: str = "text",
    query_id: str = "qid",
    plan: VoteJoinPlan = DEFAULT_PLAN,
    collation: str | None = None,
    dialect: str = "spark",
) -> DataFrame:
    """V3: the distinct slices matched by any of the queries (set union of
    the single lookups, duplicates removed by slice Id)."""
    store = slices
    cp = cluster_predicate(clusters, mode, collation, dialect)
    if cp is not None:
        store = store.filter(cp)
    pairs = vote_join(queries, store, threshold, query_id=query_id, plan=plan)
    return slices.join(pairs.select("Id").distinct(), "Id", "left_semi")


def vote_lookup_batch_votes(slices, queries, threshold, clusters=None, mode="text", query_id="qid", plan=DEFAULT_PLAN, collation=None, dialect="spark"):
    """V4 in batch form: (query id, slice Id, votes) for every match."""
    store = slices
    cp = cluster_predicate(clusters, mode, collation, dialect)
    if cp is not None:
        store = store.filter(cp)
    return vote_join(queries, store, threshold, query_id=query_id, plan=plan)


def similar_pairs(slices: DataFrame, threshold: int | None, id_col: str = "Id", plan: VoteJoinPlan = DEFAULT_PLAN) -> DataFrame:
    """V7: pairs of stored slices (a < b) with >= T positional agreements.
    Returns (a_id, b_id, votes).  A row without an id is in no pair."""
    slices = slices.filter(F.col(id_col).isNotNull())
    pairs = vote_join(slices, slices, threshold, query_id=id_col, store_id=id_col, self_pairs=True, plan=plan)
    return pairs.select(F.col(id_col).alias("a_id"), F.col(id_col + "_2").alias("b_id"), F.col(VOTES))


def similar_classes(slices: DataFrame, threshold: int | None, id_col: str = "Id", plan: VoteJoinPlan = DEFAULT_PLAN) -> DataFrame:
    """V7 by row: for every row of ``slices`` its id, class_id (the smallest
    id among the rows with the same bins), n_class (the rows of the class) and
    n_links, the number of other rows that agree with it in >= T positions.

    Copies are joined once, as a class; a class's links count the rows of the
    classes that it agrees with, and its own other rows.  No pair of rows is
    made, so the result grows with the rows however many of them are alike."""
    ensure_checkpoint_dir(slices.sparkSession)
    t = effective_threshold(threshold)
    classes = slices.groupBy(*BIN_COLS).agg(F.min(id_col).alias("class_id"), F.count(F.lit(1)).alias("n_class"))
    classes = classes.withColumn("_class", F.monotonically_increasing_id()).checkpoint()
    pairs = vote_join(classes, classes, threshold, query_id="_class", store_id="_class", keep_query=["n_class"], keep_store=["n_class"], self_pairs=True, plan=plan)
    # by position: both sides carry a column of one name
    pairs = pairs.toDF("_a", "_b", VOTES, "_na", "_nb")
    ends = F.explode(F.array(F.struct(F.col("_a").alias("_class"), F.col("_nb").alias("_n")), F.struct(F.col("_b").alias("_class"), F.col("_na").alias("_n"))))
    links = pairs.select(ends.alias("_e")).select("_e.*").groupBy("_class").agg(F.sum("_n").alias("_links"))
    # copies agree wherever their bin is not NULL
    agree = sum((F.col(c).isNotNull().cast("int") for c in BIN_COLS), F.lit(0))
    own = F.when(agree >= F.lit(N_BINS + 1 if t is None else t), F.col("n_class") - 1).otherwise(F.lit(0))
    found = classes.join(links, "_class", "left").withColumn("n_links", (F.coalesce("_links", F.lit(0)) + own).cast("long"))
    return _members(slices, found).select(F.col(id_col), "class_id", "n_class", "n_links")


#: A class of more than this share of the rows reaches its rows by a broadcast.
_LARGE_CLASS = 1e-3


def _members(slices: DataFrame, classes: DataFrame) -> DataFrame:
    """Every row with the columns of its class.  Large classes, of which there
    are few, are broadcast, so that no task gets all their rows."""
    rows = F.greatest(classes.select((F.sum("n_class") * _LARGE_CLASS).alias("m")).scalar(), F.lit(1.0))
    classes = classes.select(*[F.col(c).alias("_c" + c) for c in BIN_COLS], "class_id", "n_class", "n_links", (F.col("n_class") > rows).alias("_large")).checkpoint()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col("_c" + c)) for c in BIN_COLS])
    large, small = classes.filter("_large"), classes.filter("not _large")
    return slices.join(F.broadcast(large), same).unionByName(slices.join(F.broadcast(large), same, "left_anti").join(small, same))
