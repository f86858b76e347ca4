"""Column expressions over the 25 hash bins and the cluster labels.

Everything here returns built-in Spark expressions, so the work stays in
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import BIN_COLS, N_BINS


def check_query_bins(bins: Sequence[int]) -> list[int]:
    """A query vector must hold exactly 25 integer bins."""
    bins = list(bins)
    if len(bins) != N_BINS:
        raise ValueError(f"a query needs exactly {N_BINS} bins, got {len(bins)}")
    out = []
    for b in bins:
        if b is None:
            raise ValueError("query bins must not be NULL")
        out.append(int(b))
    return out


def pack_bins(df: DataFrame, out: str = "bins", drop: bool = True) -> DataFrame:
    """25 bin columns -> one ``array<int>`` column, position order kept."""
    res = df.withColumn(out, F.array(*[F.col(c) for c in BIN_COLS]))
    return res.drop(*BIN_COLS) if drop else res


def spread_bins(df: DataFrame, src: str = "bins", drop: bool = True, check: bool = True) -> DataFrame:
    """One array column of 25 bins -> 25 bin columns.

    With ``check`` a row whose array does not hold exactly 25 bins raises
    (the store has 25 NOT NULL bin columns).
    """
    arr = F.col(src)
    if check:
        arr = F.when(
            F.size(arr) == N_BINS, arr
        ).otherwise(F.raise_error(F.concat(F.lit("slice needs 25 bins, got "), F.size(arr).cast("string"))))
        df = df.withColumn(src, arr)
    res = df.select("*", *[F.col(src)[i].alias(c) for i, c in enumerate(BIN_COLS)])
    return res.drop(src) if drop else res


def encode_clusters(col: Column | str) -> Column:
    """Label list -> stored text: labels joined by ',' (NULL list -> '')."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.concat_ws(",", c), F.lit(""))


def decode_clusters(col: Column | str) -> Column:
    """Stored text -> label list.  NULL or '' -> empty list; a label that held
    a comma comes back as two labels; trailing empty labels survive."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(F.split(c, ",", -1))


def agree(a: Column, b: Column) -> Column:
    """1 when two bins are equal, else 0; NULL counts as no agreement."""
    return F.coalesce(a == b, F.lit(False)).cast("int")


def votes_vs_literal(bins: Sequence[int], prefix: str = "") -> Column:
    """Number of positions where the row's bins equal the literal query bins."""
    bins = check_query_bins(bins)
    terms = [agree(F.col(prefix + c), F.lit(b)) for c, b in zip(BIN_COLS, bins)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def any_agree_literal(bins: Sequence[int], positions: Sequence[int] | None = None) -> Column:
    """OR of equalities at some positions: implied by any vote >= 1, and
    pushed to the parquet scan as row-group filters."""
    bins = check_query_bins(bins)
    pos = range(N_BINS) if positions is None else positions
    cond = None
    for i in pos:
        e = F.col(BIN_COLS[i]) == F.lit(bins[i])
        cond = e if cond is None else (cond | e)
    return cond


def effective_threshold(threshold: int | None) -> int | None:
    """A row with no agreeing bin is never a candidate, so T <= 0 acts as 1.
    NULL T matches nothing (returned as None)."""
    if threshold is None:
        return None
    return max(int(threshold), 1)


def pigeonhole_positions(threshold: int) -> list[int]:
    """Positions of which any pair with >= T agreeing bins shares at least one.

    A pair that agrees in >= T of 25 positions disagrees in <= 25 - T, so
    among any 25 - T + 1 positions at least one agrees.  We use the first
    25 - T + 1 positions.
    """
    t = effective_threshold(threshold)
    n = N_BINS - t + 1
    return list(range(max(n, 0)))
