"""Integrity checks: the store's constraints as data-quality jobs.

Each check returns the offending rows plus a ``rule`` column naming the
broken constraint; an empty result means the table passes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import parts_for


def check_ranges(tracks: DataFrame) -> DataFrame:
    """Q1: ReleaseYear > -1 and Length > -1.  NULL passes (a CHECK is only
    broken by FALSE), and -0.5 passes."""
    year = ~(F.col("ReleaseYear") > F.lit(-1))
    length = ~(F.col("Length") > F.lit(-1))
    bad = tracks.filter(F.coalesce(year, F.lit(False)) | F.coalesce(length, F.lit(False)))
    rule = F.when(F.coalesce(year, F.lit(False)) & F.coalesce(length, F.lit(False)), F.lit("ReleaseYear,Length")).when(
        F.coalesce(year, F.lit(False)), F.lit("ReleaseYear")
    ).otherwise(F.lit("Length"))
    return bad.withColumn("rule", rule)


def check_orphans(child: DataFrame, parent: DataFrame, child_key: str = "TrackId", parent_key: str = "Id", name: str = "TrackId") -> DataFrame:
    """Q2: child rows whose foreign key has no parent row (anti-join).  A
    NULL key is not an orphan (a foreign key accepts NULL)."""
    p = parent.select(F.col(parent_key).alias("_bv_pk"))
    c = child.filter(F.col(child_key).isNotNull())
    return c.join(p, c[child_key] == p["_bv_pk"], "left_anti").withColumn("rule", F.lit(f"foreign key {name}"))


def check_unique(df: DataFrame, keys: Sequence[str], rare: bool = False) -> DataFrame:
    """Q3: key values held by more than one row, with their row count.

    With ``rare`` keys, which hardly repeat, grouping before the shuffle would
    fold nothing: they are dealt as they are, into tasks of bounded rows, and
    grouped there."""
    keys = list(keys)
    if rare:
        df = df.select(*keys).repartition(parts_for(df.sparkSession, df.count()), *keys)
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .withColumn("rule", F.lit("unique " + ",".join(keys)))
    )


def check_new(df: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q3 against stored rows: rows of ``df`` whose key is there already.  A
    semi-join on the key columns only; the stored table's files carry Bloom
    filters of its keys, and Spark's runtime filter skips by the new keys."""
    held = stored.select(*[F.col(k).alias(f"_bv_{k}") for k in keys])
    same = [df[k] == held[f"_bv_{k}"] for k in keys]
    return df.join(held, same, "left_semi").withColumn("rule", F.lit("unique " + ",".join(keys)))


def check_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q4: rows with NULL in a NOT NULL column; ``rule`` lists the columns."""
    cols = list(columns)
    bad = None
    for c in cols:
        e = F.col(c).isNull()
        bad = e if bad is None else (bad | e)
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return df.filter(bad).withColumn("rule", F.concat(F.lit("not null "), names))


def _len(col: str, dtype: str):
    return F.octet_length(F.col(col)) if dtype == "binary" else F.length(F.col(col))


def check_lengths(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Q5: texts longer than their column's limit (bytes for binary)."""
    if not limits:
        return df.filter(F.lit(False)).withColumn("rule", F.lit(""))
    types = dict(df.dtypes)
    bad = None
    for c, n in limits.items():
        e = F.coalesce(_len(c, types[c]) > F.lit(n), F.lit(False))
        bad = e if bad is None else (bad | e)
    names = F.concat_ws(
        ",", *[F.when(F.coalesce(_len(c, types[c]) > F.lit(n), F.lit(False)), F.lit(c)) for c, n in limits.items()]
    )
    return df.filter(bad).withColumn("rule", F.concat(F.lit("too long "), names))


def fit_lengths(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Q5: cut texts to their limit, as the store's parameters do silently."""
    types = dict(df.dtypes)
    out = df
    for c, n in limits.items():
        if types[c] == "binary":
            out = out.withColumn(c, F.substring(F.col(c), 1, n))
        else:
            out = out.withColumn(c, F.substring(F.col(c), 1, n))
    return out


def check_isrc_not_empty(tracks: DataFrame) -> DataFrame:
    """Q6: the historical rule ISRC <> '' (today '' is accepted)."""
    return tracks.filter(F.col("ISRC") == F.lit("")).withColumn("rule", F.lit("ISRC not empty"))
