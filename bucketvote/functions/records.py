"""Record functions: the row mapper's rules as column jobs.

Nested records flatten to ``Parent_Child`` columns; NULLs get typed
defaults; enumerations map from names (case-insensitive) or ordinals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ids import sequence_within

#: Keys in one piece of a large group's map.
PIECE_ROWS = 100_000


def flatten_record(df: DataFrame, col: str, ignore: Sequence[str] = (), sep: str = "_") -> DataFrame:
    """M1: replace struct column ``col`` by ``col_field`` columns, recursing
    into nested structs; fields named in ``ignore`` (dotted paths below
    ``col``) are skipped."""
    ignore = set(ignore)

    def walk(dtype: T.StructType, path: list[str]) -> list[Column]:
        out = []
        for f in dtype.fields:
            p = [*path, f.name]
            dotted = ".".join(p[1:])
            if dotted in ignore:
                continue
            if isinstance(f.dataType, T.StructType):
                out.extend(walk(f.dataType, p))
            else:
                out.append(F.col(".".join(f"`{x}`" for x in p)).alias(sep.join(p)))
        return out

    dtype = df.schema[col].dataType
    if not isinstance(dtype, T.StructType):
        raise ValueError(f"{col} is not a struct column")
    others = [F.col(c) for c in df.columns if c != col]
    return df.select(*others, *walk(dtype, [col]))


def nest_record(df: DataFrame, prefix: str, sep: str = "_", depth: int = 1) -> DataFrame:
    """M2: the inverse of ``flatten_record``: columns ``prefix_*`` become a
    struct ``prefix``.  Field names may hold the separator themselves, so by
    default one level is built (as the row mapper does); ``depth=k`` splits
    up to k - 1 further separators into nested structs."""
    start = prefix + sep
    members = [c for c in df.columns if c.startswith(start)]

    def build(names: list[str], base: str, level: int) -> Column:
        groups: dict[str, list[str]] = {}
        leaves = []
        for n in names:
            rest = n[len(base):]
            if level < depth and sep in rest:
                groups.setdefault(rest.split(sep, 1)[0], []).append(n)
            else:
                leaves.append(n)
        fields = [F.col(f"`{n}`").alias(n[len(base):]) for n in leaves]
        for head, sub in groups.items():
            fields.append(build(sub, f"{base}{head}{sep}", level + 1).alias(head))
        return F.struct(*fields)

    others = [F.col(f"`{c}`") for c in df.columns if c not in members]
    return df.select(*others, build(members, start, 1).alias(prefix))


def _default_for(dtype: T.DataType) -> Column | None:
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.DateType):
        return F.lit("0001-01-01").cast("date")
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.lit("0001-01-01 00:00:00").cast("timestamp")
    if isinstance(dtype, T.BinaryType):
        return F.lit(b"").cast("binary")
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    return None


def default_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """M3: typed defaults for NULL: '' / false / 0 / 0001-01-01 / empty bytes."""
    cols = set(columns or df.columns)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in cols:
            d = _default_for(f.dataType)
            if d is not None:
                c = F.coalesce(c, d)
        out.append(c.alias(f.name))
    return df.select(*out)


def enum_from_name(col: str, members: Sequence[str], default: str | None = None) -> Column:
    """M4: member by name, case-insensitive; NULL -> the default member (the
    first member unless given); an unknown name raises."""
    lookup = F.create_map(*[x for m in members for x in (F.lit(m.lower()), F.lit(m))])
    dflt = default if default is not None else members[0]
    c = F.col(col)
    hit = F.element_at(lookup, F.lower(c))
    return F.when(c.isNull(), F.lit(dflt)).when(hit.isNotNull(), hit).otherwise(
        F.raise_error(F.concat(F.lit("unknown enum name: "), c))
    )


def enum_from_ordinal(col: str, members: Mapping[int, str]) -> Column:
    """M5: member by number; NULL counts as 0; a number without a member is
    kept as its number (as text)."""
    lookup = F.create_map(*[x for k, v in sorted(members.items()) for x in (F.lit(int(k)), F.lit(v))])
    n = F.coalesce(F.col(col).cast("int"), F.lit(0))
    return F.coalesce(F.element_at(lookup, n), n.cast("string"))


def unique_pairs(df: DataFrame, key: str, value: str, group: Sequence[str]) -> DataFrame:
    """M6 as a relation: (group, key, value), one row a key; a key that
    repeats in its group raises.  A grouped count with a map-side partial
    step, so a group of any size is spread over its keys."""
    group = list(group)
    one = df.groupBy(*group, key).agg(F.first(value).alias(value), F.count(F.lit(1)).alias("_bv_n"))
    checked = F.when(F.col("_bv_n") > 1, F.raise_error(F.lit("to_unique_map: a key repeats"))).otherwise(F.lit(True))
    return one.filter(checked).select(*group, key, value)


def map_pieces(df: DataFrame, key: str, value: str, group: Sequence[str], piece_rows: int = PIECE_ROWS) -> DataFrame:
    """M6 for groups of any size: (group, piece, first_key, last_key, n, map).
    A group's keys are numbered in their order by ranges (``sequence_within``),
    and every ``piece_rows`` of them are one map, so a group's pieces are its
    map, cut in order, and no task or row holds more than a piece.  A repeated
    key raises."""
    group = list(group)
    ranked = sequence_within(unique_pairs(df, key, value, group), group, [key], out="_bv_rank")
    pieces = ranked.withColumn("piece", F.floor(F.col("_bv_rank") / F.lit(piece_rows)).cast("int")).groupBy(*group, "piece")
    entries = F.sort_array(F.collect_list(F.struct(F.col(key), F.col(value))))  # piece_rows at most
    return pieces.agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count(F.lit(1)).alias("n"), F.map_from_entries(entries).alias("map"))


def to_unique_map(df: DataFrame, key: str, value: str, group: Sequence[str]) -> DataFrame:
    """M6: per group a key -> value map; a repeated key raises.  A map is one
    value, held whole by one row: for groups that may be large, use ``map_pieces`` (or
    ``unique_pairs``, the same content as rows)."""
    pairs = unique_pairs(df, key, value, group)
    return pairs.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), F.col(value)))).alias("map"))


def enum_to_ordinal(col: str, members: Sequence[str]) -> Column:
    """The writing side of M5: a member's number (its place), any case; NULL
    stays NULL, an unknown name raises."""
    lookup = F.create_map(*[x for k, m in enumerate(members) for x in (F.lit(m.lower()), F.lit(k))])
    hit = F.element_at(lookup, F.lower(F.col(col)))
    return F.when(F.col(col).isNull() | hit.isNotNull(), hit).otherwise(F.raise_error(F.concat(F.lit("unknown enum name: "), F.col(col))))


def enum_to_name(col: str, members: Mapping[int, str]) -> Column:
    """The writing side of M4: a number's member; a number without one stays
    a number (as text)."""
    lookup = F.create_map(*[x for k, v in sorted(members.items()) for x in (F.lit(int(k)), F.lit(v))])
    n = F.col(col).cast("int")
    return F.coalesce(F.element_at(lookup, n), n.cast("string"))
