"""The store's constraints, enforced on rows before they are written.

NOT NULL, text limits and value ranges are checked row by row; a child's key
must be among its parents, and a key that the client brings must be new.  Each check looks for one offending row and raises
``ConstraintError`` naming the broken rule; nothing is written then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import KEYS, LENGTH_LIMITS, REQUIRED
from . import quality as Q


class ConstraintError(ValueError):
    """Rows break a constraint of their table."""


def enforce(table: str, rows: DataFrame, parents: DataFrame | None = None, stored: DataFrame | None = None) -> DataFrame:
    """``rows`` (new rows of ``table``, with Ids) if they meet all constraints.
    ``parents`` are the tracks that TrackId must name.  With ``stored``, the
    table's rows, the key must be unique among the new rows and not be there
    yet; claimed Ids need no such check."""
    checks = [Q.check_required(rows, [c for c in REQUIRED[table] if c in rows.columns]), Q.check_lengths(rows, LENGTH_LIMITS[table])]
    if table == "tracks":
        checks.append(Q.check_ranges(rows))
    if parents is not None:
        checks.append(Q.check_orphans(rows, parents))
    if stored is not None:
        checks += [Q.check_unique(rows, KEYS[table]), Q.check_new(rows, stored, KEYS[table])]
    broken = checks[0].select("rule")
    for c in checks[1:]:
        broken = broken.unionByName(c.select("rule"))
    found = broken.limit(1).agg(F.max("rule")).first()[0]
    if found is not None:
        raise ConstraintError(f"{table}: {found}")
    return rows
