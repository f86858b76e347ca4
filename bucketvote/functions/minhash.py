"""MinHash bins: the 25-bin producer that stands where the external hash
step is, so that the store and the lookups get realistic input.

Per item: ``w`` = the non-empty tokens of the text split on one blank,
``x`` = the first 15 hex digits of ``md5(w)`` read as a number, modulo p, and
``HashTable_i = min over w of (x * a_i + b_i) mod p``.  The minimum over a
bag equals the minimum over its set, so no ``distinct`` (and no shuffle of
tokens) is needed: the tokens of one item are exploded in the task that
holds the item, the partial aggregate folds them to one row per item, and
only that row is shuffled.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import BIN_COLS, N_BINS

# Fixed values of the MinHash family: modulus p (2^31 - 1), and a seed from
# which the 25 unrelated pairs (a_i, b_i) are drawn.
MINHASH_PRIME = 2147483647
MINHASH_SEED = 20240229
# hex digits of md5 that identify a token (60 bits)
TOKEN_HEX_DIGITS = 15


def minhash_coefficients() -> list[tuple[int, int]]:
    """25 pairs with 1 <= a < p and 0 <= b < p, from a fixed seed."""
    rng = random.Random(MINHASH_SEED)
    return [(rng.randrange(1, MINHASH_PRIME), rng.randrange(MINHASH_PRIME)) for _ in range(N_BINS)]


def token_hash(token_col: str = "w"):
    """The token's 60-bit number modulo p."""
    wide = F.conv(F.substring(F.md5(F.col(token_col)), 1, TOKEN_HEX_DIGITS), 16, 10).cast("bigint")
    return wide % F.lit(MINHASH_PRIME)


def minhash_bins(items: DataFrame, id_col: str, text_col: str, carry: list[str] | None = None) -> DataFrame:
    """One row per item that has at least one non-empty token:
    ``(id_col, *carry, HashTable_0 .. HashTable_24)`` (int bins).

    ``carry`` are columns functionally dependent on ``id_col``; they ride
    along the grouping instead of being joined back afterwards.  Whole texts
    are tokenised, and each distinct token of an item is hashed once; products stay below 2^62 in bigint.
    """
    carry = list(carry or [])
    toks = (
        items.select(F.col(id_col), *carry, F.explode(F.array_distinct(F.split(F.col(text_col), " "))).alias("w"))
        .filter(F.col("w") != "")
        .select(F.col(id_col), *carry, token_hash("w").alias("x"))
    )
    aggs = [
        F.min((F.col("x") * F.lit(a) + F.lit(b)) % F.lit(MINHASH_PRIME)).cast("int").alias(c)
        for (a, b), c in zip(minhash_coefficients(), BIN_COLS)
    ]
    return toks.groupBy(id_col, *carry).agg(*aggs)
