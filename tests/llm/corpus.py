"""Small tables with nulls, empty and very long texts, ties, repeated rows
and extra columns whose names clash with those the operators use."""

from __future__ import annotations

import random

import pytest

#: Names of columns that operators make themselves.
EXTRA = ["fp", "component_id", "word", "row", "part", "bucket", "shard", "ids", "kept", "items", "n_words", "removed", "_llm_text", "_llm_0", "score"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def words(rng: random.Random, n: int) -> list[str]:
    parts = "the an er in on ti re at nd es tion ou ed é ç ß".split()
    return ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n)]


def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(7)
    passage = words(rng, 60)
    base = words(rng, 120)
    out: list[tuple[int | None, str | None]] = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (None, " ".join(words(rng, 50))), (None, None)]
    out += [(10, " ".join(base)), (11, " ".join(base)), (12, " ".join([*base[:-1], "changed"])), (13, " ".join(base).upper())]
    out += [(20 + i, " ".join([*words(rng, 30), *passage, *words(rng, 25)])) for i in range(4)]
    out += [(30, "\n".join(" ".join(words(rng, 9)) for _ in range(12))), (31, "a b c d e f g h i\n" * 30)]
    out += [(40, " ".join(words(rng, 6000))), (41, "x" * 5000 + " " + "ab" * 3000), (42, "de%%% la### | ▁ tab\tand\x0bvt  two  spaces \U0001f600   nbsp\r\n")]
    out += [(50, " ".join(words(rng, 70)))] * 3  # the same row three times
    out += [(51, " ".join(words(rng, 40))), (51, " ".join(words(rng, 40)))]  # one id, two texts
    out += [(100 + i, " ".join(words(rng, rng.randint(1, 90)))) for i in range(30)]
    return out


def documents(spark, rows=None, extra: bool = False):
    rows = texts() if rows is None else rows
    langs = ["en", "de", None, "fr"]
    data = [(i, t, langs[k % 4], None if k % 5 == 0 else f"src{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(data, DOCS).repartition(3)
    if extra:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(EXTRA)])
    return df


def by_row(df, *columns) -> list:
    """Rows as tuples, in an order that nulls do not upset."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture
def vocabulary():
    return VOCABULARY
