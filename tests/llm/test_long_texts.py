"""One text of several slices (over 5 MB), its copy and a few short ones
through every operator over documents."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from bucketvote.llm import contamination as CO
from bucketvote.llm import filter_audit as FA
from bucketvote.llm import language as LA
from bucketvote.llm import likelihood as LI
from bucketvote.llm import pieces as PI
from bucketvote.llm import quality as QU
from bucketvote.llm import rules as RU
from bucketvote.llm import simhash as SI
from bucketvote.llm import substrings as SU
from bucketvote.llm.text import SLICE_BYTES

from .corpus import words

PASSAGE = " ".join(f"passage{i}" for i in range(40))


@pytest.fixture(scope="module")
def long():
    rng = random.Random(6)
    stock = words(rng, 4000)
    text = "\n".join(" ".join(rng.choices(stock, k=12)) for _ in range(90_000)) + "\n" + PASSAGE
    assert len(text.encode()) > SLICE_BYTES + (1 << 20)
    return text


@pytest.fixture(scope="module")
def docs(spark, long):
    seam = long.index(" ", len(long) // 2)
    rows = [(1, long, "en"), (2, " ".join(long.split()[:30]) + " " + PASSAGE, "en"), (3, long[:seam] + " other" + long[seam:], "en"), (4, None, None), (5, "", "de"), (6, "a few words", "de")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)


@pytest.fixture(scope="module")
def n_words(docs):
    return {r["doc_id"]: len((r["text"] or "").split()) for r in docs.collect()}


def test_pieces(docs):
    back = PI.decode(PI.encode(docs, carry=["doc_id", "text"]))
    assert back.filter(~F.col("text").eqNullSafe(F.col("decoded"))).count() == 0


def test_likelihood(docs, n_words):
    got = {r["doc_id"]: r for r in LI.likelihood(docs).collect()}
    assert {i: r["n_tokens"] - 1 for i, r in got.items()} == n_words and -1e9 < got[1]["score"] < got[2]["score"] < 0


def test_contamination(spark, docs, n_words):
    items = spark.createDataFrame([(7, PASSAGE), (8, "not there at all")], "item_id long, text string")
    got = {r["doc_id"]: r for r in CO.contamination(docs, items).collect()}
    assert {i: r["n_words"] for i, r in got.items()} == n_words
    assert [(h["first"], h["words"]) for h in got[1]["hits"]] == [(n_words[1] - 40, 40)] and got[1]["items"] == ["7"]


def test_quality(spark, docs):
    labels = spark.createDataFrame([(i, 1, 0) for i in (1, 2, 3)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["n_symbols"] for r in QU.classify(docs, labels).collect()}
    size = {r["doc_id"]: r["n"] for r in docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).collect()}
    assert got == {i: n + 1 for i, n in size.items()}


def test_substrings(docs, n_words):
    got = {r["doc_id"]: r for r in SU.repeated_substrings(docs).select("doc_id", "n_words", "n_removed").collect()}
    assert {i: r["n_words"] for i, r in got.items()} == n_words
    # the third text is the first with one word more: only windows over it are new
    assert got[1]["n_removed"] == n_words[1] and got[3]["n_removed"] >= n_words[3] - 1 and got[2]["n_removed"] == 40


def test_near_duplicates(docs):
    got = {r["doc_id"]: r["component_id"] for r in SI.near_duplicates(docs).collect()}
    assert got[1] == got[3] == 1 and got[4] == got[5] == 4


def test_rules(docs, n_words):
    got = {r["doc_id"]: r for r in RU.judged(docs).collect()}
    assert {i: r["n_words"] for i, r in got.items()} == n_words and got[1]["n_repeat_words"] == 0 and got[1]["n_dup_lines"] == 0


def test_language(docs):
    got = {r["doc_id"]: r["lang_pred"] for r in LA.identify(docs, held=F.lit(False)).collect()}
    assert got[1] == got[3] == "en" and got[4] == got[5] == "und"


def test_audit(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): r for r in FA.filter_interactions(docs, labels).collect()}
    # of the English texts the long ones repeat words (B), the second is short (A)
    first = got["en", "ABCDE", 1], got["en", "ABCDE", 2]
    assert [(r["kept"], r["removed"], r["good_lost"]) for r in first] == [(2, 1, 0), (0, 2, 1)]
