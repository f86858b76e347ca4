"""The pipeline, stage by stage, against brute force on a small folder, and
the registered queries on the smallest given tables."""

from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from bucketvote.llm import quality as QU
from bucketvote.llm.lattice import Lattice, chunks_of, load_vocabulary
from bucketvote.llm.queries import QUERIES

from .corpus import VOCABULARY, texts
from .test_language_operators import corpus, kneser_ney
from .test_text_operators import contaminated, cut, groups


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    good = corpus()
    rows = [(1000 + i, t, lang, "s", len(t)) for i, t, lang, _ in good]
    rows += [(5000 + k, good[k * 5 + 1][1], "en", None, len(good[k * 5 + 1][1])) for k in range(20)]  # copies
    passage = " ".join((good[2][1] + " " + good[4][1]).split()[:45])
    rows += [(6000 + k, f"{good[16 + 2 * k][1]} {passage} {good[26 + 2 * k][1]}", "en", "s", 0) for k in range(3)]
    rows += [(d, t, "en", "s", None if t is None else len(t)) for d, t in texts() if d is not None and d < 50 and d != 41]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1000 + i, q, 0) for i, _, _, q in good if i % 4 < 2], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    items = [(1, " ".join(good[6][1].split()[2:14])), (2, " ".join(good[301][1].split()[:11])), (3, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, rows, items


def good_rows(spark, rows, labels):
    folds = {r["i"]: (r["fold"], r["rank"]) for r in spark.range(0, 7000).select(F.col("id").alias("i"), F.pmod(F.xxhash64("id"), F.lit(2)).alias("fold"), F.xxhash64("id", F.lit(1)).alias("rank")).collect()}
    trusted = [i for i, q in labels if q]
    text = {r[0]: r[1] for r in rows}
    log_p, _ = kneser_ney([text[i] for i in trusted if folds[i][0] == 0], QU.ORDER)
    scored = {r[0]: (log_p(r[1]), len((r[1] or "").encode()) + 1, r[2]) for r in rows}
    judged = [scored[i] for i in trusted if folds[i][0] == 1]
    mean = {g: -sum(a for a, _, x in judged if x == g) / sum(n for _, n, x in judged if x == g) for g in {x for _, _, x in judged}}
    value = lambda s: (QU.SHRINK * mean[s[2]] - s[0]) / (s[1] + QU.SHRINK)
    most = {}
    for g in mean:
        own = sorted(value(s) for s in judged if s[2] == g)
        most[g] = own[math.ceil(QU.QUANTILE * len(own)) - 1] * QU.SLACK
    return [r for r in rows if value(scored[r[0]]) <= most[r[2]]]


def test_every_stage_does_what_brute_force_does(spark, folder, tmp_path):
    at, rows, items = folder
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{at}/labels.parquet").collect()]
    docs = spark.read.parquet(f"{at}/documents.parquet")

    def step(k):
        out = P.STAGES[k][1](spark, docs, at)
        out.write.parquet(f"{tmp_path}/{k}")
        return spark.read.parquet(f"{tmp_path}/{k}")

    def same(found, expected):
        assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(expected, key=repr)
        assert found.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    kept = good_rows(spark, rows, labels)
    docs = step(0)
    same(docs, kept)
    assert 0 < len(rows) - len(kept) < len(rows) / 2

    least = {c for _, _, c in groups([(r[0], r[1]) for r in kept], 4)}
    kept = [r for r in kept if r[0] in least]
    docs = step(1)
    same(docs, kept)

    removed = cut([(r[0], r[1]) for r in kept], 35)
    kept = [(r[0], x, *r[2:4], len(x)) if n else r for r, (_, _, n, x) in zip(kept, removed)]
    docs = step(2)
    same(docs, kept)
    assert any(n for _, _, n, _ in removed)

    dirty = {d for d, _, n, _ in contaminated([(r[0], r[1]) for r in kept], items, 10) if n}
    kept = [r for r in kept if r[0] not in dirty]
    docs = step(3)
    same(docs, kept)
    assert dirty

    docs = step(4)
    lattice = Lattice(load_vocabulary(VOCABULARY))
    found = {r["doc_id"]: r for r in docs.collect()}
    assert sorted(found) == sorted(r[0] for r in kept)
    for r in kept:
        assert found[r[0]]["ids"] == (None if r[1] is None else lattice.best(chunks_of(r[1]))[0].tolist())
        assert found[r[0]]["text"] == r[1]


def test_run_is_all_stages(spark, folder):
    at, rows, _ = folder
    got = P.run(spark, at)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_pieces", "ids", "nbest"]
    assert 0 < got.count() < len(rows)
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "sentencepiece_encoding"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_queries_run_over_whole_tables(spark, smoke_dir, name):
    table, key = ("pages", "page_id") if name.startswith(("op8_", "op10_")) else ("documents", "doc_id")
    got = QUERIES[name](spark, smoke_dir).toPandas()
    if name.startswith("op12_"):
        langs = spark.read.parquet(f"{smoke_dir}/documents.parquet").select(F.coalesce("lang", F.lit("")).alias("lang")).toPandas().lang
        assert len(got) == 600 * langs.nunique() and (got[got.step == 1].groupby("part").apply(lambda x: x.kept + x.removed).groupby("part").max() == langs.value_counts().sort_index()).all()
        return
    if name.startswith("op13_"):
        assert (got.anchor_id % 100 == 0).all() and set(got["rank"]) <= {1, 2, 3, 4, 5} and (5 * got.negative_score >= 4 * got.positive_score).all()
        return
    whole = spark.read.parquet(f"{smoke_dir}/{table}.parquet").toPandas()
    assert sorted(got[key]) == sorted(whole[key])
    by = got.set_index(key)
    text = dict(zip(whole[key], whole["html" if table == "pages" else "text"]))
    if name.startswith("op6_"):
        for d, words, removed, kept in cut([(d, text[d]) for d in whole[key]], 35):
            assert (by.n_words[d], by.n_removed[d], by.kept_sha256[d]) == (words, removed, hashlib.sha256(kept.encode()).hexdigest())
    if name.startswith("op3_"):
        assert (by["size"] == [len(text[d].encode()) + 8 for d in by.index]).all() and set(by["shard"]) <= set(range(24))
    if name.startswith("op1_"):
        assert by.round_trip.all()
    if name.startswith("op10_"):
        assert (by.n_chars == by.text.str.len()).all()
