"""Encoding, likelihood and classifier against brute-force versions."""

from __future__ import annotations

import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bucketvote.llm import likelihood as LI
from bucketvote.llm import pieces as PI
from bucketvote.llm import quality as QU
from bucketvote.llm.lattice import MARK, SCALE, Lattice, chunks_of, load_vocabulary

from .corpus import VOCABULARY, by_row, documents, texts
from .test_text_operators import SPACE, lower


@pytest.fixture(scope="module")
def known():
    return load_vocabulary(VOCABULARY)


# ---- the lattice -----------------------------------------------------------
def all_paths(known, chunk, by_id, byte):
    """(weight, lengths from the last piece, ids) of every segmentation."""
    marked = chunk if chunk[:1] == "\n" else MARK + chunk
    ids = {p: i for i, p in enumerate(known.pieces) if p}

    def ending(t):
        if not t:
            return [(0, (), [])]
        out = []
        for length in range(1, t + 1):
            part = marked[t - length : t]
            literal = MARK in (part if t > length else part[1:])
            i = None if literal else ids.get(part)
            if i is not None:
                w, spelt = by_id[i], [i]
            elif length == 1:
                spelt = [int(known.byte_ids[b]) for b in part.encode()]
                w = byte * len(spelt)
            else:
                continue
            out += [(w + x, (length, *lengths), got + spelt) for x, lengths, got in ending(t - length)]
        return out

    return ending(len(marked))


def by_lists(lattice, chunk, n):
    """The n best segmentations, by the n best of each position."""
    marked = chunk if chunk[:1] == "\n" else MARK + chunk
    masked, known = marked[:1] + marked[1:].replace(MARK, "\n"), lattice.vocabulary

    def into(t):
        for k in range(1, min(t, lattice.longest) + 1):
            got = lattice.by_piece.get(masked[t - k : t])
            if got is not None:
                yield k, got[1], [got[0]]
            elif k == 1:
                spelt = [int(known.byte_ids[b]) for b in marked[t - 1].encode()]
                yield 1, len(spelt) * known.byte_weight, spelt

    kept = [[(0, 0, 0)]]
    for t in range(1, len(chunk) + 1 + (chunk[:1] != "\n")):
        own = [(-(kept[t - k][r][0] + w), k, r) for k, w, _ in into(t) for r in range(len(kept[t - k]))]
        kept.append([(-s, k, r) for s, k, r in heapq.nsmallest(n, own)])
    out = []
    for r, (score, _, _) in enumerate(kept[-1]):
        ids, at, rank = [], len(kept) - 1, r
        while at:
            _, k, rank = kept[at][rank]
            ids.append(next(x for length, _, x in into(at) if length == k))
            at -= k
        out.append((score, [i for x in reversed(ids) for i in x]))
    return out


CHUNKS = ["", "the", "nation", "thanedble", "\nçon", "été###", "a▁b", "\U0001f600x", "xyzzy!!", "\n", "\n\n", "tab\tand", "éeux"]


def test_best_and_next_best_of_a_chunk(known):
    lattice = Lattice(known)
    flat, offsets, score, gap = lattice.best(CHUNKS)
    for k, chunk in enumerate(CHUNKS):
        if chunk == "\n\n":
            continue  # no text gives this chunk
        paths = sorted(all_paths(known, chunk, known.weights.tolist(), known.byte_weight), key=lambda p: (-p[0], p[1]))
        expected = [(w, ids) for w, _, ids in paths[:6]]
        assert lattice.nbest(chunk, 6) == expected
        assert by_lists(lattice, chunk, 6) == expected
        assert flat[offsets[k] : offsets[k + 1]].tolist() == expected[0][1] and score[k] == expected[0][0]
        if len(expected) > 1:
            assert gap[k] == expected[0][0] - expected[1][0]


def test_next_best_of_very_long_chunks(known):
    """Ties everywhere, and chunks far beyond any text's words."""
    lattice, rng = Lattice(known), random.Random(1)
    for chunk in ("x" * 3000, "ab" * 1500, "".join(rng.choices("thenationérdsç#", k=4000)), "\n" + "the" * 900, "\U0001f600" * 600):
        got = lattice.nbest(chunk, 5)
        assert got == by_lists(lattice, chunk, 5)
    assert lattice.nbest("y" * 30_000, 2)[0][0] >= lattice.nbest("y" * 30_000, 2)[1][0]


def test_marginal_is_the_sum_over_all_segmentations(known):
    lattice = Lattice(known)
    by_id, byte = known.weights / SCALE, known.byte_weight / SCALE
    chunks = [c for c in CHUNKS if c != "\n\n"]
    total, expected = lattice.marginal(chunks, by_id, byte, np.ones(len(chunks)))
    counts = defaultdict(float)
    for c, got in zip(chunks, total):
        paths = all_paths(known, c, by_id, byte)
        z = math.log(sum(math.exp(w) for w, _, _ in paths))
        assert got == pytest.approx(z, abs=1e-9)
        for w, _, ids in paths:
            for i in ids:
                counts["byte" if i in set(known.byte_ids.tolist()) else i] += math.exp(w - z)
    for i in range(len(by_id)):
        assert expected[i] == pytest.approx(counts[i] if known.pieces[i] else 0, abs=1e-9)
    assert expected[-1] == pytest.approx(counts["byte"], abs=1e-9)


# ---- encoding -----------------------------------------------------------------
def test_round_trip_of_every_text(spark):
    docs = documents(spark, extra=True)
    back = PI.decode(PI.encode(docs, carry=["doc_id", "text"]))
    for r in back.collect():
        assert r["decoded"] == r["text"]
        assert (r["ids"] is None) == (r["text"] is None) == (r["nbest"] is None)


def test_nbest_of_short_texts(spark, known):
    rows = [(1, "é ç"), (2, "on at"), (3, ""), (4, "re\nti in"), (5, "aa aa")]
    got = PI.encode(documents(spark, rows), n=5).withColumn("whole", F.transform("nbest", lambda b: PI.edited(F.col("ids"), b["edits"])))
    by_id, byte = known.weights.tolist(), known.byte_weight
    for r in got.collect():
        chunks = chunks_of(dict(rows)[r["doc_id"]])
        paths = [(0, [])]
        for c in chunks:
            paths = [(w + x, ids + more) for w, ids in paths for x, _, more in all_paths(known, c, by_id, byte)]
        paths.sort(key=lambda p: -p[0])
        assert [round(b["score"] * SCALE) for b in r["nbest"]] == [w for w, _ in paths[:5]]
        assert r["whole"][0] == r["ids"] and len({tuple(x) for x in r["whole"]}) == len(r["whole"])
        scores = defaultdict(set)
        for w, ids in paths:
            scores[w].add(tuple(ids))
        for b, ids in zip(r["nbest"], r["whole"]):
            assert tuple(ids) in scores[round(b["score"] * SCALE)]


def test_small_memory_gives_the_same(spark, monkeypatch):
    docs = documents(spark)
    whole = by_row(PI.encode(docs), "doc_id", "ids", "nbest")
    monkeypatch.setattr(PI, "MEMORY", 20)
    monkeypatch.setattr(PI, "AT_ONCE", 7)
    monkeypatch.setattr(PI, "SLICE", 300)
    assert by_row(PI.encode(docs), "doc_id", "ids", "nbest") == whole


def test_with_pieces_replaces_columns_of_its_names(spark):
    docs = documents(spark, extra=True)
    got = PI.with_pieces(docs)
    assert got.columns == [c for c in docs.columns if c != "ids"] + ["n_pieces", "ids", "nbest"]
    assert got.filter("n_pieces != size(ids)").count() == 0
    assert PI.with_pieces(docs.limit(0)).count() == 0


# ---- likelihood ------------------------------------------------------------------
def piece_weights(known, counts, n_texts):
    """(weights by piece, of a byte, of the end), from all segmentations."""
    pieces, bytes_ = {p: i for i, p in enumerate(known.pieces) if p}, set(known.byte_ids.tolist())
    start = {i: math.exp(known.weights[i] / SCALE) for i in pieces.values()} | {"byte": 256 * math.exp(known.byte_weight / SCALE)}
    whole = sum(start.values())
    start = {k: v / whole for k, v in start.items()}
    now, end = start, 0.5
    for _ in range(LI.PASSES):
        total = defaultdict(float, {k: LI.PRIOR_PIECES * v for k, v in start.items()})
        for word, c in counts.items():
            paths = all_paths(known, word, now_logs(known, now), math.log(now["byte"] / 256))
            z = sum(math.exp(w) for w, _, _ in paths)
            for w, _, ids in paths:
                for i in ids:
                    total["byte" if i in bytes_ else i] += c * math.exp(w) / z
        mass = sum(total.values())
        now, end = {k: v / mass for k, v in total.items()}, n_texts / (mass + n_texts)
    return {k: v * (1 - end) for k, v in now.items()}, end


def now_logs(known, now):
    return [math.log(now[i]) if now.get(i) else -math.inf for i in range(len(known.pieces))]


def scored(known, rows):
    held = [zlib.crc32(b"" if d is None else str(d).encode()) % 5 == 1 for d, _ in rows]
    own = [re.findall(SPACE, lower(t)) for _, t in rows]
    counts = Counter(w for w, h in zip(own, held) if not h for w in w)
    n_texts = held.count(False)
    n, v = sum(counts.values()) + n_texts, len(counts) + 1
    weights, end = piece_weights(known, counts, n_texts)
    logs, byte = now_logs(known, weights), math.log(weights["byte"] / 256)
    p = {w: math.log10(sum(math.exp(x) for x, _, _ in all_paths(known, w, logs, byte))) for w in {w for o in own for w in o}}
    base = lambda c: math.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    return [
        (d, h, len(o) + 1, sum(counts[w] > 0 for w in o) + 1, n, sum(base(counts[w]) for w in o) + base(n_texts), sum(p[w] for w in o) + math.log10(end))
        for (d, _), h, o in zip(rows, held, own)
    ]


@pytest.fixture(scope="module")
def likely(known):
    rows = [(d, t) for d, t in texts() if d not in (40, 41)]  # every segmentation of every word is walked
    return rows, sorted(scored(known, rows), key=lambda r: (str(r[0]), r[2], r[5]))


@pytest.mark.parametrize("frequent", [65_536, 8, 0])
def test_likelihood(spark, likely, frequent):
    rows, expected = likely
    got = LI.likelihood(documents(spark, rows, extra=True), frequent=frequent)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    found = sorted((tuple(r) for r in got.select(names).collect()), key=lambda r: (str(r[0]), r[2], r[5]))
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_likelihood_of_long_words_and_without_training(spark):
    got = {r["doc_id"]: r for r in LI.likelihood(documents(spark, [(3, "x" * 3000 + " y"), (2, None), (4, "y")])).collect()}
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got.values()) and got[3]["held_out"] and got[3]["score"] < -1000
    alone = LI.likelihood(documents(spark, [(1, "a b"), (2, None)]), held=F.lit(True)).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in alone} == {(0, 0)} and all(math.isfinite(r["score"]) for r in alone)
    assert LI.likelihood(documents(spark).limit(0)).count() == 0


# ---- classifier -------------------------------------------------------------------
def kneser_ney(train, order):
    """log p of a gram's last symbol, from the definition with dicts."""
    def grams(text):
        padded = b"\xff" * (order - 1) + (text or "").encode() + b"\xfe"
        return [padded[i : i + order] for i in range(len(padded) - order + 1)]

    counts = {order: Counter(g for t in train for g in grams(t))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut, totals, left = {}, {}, {}
    for k, c in counts.items():
        n = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
        d = [min(i, max(0.05, i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] else 0.5 for i in (1, 2, 3)]
        cut[k] = lambda v, d=d: d[min(v, 3) - 1]
        totals[k], left[k] = Counter(), Counter()
        for g, v in c.items():
            totals[k][g[:-1]] += v
            left[k][g[:-1]] += cut[k](v)

    def p(g):
        k = len(g)
        lower_p = p(g[1:]) if k > 1 else 1 / 257
        if not totals[k][g[:-1]]:
            return lower_p
        v = counts[k].get(g, 0)
        return ((v - cut[k](v)) if v else 0) / totals[k][g[:-1]] + left[k][g[:-1]] / totals[k][g[:-1]] * lower_p

    return lambda text: sum(math.log(p(g)) for g in grams(text)), p


@pytest.mark.parametrize("order,shard_rows", [(3, 4_000_000), (5, 60)])
def test_model_is_interpolated_modified_kneser_ney(spark, order, shard_rows):
    rows = [(i, t) for i, t in texts() if i and i >= 100]
    fitted = QU.model(documents(spark, rows), order)
    log_p, p = kneser_ney([t for _, t in rows], order)
    asked = [(1, rows[0][1]), (2, "never seen é Ж"), (3, ""), (4, None), (5, "the the"), (6, "\x00\x01")]
    got = {r["doc_id"]: r for r in QU.score(documents(spark, asked), fitted, order, shard_rows=shard_rows).collect()}
    for i, t in asked:
        assert got[i]["log_p"] == pytest.approx(log_p(t), rel=1e-9) and got[i]["n_symbols"] == len((t or "").encode()) + 1
    some = rows[0][1].encode()[: order - 1]
    assert sum(p(some + bytes([b])) for b in range(256)) <= 1 + 1e-9


def corpus(seed=3, n=400):
    rng = random.Random(seed)
    parts = {"en": "the an er in on ti re at nd es".split(), "fr": "le en on ou é aux des qui re ion".split()}
    rows = []
    for i in range(n):
        lang = ("en", "fr")[i % 2]
        own = ["".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(15, 60))]
        good = i % 5 != 0
        rows.append((i, " ".join(own) if good else " ".join(w.upper() + rng.choice(["###", "$$$", "%%%"]) for w in own), lang, 1 if good else 0))
    return rows


def test_classifier_tells_held_out_text(spark):
    rows = corpus(n=2400)  # about 240 trusted documents a language for the threshold
    docs = spark.createDataFrame([(i, t, lang) for i, t, lang, _ in rows] + [(9000, None, None), (None, "the an er in on", "en")], "doc_id long, text string, lang string")
    labelled = [(i, q, 0) for i, _, _, q in rows if i % 4 < 2] + [(0, 1, None), (1, 1, 1), (None, 1, 0), (77777, 1, 0)]
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in QU.classify(docs, labels).collect()}
    unseen = [(got[i], q) for i, _, _, q in rows if i % 4 >= 2]
    assert sum(k for k, q in unseen if q) >= 0.97 * sum(q for _, q in unseen)
    assert not any(k for k, q in unseen if not q)
    wide = docs.withColumn("kept", F.lit("x")).withColumn("log_p", F.lit(1))
    kept = QU.keep_good(wide, labels)
    assert kept.columns == wide.columns and kept.count() == sum(got.values())


def test_without_trusted_text_everything_is_kept(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert QU.classify(docs, none).filter("kept").count() == docs.count()
    assert QU.classify(docs.limit(0), none).count() == 0
    one = spark.createDataFrame([(31, 1, 0), (40, 1, 0)], "doc_id long, quality int, toxic int")
    assert QU.classify(docs, one).count() == docs.count()


def test_limit_is_the_quantile_and_repetition_goes(spark):
    rng = random.Random(9)
    parts = "the an er in on ti re at nd es".split()
    known = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(80)]
    good = [" ".join(" ".join(rng.choices(known, k=rng.randint(5, 9))).capitalize() + "." for _ in range(rng.randint(3, 9))) for _ in range(300)]
    junk = [" ".join([w] * n) for w in ("the", "er", "The", "In") for n in (20, 40, 80)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(good + junk)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    got = QU.classify(docs, labels).withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(2))).collect()
    judged = sorted(r["perplexity"] for r in got if r["doc_id"] < 300 and r["fold"] == 1)
    assert {round(r["threshold"], 9) for r in got} == {round(judged[math.ceil(0.99 * len(judged)) - 1], 9)}
    assert not any(r["kept"] for r in got if r["doc_id"] >= 300)
    assert sum(r["kept"] for r in got if r["doc_id"] < 300) >= 0.98 * 300
