"""Operators on texts against brute-force versions on a small corpus."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from bucketvote.llm import contamination as CO
from bucketvote.llm import rules as RU
from bucketvote.llm import sharding as SH
from bucketvote.llm import simhash as SI
from bucketvote.llm import substrings as SU
from bucketvote.llm.components import components

from .corpus import by_row, documents, texts

SPACE = r"[^\x20\x09-\x0D]+"


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- SimHash ---------------------------------------------------------------
def fingerprint(text, width=4):
    own = [w.encode() for w in re.findall(SPACE, lower(text))]
    grams = [b" ".join(own[i : i + width]) for i in range(max(1, len(own) - width + 1))] if own else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(rows, radius):
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, f - (1 << 64) if f >> 63 else f, least.get(find(i))) for i, ((d, _), f) in enumerate(zip(rows, prints))]


@pytest.mark.parametrize("radius,tile", [(4, 16384), (10, 7)])
def test_near_duplicates(spark, radius, tile):
    found = SI.near_duplicates(documents(spark, extra=True), radius=radius, tile=tile)
    assert by_row(found, "doc_id", "fp", "component_id") == sorted(groups(texts(), radius), key=repr)


def test_keep_first_keeps_one_of_each_group(spark):
    docs = documents(spark, extra=True)
    kept = SI.keep_first(docs)
    assert kept.columns == docs.columns
    expected = {c for d, _, c in groups(texts(), 4) if d is not None}
    assert sorted(r[0] for r in kept.select("doc_id").collect() if r[0] is not None) == sorted(expected)


def test_forest_links_what_all_pairs_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 20, dtype=np.uint64)
    a = np.unique(np.concatenate([base ^ np.uint64(1 << int(b)) for b in rng.integers(0, 60, 9)]))
    links = SI._forest(a, None, 2)
    assert len(links) < len(a) and all(bin(int(a[i]) ^ int(a[j])).count("1") <= 2 for i, j in links)
    pairs = [(i, j) for i in range(len(a)) for j in range(i) if bin(int(a[i]) ^ int(a[j])).count("1") <= 2]
    for i, j in pairs:
        seen, todo = {i}, [i]
        while todo:
            x = todo.pop()
            new = {q if p == x else p for p, q in links if x in (p, q)} - seen
            seen |= new
            todo += new
        assert j in seen


def test_components_of_a_chain_a_hub_and_nulls(spark):
    chain = [(i, i + 1) for i in range(40)]
    hub = [(1000, 1001 + i) for i in range(60)]
    df = spark.createDataFrame([*chain, *hub, (None, 3), (7, 7), (9999, 9999)], "u long, v long")
    assert by_row(components(df), "node", "root") == sorted([(i, 0) for i in range(41)] + [(1000 + i, 1000) for i in range(61)], key=repr)
    assert components(df.limit(0)).count() == 0


# ---- substrings --------------------------------------------------------------
def cut(rows, width):
    own = [re.findall(SPACE, t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in own for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(rows, own):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


@pytest.mark.parametrize("width", [5, 35])
def test_repeated_substrings(spark, width):
    found = SU.repeated_substrings(documents(spark, extra=True), width)
    assert by_row(found, "doc_id", "n_words", "n_removed", "kept") == sorted(cut(texts(), width), key=repr)
    for r in found.collect():
        assert sum(s["words"] for s in r["removed"]) == r["n_removed"]
        assert all(a["first"] + a["words"] < b["first"] for a, b in zip(r["removed"], r["removed"][1:]))


def test_small_slices_and_many_buckets_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(SU, "SLICE", 500)
    monkeypatch.setattr(SU, "BUCKET_WINDOWS", 40)
    found = SU.repeated_substrings(documents(spark), 5)
    assert by_row(found, "doc_id", "n_words", "n_removed", "kept") == sorted(cut(texts(), 5), key=repr)


def test_without_repeats_keeps_columns_and_clean_texts(spark):
    docs = documents(spark, extra=True)
    got = SU.without_repeats(docs, 35)
    assert got.dtypes == docs.dtypes
    whole = {(d, t): n for (d, t), (_, _, n, _) in zip(texts(), cut(texts(), 35))}
    unchanged = sorted(((d, t) for (d, t), n in whole.items() if not n), key=repr)
    assert set(unchanged) <= {tuple(r) for r in got.select("doc_id", "text").collect()}
    assert got.filter("n_chars != char_length(text)").count() == 0


# ---- contamination -----------------------------------------------------------
def norm(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contaminated(rows, items, width):
    windows = {}
    for i, t in items:
        w = norm(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + width]), set()).add("" if i is None else str(i))
    out = []
    for d, t in rows:
        w, hit, found = norm(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if names := windows.get(tuple(w[k : k + n])):
                    found |= names
                    hit.update(range(k, k + n))
        out.append((d, len(w), len(hit), sorted(found)))
    return out


ITEMS = [(1, "An ER, in!"), (1, "An ER, in!"), (12, None), (None, "ab ab ab ab ab ab ab ab ab ab ab ab"), (9, "a b c d e f g h i a b c d"), (10, ""), (11, "...")]


@pytest.mark.parametrize("block, piece", [(1 << 20, 1 << 20), (20, 3)])
def test_contamination(spark, block, piece):
    rows = texts()
    items = [*ITEMS, (77, " ".join(rows[6][1].split()[20:45])), (78, " ".join(rows[6][1].split()[50:53]))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hits", F.lit(1))
    found = CO.contamination(documents(spark, extra=True), bench, block_words=block, piece_words=piece)
    n_hit = F.aggregate("hits", F.lit(0), lambda a, x: a + x["words"]).alias("n_hit")
    got = by_row(found.select("doc_id", "n_words", n_hit, "items"), "doc_id", "n_words", "n_hit", "items")
    assert got == sorted(contaminated(rows, items, 10), key=repr)
    clean = CO.without_contaminated(documents(spark, extra=True), bench)
    assert clean.count() == sum(not x[3] for x in contaminated(rows, items, 10)) and clean.columns == documents(spark, extra=True).columns


def test_no_benchmark_hits_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert CO.contamination(documents(spark), none).filter("size(items) > 0 or size(hits) > 0").count() == 0


def test_buckets_are_dealt_by_a_hash_of_their_own():
    words = [f"w{i * i % 997}" for i in range(4000)]
    text = " ".join(words + words[:500])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([1, 2]), pa.array([text.encode(), text.encode()[:9000]])], names=["dk", "check", "text"])
    tops, seen = Counter(), {}
    for out in SU._hashed(5, 16)(iter([batch])):
        for row in out.to_pylist():
            if row["hashes"] is not None:
                for v in np.frombuffer(row["hashes"], "<u8").tolist():
                    assert seen.setdefault(v, row["target"]) == row["target"]
                    tops[v >> 60, row["target"]] += 1
    # a bucket tells nothing about the hash: nearly all of 16 x 16 combinations occur
    assert len(tops) > 200


def test_windows_of_equal_hash_are_told_apart():
    """A roller that gives every window the same hash changes nothing."""

    class Flat:
        def spans(self, values, begin, end):
            return np.zeros(len(begin), np.uint64)

    words = np.array([1, 2, 1, 2, 3, 1, 2], np.int32)
    got = CO._windows(words, np.array([0, 1, 2, 3, 5]), np.array([0, 0, 0, 1, 1]), 2, Flat())
    found = {tuple(words[b : b + 2].tolist()): got.owners[x:y].tolist() for b, x, y in zip(got.begin, got.own, got.own[1:])}
    assert found == {(1, 2): [0, 1], (2, 1): [0], (2, 3): [1]} and (np.diff(got.value.astype(np.int64)) >= 0).all()
    docs = np.array([2, 1, 0, 1, 2, 3], np.int64)
    block = ({}, words, ["a", "b"], {2: got})
    assert [(n, at.tolist(), [words[w.begin[i]] for i in which]) for n, at, which, w in CO._matches(block, docs, Flat())] == [
        (2, [3], [1]), (2, [0], [2]), (2, [4], [2])
    ]


# ---- sharding ------------------------------------------------------------------
def test_shards_are_even_whole_and_gapless(spark):
    rows = [(i, "word " * (i * 7 % 50)) for i in range(3000)] + [(5000 + i, "copy " * 20) for i in range(1500)]
    rows += [(None, None), (7, None), (7, "word")]
    got = SH.shard(documents(spark, rows, extra=True), shards=24).collect()
    assert sorted(((r["doc_id"], r["size"]) for r in got), key=repr) == sorted(((d, len((t or "").encode()) + 8) for d, t in rows), key=repr)
    sizes, slots = Counter(), {}
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(sizes) == list(range(24))
    mean = sum(sizes.values()) / 24
    assert max(abs(x - mean) for x in sizes.values()) < 0.05 * mean + 300
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def halved(rows, shards):
    """(part, row): the k-d splits by sorting, part by part."""
    widest = [max(max(r[k] for r in rows) - min(r[k] for r in rows), 1) for k in ("k0", "k1", "k2")]

    def split(own, n, first):
        if n == 1 or not own:
            return [(first, r) for r in own]
        widths = [(max(r[k] for r in own) - min(r[k] for r in own)) / w for k, w in zip(("k0", "k1", "k2"), widest)]
        key = f"k{widths.index(max(widths))}"
        target, at = sum(r["size"] for r in own) * (n // 2) / n, 0
        for cut in sorted({r[key] for r in own}):
            size = sum(r["size"] for r in own if r[key] == cut)
            if at + size >= target:
                break
            at += size
        low = lambda r: r[key] < cut or r[key] == cut and at + size - target < target - at
        return split([r for r in own if low(r)], n // 2, first) + split([r for r in own if not low(r)], n - n // 2, first + n // 2)

    return split(rows, shards, 0)


@pytest.mark.parametrize("shards", [2, 13])
def test_splits_against_sorting(spark, monkeypatch, shards):
    monkeypatch.setattr(SH, "TOLERANCE", 0.0)
    rows = [(i, "word " * (i * 7 % 50)) for i in range(300)] + [(500 + i, "copy " * 20) for i in range(150)] + [(None, None), (7, None), (7, "word"), (7, "word")]
    points = SH.points(documents(spark, rows), SH.DIMENSIONS).checkpoint()
    names = ["k0", "k1", "k2", "size"]
    got = Counter((r["part"], *(r[n] for n in names)) for r in SH.split(points, 3, shards=shards).collect())
    assert got == Counter((part, *(r[n] for n in names)) for part, r in halved(points.collect(), shards))


def test_target_bytes_decides_the_number_of_shards(spark):
    rows = [(i, "x" * 92) for i in range(100)]
    got = SH.shard(documents(spark, rows), target_bytes=1000)
    assert {r["count"] for r in got.groupBy("shard").count().collect()} == {10}


def test_copies_lie_next_to_each_other(spark):
    rows = [(i, f"text number {i % 40} " * 3) for i in range(2000)]
    docs = documents(spark, rows).withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))
    got = SH.shard(docs, shards=8).groupBy("text_crc32").agg(F.countDistinct("shard").alias("n"))
    assert sum(r["n"] - 1 for r in got.collect()) <= 7  # only a cut parts a group


def test_rows_that_cannot_be_told_apart_share_a_shard(spark):
    got = SH.shard(documents(spark, [(1, "same")] * 50).withColumn("lang", F.lit("x")).withColumn("source", F.lit("x")), shards=4)
    assert got.count() == 50 and sorted(r["slot"] for r in got.collect()) == list(range(50))


def test_many_alike_rows_are_numbered_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(SH, "REPEATED", 7)
    monkeypatch.setattr(SH, "BROADCAST_PARTS", 1)
    rows = [(None, "same")] * 50 + [(i, f"text {i}") for i in range(30)]
    got = SH.shard(documents(spark, rows), shards=3).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in rows)
    for s in {r["shard"] for r in got}:
        own = sorted(r["slot"] for r in got if r["shard"] == s)
        assert own == list(range(len(own)))


# ---- rules -----------------------------------------------------------------------
def measures(text):
    text = text or ""
    w = re.findall(SPACE, text)
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures(spark):
    rows = [*texts(), (900, "x y " * 400), (901, " ".join("abcdefgh") + " " + " ".join("abcdefgh")), (902, "a\n a\na\n\n\na"), (903, " ".join("abcdefgh"))]
    docs = documents(spark, rows, extra=True)
    got = RU.measured(docs.select("doc_id", "text"), ["doc_id"])
    expected = [(d, *measures(t)) for d, t in rows]
    assert by_row(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") == sorted(expected, key=repr)


def test_order_changes_the_time_and_never_the_verdict(spark):
    docs = documents(spark, extra=True)
    found = RU.judged(docs)
    kept = sorted((r["doc_id"] for r in RU.keep_passing(docs).collect()), key=repr)
    assert kept == sorted((r["doc_id"] for r in found.filter("passed").collect()), key=repr)
    of = {c: F.col(c) for c in RU.measures()}
    rows = RU.measured(docs, ["doc_id", "text"])
    one = rows.select("doc_id", RU.verdict(RU.RULES, [*RU.RULES], of).alias("passed"))
    other = rows.select("doc_id", RU.verdict(RU.RULES, [*RU.RULES][::-1], of).alias("passed"))
    assert by_row(one, "doc_id", "passed") == by_row(other, "doc_id", "passed") == by_row(found, "doc_id", "passed")


def test_rules_are_ordered_by_rejection_per_cost(spark):
    order = RU.order_rules(documents(spark))
    rates = [share / seconds for _, share, seconds in order]
    assert rates == sorted(rates, reverse=True) and {n for n, _, _ in order} == {*RU.RULES}


def test_later_rules_do_not_see_rejected_rows(spark):
    boom = {"few": lambda m: m["n_words"] < 3, "fails": lambda m: F.when(m["n_words"] < 3, F.raise_error(F.lit("seen"))).isNotNull()}
    docs = documents(spark, [(1, "a b"), (2, "a b c d")])
    got = docs.filter(RU.verdict(boom, ["few", "fails"], RU.measures()))
    assert [r["doc_id"] for r in got.collect()] == [2]


# ---- empty tables -------------------------------------------------------------------
def test_empty_tables_give_empty_results(spark):
    none = documents(spark).limit(0)
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert SI.near_duplicates(none).count() == 0 and SI.keep_first(none).count() == 0
    assert SU.repeated_substrings(none).count() == 0 and SU.without_repeats(none).count() == 0
    assert CO.contamination(none, bench).count() == 0
    assert SH.shard(none, shards=24).count() == 0
    assert RU.judged(none).count() == 0


# ---- documents that share an id, or have none ------------------------------------
def test_texts_without_doc_id_keep_their_own_places(spark):
    passage = " ".join(f"p{k}" for k in range(40))
    with_it = [f"{i} x {passage}" for i in (17499, 20036, 28345)]
    # these share the 32-bit hash of (true, text) with those above
    others = [" ".join(f"{j}q{k}" for k in range(36)) for j in (86706, 3071, 334945)]
    short = [(None, f"{t} end") for t in others]
    rows = [(None, t) for t in with_it + others] + short + [(7, passage), (7, f"other {passage}"), (7, " ".join(f"r{k}" for k in range(50)))]
    df = documents(spark, rows)
    pairs = df.select(F.hash(F.col("doc_id").isNull(), "text").alias("h")).distinct().count()
    assert pairs == len(rows) - 3
    found = SU.repeated_substrings(df, 35, ["doc_id", "text"])
    expected = [(d, t, w, n, k) for (d, t), (_, w, n, k) in zip(rows, cut(rows, 35))]
    assert by_row(found, "doc_id", "text", "n_words", "n_removed", "kept") == sorted(expected, key=repr)


def test_places_of_one_id_are_dealt_by_text_too():
    docs = 64
    doc, place = np.repeat(np.arange(docs), 5), np.tile(np.arange(5), docs)
    ids = np.full(docs, 5, "<i8")

    def dealt(checks):
        return [(t, *SU._unpack(dict(zip(("docs", "checks", "counts", "places"), rest)))) for t, *rest in SU._dealt(doc, place, ids, checks.astype("<i8"), 8)]

    other = dealt(np.arange(docs) * 7919)
    assert len({r[0] for r in other}) == 8 and sum(len(r[4]) for r in other) == docs * 5
    same = dealt(np.ones(docs))
    assert len(same) == 1 and same[0][4].tolist() == [0, 1, 2, 3, 4]


def test_repeated_rows_are_gathered_once(monkeypatch):
    monkeypatch.setattr(SU, "GATHERED", 100)
    doc, place, ids, checks = np.zeros(60, np.int64), np.arange(60), np.array([5], "<i8"), np.array([1 << 40], "<i8")
    row = next(iter(SU._dealt(doc, place, ids, checks, 1)))
    largest = []
    whole = SU._distinct
    monkeypatch.setattr(SU, "_distinct", lambda held: largest.append(sum(len(h[0]) for h in held)) or whole(held))
    out = [r for b in SU._by_document(SU._batches([row] * 50, SU._PLACES)) for r in b.to_pylist()]
    assert [(r["dk"], r["check"]) for r in out] == [(5, 1 << 40)]
    assert np.frombuffer(out[0]["places"], "<i4").tolist() == list(range(60)) and max(largest) <= 300


def test_keep_first_goes_by_row(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(3, a), (5, a.upper()), (5, b), (None, b), (None, c), (None, c), (None, c + " end"), (None, a)]
    assert len({d[2] for d in groups([(k, t) for k, (_, t) in enumerate(rows)], 4)}) == 3
    kept = by_row(SI.keep_first(documents(spark, rows)), "doc_id", "text")
    assert len(kept) == 3 and (3, a) in kept and (5, b) in kept
    alone = [t for d, t in kept if d is None]
    assert len(alone) == 1 and alone[0] in (c, c + " end")
    same = [(7, a), (7, a), (None, b), (None, b)]
    assert by_row(SI.keep_first(documents(spark, same)), "doc_id", "text") == sorted([(7, a), (None, b)], key=repr)
