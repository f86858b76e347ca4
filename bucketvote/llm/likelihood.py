"""Subword lattice likelihood: a text's probability over all segmentations.

The pieces of an existing vocabulary weigh all segmentations of a word.  The
starting weights are the vocabulary's own scores; ``PASSES`` expectation
passes over the lattices of all training words (distinct words with their
counts) give the expected count of every piece, and these, with
``PRIOR_PIECES`` pieces spread by the vocabulary's scores, are the weights.
The training rows act on the piece weights only.  A word's probability is the
sum over all its segmentations (forward recursion in log space), and a text's
is the product over its words and the end, which is drawn like a piece: the
texts' share of all training pieces and ends.

Work goes by distinct word: words are counted over the training texts and
scored once each.  Texts then meet their words' scores: the most frequent
words (at most ``FREQUENT``, each of at most ``FREQUENT_BYTES``) come as a
broadcast of bounded size, which also takes the hot keys out of the join; all
other words are joined on the word, by a join that can spill.  What rows are
numbered by is checkpointed before that join, so a recomputed task cannot
number them anew.

Nulls: a null text is empty; a null doc_id counts as an empty string when
rows are held out.  Repeated rows count and are scored as often as they occur.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lattice import SCALE, Lattice, Vocabulary, load_vocabulary
from .pieces import VOCABULARY
from .text import LOWER, bounded_batches, slices, utf8

#: Bounds of the broadcast word table.
FREQUENT, FREQUENT_BYTES = 65_536, 64
#: Weight of the vocabulary's own scores, in pieces, and expectation passes.
PRIOR_PIECES, PASSES = 1000.0, 2
#: Words a task holds before it passes its counts on, and words solved at once.
HELD_WORDS, AT_ONCE = 400_000, 20_000


def held_out(doc_id: str = "doc_id", folds: int = 5, fold: int = 1) -> Column:
    """Whether a row is kept from training: crc32 of its id as text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == fold


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n): counts in training texts, 0 for words of other texts."""

    def out(counts):
        words = list(counts)
        for i in range(0, len(words), 50_000):
            part = words[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([counts[w] for w in part], pa.int64())], names=["word", "n"])

    counts: Counter[bytes] = Counter()
    for batch in slices(batches):
        for text, held in zip(batch.column("text").to_pylist(), batch.column("held").to_pylist()):
            words = text.translate(LOWER).split() if text else ()
            if held:
                for w in words:
                    if w not in counts:
                        counts[w] = 0
            else:
                counts.update(words)
        if len(counts) > HELD_WORDS:
            yield from out(counts)
            counts.clear()
    yield from out(counts)


def _expected(vocabulary, logs):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, (by_id, byte) = Lattice(Vocabulary(*vocabulary.value)), logs
        total = np.zeros(len(by_id) + 1)
        for batch in batches:
            words, times = _chunks(batch.column("word")), batch.column("n").to_numpy().astype(float)
            for i in range(0, len(words), AT_ONCE):
                total += lattice.marginal(words[i : i + AT_ONCE], by_id, byte, times[i : i + AT_ONCE])[1]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["id", "n"])

    return of


def _scored(vocabulary, logs):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, (by_id, byte) = Lattice(Vocabulary(*vocabulary.value)), logs.value
        for batch in batches:
            words = _chunks(batch.column("word"))
            score = np.concatenate([lattice.marginal(words[i : i + AT_ONCE], by_id, byte) for i in range(0, len(words), AT_ONCE)]) if words else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(score / np.log(10))], names=["word", "n", "score"])

    return of


def _chunks(words: pa.Array) -> list[str]:
    return [w.decode() for w in words.to_pylist()]


def _met(frequent):
    """Per text a row of what the frequent words give, named by a space and
    the row number (no word has a space), and a row for each other word."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, known, base, score, end_base, end_score, end_known = frequent.value
        for batch in slices(batches):
            rows, words_out, times = [], [], []
            sums = []
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                counts = Counter(text.translate(LOWER).split()) if text else {}
                at, n = [], []
                for w, k in counts.items():
                    i = number.get(w)
                    if i is None:
                        rows.append(row)
                        words_out.append(w)
                        times.append(k)
                    else:
                        at.append(i)
                        n.append(k)
                n = np.array(n, np.int64)
                at = np.array(at, np.int64)
                sums.append((row, b" %d" % row, 1 + sum(counts.values()), int((n * known[at]).sum()) + end_known, float((n * base[at]).sum()) + end_base, float((n * score[at]).sum()) + end_score))
            row, word, tokens, n_known, base_sum, score_sum = zip(*sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int64()), pa.array(word, pa.binary()), pa.array([None] * len(row), pa.int64()), batch.column("doc_id"), batch.column("held"), pa.array(tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base_sum), pa.array(score_sum)],
                names=_MET,
            )
            if rows:
                none = pa.nulls(len(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array(words_out, pa.binary()), pa.array(times, pa.int64()), none.cast(pa.int64()), none.cast(pa.bool_()), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.float64()), none.cast(pa.float64())],
                    names=_MET,
                )

    return of


_MET = ["row", "word", "times", "doc_id", "held", "tokens", "known", "base", "score"]


def word_counts(docs: DataFrame, held: Column) -> DataFrame:
    """(word, n): every word of ``docs`` (binary, A-Z lower-cased) and its
    count in the rows that are not held out."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(utf8("text").alias("text"), held.alias("held"))
    return rows.mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit(counts: DataFrame, vocabulary: Vocabulary, n_texts: int, prior: float = PRIOR_PIECES, passes: int = PASSES) -> tuple[np.ndarray, float, float]:
    """Natural logs of the weights of each piece, of any byte piece and of a
    text's end, from words with their training counts and the training texts'
    number.  Without training texts the end has one half."""
    spark = counts.sparkSession
    usable = np.array([p is not None for p in vocabulary.pieces])
    start = np.append(np.where(usable, np.exp(vocabulary.weights / SCALE), 0.0), 256 * np.exp(vocabulary.byte_weight / SCALE))
    start /= start.sum()  # the last one: all byte pieces
    shared = spark.sparkContext.broadcast(tuple(vocabulary))
    weights, ends = start, 0.5

    def logs() -> tuple[np.ndarray, float]:
        with np.errstate(divide="ignore"):
            return np.log(weights[:-1]), float(np.log(weights[-1] / 256))

    for _ in range(passes if n_texts else 0):
        seen = counts.filter("n > 0").mapInArrow(_expected(shared, logs()), "id int, n double")
        total = prior * start
        for r in seen.groupBy("id").agg(F.sum("n").alias("n")).collect():  # as many rows as the vocabulary has
            total[r["id"]] += r["n"]
        weights, ends = total / total.sum(), n_texts / (total.sum() + n_texts)
    weights = weights * (1 - ends)
    return *logs(), float(np.log(ends))


def likelihood(docs: DataFrame, held: Column | None = None, vocabulary: str = VOCABULARY, frequent: int = FREQUENT) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score and score (log10).

    Tokens are the words of the text (A-Z lower-cased) and one end.  The base
    is the add-half unigram model of the training tokens; score is the lattice
    model's marginal.  An empty table gives no rows; without training rows the
    model is the vocabulary's own.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    held = held_out() if held is None else held
    own = load_vocabulary(vocabulary)
    counts = word_counts(docs, held).checkpoint()
    n_texts = docs.filter(~held).count()
    seen = counts.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    n, v = (seen["n"] or 0) + n_texts, seen["v"] + (n_texts > 0)
    shared = spark.sparkContext.broadcast(tuple(own))
    by_id, byte, end = fit(counts, own, n_texts)
    model = spark.sparkContext.broadcast((by_id, byte))
    scored = counts.mapInArrow(_scored(shared, model), "word binary, n long, score double").checkpoint()

    # The frequent words: as many steps of a count scale as fit the bound.
    step = F.floor(F.log2("n") * 8)
    short = scored.filter((F.col("n") > 0) & (F.octet_length("word") <= FREQUENT_BYTES)).withColumn("step", step)
    fit_, least = 0, 1 << 40
    for r in short.groupBy("step").count().orderBy(F.desc("step")).collect():  # at most 8 * 63 rows
        if fit_ + r["count"] > frequent:
            break
        fit_, least = fit_ + r["count"], r["step"]
    rows = short.filter(F.col("step") >= least).select("word", "n", "score").collect()  # at most `frequent`
    below = n + 0.5 * (v + 1)
    c = np.array([r["n"] for r in rows], np.float64)
    table = (
        {bytes(r["word"]): i for i, r in enumerate(rows)}, (c > 0).astype(np.int64), np.log10((c + 0.5) / below), np.array([r["score"] for r in rows]),
        float(np.log10((n_texts + 0.5) / below)), end / float(np.log(10)), int(n_texts > 0),
    )
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"), utf8("text").alias("text"))
    met = texts.mapInArrow(_met(spark.sparkContext.broadcast(table)), "row long, word binary, times long, doc_id long, held boolean, tokens long, known long, base double, score double").checkpoint()
    others = scored.select("word", F.col("n").alias("count"), F.col("score").alias("word_score"))
    per_word = met.join(others, "word", "left").select(
        "row", "doc_id", "held", "tokens",
        F.coalesce("known", F.when(F.col("count") > 0, F.col("times")).otherwise(0)).alias("known"),
        F.coalesce("base", F.col("times") * F.log10((F.coalesce("count", F.lit(0)) + 0.5) / F.lit(below))).alias("base"),
        F.coalesce("score", F.col("times") * F.col("word_score")).alias("score"),
    )
    return (
        per_word.groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("held").alias("held_out"), F.max("tokens").alias("n_tokens"), F.sum("known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score"))
        .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
    )
