"""Language identification by segmentation-marginalised unigrams.

Every language has its own probabilities of the pieces of one fixed public
vocabulary.  A word's probability in a language is the sum over all its
segmentations into pieces, by a forward recursion for all languages at once;
a text's is the product over its words and the language's share of the
training texts.  The language of the largest probability is the prediction,
its posterior the score.

Words are runs of ASCII letters and non-ASCII characters of the lower-cased
text.  Fitting: words are counted by language over the training texts, one
expectation pass over their lattices under the vocabulary's own scores gives
each language's expected piece counts, and these are smoothed by the counts of
all languages, which are smoothed by the vocabulary's scores.  At most about
``TRAIN_TEXTS`` texts a language are used, chosen by a hash of id and text,
and the ``LANGUAGES`` most frequent languages are learned (ties: by name), so
the model is bounded; it is broadcast, and scoring needs no shuffle.

Nulls: a null text, or one without a letter, is ``und`` with score 0; rows
without language do not train; a null doc_id counts as an empty string when
rows are held out.  Without training rows every prediction is ``und`` with
score 0.  Repeated rows train and are scored as often as they occur.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lattice import SCALE, Lattice, Vocabulary, load_vocabulary
from .likelihood import held_out
from .pieces import VOCABULARY
from .text import bounded_batches, slices, utf8

TRAIN_TEXTS, LANGUAGES = 10_000, 256
#: Pieces that the shared counts weigh in a language's, and the vocabulary's
#: own scores in the shared counts.
SHARED_PIECES, PRIOR_PIECES = 200.0, 1000.0
#: Word scores that a task keeps (more begin anew), words counted before a task
#: passes them on, words of one lattice, values of one recursion, code points of
#: a word that are taken at once, and bytes from which a training word is cut.
MEMORY, HELD_WORDS, AT_ONCE, VALUES, SPAN, CUT = 1 << 20, 400_000, 20_000, 1 << 22, 4096, 1024
SLICE = 1 << 20

UNKNOWN = "und"
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """The words of a text; none if it has no letter."""
    if text.isascii():
        return text.translate(_WORDS).split()
    lower = text.decode(errors="replace").lower()
    return lower.encode().translate(_WORDS).split() if any(map(str.isalpha, lower)) else []


class Forward:
    """Word probabilities in all languages.  ``logs`` has a row for each piece
    and a column for each language, ``log_byte`` the weight of a byte piece."""

    def __init__(self, lattice: Lattice, logs: np.ndarray, log_byte: np.ndarray):
        self.lattice, self.languages = lattice, logs.shape[1]
        # a piece id names its row; -1 no piece, -2 to -5 a point spelt in one to four bytes
        spelt = np.arange(4, 0, -1)[:, None] * log_byte
        self.logs = np.concatenate((logs, spelt, np.full((1, self.languages), -np.inf)))

    def __call__(self, words: list[str]) -> np.ndarray:
        """Natural logs, a row for each word."""
        out = np.zeros((len(words), self.languages))
        size = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(size > SPAN).tolist():
            out[i] = self._long(words[i])
        short = np.flatnonzero(size <= SPAN)
        for i in range(0, len(short), AT_ONCE):
            own = short[i : i + AT_ONCE]
            out[own] = self._short([words[j] for j in own.tolist()])
        return out

    def _edges(self, chunks: list[str]):
        points, begin, size, ids = self.lattice.edges(chunks)
        if ids:
            ids[0] = np.where(ids[0] == -2, -1 - self.lattice.spelt(points), ids[0])
        return begin, size, ids

    def _short(self, words: list[str]) -> np.ndarray:
        begin, size, ids = self._edges(words)
        out = np.zeros((len(words), self.languages))
        for band in self.lattice.groups(size):
            step = max(1, VALUES // ((int(size[band[0]]) + 1) * self.languages))
            for i in range(0, len(band), step):
                own = band[i : i + step]
                length, at = size[own], begin[own]
                ahead = np.full((int(length[0]) + 1, len(own), self.languages), -np.inf)
                ahead[0] = 0.0
                for t in range(1, len(ahead)):
                    self._step(ahead, t, ids, at[: np.searchsorted(-length, -t, "right")], t)
                out[own] = ahead[length, np.arange(len(own))]
        return out

    def _step(self, ahead: np.ndarray, t: int, ids: list[np.ndarray], at: np.ndarray, most: int) -> None:
        """ahead[t] of the chunks that begin at ``at``, from the edges that
        end there and are at most ``most`` points long."""
        for L in range(1, min(most, len(ids)) + 1):
            what = ids[L - 1][at + (t - L)]
            some = np.flatnonzero(what != -1)
            if len(some):
                ahead[t, some] = np.logaddexp(ahead[t, some], ahead[t - L, some] + self.logs[what[some]])

    def _long(self, word: str) -> np.ndarray:
        """A very long word: windows of SPAN points, each with the points and
        the values before it as far back as a piece reaches."""
        back, carried = self.lattice.longest, None
        for i in range(0, len(word), SPAN):
            # a chunk that begins with a line feed has no mark, and no piece holds the line feed
            begin, size, ids = self._edges([word[:SPAN] if carried is None else "\n" + word[i - back : i + SPAN]])
            ahead = np.full((int(size[0]) + 1, 1, self.languages), -np.inf)
            if carried is None:
                ahead[0], first = 0.0, 1
            else:
                ahead[1 : back + 2], first = carried, back + 2
            for t in range(first, len(ahead)):
                self._step(ahead, t, ids, begin, t)
            carried = ahead[-(back + 1) :]
        return carried[-1, 0]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of training texts; lang is the language's number."""

    def out():
        keys = list(counts)
        for i in range(0, len(keys), 50_000):
            part = keys[i : i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in part], pa.int32()), pa.array([k[1] for k in part], pa.binary()), pa.array([counts[k] for k in part], pa.int64())], names=["lang", "word", "n"]
            )
        counts.clear()

    counts: Counter[tuple[int, bytes]] = Counter()
    for batch in slices(batches, limit=SLICE):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for word in words_of(text or b""):
                if len(word) <= CUT:
                    counts[lang, word] += 1
                else:
                    whole = word.decode()
                    counts.update((lang, whole[i : i + CUT // 4].encode()) for i in range(0, len(whole), CUT // 4))
        if len(counts) > HELD_WORDS:
            yield from out()
    yield from out()


def _expected(vocabulary, logs):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, (by_id, byte) = Lattice(Vocabulary(*vocabulary.value)), logs
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            lang, n = batch.column("lang").to_numpy(), batch.column("n").to_numpy().astype(float)
            words = [w.decode() for w in batch.column("word").to_pylist()]
            for x in np.unique(lang).tolist():
                own = np.flatnonzero(lang == x)
                got = lattice.marginal([words[i] for i in own.tolist()], by_id, byte, n[own])[1]
                total[x] = total.get(x, 0) + got
        for x, count in total.items():
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), x, np.int32)), pa.array(at.astype(np.int32)), pa.array(count[at])], names=["lang", "id", "n"])

    return of


class Model(NamedTuple):
    """Plain data: language names, logs of their shares of the training texts,
    and logs of piece and byte weights, a column for each language."""

    languages: list
    share: np.ndarray
    logs: np.ndarray
    log_byte: np.ndarray


def fit(rows: DataFrame, vocabulary: Vocabulary, train_texts: int = TRAIN_TEXTS, languages: int = LANGUAGES) -> Model | None:
    """The model of training rows (lang, text, doc_id); None if there are none."""
    spark = rows.sparkSession
    known = rows.filter(F.col("lang").isNotNull())
    found = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not found:
        return None
    names, sizes = [r["lang"] for r in found], np.array([r["count"] for r in found], float)
    numbers = spark.createDataFrame([(n, i, min(1.0, train_texts / k)) for i, (n, k) in enumerate(zip(names, sizes.tolist()))], "lang string, number int, share double")
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    sample = known.join(F.broadcast(numbers), "lang").filter(chosen).select(F.col("number").alias("lang"), utf8("text").alias("text"))
    counts = sample.mapInArrow(_counted, "lang int, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))

    usable = np.array([p is not None for p in vocabulary.pieces])
    start = np.append(np.where(usable, np.exp(vocabulary.weights / SCALE), 0.0), 256 * np.exp(vocabulary.byte_weight / SCALE))
    start /= start.sum()  # the last one: any byte piece
    with np.errstate(divide="ignore"):
        begin = np.log(start[:-1]), float(np.log(start[-1] / 256))
    seen = counts.mapInArrow(_expected(spark.sparkContext.broadcast(tuple(vocabulary)), begin), "lang int, id int, n double")
    expected = np.zeros((len(start), len(names)))
    for r in seen.groupBy("lang", "id").agg(F.sum("n").alias("n")).toLocalIterator():  # at most the vocabulary's size a language
        expected[r["id"], r["lang"]] = r["n"]
    return Model(names, np.log(sizes / sizes.sum()), *_smoothed(expected, start))


def _smoothed(expected: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shared = expected.sum(axis=1) + PRIOR_PIECES * start
    own = expected + SHARED_PIECES * (shared / shared.sum())[:, None]
    with np.errstate(divide="ignore"):
        logs = np.log(own / own.sum(axis=0))
    return logs[:-1], logs[-1] - np.log(256)


def _predicted(vocabulary, model):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*model.value)
        forward = Forward(Lattice(Vocabulary(*vocabulary.value)), own.logs, own.log_byte)
        number: dict[bytes, int] = {}
        logs = np.zeros((0, len(own.languages)))
        for batch in slices(batches, limit=SLICE):
            texts = [words_of(t) if t else [] for t in batch.column("text").to_pylist()]
            if len(number) * len(own.languages) > MEMORY:
                number.clear()
                logs = logs[:0]
            new = list(set().union(*texts).difference(number))
            if new:
                number.update(zip(new, range(len(number), len(number) + len(new))))
                logs = np.concatenate((logs, forward([w.decode() for w in new])))
            names, scores = [], []
            for words in texts:
                if not words:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total = own.share + logs[np.fromiter(map(number.__getitem__, words), np.int64, len(words))].sum(axis=0)
                best = int(np.argmax(total))
                names.append(own.languages[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "held")), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    return of


def identify(docs: DataFrame, held: Column | None = None, vocabulary: str = VOCABULARY, train_texts: int = TRAIN_TEXTS, languages: int = LANGUAGES) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, lang_pred and score
    (the prediction's posterior probability)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    held = held_out(fold=0) if held is None else held
    own = load_vocabulary(vocabulary)
    model = fit(docs.filter(~held).select("doc_id", "lang", "text"), own, train_texts, languages)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"), utf8("text").alias("text"))
    if model is None:
        return rows.select("doc_id", F.col("held").alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(tuple(own)), spark.sparkContext.broadcast(tuple(model))
    return rows.mapInArrow(_predicted(*shared), "doc_id long, held_out boolean, lang_pred string, score double")
