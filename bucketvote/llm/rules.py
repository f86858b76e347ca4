"""Quality rules as a short-circuit cascade, in DataFrame operations.

Each rule rejects rows by a condition.  On a sample, every rule's cost (time
that it adds to the plan that runs) and selectivity (share rejected) are measured; rules are then
tried in the order of rejection per cost, and a row that one rejects is not
shown to the others (a CASE is evaluated branch by branch).  The order changes
the time, never the verdict: a row is kept if no rule rejects it.

The text measures are expressions over the whole text of a row; their time
grows as n log n with its words.

Nulls: a null text is empty.  A rule whose condition is null does not reject.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import bounded_batches, let

SAMPLE_ROWS = 4000
SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8


def _text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words(column: str = "text") -> Column:
    return F.filter(F.split(_text(column), SPACE), lambda w: w != "")


def word_chars(column: str = "text") -> Column:
    """Code points in words."""
    return F.char_length(F.regexp_replace(_text(column), SPACE, "")).cast("long")


def symbols(column: str = "text", of: str = "#*$%&|<>") -> Column:
    return (F.char_length(_text(column)) - F.char_length(F.translate(_text(column), of, ""))).cast("long")


def duplicate_lines(column: str = "text") -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(_text(column), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(of: Column, window: int = WINDOW) -> Column:
    """Words in windows that are found twice or more in the list ``of``."""

    def covered(starts: Column) -> Column:
        # each start covers a window, less what the next one covers too
        steps = F.transform(starts, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(starts, i + 1) - p, F.lit(window))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, k, x: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        marked = let(ordered, lambda s: F.transform(s, lambda x, k: F.when(same(s, k - 1, x) | same(s, k + 1, x), x["i"])))
        return let(F.array_sort(F.filter(marked, lambda i: i.isNotNull())), covered)

    def counted(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - window)
        hashes = let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(repeated(h)))

    return let(of, lambda w: F.when(F.size(w) <= window, F.lit(0).cast("long")).otherwise(counted(w)))


def measures() -> dict[str, Column]:
    """Measures of the column ``text``, by name."""
    return {
        "n_words": F.size(words()).cast("long"), "word_chars": word_chars(), "n_symbols": symbols(),
        "n_dup_lines": duplicate_lines(), "n_repeat_words": repeated_words(words()),
    }


def measured(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The ``carry`` columns and all measures; a text is split once."""
    split = docs.select(*carry, F.col("text").alias("_llm_text"), words().alias("_llm_words"))
    return split.select(
        *carry, F.size("_llm_words").cast("long").alias("n_words"), word_chars("_llm_text").alias("word_chars"), symbols("_llm_text").alias("n_symbols"),
        duplicate_lines("_llm_text").alias("n_dup_lines"), repeated_words(F.col("_llm_words")).alias("n_repeat_words"),
    )


def _share(part: str, whole: str, more_than: float) -> Column:
    """Whether characters of class ``part`` are more than a share of those of
    class ``whole``."""
    count = lambda kind: F.char_length(F.regexp_replace(_text(), f"[^{kind}]", ""))
    return count(part) > more_than * count(whole)


Rule = Callable[[dict[str, Column]], Column]

#: Rules over the measures and the column ``text``; a row is rejected where
#: one is true.
RULES: dict[str, Rule] = {
    "few_words": lambda m: m["n_words"] < 20,
    "repeated_words": lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"],
    "repeated_lines": lambda m: (m["n_dup_lines"] >= 3) & (8 * m["n_dup_lines"] > m["n_words"]),
    "symbols": lambda m: 10 * m["n_symbols"] > m["n_words"],
    "word_length": lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 20 * m["n_words"]),
    "capitals": lambda m: _share(r"\p{Lu}", r"\p{L}", 0.5),
    "doubled_marks": lambda m: 4 * F.size(F.regexp_extract_all(_text(), F.lit(r"[!?]{2,}"), F.lit(0))) > m["n_words"],
}


def order_rules(docs: DataFrame, rules: dict[str, Rule] = RULES, sample_rows: int = SAMPLE_ROWS, seed: int = 42, given: bool = False) -> list[tuple[str, float, float]]:
    """(rule, share rejected, seconds) by rejection per second, best first,
    from about ``sample_rows`` rows.  A rule's time is what it adds to the plan
    that runs: with the measures it needs, or, if these are ``given`` there as
    columns, without."""
    bounded_batches(docs.sparkSession)
    share = min(1.0, sample_rows / max(docs.count(), 1))
    sample = docs.select("text").sample(share, seed)
    of, found = measures(), []
    if given:
        sample, of = measured(sample, ["text"]), {name: F.col(name) for name in of}
    sample = sample.checkpoint()
    began = time.perf_counter()
    n = sample.count()
    least = time.perf_counter() - began
    for name, rule in rules.items():
        began = time.perf_counter()
        rejected = sample.agg(F.count_if(rule(of))).first()[0]
        found.append((name, rejected / max(n, 1), max(time.perf_counter() - began - least, 1e-3)))
    return sorted(found, key=lambda x: (-x[1] / x[2], x[2], x[0]))


def verdict(rules: dict[str, Rule], order: list[str], of: dict[str, Column]) -> Column:
    """Whether a row passes all rules, tried in ``order`` until one rejects."""
    return reduce(lambda rest, name: F.when(rules[name](of), F.lit(False)).otherwise(rest), reversed(order), F.lit(True))


def keep_passing(docs: DataFrame, rules: dict[str, Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that pass; a measure is only computed for rows that reach a
    rule which needs it."""
    order = [name for name, _, _ in order_rules(docs, rules, sample_rows)]
    return docs.filter(verdict(rules, order, measures()))


def judged(docs: DataFrame, rules: dict[str, Rule] = RULES, sample_rows: int = SAMPLE_ROWS, carry: list[str] | None = None) -> DataFrame:
    """One row for each row of ``docs``: the ``carry`` columns (doc_id unless
    named), all measures and passed, the cascade's verdict."""
    carry = ["doc_id"] if carry is None else carry
    order = [name for name, _, _ in order_rules(docs, rules, sample_rows, given=True)]
    rows = measured(docs, [*dict.fromkeys([*carry, "text"])])
    of = {name: F.col(name) for name in measures()}
    return rows.select(*carry, *of, verdict(rules, order, of).alias("passed"))
