"""LIKE patterns of the store's own dialect.

``%`` is any text, ``_`` any one character, ``[abc]`` and ``[a-f]`` one
character of a set, ``[^...]`` one that is not in it.  A wildcard in brackets
stands for itself (``[%]``).  A bracket that is never closed, and an empty set,
match nothing; a ``]`` outside a set stands for itself.  Spark's LIKE has only
the first two.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NOTHING = "(?!)"


def _literal(c: str) -> str:
    return c if c.isalnum() else "\\" + c if c.isascii() and not c.isspace() else f"\\x{{{ord(c):X}}}"


def _set(body: str) -> str:
    """The regex of a set's body: ranges and single characters."""
    negated, body = body.startswith("^") and len(body) > 1, body
    body = body[1:] if negated else body
    parts, i = [], 0
    while i < len(body):
        if i + 2 < len(body) and body[i + 1] == "-":
            low, high = body[i], body[i + 2]
            parts.append(f"{_literal(low)}-{_literal(high)}" if low <= high else "")
            i += 3
        else:
            parts.append(_literal(body[i]))
            i += 1
    held = "".join(parts)
    if not held:
        return r"[\x{0}-\x{10FFFF}]" if negated else _NOTHING
    return f"[{'^' if negated else ''}{held}]"


def like_regex(pattern: str) -> str:
    """An anchored Java regex that matches what the LIKE pattern matches."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        if c == "[":
            end = pattern.find("]", i + 1)
            out.append(_NOTHING if end < 0 else _set(pattern[i + 1 : end]))
            i = len(pattern) if end < 0 else end + 1
            continue
        out.append(".*" if c == "%" else "." if c == "_" else _literal(c))
        i += 1
    return r"(?s)\A" + "".join(out) + r"\z"


def like(value: Column, pattern: str, collation: str | None = None) -> Column:
    """Whether a text is LIKE the pattern.  Of the collations, ``UTF8_LCASE``
    compares without case and those that end in ``RTRIM`` without trailing
    blanks; others that Spark knows do not go with a regex and raise."""
    regex, name = like_regex(pattern), (collation or "UTF8_BINARY").upper()
    if name not in ("UTF8_BINARY", "UTF8_LCASE", "UTF8_BINARY_RTRIM", "UTF8_LCASE_RTRIM"):
        raise ValueError(f"collation {collation!r} does not go with bracket patterns")
    if "LCASE" in name:
        regex = "(?iu)" + regex
    return F.rlike(F.rtrim(value) if name.endswith("RTRIM") else value, F.lit(regex))
