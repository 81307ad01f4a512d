"""Text recipes: SQL Server LIKE classes, case-insensitive compare, string helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def like_to_regex(pattern: str) -> str:
    """Translate a SQL Server LIKE pattern into an anchored Java regex.

    ``%`` -> any run, ``_`` -> one character, ``[abc]`` / ``[a-c]`` / ``[^a]``
    are character classes (Spark's own LIKE treats ``[`` literally). The result
    is anchored at both ends; ``\\z`` rather than ``$`` so a trailing newline
    does not match early.
    """
    out = ["(?s)^"]
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        elif ch == "[":
            j = pattern.find("]", i + 1)
            if j < 0:
                out.append(re.escape(ch))
            else:
                body = pattern[i + 1:j]
                neg = body.startswith("^")
                if neg:
                    body = body[1:]
                body = body.replace("\\", "\\\\").replace("[", "\\[")
                out.append("[" + ("^" if neg else "") + body + "]")
                i = j
        else:
            out.append(re.escape(ch))
        i += 1
    out.append("\\z")
    return "".join(out)


def like(col, pattern: str, case_insensitive: bool = True) -> Column:
    """``col LIKE pattern`` with SQL Server classes and (by default) a
    case-insensitive collation. Plain patterns without classes use Spark's
    own LIKE, which Catalyst can turn into StartsWith/Contains."""
    c = _c(col)
    if "[" not in pattern:
        return (F.lower(c).like(pattern.lower()) if case_insensitive else c.like(pattern))
    rx = like_to_regex(pattern.lower() if case_insensitive else pattern)
    return (F.lower(c) if case_insensitive else c).rlike(rx)


def _ci(col) -> Column:
    # case-insensitive collation; '=' also ignores trailing blanks (ANSI padding)
    return F.rtrim(F.lower(_c(col)))


def _ci_text(value: str) -> str:
    return value.lower().rstrip(" ")


def ci_key(col) -> Column:
    """The group of a text under a case-insensitive collation that ignores trailing blanks:
    ``GROUP BY``, ``DISTINCT`` and ``PARTITION BY`` on it put case variants together, as the
    reference's server does. A group is shown under ``spelling``."""
    return _ci(col)


def spelling(col) -> Column:
    """The spelling a group of case variants is shown under. The reference's server shows any of
    them; here it is the least in binary order (capitals before small letters)."""
    return F.min(_c(col))


def ci_eq(col, value: str) -> Column:
    """Equality under a case-insensitive collation (the reference compares one
    column with both 'Payment' and 'payment'); trailing blanks are ignored, as
    SQL Server's '=' does. Used on dimension columns only, so fact scans keep
    their pushed filters."""
    return _ci(col) == F.lit(_ci_text(value))


def ci_ne(col, value: str) -> Column:
    return _ci(col) != F.lit(_ci_text(value))


def ci_in(col, values) -> Column:
    return _ci(col).isin([_ci_text(v) for v in values])


def prefix_before(col, ch: str = "-") -> Column:
    """``SUBSTRING(s, 0, CHARINDEX(ch, s))``: the text before the first ``ch``.

    Start 0 makes SQL Server return one character less than the length, so the
    ``ch`` itself is dropped and a blank before it is kept; no ``ch`` -> ''.
    """
    c = _c(col)
    pos = F.instr(c, ch)
    return F.when(pos > 0, F.left(c, pos - 1)).when(pos.isNotNull(), F.lit(""))


def concat_text(*cols) -> Column:
    """``CONCAT(a, b, ...)``: numbers become text, NULL counts as ''."""
    return F.concat_ws("", *[_c(c).cast("string") for c in cols])


def nvl_text(col, default: str = "") -> Column:
    """``ISNULL(x, '')``."""
    return F.coalesce(_c(col), F.lit(default))
