"""Text and path expressions used by the link catalogue and the ingest jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_token(s, n: int, sep: str = " ") -> Column:
    """FN11: token ``n`` of ``s`` split on ``sep`` (0-based; negative counts from the end).

    Out-of-range positions give null (the ``try_`` form; plain ``element_at``
    raises under ANSI mode).
    """
    parts = F.split(_c(s), F.lit(sep), -1)
    if n >= 0:
        return F.get(parts, n)
    return F.try_element_at(parts, F.lit(n))


def token_count(s, sep: str = " ") -> Column:
    """Number of ``sep``-separated tokens; null for null input (also when ANSI is off)."""
    col = _c(s)
    return F.when(col.isNotNull(), F.size(F.split(col, F.lit(sep), -1)))


def text_in_parens(s) -> Column:
    """FN12: text between the first '(' and the next ')'; null when there is no '('.

    Without a closing ')' the rest of the text is returned.
    """
    col = _c(s)
    rest = F.when(F.instr(col, "(") > 0, F.substring(col, F.instr(col, "(") + 1, F.length(col)))
    return F.substring_index(rest, ")", 1)


def path_basename(p) -> Column:
    """FN13: last '/'-separated part of a URL or path."""
    return F.substring_index(_c(p), "/", -1)


def path_restem(name, extension: str) -> Column:
    """FN14: stem before the first '.' followed by a new extension."""
    return F.concat(F.substring_index(_c(name), ".", 1), F.lit(extension))


def path_concat(*parts) -> Column:
    """FN15: plain concatenation of URL / path parts (``str`` parts are literals)."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
