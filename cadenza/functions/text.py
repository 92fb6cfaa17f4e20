"""Text predicates: case-folded substring search with SQL LIKE wildcards."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_ESCAPABLE = "%_\\"


def like_pattern(term: str) -> str:
    """``'%' + term + '%'`` with the term's wildcards left live.

    The user's ``%`` and ``_`` act as wildcards and ``\\`` as the escape, as
    in PostgreSQL. PostgreSQL reads ``\\x`` as a literal ``x`` for any ``x``;
    Spark accepts the escape only before ``%``, ``_`` and ``\\``, so a
    backslash before any other character is dropped (same match).
    """
    raw = f"%{term}%"
    out = []
    i = 0
    while i < len(raw):
        ch = raw[i]
        if ch == "\\" and i + 1 < len(raw):
            nxt = raw[i + 1]
            if nxt in _ESCAPABLE:
                out.append(ch + nxt)
            else:
                out.append(nxt)
            i += 2
            continue
        out.append(ch)
        i += 1
    return "".join(out)


def search_match(column: str | Column, term: str) -> Column:
    """``lower(coalesce(col, '')) LIKE lower('%term%')``.

    NULL values take part as the empty string, so an empty term matches every
    row (NULLs included) and a non-empty term never matches a NULL. Without
    inner wildcards the optimizer rewrites this into a ``Contains`` filter
    evaluated inside the scan.
    """
    col = F.col(column) if isinstance(column, str) else column
    folded = F.lower(F.coalesce(col, F.lit("")))
    return F.like(folded, F.lower(F.lit(like_pattern(term))))


def any_match(columns: list[str | Column], term: str) -> Column:
    """Disjunction of ``search_match`` over several columns (same term)."""
    cond = search_match(columns[0], term)
    for c in columns[1:]:
        cond = cond | search_match(c, term)
    return cond


def whole_word_match(column: str | Column, term: str) -> Column:
    """Case-insensitive whole-word match: no word character of any script beside the term.

    The term is quoted, so regex metacharacters in it are literal; it may
    itself begin or end with other characters ("C++").
    """
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(col, F.lit("")).rlike("(?iuU)(?<!\\w)" + re.escape(term) + "(?!\\w)") if term else F.lit(True)
