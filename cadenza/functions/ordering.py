"""Sort keys with PostgreSQL null placement and deterministic tie-breaks.

PostgreSQL puts NULLs last in ascending and first in descending order;
Spark's defaults are the opposite, so every sort key states its placement.
Every ``ORDER BY ... LIMIT`` also ends in the primary key, which makes the
top-k a function of the data instead of an accident of the plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def asc(column: str | Column) -> Column:
    """``ORDER BY x`` / ``x ASC`` (NULLS LAST)."""
    return _c(column).asc_nulls_last()


def desc(column: str | Column) -> Column:
    """``ORDER BY x DESC`` (NULLS FIRST)."""
    return _c(column).desc_nulls_first()


def text_key(column: str, collation: str | None = None) -> Column:
    """``ORDER BY x`` of a text: by code point, or in the order of ``collation`` (e.g. 'UNICODE': Alena, Aleš, Alex)."""
    return asc(F.collate(F.col(column), collation) if collation else column)


def asc_nulls_first(column: str | Column) -> Column:
    return _c(column).asc_nulls_first()


def desc_nulls_last(column: str | Column) -> Column:
    return _c(column).desc_nulls_last()


def with_tiebreak(keys: list[Column], *tiebreak: str) -> list[Column]:
    """Append the tie-breaking key columns, ascending."""
    return list(keys) + [asc(c) for c in tiebreak]
