"""Aggregate expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = ", "


def _c(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def distinct_names(column: str | Column, sep: str = SEPARATOR) -> Column:
    """``STRING_AGG(DISTINCT x, ', ')`` with the values in sorted order.

    NULLs are skipped; a group with no non-NULL value gives NULL (not '').
    ``collect_set`` merges map-side (partial aggregation), so a group is never
    shipped row by row; only its distinct values travel.
    """
    values = F.array_sort(F.collect_set(_c(column)))
    return F.when(F.size(values) > 0, F.array_join(values, sep))


def collated_names(column: str, collation: str = "UNICODE", sep: str = SEPARATOR) -> Column:
    """Sorted, comma-joined values under a linguistic collation.

    The input must already be distinct per group (dedupe ``(key, value)``
    first): Spark rejects ``DISTINCT`` together with a collated ``WITHIN
    GROUP`` order.
    """
    return F.expr(
        f"string_agg({column}, '{sep}') WITHIN GROUP (ORDER BY collate({column}, '{collation}'))"
    )


def avg2(total: str | Column, count: str | Column) -> Column:
    """Exact average of integers rounded half away from zero to 2 places.

    ``AVG(int)::numeric`` is exact in PostgreSQL; dividing doubles is not, so
    the sum is divided as a decimal and rounded once. NULL when count is 0.
    """
    cnt = _c(count)
    q = _c(total).cast("decimal(20,0)") / F.when(cnt > 0, cnt).cast("decimal(20,0)")
    return F.round(q, 2).cast("decimal(10,2)")
