"""Key sets and size-bounded broadcasts.

The reference looks up one id at a time. Here every detail operator takes a
*key set*: ``None`` (all keys), one int, a list of ints, or a DataFrame whose
first column holds the keys. Scalars and lists become filters that reach the
Parquet scan; a DataFrame becomes a ``left_semi`` join whose physical form
(broadcast or shuffle) AQE picks from the side's real size at run time.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

KeySet = Union[None, int, Iterable[int], DataFrame]

# Largest row count we broadcast on the strength of a static bound alone
# (e.g. the ``limit`` of a top-k). Top-k rows carry a handful of columns
# (~100 bytes), so the bound caps a hinted broadcast near 10 MB; a larger
# limit gets no hint and the planner / AQE choose from measured sizes.
BROADCAST_ROW_BOUND = 100_000


def is_single(ids: KeySet) -> bool:
    return isinstance(ids, int) and not isinstance(ids, bool)


def restrict(df: DataFrame, column: str, ids: KeySet) -> DataFrame:
    """Keep rows of ``df`` whose ``column`` is in the key set."""
    if ids is None:
        return df
    if is_single(ids):
        return df.filter(F.col(column) == F.lit(ids))
    if isinstance(ids, DataFrame):
        keys = ids.select(F.col(ids.columns[0]).alias(column))
        return df.join(keys, column, "left_semi").select(*df.columns)
    values = sorted({int(v) for v in ids})
    return df.filter(F.col(column).isin(values))


def key_condition(column: str, ids: KeySet) -> Column | None:
    """The key set as a plain predicate, or ``None`` for DataFrame / all keys."""
    if ids is None or isinstance(ids, DataFrame):
        return None
    if is_single(ids):
        return F.col(column) == F.lit(ids)
    return F.col(column).isin(sorted({int(v) for v in ids}))


def top_rows(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of ``df``, evaluated once.

    The rows are used several times (to cut the bridge tables and to carry
    the result), each time with other columns, so the planner could not
    share the scan; at most ``limit`` rows go to the checkpoint folder.
    """
    return reliable_checkpoint(df.orderBy(*order).limit(limit))


def bounded_broadcast(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast ``df`` only when its row count has a proven static bound.

    ``max_rows`` comes from the plan itself (a ``limit``, a fixed-size
    dimension); unbounded inputs stay un-hinted so the planner and AQE
    choose between broadcast and shuffle from measured sizes.
    """
    if max_rows is not None and 0 <= max_rows <= BROADCAST_ROW_BOUND:
        return F.broadcast(df)
    return df
