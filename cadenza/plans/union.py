"""Union of many DataFrames, built as a balanced tree.

Each classic-PySpark ``unionByName`` re-analyses the plan it creates; a
left-deep chain of n unions therefore re-walks ever larger plans. Pairing
the inputs halves the depth each round. The optimizer flattens nested
unions either way, so the physical plan is the same single ``Union``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(frames: list[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("union_all needs at least one DataFrame")
    level = list(frames)
    while len(level) > 1:
        nxt = [level[i].unionByName(level[i + 1]) for i in range(0, len(level) - 1, 2)]
        if len(level) % 2:
            nxt.append(level[-1])
        level = nxt
    return level[0]
