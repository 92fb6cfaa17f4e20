"""Connected components of an edge table, for keys that belong together through other keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written_table


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``: root is the smallest node of its component.

    Each round points every node at the smallest of itself and its
    neighbours, follows the pointers to their ends by doubling, and contracts
    the edges to those ends; at most half of a component's nodes are ends, so
    the number of rounds is logarithmic. Minima are partial aggregates, so a
    node with very many edges is combined map-side, and every round is
    written, so a lost executor repeats one round at most.
    """
    e = written_table(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    roots = None
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("b"))
        ends = _followed(written_table(near.select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "pointers"))
        roots = ends if roots is None else written_table(_moved(roots, "root", ends), "roots")
        e = written_table(_moved(_moved(e, "a", ends), "b", ends).filter(F.col("a") != F.col("b")).distinct(), "edges")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    return roots


def _moved(df: DataFrame, column: str, pointers: DataFrame) -> DataFrame:
    """``df`` with ``column`` replaced by the end of its pointer, where it has one."""
    to = pointers.select(F.col("node").alias(column), F.col("root").alias("_to"))
    return df.join(to, column, "left").withColumn(column, F.coalesce("_to", column)).select(*df.columns)


def _followed(pointers: DataFrame) -> DataFrame:
    """Pointers that lead to nodes which point at themselves."""
    while True:
        on_way = pointers.join(pointers.select(F.col("node").alias("root"), F.col("root").alias("_next")), "root")
        if on_way.filter(F.col("_next") != F.col("root")).isEmpty():
            return pointers
        pointers = written_table(on_way.select("node", F.col("_next").alias("root")), "pointers")
