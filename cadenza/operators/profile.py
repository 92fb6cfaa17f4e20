"""Catalog profiling: exact row counts and per-column coverage.

Each table is scanned once; all per-table results are unioned into one
plan, so the whole profile is a single Spark job with one tiny aggregate
per table (no shuffle of table rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..plans.union import union_all
from ..functions.aggregates import avg2
from ..functions.ordering import asc, desc
from ..schemas import TABLES, optional_schema, schema


def table_row_counts(cat: Catalog, tables: tuple[str, ...] | None = None) -> DataFrame:
    """table_name, row_count; largest first (exact, not a planner estimate).

    Every table contributes only a constant tag column, so the scans read
    no data columns (row counts come from Parquet metadata), and one grouped
    count over the union does all tables with a single shuffle of at most
    (tables x partitions) partial counts.
    """
    names = [t for t in (tables or TABLES) if t in cat]
    tags = union_all([cat[t].select(F.lit(t).alias("table_name")) for t in names])
    counts = tags.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))
    # An empty table yields no group: report it from the table list (one
    # row per table, metadata) with 0.
    listed = cat.spark.createDataFrame([(t,) for t in names], "table_name string")
    return (
        listed.join(F.broadcast(counts), "table_name", "left")
        .select("table_name", F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"))
        .orderBy(desc("row_count"), asc("table_name"))
    )


def coverage_report(cat: Catalog, columns: dict[str, list[str]] | None = None) -> DataFrame:
    """table_name, column_name, row_count, non_null, coverage_pct (0-100, 2 places).

    ``columns`` maps table -> columns; default is every declared column of
    every table plus the optional ones (external ids, bios) the table carries. Each table is projected to a common shape (tag, one 0/1
    "is present" flag per column slot) and the union is summed per tag in
    one grouped aggregate (partial sums map-side, one shuffle for the whole
    catalog); ``stack`` then turns each wide row into (slot, count) rows and
    a broadcast join with the slot -> column-name metadata (one row per
    profiled column) names them.
    """
    if columns is None:
        columns = {}
        for t in TABLES:
            if t in cat:
                extra = optional_schema(t)
                present = set(cat[t].columns) if extra else set()
                columns[t] = [f.name for f in schema(t).fields] + [
                    f.name for f in (extra.fields if extra else []) if f.name in present
                ]
    wanted = columns
    wanted = {t: cols for t, cols in wanted.items() if cols}
    width = max(len(cols) for cols in wanted.values())
    slots = [f"nn_{i}" for i in range(width)]
    parts = []
    for table, cols in wanted.items():
        flags = [F.col(c).isNotNull().cast("long").alias(slots[i]) for i, c in enumerate(cols)]
        pad = [F.lit(None).cast("long").alias(slots[i]) for i in range(len(cols), width)]
        parts.append(cat[table].select(F.lit(table).alias("table_name"), *flags, *pad))
    sums = union_all(parts).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("row_count"), *[F.sum(c).alias(c) for c in slots]
    )
    stack_args = ", ".join(f"{i}, {c}" for i, c in enumerate(slots))
    long = sums.select("table_name", "row_count", F.expr(f"stack({width}, {stack_args}) AS (slot, non_null)"))
    meta = cat.spark.createDataFrame(
        [(t, i, c) for t, cols in wanted.items() for i, c in enumerate(cols)],
        "table_name string, slot int, column_name string",
    )
    # Left join from the column list: an empty table has no group, and its
    # columns are reported with 0 rows.
    out = meta.join(F.broadcast(long), ["table_name", "slot"], "left")
    return out.select(
        "table_name",
        "column_name",
        F.coalesce(F.col("row_count"), F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce(F.col("non_null"), F.lit(0)).cast("bigint").alias("non_null"),
        avg2(F.coalesce(F.col("non_null"), F.lit(0)) * 100, F.coalesce(F.col("row_count"), F.lit(0))).alias("coverage_pct"),
    ).orderBy(asc("table_name"), asc("column_name"))
