"""Merge entities that share external ids.

One entity can be known by several ids (a recording by its gid, by the ISRC
on its row and by those of its ISRC table), and ids overlap: two rows share a
gid, one of them an ISRC with a third. All rows connected by shared ids are
one entity, kept under its smallest key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..plans.components import connected_components
from ..plans.union import union_all
from ..schemas import FOREIGN_KEYS, PRIMARY_KEYS
from ..session import written_table

# Tables that list further ids of an entity: (table, key column, id column).
ID_TABLES: dict[str, tuple[tuple[str, str, str], ...]] = {"track": (("track_isrc", "track_id", "isrc"),)}


@dataclass(frozen=True)
class DedupeResult:
    catalog: Catalog
    mapping: DataFrame  # (old_key, kept_key) for every merged row


def shared_ids(cat: Catalog, table: str, id_columns: list[str], id_tables: tuple[tuple[str, str, str], ...] = ()) -> DataFrame:
    """(key, id_kind, id) of every id an entity of ``table`` has; values of one kind are compared with one another.

    An id table's column is of the kind of the same column on the entity's row.
    """
    key = PRIMARY_KEYS[table][0]
    parts = [cat[table].select(F.col(key).alias("key"), F.lit(c).alias("id_kind"), F.col(c).alias("id")) for c in id_columns if c in cat[table].columns]
    for child, column, id_column in id_tables:
        if child in cat:
            known = cat[child].join(cat[table].select(F.col(key).alias(column)), column, "left_semi")
            parts.append(known.select(F.col(column).alias("key"), F.lit(id_column).alias("id_kind"), F.col(id_column).alias("id")))
    if not parts:
        return cat.spark.createDataFrame([], "key bigint, id_kind string, id string")
    return union_all(parts).filter(F.col("id").isNotNull() & F.col("key").isNotNull())


def dedupe_entities(
    cat: Catalog, table: str, id_columns: list[str], id_tables: tuple[tuple[str, str, str], ...] = ()
) -> DedupeResult:
    """Merge the rows of ``table`` that are connected by shared external ids.

    An id links all its rows to the smallest of them (one partial aggregate
    per id, so an id that very many rows share makes no pairs), and the
    components of these links are the entities. The smallest key of each is
    kept and every reference to the others rewritten to it. Only child rows
    whose reference belongs to a merged entity are touched: those that
    collide after the rewrite are reduced to one per primary key, the row of
    the smallest original key, and all others pass through as they are.
    """
    pk = PRIMARY_KEYS[table]
    if len(pk) != 1:
        raise ValueError("dedupe works on tables with a single-column key")
    key = pk[0]
    ids = shared_ids(cat, table, id_columns, id_tables)
    least = ids.groupBy("id_kind", "id").agg(F.min("key").alias("least"))
    links = ids.join(least, ["id_kind", "id"]).filter(F.col("key") != F.col("least"))
    roots = connected_components(links.select(F.col("key").alias("a"), F.col("least").alias("b")))
    mapping = written_table(roots.filter(F.col("node") != F.col("root")).select(F.col("node").alias("old_key"), F.col("root").alias("kept_key")), "merged")
    merged = written_table(
        mapping.select(F.col("old_key").alias("entity"), "kept_key").unionByName(mapping.select(F.col("kept_key").alias("entity"), "kept_key").distinct()),
        "entities",
    )  # every key of a merged entity, the kept one included
    old = mapping.select(F.col("old_key").alias(key))
    tables: dict[str, DataFrame] = {table: cat[table].join(old, key, "left_anti").select(*cat[table].columns)}
    for fk in FOREIGN_KEYS:
        if fk.parent != table or fk.parent_column != key or fk.child not in cat:
            continue
        child = tables.get(fk.child, cat[fk.child])
        tables[fk.child] = _rewritten(child, fk.child, fk.column, merged, fk.child == table)
    return DedupeResult(cat.replace(**tables), mapping)


def _rewritten(child: DataFrame, name: str, column: str, merged: DataFrame, own: bool) -> DataFrame:
    """``child`` with the references in ``column`` to merged entities rewritten."""
    cols, child_pk = child.columns, list(PRIMARY_KEYS[name])
    entity = merged.select(F.col("entity").alias(column), "kept_key")
    if column not in child_pk or own:  # a plain reference: nothing can collide
        moved = child.join(entity, column, "left").withColumn(column, F.coalesce("kept_key", column))
        return moved.select(*cols)
    touched = child.join(entity, column).select(*[F.col("kept_key").alias(c) if c == column else F.col(c) for c in cols], F.col(column).alias("_orig"))
    others = [c for c in cols if c not in child_pk]
    if others:
        best = touched.groupBy(*child_pk).agg(F.min_by(F.struct(*others), F.struct("_orig", *others)).alias("_row"))
        touched = best.select(*child_pk, *[F.col(f"_row.{c}").alias(c) for c in others])
    else:
        touched = touched.select(*child_pk).distinct()
    return child.join(entity, column, "left_anti").select(*cols).unionByName(touched.select(*cols))
