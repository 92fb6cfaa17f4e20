"""What a batch changes in the declared constraints, without checking the whole catalog again.

A batch appends rows and removes primary keys. Only keys, values and
references that the batch touches can change a constraint, so the stored
tables are cut to those by semi joins first: new rows are checked against old
and new keys, removed parents against the children that stay. The result is
the difference of the full report before and after the batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions.ordering import asc
from ..plans.union import union_all
from ..schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLES, UNIQUES, ForeignKey
from ..sources.files import Changes


def applied(cat: Catalog, changes: Changes) -> Catalog:
    """The catalog after the batch: removed keys gone, then appended rows added."""
    tables = {}
    for t in {*changes.appends, *changes.removes}:
        df = cat[t]
        if t in changes.removes:
            df = df.join(_removed(changes, t), list(PRIMARY_KEYS[t]), "left_anti").select(*df.columns)
        if t in changes.appends:
            df = df.unionByName(changes.appends[t].select(*[c for c in df.columns if c in changes.appends[t].columns]), allowMissingColumns=True)
        tables[t] = df
    return cat.replace(**tables)


def _removed(changes: Changes, table: str) -> DataFrame:
    return changes.removes[table].select(*PRIMARY_KEYS[table]).distinct()


def _sides(cat: Catalog, changes: Changes, table: str, columns: list[str]) -> list[DataFrame]:
    """``columns`` of the rows the batch removes (_old = 1, _new = 0) and appends (0, 1); stored rows that stay are not among them."""
    out = []
    if table in changes.removes:
        gone = cat[table].join(_removed(changes, table), list(PRIMARY_KEYS[table]), "left_semi")
        out.append(gone.select(*columns, F.lit(1).alias("_old"), F.lit(0).alias("_new")))
    if table in changes.appends:
        out.append(changes.appends[table].select(*columns, F.lit(0).alias("_old"), F.lit(1).alias("_new")))
    return out


def _staying(cat: Catalog, changes: Changes, table: str) -> DataFrame:
    if table not in changes.removes:
        return cat[table]
    return cat[table].join(_removed(changes, table), list(PRIMARY_KEYS[table]), "left_anti")


def _null_safe(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``left`` whose ``columns`` are among those of ``right``, NULLs equal."""
    named = right.select(*[F.col(c).alias(f"_{c}") for c in columns])
    return left.join(named, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]), "left_semi")


def _key_change(cat: Catalog, changes: Changes, table: str, columns: list[str], nulls_break: bool) -> DataFrame | None:
    """One row (change): violating values after the batch less those before it."""
    sides = _sides(cat, changes, table, columns)
    if not sides:
        return None
    touched = union_all(sides)
    if not nulls_break:
        touched = touched.filter(F.col(columns[0]).isNotNull())
    stay = _null_safe(_staying(cat, changes, table).select(*columns), touched.select(*columns).distinct(), columns)
    stay = stay.select(*columns, F.lit(1).alias("_old"), F.lit(1).alias("_new"))
    per_key = stay.unionByName(touched).groupBy(*columns).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])

    def broken(n: str) -> Column:
        many = F.col(n) > 1
        return (many | (null_key & (F.col(n) > 0)) if nulls_break else many).cast("int")

    return per_key.agg(F.coalesce(F.sum(broken("_new") - broken("_old")), F.lit(0)).cast("bigint").alias("change"))


def _reference_change(cat: Catalog, changes: Changes, fk: ForeignKey) -> DataFrame | None:
    """One row (change): orphans of ``fk`` after the batch less those before it."""
    children = _sides(cat, changes, fk.child, [fk.column])
    parents = _sides(cat, changes, fk.parent, [fk.parent_column])
    if not children and not parents:
        return None
    by_child = [c.select(F.col(fk.column).alias("key"), "_old", "_new") for c in children]
    staying = _staying(cat, changes, fk.child).select(F.col(fk.column).alias("key"))
    if parents:
        moved = union_all(parents).select(F.col(fk.parent_column).alias("key")).distinct()
        still = staying.join(moved, "key", "left_semi").select("key", F.lit(1).alias("_old"), F.lit(1).alias("_new"))
        by_child.append(still)
    # Children per key first: a key that very many children name is combined map-side.
    counted = union_all(by_child).filter(F.col("key").isNotNull()).groupBy("key").agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    keys = cat[fk.parent].select(F.col(fk.parent_column).alias("key")).join(counted.select("key"), "key", "left_semi")
    stays = _staying(cat, changes, fk.parent).select(F.col(fk.parent_column).alias("key")).join(counted.select("key"), "key", "left_semi")
    found = keys.select("key", F.lit(1).alias("_before"), F.lit(0).alias("_after"))
    found = found.unionByName(stays.select("key", F.lit(0).alias("_before"), F.lit(1).alias("_after")))
    if fk.parent in changes.appends:
        fresh = changes.appends[fk.parent].select(F.col(fk.parent_column).alias("key"), F.lit(0).alias("_before"), F.lit(1).alias("_after"))
        found = found.unionByName(fresh)
    known = found.groupBy("key").agg(F.max("_before").alias("_before"), F.max("_after").alias("_after"))
    joined = counted.join(known, "key", "left")
    before = F.when(F.coalesce("_before", F.lit(0)) == 0, F.col("_old")).otherwise(0)
    after = F.when(F.coalesce("_after", F.lit(0)) == 0, F.col("_new")).otherwise(0)
    return joined.agg(F.coalesce(F.sum(after - before), F.lit(0)).cast("bigint").alias("change"))


def batch_violations(cat: Catalog, changes: Changes) -> DataFrame:
    """constraint_name, kind, table_name, change: what the batch adds to (or, negative, takes from) each constraint's violations.

    One row per declared constraint with a table that the batch touches. A
    constraint whose new violations have to be zero rejects the batch when
    ``change`` is positive.
    """
    parts: list[DataFrame] = []

    def add(name: str, kind: str, table: str, change: DataFrame | None) -> None:
        if change is not None:
            parts.append(change.select(F.lit(name).alias("constraint_name"), F.lit(kind).alias("kind"), F.lit(table).alias("table_name"), "change"))

    for t in TABLES:
        if t in cat:
            add(f"{t}.pk", "primary key", t, _key_change(cat, changes, t, list(PRIMARY_KEYS[t]), True))
    for t, column in UNIQUES:
        if t in cat and column in cat[t].columns:
            add(f"{t}.{column}.unique", "unique", t, _key_change(cat, _with_column(changes, t, column), t, [column], False))
    for fk in FOREIGN_KEYS:
        if fk.child in cat and fk.parent in cat:
            add(fk.name, "foreign key", fk.child, _reference_change(cat, changes, fk))
    if not parts:
        return cat.spark.createDataFrame([], "constraint_name string, kind string, table_name string, change bigint")
    return union_all(parts).orderBy(asc("constraint_name"))


def _with_column(changes: Changes, table: str, column: str) -> Changes:
    """Appended rows without an optional column have NULL there."""
    rows = changes.appends.get(table)
    if rows is None or column in rows.columns:
        return changes
    return Changes({**changes.appends, table: rows.withColumn(column, F.lit(None).cast("string"))}, changes.removes)
