"""Declared constraints as data-quality jobs, and cascading deletes.

Parquet enforces no keys. These jobs check what the DDL declares: primary
keys (no NULL part, no duplicate), single-column UNIQUE (NULLs may repeat)
and foreign keys (every non-NULL child value has a parent), and apply
``ON DELETE CASCADE`` / ``SET NULL`` to produce a new catalog.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions.ordering import asc
from ..plans.keys import KeySet, restrict
from ..plans.union import union_all
from ..schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLES, UNIQUES, ForeignKey, schema
from ..session import written_table
from ..sources.files import Changes
from .dedupe import DedupeResult, dedupe_entities


def pk_violations(cat: Catalog, table: str) -> DataFrame:
    """Key values that break the primary key: ``pk..., row_count, problem``.

    ``problem`` is 'null key' (some key part is NULL) or 'duplicate key'
    (the key occurs ``row_count`` > 1 times). The count is a partial
    aggregate, so a heavily repeated key is combined map-side.
    """
    pk = list(PRIMARY_KEYS[table])
    counts = cat[table].groupBy(*pk).agg(F.count(F.lit(1)).alias("row_count"))
    null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in pk])
    return counts.filter(null_key | (F.col("row_count") > 1)).select(
        *pk,
        "row_count",
        F.when(null_key, F.lit("null key")).otherwise(F.lit("duplicate key")).alias("problem"),
    )


def unique_violations(cat: Catalog, table: str, column: str) -> DataFrame:
    """Non-NULL values of ``column`` held by more than one row.

    A column that the table does not carry is an error, not an absence of violations.
    """
    df = cat[table]
    if column not in df.columns:
        raise KeyError(f"{table} carries no column {column!r}: UNIQUE cannot be checked")
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def fk_violations(cat: Catalog, fk: ForeignKey) -> DataFrame:
    """Child rows whose non-NULL reference has no parent row (orphans)."""
    parent_keys = cat[fk.parent].select(F.col(fk.parent_column).alias(fk.column))
    return cat[fk.child].filter(F.col(fk.column).isNotNull()).join(parent_keys, fk.column, "left_anti")


def _key_slots(cat: Catalog, table: str, numbers: dict[str, int], uniques: list[str]) -> DataFrame:
    """(_constraint, k1, k2, k3): one table's primary keys and its values of ``uniques``, from one scan.

    ``numbers`` gives each constraint's number. Keys are at most two columns;
    bigint parts go to the long slots, text parts (and UNIQUE values) to the
    text slot, so every table fits one union-compatible shape.
    """
    longs, texts = _pk_parts(table)
    parts = [F.col(c).cast("bigint") for c in longs] + [F.lit(None).cast("bigint")] * (2 - len(longs))
    text = F.col(texts[0]) if texts else F.lit(None).cast("string")
    number = F.lit(numbers[f"{table}.pk"])
    if not uniques:
        return cat[table].select(number.alias("_constraint"), parts[0].alias("k1"), parts[1].alias("k2"), text.alias("k3"))
    none = F.lit(None).cast("bigint")

    def slot(constraint: Column, k1: Column, k2: Column, k3: Column) -> Column:
        return F.struct(constraint.alias("_constraint"), k1.alias("k1"), k2.alias("k2"), k3.cast("string").alias("k3"))

    slots = [slot(number, *parts, text)] + [slot(F.lit(numbers[f"{table}.{c}.unique"]), none, none, F.col(c)) for c in uniques]
    exploded = cat[table].select(F.explode(F.array(*slots)).alias("_slot")).select("_slot.*")
    return exploded.filter((F.col("_constraint") == number) | F.col("k3").isNotNull())  # NULLs may repeat


def _pk_parts(table: str) -> tuple[list[str], list[str]]:
    """The bigint and the text columns of a primary key, by their declared types (no round trip to the JVM for the plan's schema)."""
    declared = schema(table)
    texts = [c for c in PRIMARY_KEYS[table] if declared[c].dataType.simpleString() == "string"]
    return [c for c in PRIMARY_KEYS[table] if c not in texts], texts


def integrity_report(cat: Catalog, include_unique: bool = True, include_absent: bool = False) -> DataFrame:
    """One row per declared constraint: constraint_name, kind, table_name, violations.

    Two set-wise passes over the whole catalog instead of one job per
    constraint:

    * primary keys and UNIQUE columns: every table's key tuple and non-NULL
      UNIQUE values in one union (each table scanned once for both), one
      grouped count (partial counts map-side, one shuffle); a group is a
      violation when its primary key has a NULL part or it occurs more than once;
    * foreign keys: all non-NULL references, tagged with their constraint,
      in one union (each child table scanned once for all of its foreign
      keys), anti-joined in one hash join against the union of all parent keys
      on (parent column, key): references are streamed, never sorted, and a task
      holds the parent keys of its partition.

    Constraints on tables or columns that the catalog does not carry are left
    out, or with ``include_absent`` listed: a column ``status`` then says
    'checked' or 'absent', and violations are NULL where nothing was checked.
    """
    spark = cat.spark
    names = [t for t in TABLES if t in cat]
    uniques: dict[str, list[str]] = {t: [] for t in names}
    if include_unique:
        for table, column in UNIQUES:
            if table in cat and column in cat[table].columns:
                uniques[table].append(column)
    fks = [fk for fk in FOREIGN_KEYS if fk.child in cat and fk.parent in cat]

    every = [(f"{t}.pk", "primary key", t, t in cat) for t in TABLES]
    every += [(f"{t}.{c}.unique", "unique", t, c in uniques.get(t, ())) for t, c in UNIQUES] if include_unique else []
    every += [(fk.name, "foreign key", fk.child, fk in fks) for fk in FOREIGN_KEYS]
    numbers = {m[0]: i for i, m in enumerate(every)}

    keys = union_all([_key_slots(cat, t, numbers, uniques[t]) for t in names])
    groups = keys.groupBy("_constraint", "k1", "k2", "k3").agg(F.count(F.lit(1)).alias("_n"))
    # Which slots a constraint's primary key fills: there a NULL is a violation.
    slots: dict[str, list[int]] = {"k1": [], "k2": [], "k3": []}
    for t in names:
        longs, texts = _pk_parts(t)
        for slot in ["k1", "k2"][: len(longs)] + ["k3"][: len(texts)]:
            slots[slot].append(numbers[f"{t}.pk"])
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() & F.col("_constraint").isin(filled) for k, filled in slots.items()])
    name = F.element_at(F.array(*[F.lit(m[0]) for m in every]), F.col("_constraint") + 1)
    parts = [groups.filter(null_key | (F.col("_n") > 1)).select(name.alias("constraint_name"))]

    if fks:
        # One scan per child table: all of its references leave the scan
        # together as an array of (constraint, target, key) and are exploded,
        # so a child with two foreign keys opens its files once, not twice.
        targets = sorted({(fk.parent, fk.parent_column) for fk in fks})
        by_child: dict[str, list[ForeignKey]] = {}
        for fk in fks:
            by_child.setdefault(fk.child, []).append(fk)
        branches = []
        for child, child_fks in by_child.items():
            tagged = F.array(
                *[
                    F.struct(
                        F.lit(fk.name).alias("constraint_name"),
                        F.lit(f"{fk.parent}.{fk.parent_column}").alias("_target"),
                        F.col(fk.column).cast("bigint").alias("_key"),
                    )
                    for fk in child_fks
                ]
            )
            branches.append(cat[child].select(F.explode(tagged).alias("_ref")).select("_ref.*"))
        refs = union_all(branches).filter(F.col("_key").isNotNull())
        parent_keys = union_all(
            [cat[p].select(F.lit(f"{p}.{c}").alias("_target"), F.col(c).cast("bigint").alias("_key")) for p, c in targets]
        )
        # An anti join would be pushed below the union (one join per child);
        # an outer join stays one join. The parent keys stay undistinct: only
        # unmatched references are kept, so a repeated parent key changes
        # nothing, and adaptive execution splits a hot reference only while
        # both sides are plain shuffles.
        hits = parent_keys.withColumn("_hit", F.lit(True)).hint("shuffle_hash")
        orphans = refs.join(hits, ["_target", "_key"], "left").filter(F.col("_hit").isNull())
        parts.append(orphans.select("constraint_name"))

    found = union_all(parts).groupBy("constraint_name").agg(F.count(F.lit(1)).alias("_violations"))
    # One row per declared constraint (metadata, not data: 65 rows here).
    rows = [(*m[:3], "checked" if m[3] else "absent") for m in every if m[3] or include_absent]
    declared = spark.createDataFrame(rows, "constraint_name string, kind string, table_name string, status string")
    violations = F.when(F.col("status") == "checked", F.coalesce("_violations", F.lit(0)).cast("bigint"))
    return (
        declared.join(F.broadcast(found), "constraint_name", "left")
        .select("constraint_name", "kind", "table_name", violations.alias("violations"), *(["status"] if include_absent else []))
        .orderBy(asc("constraint_name"))
    )


# ---------------------------------------------------------------- cascading delete


@dataclass(frozen=True)
class DeleteResult:
    catalog: Catalog  # the catalog after the delete
    deleted: dict[str, DataFrame]  # table -> primary keys of deleted rows
    nulled: dict[str, DataFrame]  # table -> primary keys of rows whose reference was set to NULL
    flagged: dict[str, DataFrame]  # reached table -> its rows after the delete and the deleted ones, with _gone and _nulled

    def changes(self) -> Changes:
        """The delete as a batch for a stored catalog: keys to remove, and rows with cleared references to write anew."""
        removes, appends = {}, {}
        for t, rows in self.flagged.items():
            touched = rows.filter(F.col("_gone") | F.col("_nulled"))
            removes[t] = touched.select(*PRIMARY_KEYS[t])
            if t in self.nulled:
                appends[t] = touched.filter(~F.col("_gone")).drop("_gone", "_nulled")
        return Changes(appends, removes)


def _topological(tables: list[str]) -> list[str]:
    """Parents before children along the references (references to the own table ignored)."""
    edges = {t: {fk.parent for fk in FOREIGN_KEYS if fk.child == t and fk.parent != t} for t in tables}
    order, done = [], set()

    def visit(t: str, path: tuple[str, ...] = ()) -> None:
        if t in done:
            return
        if t in path:
            raise ValueError(f"reference cycle through {t}")
        for p in sorted(edges.get(t, ())):
            if p in edges:
                visit(p, path + (t,))
        done.add(t)
        order.append(t)

    for t in tables:
        visit(t)
    return order


def _flag(df: DataFrame, column: str, keys: DataFrame, flag: str) -> DataFrame:
    """Add boolean ``flag``: is ``column`` one of ``keys(key)`` (different values)? One outer join, hot values on the left."""
    marks = keys.select(F.col("key").alias(column), F.lit(True).alias(flag))
    return df.join(marks, column, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def _any(flags: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f) for f in flags], F.lit(False))


def cascade_delete(cat: Catalog, table: str, ids: KeySet) -> DeleteResult:
    """Delete the rows of ``table`` whose (single-column) key is in ``ids``.

    Tables are visited parents first. A row is deleted when its own key was
    asked for or any cascading reference points at a deleted parent key; a
    table reached along several paths (written_by from consumer and from
    review) takes them all into account before its own children are visited.
    References declared ``SET NULL`` are cleared instead.

    The deleted keys of each parent table are written once (key and reference
    columns are all that is read for them), so no child derives them again.
    A reached table then is one scan with one flagged outer join per
    reference; rows that stay, rows that go and counts all come from it.
    """
    pk = PRIMARY_KEYS[table]
    if len(pk) != 1:
        raise ValueError("cascade_delete starts from a table with a single-column key")
    names = [t for t in TABLES if t in cat]
    parents = {fk.parent for fk in FOREIGN_KEYS}
    doomed: dict[str, DataFrame] = {}  # parent table -> written, different values of its deleted keys
    flagged: dict[str, DataFrame] = {}
    nulled: dict[str, DataFrame] = {}
    asked = restrict(cat[table].select(pk[0]), pk[0], ids).select(F.col(pk[0]).alias("key"))
    asked = written_table(asked.filter(F.col("key").isNotNull()).distinct(), f"asked-{table}")

    for t in _topological(names):
        cascades = [(fk.column, fk.parent) for fk in FOREIGN_KEYS if fk.child == t and fk.parent in doomed and fk.on_delete == "cascade"]
        sources = [(column, doomed[parent]) for column, parent in cascades] + ([(pk[0], asked)] if t == table else [])
        flags = [f"_gone{k}" for k in range(len(sources))]

        def marked(df: DataFrame, sources=sources, flags=flags) -> DataFrame:
            for (column, keys), flag in zip(sources, flags, strict=True):
                df = _flag(df, column, keys, flag)
            return df.withColumn("_gone", _any(flags)).drop(*flags)

        t_pk = PRIMARY_KEYS[t]
        if sources and t in parents and len(t_pk) == 1:
            narrow = cat[t].select(*dict.fromkeys([t_pk[0], *(column for column, _ in sources)]))
            keys = marked(narrow).filter(F.col("_gone") & F.col(t_pk[0]).isNotNull()).select(F.col(t_pk[0]).alias("key"))
            doomed[t] = written_table(keys.distinct(), f"deleted-{t}")
        clears = [fk for fk in FOREIGN_KEYS if fk.child == t and fk.parent in doomed and fk.on_delete == "set_null"]
        if not sources and not clears:
            continue
        df = marked(cat[t])
        cleared = [f"_null{k}" for k in range(len(clears))]
        for fk, flag in zip(clears, cleared, strict=True):
            df = _flag(df, fk.column, doomed[fk.parent], flag)
        types = {f.name: f.dataType for f in cat[t].schema.fields}
        emptied = {fk.column: flag for fk, flag in zip(clears, cleared, strict=True)}
        flagged[t] = df.select(
            *[
                F.when(F.col(emptied[c]), F.lit(None).cast(types[c])).otherwise(F.col(c)).alias(c) if c in emptied else F.col(c)
                for c in cat[t].columns
            ],
            "_gone",
            (_any(cleared) & ~F.col("_gone")).alias("_nulled"),
        )
        if clears:
            nulled[t] = flagged[t].filter("_nulled").select(*t_pk)
    after = {t: df.filter(~F.col("_gone")).drop("_gone", "_nulled") for t, df in flagged.items()}
    deleted = {
        t: df.filter("_gone").select(*PRIMARY_KEYS[t]).distinct()
        for t, df in flagged.items()
        if t == table or any(fk.child == t and fk.parent in doomed and fk.on_delete == "cascade" for fk in FOREIGN_KEYS)
    }
    return DeleteResult(cat.replace(**after), deleted, nulled, flagged)


def delete_summary(before: Catalog, result: DeleteResult) -> DataFrame:
    """table_name, rows_before, rows_after, rows_deleted, rows_set_null per table.

    Every table is scanned once (a reached one with its flags) in one union
    with one grouped count, so the whole summary costs one shuffle of partial
    counts.
    """
    names = [t for t in TABLES if t in before]
    parts = []
    for t in names:
        if t in result.flagged:
            parts.append(result.flagged[t].select(F.lit(t).alias("table_name"), "_gone", "_nulled"))
        else:
            parts.append(before[t].select(F.lit(t).alias("table_name"), F.lit(False).alias("_gone"), F.lit(False).alias("_nulled")))
    grouped = union_all(parts).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("_before"), F.count_if("_gone").alias("_gone"), F.count_if("_nulled").alias("_nulled")
    )
    # Empty tables have no group: start from the table list (metadata).
    listed = before.spark.createDataFrame([(t,) for t in names], "table_name string")
    wide = listed.join(F.broadcast(grouped), "table_name", "left")
    rows_before, gone = F.coalesce("_before", F.lit(0)), F.coalesce("_gone", F.lit(0))
    return wide.select(
        "table_name",
        rows_before.cast("bigint").alias("rows_before"),
        (rows_before - gone).cast("bigint").alias("rows_after"),
        gone.cast("bigint").alias("rows_deleted"),
        F.coalesce("_nulled", F.lit(0)).cast("bigint").alias("rows_set_null"),
    ).orderBy(asc("table_name"))


# ---------------------------------------------------------------- dedupe by external id


def dedupe_by_external_id(cat: Catalog, table: str, gid_column: str) -> DedupeResult:
    """Merge rows of ``table`` that share one external id; ``dedupe.dedupe_entities`` takes several ids."""
    return dedupe_entities(cat, table, [gid_column])
