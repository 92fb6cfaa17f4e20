"""Registered queries on catalogs that were written, loaded again and changed, and on one that breaks every constraint."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions.music import PITCH_CLASS_NAMES, key_name
from ..operators import discovery, integrity
from ..schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLES, UNIQUES
from ..session import scratch_folder
from ..sources import feeds
from ..sources.files import Changes, commit_changes, load_catalog, save_catalog
from .catalog_queries import fk_sql, pk_sql
from .registry import register

# ---------------------------------------------------------------- every constraint broken
# By the first key column k of a table: every third row comes twice, rows with k % 7 = 1
# once more without k, rows with k % 5 = 2 once more with references to nobody.
# UNIQUE columns hold one value for k and its successor (the n-th of a table for n more).


def _references(table: str) -> list[str]:
    return [fk.column for fk in FOREIGN_KEYS if fk.child == table]


def _shared_ids(table: str) -> dict[str, int]:
    """UNIQUE column -> how many neighbouring keys share a value."""
    return {column: 2 + i for i, column in enumerate(c for t, c in UNIQUES if t == table)}


def _damaged_table(cat: Catalog, table: str):
    """Every row leaves one scan of the table together with its copies.

    As a union of four filtered copies each filter would move into the derived
    table, which would then be made anew for every branch.
    """
    k, refs = PRIMARY_KEYS[table][0], _references(table)
    types = {f.name: f.dataType for f in cat[table].schema.fields}
    copies = F.array(F.lit("whole"), F.when(F.col(k) % 3 == 0, "twice"), F.when(F.col(k) % 7 == 1, "keyless"), F.when(F.col(k) % 5 == 2, "astray"))
    out = cat[table].select("*", F.explode(copies).alias("_copy")).filter(F.col("_copy").isNotNull())
    keyless, astray = F.col("_copy") == "keyless", F.col("_copy") == "astray"
    changed = {c: F.when(astray, -1_000_000_000 - F.col(c)).otherwise(F.col(c)) for c in refs}
    changed[k] = F.when(keyless, F.lit(None).cast(types[k])).otherwise(changed.get(k, F.col(k)))
    out = out.withColumns(changed).drop("_copy")
    return out.withColumns({c: F.concat(F.lit("id "), (F.col(k) - F.col(k) % n).cast("string")) for c, n in _shared_ids(table).items()})


def _damaged(cat: Catalog) -> Catalog:
    return cat.replace(**{t: _damaged_table(cat, t) for t in TABLES})


def _damaged_sql(table: str) -> str:
    k, refs = PRIMARY_KEYS[table][0], _references(table)
    columns = [*PRIMARY_KEYS[table], *(c for c in refs if c not in PRIMARY_KEYS[table])]

    def rows(where: str, **instead: str) -> str:
        return f"SELECT {', '.join(f'{instead.get(c, c)} AS {c}' for c in columns)} FROM {table} WHERE {where}"

    shared = "".join(f", 'id ' || CAST({k} - {k} % {n} AS VARCHAR) AS {c}" for c, n in _shared_ids(table).items())
    branches = [rows("TRUE"), rows(f"{k} % 3 = 0"), rows(f"{k} % 7 = 1", **{k: "NULL"}), rows(f"{k} % 5 = 2", **{c: f"-1000000000 - {c}" for c in refs})]
    return f"bad_{table} AS (SELECT *{shared} FROM ({' UNION ALL '.join(branches)}))"


def _unique_sql(table: str, column: str) -> str:
    return (
        f"SELECT '{table}.{column}.unique', 'unique', '{table}', CAST(COUNT(*) AS BIGINT) FROM "
        f"(SELECT {column} FROM bad_{table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING COUNT(*) > 1)"
    )


register(
    "integrity_report_broken",
    "WITH "
    + ",\n".join(_damaged_sql(t) for t in TABLES)
    + "\n"
    + "\nUNION ALL\n".join([pk_sql(t, "bad_") for t in TABLES] + [fk_sql(fk, "bad_") for fk in FOREIGN_KEYS] + [_unique_sql(t, c) for t, c in UNIQUES]),
)(lambda cat: integrity.integrity_report(_damaged(cat)))

# ---------------------------------------------------------------- written and loaded again


def _stored(cat: Catalog, *tables: str, fmt: str = "parquet") -> str:
    root = scratch_folder(cat.spark, f"catalog-{fmt}")
    save_catalog(Catalog({t: cat[t] for t in tables}), root, fmt)
    return root


def _reloaded(cat: Catalog, *tables: str, fmt: str = "parquet") -> Catalog:
    return load_catalog(cat.spark, _stored(cat, *tables, fmt=fmt), fmt, strict=fmt != "csv", tables=tables)


register("stored_track", "SELECT * FROM track")(lambda cat: _reloaded(cat, "track").track)
register("stored_review_csv", "SELECT * FROM review")(lambda cat: _reloaded(cat, "review", fmt="csv").review)

# ---------------------------------------------------------------- a batch of removals and appends on a stored catalog
# Returned lines leave their playlists; those of every fourth order come back in the same batch.


def _after_returns(cat: Catalog) -> Catalog:
    root = _stored(cat, "playlist_track")
    before = load_catalog(cat.spark, root, tables=("playlist_track",))
    returned = cat.source("lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("playlist_id"), F.col("l_partkey").alias("track_id")).distinct()
    back = returned.filter("playlist_id % 4 = 0").withColumn("added_at", F.lit(feeds.BATCH_TS).cast("timestamp_ntz"))
    commit_changes(cat.spark, root, Changes({"playlist_track": back}, {"playlist_track": returned}), "returns", 0, before.as_of)
    return load_catalog(cat.spark, root, tables=("playlist_track",))


register(
    "stored_playlist_changes",
    f"""
WITH returned AS (SELECT DISTINCT l_orderkey AS playlist_id, l_partkey AS track_id FROM lineitem WHERE l_returnflag = 'R')
SELECT playlist_id, track_id, CAST(added_at AS TIMESTAMP) AS added_at FROM playlist_track
WHERE (playlist_id, track_id) NOT IN (SELECT playlist_id, track_id FROM returned)
UNION ALL
SELECT playlist_id, track_id, TIMESTAMP '{feeds.BATCH_TS}' FROM returned WHERE playlist_id % 4 = 0
""",
)(lambda cat: _after_returns(cat).playlist_track)

# ---------------------------------------------------------------- keys stored as pitch classes
# Every second track's key as a number from -1 to 12, the rest as names.

_PITCHED = "CASE WHEN track_id % 2 = 0 THEN CAST(track_id % 14 - 1 AS {text}) ELSE key END"


def _named_keys(cat: Catalog):
    pitched = cat.replace(track=cat.track.withColumn("key", F.expr(_PITCHED.format(text="string"))))
    return discovery.tracks_by_audio(pitched).select("track_id", "title", "bpm", key_name("key").alias("key"), "mode")


register(
    "tracks_by_audio_named_keys",
    f"""
WITH pitched AS (SELECT track_id, title, bpm, {_PITCHED.format(text='VARCHAR').replace('ELSE key', 'ELSE "key"')} AS pitch, "mode" FROM track)
SELECT track_id, title, bpm, CASE {' '.join(f"WHEN pitch = '{i}' THEN '{n}'" for i, n in enumerate(PITCH_CLASS_NAMES))}
  WHEN pitch IN ('-1', '12') THEN NULL ELSE pitch END AS "key", "mode"
FROM pitched
""",
)(_named_keys)
