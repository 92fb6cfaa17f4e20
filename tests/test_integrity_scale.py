"""The constraint report stays one scan a table, one hash join for all references, and the same counts."""

import re

from pyspark.sql import functions as F

from cadenza.catalog import Catalog
from cadenza.operators import integrity
from cadenza.plans import stored_queries
from cadenza.schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLES, schema


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_damaged_table_is_derived_once(small_catalog):
    for table in ("track_album", "track_artist"):
        plan = _plan(stored_queries._damaged_table(small_catalog, table))
        assert len(re.findall(r"FileScan parquet|Scan parquet", plan)) == 1


def _four_branches(cat, table):
    k = PRIMARY_KEYS[table][0]
    rows = cat[table]
    twice = rows.filter(F.col(k) % 3 == 0)
    keyless = rows.filter(F.col(k) % 7 == 1).withColumn(k, F.lit(None).cast("bigint"))
    astray = rows.filter(F.col(k) % 5 == 2).withColumns({c: -1_000_000_000 - F.col(c) for c in stored_queries._references(table)})
    out = rows.unionAll(twice).unionAll(keyless).unionAll(astray)
    return out.withColumns({c: F.concat(F.lit("id "), (F.col(k) - F.col(k) % n).cast("string")) for c, n in stored_queries._shared_ids(table).items()})


def test_damaged_rows_are_the_four_branches(spark):
    def filled(t):
        # Keys from -20 to 39 and null; other columns null where they are no numbers.
        columns = [
            (F.col("id") + i if i % 2 == 0 else F.col("id") * 2 - i).cast(f.dataType) if f.dataType.simpleString() == "bigint" else F.lit(None).cast(f.dataType)
            for i, f in enumerate(schema(t).fields)
        ]
        ids = spark.range(-20, 40).select(F.when(F.col("id") != 5, F.col("id")).alias("id"))
        return ids.select(*[c.alias(f.name) for c, f in zip(columns, schema(t).fields, strict=True)])

    cat = Catalog({t: filled(t) for t in TABLES})
    for t in ("users", "track", "genre", "review", "written_by", "artist_member"):
        got, want = stored_queries._damaged_table(cat, t), _four_branches(cat, t)
        assert got.dtypes == want.dtypes
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_references_are_streamed_past_their_parents(make_catalog):
    plan = _plan(integrity.integrity_report(make_catalog()))
    assert re.search(r"ShuffledHashJoin \[_target#\d+, _key#\d+L\]", plan) and "SortMergeJoin" not in plan
    assert "hashpartitioning(_constraint#" in plan and "hashpartitioning(table_name#" not in plan


def test_unique_values_leave_the_scan_of_the_keys(make_catalog):
    cat = make_catalog(
        track=[(k, "t", 1, None, None, None, False) for k in (1, 1, 2, 3, 4, None, None)],
        track_isrc=[(1, "A", True), (1, "A", True), (1, None, False), (None, "B", True), (9, "C", True)],
    )
    isrc = F.when(F.col("track_id") > 1, F.when(F.col("track_id") < 4, "X"))
    cat = cat.replace(track=cat["track"].withColumn("isrc", isrc))
    report = integrity.integrity_report(cat)
    counts = {r[0]: r[3] for r in report.collect()}
    # Repeated NULLs of a UNIQUE column are no violation, NULL keys count once a group.
    assert counts["track.pk"] == 2 and counts["track.isrc.unique"] == 1
    assert counts["track_isrc.pk"] == 3  # A twice, and two keys with a NULL part
    fk = next(f for f in FOREIGN_KEYS if f.child == "track_isrc")
    assert counts[fk.name] == 1
    assert "track.mb_recording_gid.unique" not in counts
    assert not any(r["violations"] for r in integrity.integrity_report(cat, include_unique=False).collect() if r["kind"] == "unique")
