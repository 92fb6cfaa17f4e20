"""A key holding a third of all rows: joins split it, aggregates combine it."""

import contextlib

from pyspark.sql import functions as F

from cadenza.catalog import Catalog
from cadenza.operators import ingest, integrity
from cadenza.operators.common import artist_names
from cadenza.schemas import FOREIGN_KEYS, TABLES, schema

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_credits(spark):
    # Artist 1 holds a third of all credit rows.
    return spark.range(0, 30000).select(
        F.col("id").alias("track_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 97 + 2).cast("long").alias("artist_id"),
        F.lit("vocal").alias("role"),
    )


def test_hot_artist_is_split_in_name_join(spark):
    with conf(spark, SKEW_CONF):
        artists = spark.range(1, 100).select(
            F.col("id").alias("user_id"), F.concat(F.lit("A"), F.col("id").cast("string")).alias("name")
        )
        names = artist_names(_hot_credits(spark), artists)
        plan = _final_plan(names)
        assert "SortMergeJoin(skew=true)" in plan
        assert names.count() == 30000


def test_hot_parent_is_split_in_orphan_check(spark):
    with conf(spark, SKEW_CONF):
        tables = {t: spark.createDataFrame([], schema(t)) for t in TABLES}
        tables["track_artist"] = _hot_credits(spark)
        tables["artist"] = spark.range(1, 60).select(
            F.col("id").alias("user_id"), F.lit("n").alias("name"), F.lit(None).cast("string").alias("country"),
            F.lit(None).cast("int").alias("formed_year"), F.lit(None).cast("string").alias("type"),
        )
        fk = [f for f in FOREIGN_KEYS if f.child == "track_artist" and f.column == "artist_id"][0]
        orphans = integrity.fk_violations(Catalog(tables), fk)
        plan = _final_plan(orphans)
        assert "skew=true" in plan
        # artists 60..98 do not exist: every credit row pointing at them is an orphan
        expected = spark.range(0, 30000).filter((F.col("id") % 3 != 0) & (F.col("id") % 97 + 2 >= 60)).count()
        assert orphans.count() == expected


def _hot_requests(spark):
    # Track 1 is named by a third of all requests.
    return spark.range(0, 30000).select(
        F.col("id").alias("request_id"),
        (F.col("id") % 500).alias("consumer_id"),
        (F.col("id") % 500).alias("playlist_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 97 + 2).cast("long").alias("track_id"),
        (F.col("id") % 7).cast("int").alias("rating"),
        F.lit("text").alias("review_text"),
    )


def _catalog(spark, **tables):
    """Empty tables but for the given ones, whose missing columns are null."""
    full = {t: spark.createDataFrame([], schema(t)) for t in TABLES}
    for name, df in tables.items():
        full[name] = df.select(
            *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(name).fields]
        )
    return Catalog(full)


def test_hot_track_is_split_in_write_checks(spark):
    with conf(spark, SKEW_CONF):
        cat = _catalog(
            spark,
            track=spark.range(1, 60).toDF("track_id"),
            consumer=spark.range(0, 400).toDF("user_id"),
            playlist=spark.range(0, 400).toDF("playlist_id"),
            playlist_track=spark.range(0, 400).select(F.col("id").alias("playlist_id"), F.lit(5).alias("track_id")),
        )
        requests = _hot_requests(spark)
        checked = ingest.validate_review_requests(cat, requests)
        assert "skew=true" in _final_plan(checked) and checked.count() == 30000
        adds = ingest.playlist_add(cat, requests)
        assert "skew=true" in _final_plan(adds.added)
        assert adds.added.count() + adds.rejects.count() == 30000


def test_hot_reference_is_split_in_integrity_report(spark):
    # All references share one join, so enough partitions for the hot one to stand out.
    with conf(spark, SKEW_CONF | {"spark.sql.shuffle.partitions": "16"}):
        cat = _catalog(spark, track_artist=_hot_credits(spark), artist=spark.range(1, 60).toDF("user_id"))
        report = integrity.integrity_report(cat)
        assert "skew=true" in _final_plan(report)
        orphans = spark.range(0, 30000).filter((F.col("id") % 3 != 0) & (F.col("id") % 97 + 2 >= 60)).count()
        counts = {r["constraint_name"]: r["violations"] for r in report.collect()}
        names = {(f.child, f.column): f.name for f in FOREIGN_KEYS}
        assert counts[names["track_artist", "artist_id"]] == orphans
