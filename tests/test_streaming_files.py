import datetime as dt
import tempfile

from pyspark.sql import functions as F

from cadenza.sources.files import load_catalog, save_catalog
from cadenza.streaming import feeds
from table_rows import rows


def _stored(spark, small_catalog):
    root = tempfile.mkdtemp(prefix="cadenza-test-cat-")
    save_catalog(small_catalog, root)
    return root


def test_save_and_load_roundtrip(spark, small_catalog):
    root = _stored(spark, small_catalog)
    cat = load_catalog(spark, root)
    for t in ("track", "track_album", "review"):
        assert cat[t].schema == small_catalog[t].schema
        assert cat[t].count() == small_catalog[t].count()


def test_review_stream_appends_idempotently(spark, small_catalog):
    root = _stored(spark, small_catalog)
    inbox = tempfile.mkdtemp(prefix="cadenza-test-inbox-")
    ckpt = tempfile.mkdtemp(prefix="cadenza-test-stream-")
    tracks = [r[0] for r in rows(small_catalog.track.select("track_id").orderBy("track_id").limit(3))]
    consumers = [r[0] for r in rows(small_catalog.consumer.select("user_id").orderBy("user_id").limit(2))]
    reqs = [
        (1, consumers[0], tracks[0], 5, "great"),
        (2, consumers[1], tracks[1], 9, "too high"),
        (3, consumers[1], tracks[2], 3, ""),
    ]
    spark.createDataFrame(reqs, feeds.REVIEW_REQUEST_SCHEMA).write.mode("append").parquet(inbox)
    before_max = small_catalog.review.agg(F.max("review_id")).first()[0]

    stream = feeds.request_stream(spark, inbox, feeds.REVIEW_REQUEST_SCHEMA)
    q = feeds.start_ingest_stream(spark, stream, root, feeds.review_job(), ckpt, trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None

    cat = load_catalog(spark, root)
    new = rows(cat.review.filter(F.col("review_id") > before_max).orderBy("review_id").select("review_id", "rating", "review_text"))
    assert new == [(before_max + 1, 5, "great"), (before_max + 2, 3, None)]
    assert cat.gets.filter(F.col("review_id") > before_max).count() == 2

    # Replaying batch 0 (as after a crash) rewrites the same rows, no duplicates.
    batch = spark.createDataFrame(reqs, feeds.REVIEW_REQUEST_SCHEMA)
    feeds.catalog_sink(root, feeds.review_job(), feeds.stream_id(spark, ckpt))(batch, 0)
    again = load_catalog(spark, root)
    assert rows(again.review.filter(F.col("review_id") > before_max).select("review_id").orderBy("review_id")) == [
        (before_max + 1,),
        (before_max + 2,),
    ]


def _new_reviews(spark, root, before_max):
    return [r[0] for r in rows(load_catalog(spark, root).review.filter(F.col("review_id") > before_max).select("review_id").orderBy("review_id"))]


def test_streams_crashes_and_retries_keep_every_row(spark, small_catalog, monkeypatch):
    root = _stored(spark, small_catalog)
    tracks = [r[0] for r in rows(small_catalog.track.select("track_id").orderBy("track_id").limit(3))]
    consumer = rows(small_catalog.consumer.select("user_id").orderBy("user_id").limit(1))[0][0]
    before_max = small_catalog.review.agg(F.max("review_id")).first()[0]

    def batch(*ratings):
        return spark.createDataFrame([(i, consumer, tracks[i % 3], r, "x") for i, r in enumerate(ratings)], feeds.REVIEW_REQUEST_SCHEMA)

    first = feeds.catalog_sink(root, feeds.review_job(), "one")
    first(batch(1, 2, 3), 0)
    assert _new_reviews(spark, root, before_max) == [before_max + 1, before_max + 2, before_max + 3]
    # A second stream (or a new checkpoint) begins at batch 0 again.
    feeds.catalog_sink(root, feeds.review_job(), "two")(batch(4, 5), 0)
    assert _new_reviews(spark, root, before_max) == [before_max + i for i in range(1, 6)]

    # A crash between the tables of a batch shows nothing, not even half of it.
    written = []
    real = feeds.write_appends

    def crash(df, root, table, stream, batch_id):
        real(df, root, table, stream, batch_id)
        written.append(table)
        if len(written) == 2:
            raise OSError("lost")

    monkeypatch.setattr(feeds, "write_appends", crash)
    try:
        first(batch(1, 1), 1)
    except OSError:
        pass
    monkeypatch.setattr(feeds, "write_appends", real)
    assert len(written) == 2 and len(_new_reviews(spark, root, before_max)) == 5
    # The retry finds nothing acceptable: the earlier attempt's rows must not come back.
    first(batch(99, 99), 1)
    cat = load_catalog(spark, root)
    assert len(_new_reviews(spark, root, before_max)) == 5
    assert cat.gets.filter(F.col("review_id") > before_max).count() == 5
    first(batch(2), 2)
    assert _new_reviews(spark, root, before_max) == [before_max + i for i in range(1, 7)]


def test_csv_keeps_quotes_backslashes_empty_values_and_microseconds(spark, make_catalog):
    at = dt.datetime(2024, 1, 1, 0, 9, 58, 778549)
    texts = ['say "hi"', 'a,b', 'back\\', '\\"', "", None, '"', " padded ", "Zoë"]
    cat = make_catalog(
        users=[(i, t, None, None, None) for i, t in enumerate(texts)],
        review=[(i, 3, t, at, 1, 2) for i, t in enumerate(texts)],
    )
    folder = tempfile.mkdtemp(prefix="cadenza-test-csv-")
    save_catalog(cat, folder, fmt="csv")
    back = load_catalog(spark, folder, fmt="csv", strict=False)
    for t in ("users", "review", "track"):
        assert sorted(rows(back[t]), key=str) == sorted(rows(cat[t]), key=str)


def test_csv_catalog_by_header_names_and_with_appends(spark, small_catalog):
    import pytest

    root = _stored(spark, small_catalog)
    folder = tempfile.mkdtemp(prefix="cadenza-test-csv-")
    label = small_catalog.label
    label.select(*reversed(label.columns)).write.option("header", "true").csv(f"{folder}/label")
    from cadenza.sources.files import commit_batch, read_table, write_appends

    assert sorted(rows(read_table(spark, f"{folder}/label", "label", "csv"))) == sorted(rows(label))
    label.withColumn("label_id", F.lit("seven")).write.option("header", "true").csv(f"{folder}/bad")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_table(spark, f"{folder}/bad", "label", "csv").collect()
    write_appends(label.limit(2), folder, "label", "s", 0)
    assert load_catalog(spark, folder, fmt="csv", tables=("label",)).label.count() == label.count()
    commit_batch(spark, folder, "s", 0)
    assert load_catalog(spark, folder, fmt="csv", tables=("label",)).label.count() == label.count() + 2
    assert root


def test_size_shuffles_scales_with_input(spark):
    from cadenza.session import size_shuffles

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 100 * 1024**4) == 409600  # 100 TiB / 256 MiB
        assert size_shuffles(spark, 10) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
