"""Removals, updates and playlist logs on a stored catalog."""

import datetime as dt
import random
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F
from table_rows import rows

from cadenza.operators import ingest, integrity
from cadenza.sources import files
from cadenza.sources.files import Changes, commit_changes, load_catalog, save_catalog
from cadenza.streaming import feeds, playlist_log

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def stored(make_catalog):
    cat = make_catalog(
        users=[(i, f"u{i}", None, None, None) for i in (1, 2, 3)],
        consumer=[(1, "One"), (2, "Two")],
        artist=[(1, "Art", None, None, None)],
        track=[(t, f"T{t}", 1, None, None, None, False) for t in (10, 11, 12)],
        review=[(5, 4, "x", T0, 1, 10), (6, 4, "y", T0, 2, 10)],
        written_by=[(1, 5), (2, 6)],
        gets=[(5, 10), (6, 10)],
        playlist=[(20, "P", None, True, 1), (21, "Q", None, False, 2)],
        makes=[(1, 20), (2, 21)],
        playlist_track=[(20, 10, T0), (21, 10, T0), (21, 12, T0)],
        producer=[(30, "Prod", None, None, 1), (31, "Other", None, None, None)],
        may_be=[(1, 30)],
    )
    root = tempfile.mkdtemp(prefix="cadenza-test-base-")
    save_catalog(cat, root)
    return root


@pytest.fixture
def root(stored):
    return shutil.copytree(stored, f"{tempfile.mkdtemp(prefix='cadenza-test-cat-')}/catalog")


def _pairs(spark, root):
    return sorted(rows(load_catalog(spark, root, tables=("playlist_track",)).playlist_track.select("playlist_id", "track_id")))


def _requests(spark, *pairs):
    return spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], feeds.PLAYLIST_REMOVE_SCHEMA)


def test_removals_last_and_later_rows_stay(spark, root):
    remove = feeds.catalog_sink(root, feeds.playlist_remove_job(), "r")
    add = feeds.catalog_sink(root, feeds.playlist_add_job(), "77")  # a stream id that looks like a number
    remove(_requests(spark, (20, 10), (21, 11), (20, 10)), 0)
    assert _pairs(spark, root) == [(21, 10), (21, 12)]
    add(_requests(spark, (20, 10), (20, 11)), 0)
    assert _pairs(spark, root) == [(20, 10), (20, 11), (21, 10), (21, 12)]
    remove(_requests(spark, (20, 11), (21, 12)), 1)
    assert _pairs(spark, root) == [(20, 10), (21, 10)]
    # A batch that is replayed changes nothing, neither does the first one again.
    remove(_requests(spark, (20, 10)), 1)
    remove(_requests(spark, (20, 10)), 0)
    assert _pairs(spark, root) == [(20, 10), (21, 10)]
    add(_requests(spark, (21, 12)), 1)
    assert _pairs(spark, root) == [(20, 10), (21, 10), (21, 12)]
    rejects = spark.read.parquet(files.append_path(root, "_rejects_playlist_remove")).filter("batch_id = 0")
    assert sorted(rows(rejects.select("request_id", "reason"))) == [(1, "not on playlist"), (2, "not on playlist")]
    # Saved anew, the batches are base rows.
    compact = tempfile.mkdtemp(prefix="cadenza-test-compact-")
    cat = load_catalog(spark, root, tables=("playlist_track",))
    save_catalog(cat, compact)
    assert _pairs(spark, compact) == _pairs(spark, root) and cat.as_of == 4


def test_a_removal_hides_only_what_its_job_has_read(spark, root):
    early = load_catalog(spark, root, tables=("playlist_track",))
    gone = Changes({}, {"playlist_track": early.playlist_track.filter("playlist_id = 21")})
    late = spark.createDataFrame([(21, 11, T0)], early.playlist_track.schema)
    commit_changes(spark, root, Changes({"playlist_track": late}), "other", 0, early.as_of)
    commit_changes(spark, root, gone, "early", 0, early.as_of)
    assert _pairs(spark, root) == [(20, 10), (21, 11)]
    # An update removes the key and appends the new row in one batch.
    now = load_catalog(spark, root, tables=("playlist_track",))
    moved = now.playlist_track.filter("playlist_id = 20").withColumn("added_at", F.lit("2025-05-05").cast("timestamp_ntz"))
    commit_changes(spark, root, Changes({"playlist_track": moved}, {"playlist_track": moved}), "u", 0, now.as_of)
    assert (20, 10, dt.datetime(2025, 5, 5)) in rows(load_catalog(spark, root, tables=("playlist_track",)).playlist_track)
    assert _pairs(spark, root) == [(20, 10), (21, 11)]


def test_cascade_on_a_stored_catalog_with_a_crash_between_tables(spark, root, monkeypatch):
    delete = feeds.catalog_sink(root, feeds.cascade_delete_job("users"), "d")
    batch = spark.createDataFrame([(1,), (99,)], "user_id long")
    written = []
    real = feeds.write_removes

    def crash(df, root, table, *rest):
        real(df, root, table, *rest)
        written.append(table)
        if len(written) == 3:
            raise OSError("lost")

    monkeypatch.setattr(feeds, "write_removes", crash)
    with pytest.raises(OSError):
        delete(batch, 0)
    assert load_catalog(spark, root, tables=("users", "gets")).users.count() == 3  # nothing of the half-written batch shows
    monkeypatch.setattr(feeds, "write_removes", real)
    delete(batch, 0)
    delete(batch, 0)
    cat = load_catalog(spark, root)
    want = {"users": [2, 3], "consumer": [2], "artist": [], "review": [6], "playlist": [21], "producer": [30, 31], "track": [10, 11, 12]}
    assert {t: sorted(r[0] for r in rows(cat[t])) for t in want} == want
    assert sorted(rows(cat.producer.select("producer_id", "artist_id"))) == [(30, None), (31, None)]
    assert rows(cat.gets) == [(6, 10)] and rows(cat.written_by) == [(2, 6)] and rows(cat.makes) == [(2, 21)] and rows(cat.may_be) == []
    assert sorted(r[:2] for r in rows(cat.playlist_track)) == [(21, 10), (21, 12)]
    report = integrity.integrity_report(cat)
    assert report.filter("violations > 0").count() == 0


@pytest.mark.parametrize("shuffled", [False, True])
def test_playlist_log_stream_equals_the_whole_log(spark, root, shuffled):
    rnd = random.Random(11 + shuffled)
    log = [
        (rnd.choice([20, 21, 98]), rnd.choice([10, 11, 12, 97]), rnd.choice(["add", "add", "remove"]), seq, T0 + dt.timedelta(minutes=seq, microseconds=seq))
        for seq in range(60)
    ]
    log += [(20, 12, "add", 100, T0), (None, 10, "add", 5, T0), (20, 10, "add", None, T0)]
    whole = spark.createDataFrame([x for x in log if None not in x], playlist_log.CHANGE_SCHEMA)
    want = sorted(rows(ingest.apply_playlist_changes(load_catalog(spark, root), whole)))
    if shuffled:
        rnd.shuffle(log)
    inbox, ckpt = (tempfile.mkdtemp(prefix=f"cadenza-test-{x}-") for x in ("inbox", "stream"))
    for part in (log[:25], log[25:27], log[27:]):
        spark.createDataFrame(part, playlist_log.CHANGE_SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        changes = feeds.request_stream(spark, inbox, playlist_log.CHANGE_SCHEMA)
        query = playlist_log.start_playlist_log(spark, changes, root, ckpt, trigger={"availableNow": True})
        query.awaitTermination(300)
        assert query.exception() is None
    assert sorted(rows(load_catalog(spark, root, tables=("playlist_track",)).playlist_track)) == want
