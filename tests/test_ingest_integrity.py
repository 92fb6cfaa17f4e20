import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from table_rows import rows

from cadenza.operators import ingest, integrity
from cadenza.schemas import FOREIGN_KEYS

T0 = dt.datetime(2024, 1, 1)


def _base(make_catalog):
    return make_catalog(
        users=[(1, "u1", None, None, None), (2, "u2", None, None, None), (3, "u3", None, None, None)],
        consumer=[(1, "One"), (2, "Two")],
        artist=[(1, "Art", None, None, None)],
        track=[(10, "T10", 1, None, None, None, False), (11, "T11", 1, None, None, None, False)],
        review=[(5, 4, "x", T0, 1, 10)],
        written_by=[(1, 5)],
        gets=[(5, 10)],
        playlist=[(20, "P", None, True, 1), (21, "Q", None, False, 2)],
        makes=[(1, 20), (2, 21)],
        playlist_track=[(20, 10, T0)],
        producer=[(30, "Prod", None, None, 1)],
        may_be=[(1, 30)],
        track_artist=[(10, 1, "primary")],
        consumer_track_rating=[(1, 10, 3, T0), (2, 10, 4, T0)],
    )


def test_ingest_reviews_checks_and_ids(make_catalog, spark):
    cat = _base(make_catalog)
    req = spark.createDataFrame(
        [
            (1, 1, 10, 0, "zero"),
            (2, 1, 10, 1, ""),
            (3, 2, 11, 5, "five"),
            (4, 1, 10, 6, "six"),
            (5, 1, 99, 3, "bad track"),
            (6, 3, 10, 3, "not a consumer"),
            (7, 2, 10, None, "no rating"),
        ],
        "request_id long, consumer_id long, track_id long, rating int, review_text string",
    )
    batch = ingest.ingest_reviews(cat, req, batch_ts="2026-01-01 00:00:00")
    assert rows(batch.review.orderBy("review_id")) == [
        (6, 1, None, dt.datetime(2026, 1, 1), 1, 10),
        (7, 5, "five", dt.datetime(2026, 1, 1), 2, 11),
    ]
    assert sorted(rows(batch.written_by)) == [(1, 6), (2, 7)]
    assert sorted(rows(batch.gets)) == [(6, 10), (7, 11)]
    assert dict(rows(batch.rejects)) == {
        1: "rating out of range",
        4: "rating out of range",
        5: "unknown track",
        6: "unknown consumer",
        7: "rating out of range",
    }


def test_ingest_reviews_ids_dense_over_many_partitions(make_catalog, spark):
    cat = _base(make_catalog)
    n = 500
    req = spark.createDataFrame(
        [(i * 3, 1 + i % 2, 10, 1 + i % 5, "t") for i in range(n)],
        "request_id long, consumer_id long, track_id long, rating int, review_text string",
    ).repartition(7)
    ids = [r[0] for r in rows(ingest.ingest_reviews(cat, req).review.orderBy("review_id"))]
    assert ids == list(range(6, 6 + n))


def test_ingest_playlists_rules(make_catalog, spark):
    cat = _base(make_catalog)
    req = spark.createDataFrame(
        [
            (1, 1, "", None, "yes"),
            (2, 1, "A", "", "Y"),
            (3, 1, "B", "desc", "true"),
            (4, 1, "C", None, "no"),
            (5, 1, "D", None, None),
            (6, 9, "E", None, "yes"),
        ],
        "request_id long, user_id long, name string, description string, public string",
    )
    batch = ingest.ingest_playlists(cat, req, batch_date="2026-01-01")
    got = rows(batch.playlist.orderBy("playlist_id"))
    assert [(r[0], r[1], r[2], r[4]) for r in got] == [
        (22, "A", None, True),
        (23, "B", "desc", True),
        (24, "C", None, False),
        (25, "D", None, True),
    ]
    assert dict(rows(batch.rejects)) == {1: "name required", 6: "unknown user"}


def test_playlist_add_each_request_alone(make_catalog, spark):
    cat = _base(make_catalog)
    req = spark.createDataFrame(
        [(1, 20, 11), (2, 20, 11), (3, 20, 10), (4, 99, 10), (5, 21, 99), (6, 21, 10)],
        "request_id long, playlist_id long, track_id long",
    )
    out = ingest.playlist_add(cat, req, batch_ts="2026-01-01 00:00:00")
    assert sorted(r[:2] for r in rows(out.added)) == [(20, 11), (21, 10)]
    assert {r[0]: r[3] for r in rows(out.rejects)} == {
        2: "duplicate in batch",
        3: "already on playlist",
        4: "unknown playlist",
        5: "unknown track",
    }


def test_playlist_remove_returning_and_rejects(make_catalog, spark):
    cat = _base(make_catalog)
    pairs = spark.createDataFrame([(20, 10), (20, 11)], "playlist_id long, track_id long")
    out = ingest.playlist_remove(cat, pairs)
    assert rows(out.remaining) == []
    assert [r[:2] for r in rows(out.removed)] == [(20, 10)]
    assert [r[:2] for r in rows(out.rejects)] == [(20, 11)]


def _replay(existing, changes, playlists, tracks):
    state = dict(existing)
    for pl, tr, op, seq, ts in sorted(changes, key=lambda c: c[3]):
        key = (pl, tr)
        if op == "add":
            if pl in playlists and tr in tracks and key not in state:
                state[key] = ts
        elif key in state:
            del state[key]
    return sorted((k[0], k[1], v) for k, v in state.items())


def test_apply_playlist_changes_equals_replay(make_catalog, spark):
    rnd = random.Random(7)
    cat = _base(make_catalog)
    playlists, tracks = {20, 21}, {10, 11}
    changes = []
    for seq in range(200):
        pl = rnd.choice([20, 21, 98])
        tr = rnd.choice([10, 11, 97])
        op = rnd.choice(["add", "add", "remove"])
        changes.append((pl, tr, op, seq, T0 + dt.timedelta(minutes=seq)))
    df = spark.createDataFrame(changes, "playlist_id long, track_id long, op string, seq long, ts timestamp_ntz")
    got = sorted(rows(ingest.apply_playlist_changes(cat, df)))
    assert got == _replay({(20, 10): T0}, changes, playlists, tracks)


def test_apply_playlist_changes_keeps_first_add(make_catalog, spark):
    cat = _base(make_catalog)
    t = [T0 + dt.timedelta(days=i) for i in range(5)]
    changes = [(21, 11, "add", 1, t[1]), (21, 11, "add", 2, t[2]), (20, 10, "add", 3, t[3]), (20, 11, "remove", 4, t[4])]
    df = spark.createDataFrame(changes, "playlist_id long, track_id long, op string, seq long, ts timestamp_ntz")
    assert sorted(rows(ingest.apply_playlist_changes(cat, df))) == [(20, 10, T0), (21, 11, t[1])]


def test_integrity_finds_duplicates_nulls_orphans(make_catalog):
    cat = make_catalog(
        track=[(1, "a", 1, None, None, None, False), (1, "b", 1, None, None, None, False), (None, "c", 1, None, None, None, False)],
        track_artist=[(1, 5, "x")],
    )
    pk = {r[0]: r[2] for r in rows(integrity.pk_violations(cat, "track"))}
    assert pk == {1: "duplicate key", None: "null key"}
    fk = [f for f in FOREIGN_KEYS if f.child == "track_artist" and f.column == "artist_id"][0]
    assert rows(integrity.fk_violations(cat, fk)) == [(5, 1, "x")]
    report = {r[0]: r[3] for r in rows(integrity.integrity_report(cat))}
    assert report["track.pk"] == 2 and report[fk.name] == 1 and report["users.pk"] == 0


def test_cascade_delete_user(make_catalog):
    cat = _base(make_catalog)
    res = integrity.cascade_delete(cat, "users", [1])
    new = res.catalog
    assert [r[0] for r in rows(new.users)] == [2, 3]
    assert [r[0] for r in rows(new.consumer)] == [2]
    assert rows(new.artist) == []
    assert rows(new.review) == [] and rows(new.written_by) == [] and rows(new.gets) == []
    assert [r[0] for r in rows(new.playlist)] == [21]
    assert rows(new.makes) == [(2, 21)] and rows(new.playlist_track) == []
    assert rows(new.may_be) == [] and rows(new.track_artist) == []
    assert [r[:2] for r in rows(new.consumer_track_rating)] == [(2, 10)]
    assert rows(new.producer) == [(30, "Prod", None, None, None)]  # SET NULL, row kept
    assert len(rows(new.track)) == 2


def test_cascade_delete_genre_sets_children_null(make_catalog):
    cat = make_catalog(genre=[(1, "Root", None, None), (2, "Child", None, 1)], track_genre=[(5, 1), (5, 2)])
    res = integrity.cascade_delete(cat, "genre", 1)
    assert rows(res.catalog.genre) == [(2, "Child", None, None)]
    assert rows(res.catalog.track_genre) == [(5, 2)]
    summary = {r[0]: r[1:] for r in rows(integrity.delete_summary(cat, res))}
    assert summary["genre"] == (2, 1, 1, 1) and summary["track_genre"] == (2, 1, 1, 0)


def test_unique_violations_on_optional_columns(spark):
    from cadenza.catalog import Catalog
    from cadenza.schemas import TABLES, schema

    tables = {t: spark.createDataFrame([], schema(t)) for t in TABLES}
    tables["track"] = spark.createDataFrame(
        [(1, "a", "XX1"), (2, "b", "XX1"), (3, "c", None), (4, "d", None)], "track_id long, title string, isrc string"
    )
    cat = Catalog(tables)
    assert rows(integrity.unique_violations(cat, "track", "isrc")) == [("XX1", 2)]
    with pytest.raises(KeyError, match="mb_release_group_gid"):
        integrity.unique_violations(cat, "album", "mb_release_group_gid")


def test_distinct_counts_without_trusting_keys(make_catalog):
    from cadenza.operators import reports

    cat = make_catalog(
        label=[(1, "L", None, None, None)],
        label_album=[(1, 10), (1, 10), (1, 11)],  # duplicate bridge row
    )
    assert rows(reports.label_catalog_size(cat, assume_keys=False))[0][3] == 2
    assert rows(reports.label_catalog_size(cat, assume_keys=True))[0][3] == 3


def test_dedupe_artists_by_external_id(spark):
    from cadenza.catalog import Catalog
    from cadenza.schemas import TABLES, schema

    tables = {t: spark.createDataFrame([], schema(t)) for t in TABLES}
    tables["artist"] = spark.createDataFrame(
        [(1, "A", "g1"), (2, "A dup", "g1"), (3, "B", None), (4, "C", "g2")],
        "user_id long, name string, mb_artist_gid string",
    )
    tables["track_artist"] = spark.createDataFrame([(10, 1, "primary"), (10, 2, "vocal"), (11, 2, "vocal")], schema("track_artist"))
    tables["producer"] = spark.createDataFrame([(30, "P", None, None, 2)], schema("producer"))
    res = integrity.dedupe_by_external_id(Catalog(tables), "artist", "mb_artist_gid")
    assert rows(res.mapping) == [(2, 1)]
    assert sorted(r[0] for r in rows(res.catalog.artist)) == [1, 3, 4]
    assert sorted(rows(res.catalog.track_artist)) == [(10, 1, "primary"), (11, 1, "vocal")]
    assert rows(res.catalog.producer)[0][4] == 1


def test_dedupe_over_several_ids_follows_chains(make_catalog, spark):
    from cadenza.operators.dedupe import ID_TABLES, dedupe_entities
    from cadenza.schemas import schema

    cat = make_catalog(
        track_artist=[(1, 7, "a"), (3, 7, "b"), (4, 8, "c"), (9, 7, "d"), (3, 9, "e")],
        track_isrc=[(2, "X", True), (4, "Y", True), (5, "Y", True), (99, "Y", True), (6, None, True)],
        track_genre=[(3, 1), (4, 1), (9, 1)],
        review=[(50, 3, None, None, 1, 4), (51, 3, None, None, 1, 9)],
        gets=[(50, 4), (50, 5), (51, 9)],
    )
    # 1-2 by gid, 2-3 by ISRC (one on the row, one listed), 4-5 by listed ISRC, 5-3 by gid: one entity; 6 to 9 alone.
    ids = [(1, "g1", None), (2, "g1", None), (3, "g2", "X"), (4, None, None), (5, "g2", None), (6, None, None), (9, "g9", None)]
    track = spark.createDataFrame(ids, "track_id long, mb_recording_gid string, isrc string").withColumn("title", F.lit("t"))
    full = track.select(*[c if c in track.columns else F.lit(None).cast(f.dataType).alias(c) for f in schema("track").fields for c in [f.name]], "mb_recording_gid", "isrc")
    res = dedupe_entities(cat.replace(track=full), "track", ["mb_recording_gid", "isrc"], ID_TABLES["track"])
    assert sorted(rows(res.mapping)) == [(2, 1), (3, 1), (4, 1), (5, 1)]
    assert sorted(r[0] for r in rows(res.catalog.track)) == [1, 6, 9]
    assert sorted(rows(res.catalog.track_artist)) == [(1, 7, "a"), (1, 8, "c"), (1, 9, "e"), (9, 7, "d")]
    assert sorted(rows(res.catalog.track_genre)) == [(1, 1), (9, 1)] and sorted(rows(res.catalog.gets)) == [(50, 1), (51, 9)]
    assert sorted(rows(res.catalog.review.select("review_id", "track_id"))) == [(50, 1), (51, 9)]
    assert sorted(rows(res.catalog.track_isrc.select("track_id", "isrc"))) == [(1, "X"), (1, "Y"), (6, None), (99, "Y")]


def test_components_of_long_chains(spark):
    from cadenza.plans.components import connected_components

    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (95, 80), (7, 7)]
    got = dict(rows(connected_components(spark.createDataFrame(chain, "a long, b long"))))
    assert got == {i: 0 for i in range(41)} | {k: 80 for k in (80, 90, 95, 100)}
    assert connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_requests_on_repeated_parent_keys_are_not_multiplied(make_catalog, spark):
    twice = [(10, "T", 1, None, None, None, False)] * 2
    cat = make_catalog(track=twice, consumer=[(1, "One"), (1, "One")], users=[(1, "u", None, None, None)] * 2, playlist=[(20, "P", None, True, 1)] * 2, playlist_track=[(20, 11, T0)] * 2)
    req = spark.createDataFrame([(1, 1, 10, 3, "x"), (2, 1, 99, 3, "x")], "request_id long, consumer_id long, track_id long, rating int, review_text string")
    batch = ingest.ingest_reviews(cat, req)
    assert len(rows(batch.review)) == 1 and rows(batch.rejects) == [(2, "unknown track")]
    lists = spark.createDataFrame([(1, 1, "A", None, None)], "request_id long, user_id long, name string, description string, public string")
    assert len(rows(ingest.ingest_playlists(cat, lists).playlist)) == 1
    adds = spark.createDataFrame([(1, 20, 10), (2, 20, 11), (3, 20, 10)], "request_id long, playlist_id long, track_id long")
    out = ingest.playlist_add(cat, adds)
    assert [r[:2] for r in rows(out.added)] == [(20, 10)]
    assert sorted((r[0], r[3]) for r in rows(out.rejects)) == [(2, "unknown track"), (3, "duplicate in batch")]


def test_each_removal_is_answered_by_itself(make_catalog, spark):
    cat = _base(make_catalog)
    asked = spark.createDataFrame([(5, 20, 10), (2, 20, 10), (3, 20, 11), (4, 20, 11)], "request_id long, playlist_id long, track_id long")
    out = ingest.playlist_remove(cat, asked)
    assert [r[:2] for r in rows(out.removed)] == [(20, 10)] and rows(out.remaining) == []
    assert sorted(rows(out.rejects)) == [(3, 20, 11, "not on playlist"), (4, 20, 11, "not on playlist"), (5, 20, 10, "not on playlist")]


def test_playlists_with_their_first_tracks(make_catalog, spark):
    cat = _base(make_catalog)
    lists = spark.createDataFrame([(1, 1, "A", None, "no"), (2, 1, "", None, None), (3, 2, "B", None, None)], "request_id long, user_id long, name string, description string, public string")
    adds = spark.createDataFrame(
        [(1, 1, None, 10), (2, 1, None, 10), (3, 1, None, 99), (4, 2, None, 10), (5, 3, None, 11), (6, None, 20, 10), (7, None, 20, 11), (8, None, 99, 11), (9, 44, None, 11), (10, 1, 21, 11), (11, None, None, 10)],
        "add_id long, request_id long, playlist_id long, track_id long",
    )
    out = ingest.ingest_playlists_with_tracks(cat, lists, adds, batch_date="2026-01-01", batch_ts="2026-01-01 00:00:00")
    assert sorted(r[:2] for r in rows(out.playlist)) == [(22, "A"), (23, "B")] and sorted(rows(out.makes)) == [(1, 22), (2, 23)]
    assert sorted(r[:2] for r in rows(out.playlist_track)) == [(20, 11), (22, 10), (22, 11), (23, 11)]
    assert {r[2] or r[0]: r[3] for r in rows(out.rejects)} == {
        "playlist": "name required", 2: "duplicate in batch", 3: "unknown track", 4: "playlist not created",
        6: "already on playlist", 8: "unknown playlist", 9: "playlist not created", 11: "unknown playlist",
    }


def test_batch_check_equals_the_full_check_before_and_after(make_catalog, spark):
    from cadenza.operators.batch_checks import applied, batch_violations
    from cadenza.schemas import schema
    from cadenza.sources.files import Changes

    rnd = random.Random(3)

    def some(keys, n, null=0.1):
        return [tuple(None if rnd.random() < null else rnd.randrange(k) for k in keys) for _ in range(n)]

    def tracks(n):
        got = [(k, "t", f"i{i}" if i is not None else None) for k, i in some((8, 5), n)]
        return spark.createDataFrame(got, "track_id long, title string, isrc string")

    cat = make_catalog(artist=[(k, "n", None, None, None) for (k,) in some((6,), 6)], track_artist=[(*p, "r") for p in some((9, 7), 25)])
    cat = cat.replace(track=tracks(10))
    adds = {
        "track": tracks(4),
        "track_artist": spark.createDataFrame([(*p, "r") for p in some((9, 7), 8)], schema("track_artist")),
        "artist": spark.createDataFrame([(k, "n", None, None, None) for (k,) in some((7,), 2)], schema("artist")),
    }
    gone = {
        "track": spark.createDataFrame(some((8,), 3, 0), "track_id long"),
        "artist": spark.createDataFrame(some((6,), 2, 0), "user_id long"),
        "track_artist": spark.createDataFrame(some((9, 7), 6, 0), "track_id long, artist_id long"),
    }
    changes = Changes(adds, gone)
    before, after = ({r[0]: r[3] for r in rows(integrity.integrity_report(c))} for c in (cat, applied(cat, changes)))
    found = {r[0]: r[3] for r in rows(batch_violations(cat, changes))}
    assert found == {name: after[name] - before[name] for name in found}
    assert {n for n in after if after[n] != before[n]} <= set(found) and {"track.pk", "track.isrc.unique"} <= set(found)
    assert {n.split(".")[0] for n in found} >= {"track", "track_artist", "artist"}
    assert rows(batch_violations(cat, Changes())) == []


def test_absent_constraints_are_listed(make_catalog):
    cat = make_catalog()
    del cat._tables["genre"]
    report = {r[0]: (r[3], r[4]) for r in rows(integrity.integrity_report(cat, include_absent=True))}
    assert report["genre.pk"] == (None, "absent") and report["track.isrc.unique"] == (None, "absent") and report["track.pk"] == (0, "checked")
    assert report["track_genre.genre_id->genre.genre_id"] == (None, "absent")


def test_key_name_from_pitch_class(spark):
    from cadenza.functions.music import key_name

    df = spark.createDataFrame([("0",), ("6",), ("11",), ("12",), ("F#",), (None,)], "k string")
    assert [r[0] for r in rows(df.select(key_name("k")))] == ["C", "F#", "B", None, "F#", None]


def test_ids_stable_across_actions(make_catalog, spark):
    # Recomputing downstream of the checkpoint (as after a lost executor)
    # must hand out the same ids to the same requests.
    cat = _base(make_catalog)
    req = spark.createDataFrame(
        [(i * 7 % 101, 1 + i % 2, 10 + i % 2, 1 + i % 5, f"t{i}") for i in range(101)],
        "request_id long, consumer_id long, track_id long, rating int, review_text string",
    ).repartition(5)
    batch = ingest.ingest_reviews(cat, req, batch_ts="2026-01-01 00:00:00")
    first = sorted(rows(batch.review.select("review_text", "review_id")))
    second = sorted(rows(batch.review.select("review_text", "review_id")))
    assert first == second
    links = dict(rows(batch.gets.select("review_id", "track_id")))
    assert set(links) == {r[1] for r in first}
