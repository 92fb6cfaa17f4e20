import datetime as dt

from cadenza.operators import credits, search
from table_rows import rows

T0 = dt.datetime(2024, 1, 1)


def _music(make_catalog):
    return make_catalog(
        users=[(1, "alice", "a@x", None, "X"), (2, "bob", None, None, "Y"), (3, None, "c@x", None, None), (4, "dan", "d@x", None, None)],
        artist=[(1, "Alice Band", "X", 1990, "Group"), (2, None, None, None, "Person"), (7, "Solo", None, None, "Person")],
        consumer=[(1, "Ali"), (3, "Cee"), (4, None)],
        track=[
            (10, "High Road", 200, None, None, None, False),
            (11, "high noon", 100, None, None, None, True),
            (12, None, 50, None, None, None, False),
            (13, "High Road", 210, None, None, None, False),
        ],
        track_artist=[(10, 1, "primary"), (10, 7, "vocal"), (11, 7, "primary"), (99, 7, "primary")],
        album=[(100, "Vol 1", dt.date(2020, 1, 1), False), (101, "Vol 1 again", None, False), (102, "vol 10", dt.date(2021, 1, 1), False)],
        track_album=[(10, 100, 2), (11, 100, None), (13, 100, 1), (10, 102, 1)],
        artist_member=[(1, 7, "drums", None, None)],
        review=[(1, 5, "great", T0, 1, 10), (2, 3, "meh", T0 + dt.timedelta(hours=1), 3, 11)],
        gets=[(1, 11), (2, 11)],
        written_by=[(1, 1), (3, 2)],
    )


def test_search_tracks_ties_nulls_and_artists(make_catalog):
    cat = _music(make_catalog)
    got = rows(search.search_tracks(cat, "high", 10))
    assert [r[0] for r in got] == [10, 13, 11]  # equal titles break on track_id
    assert got[0][3] == "Alice Band, Solo"
    assert got[1][3] is None
    everything = rows(search.search_tracks(cat, "", 10))
    assert [r[0] for r in everything][-1] == 12  # NULL title matches '' and sorts last


def test_search_artists_counts_keep_zero(make_catalog):
    cat = _music(make_catalog)
    got = rows(search.search_artists(cat, "", 10))
    assert [(r[0], r[5]) for r in got] == [(1, 1), (7, 3), (2, 0)]


def test_search_albums_newest_first_nulls_last(make_catalog):
    cat = _music(make_catalog)
    got = rows(search.search_albums(cat, "vol 1", 10))
    assert [(r[0], r[4]) for r in got] == [(102, 1), (100, 3), (101, 0)]


def test_search_users_roles_and_email_match(make_catalog):
    cat = _music(make_catalog)
    got = {r[0]: r[5] for r in rows(search.search_users(cat, "", 10))}
    assert got == {1: "Artist + Consumer", 2: "Artist", 3: "Consumer", 4: "Consumer"}
    assert [r[0] for r in rows(search.search_users(cat, "c@", 10))] == [3]


def test_find_groups_needs_members(make_catalog):
    cat = _music(make_catalog)
    assert rows(search.find_groups(cat, "", 10)) == [(1, "Alice Band")]


def test_detail_single_id_has_reference_columns(make_catalog):
    cat = _music(make_catalog)
    one = credits.artist_tracks(cat, 7)
    assert one.columns == ["track_id", "title", "duration_sec", "role"]
    assert [r[0] for r in rows(one)] == [10, 11]  # inner join drops track 99; binary title order
    many = credits.artist_tracks(cat, [7, 1])
    assert many.columns[0] == "artist_id"
    assert [r[:2] for r in rows(many)] == [(1, 10), (7, 10), (7, 11)]


def test_key_set_as_dataframe(make_catalog, spark):
    cat = _music(make_catalog)
    keys = spark.createDataFrame([(100,)], "k long")
    got = rows(credits.album_tracks(cat, keys))
    assert [r[1] for r in got] == [13, 10, 11]  # track_number 1, 2, NULL last


def test_reviews_follow_their_own_links(make_catalog):
    cat = _music(make_catalog)
    # consumer_reviews takes the track from review.track_id, not from gets.
    assert [r[-1] for r in rows(credits.consumer_reviews(cat, 1))] == ["High Road"]
    # track_reviews goes through gets, reviewer from review.consumer_id.
    assert [(r[0], r[-1]) for r in rows(credits.track_reviews(cat, 11))] == [(2, "Cee"), (1, "Ali")]


def test_user_profiles_role_labels(make_catalog):
    cat = _music(make_catalog)
    got = {r[0]: r[-1] for r in rows(credits.user_profiles(cat, None))}
    assert got == {1: "Artist + Consumer", 2: "Artist", 3: "Consumer", 4: "Consumer"}
    lone = make_catalog(users=[(9, "x", None, None, None)])
    assert rows(credits.user_profiles(lone, 9))[0][-1] == "User only"


def test_track_detail_dead_isrc_join_not_needed(make_catalog):
    cat = _music(make_catalog)
    got = rows(credits.track_detail(cat, [10, 12]))
    assert [(r[0], r[7], r[8]) for r in got] == [(10, "Alice Band, Solo", None), (12, None, None)]


def test_unordered_export_has_same_rows(make_catalog):
    cat = _music(make_catalog)
    assert sorted(rows(credits.album_tracks(cat, None, ordered=False))) == sorted(rows(credits.album_tracks(cat, None)))
    assert "Sort" not in credits.album_tracks(cat, None, ordered=False)._jdf.queryExecution().optimizedPlan().toString()
