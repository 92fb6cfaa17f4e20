import datetime as dt
import decimal

from cadenza.operators import reports
from table_rows import rows

D = decimal.Decimal
T0 = dt.datetime(2024, 1, 1)


def _fanout_catalog(make_catalog, n_artists):
    ratings = [(u, 1, r, T0) for u, r in ((1, 4), (2, 5), (3, 5))]
    artists = [(100 + i, f"Artist {i}", "X", 1990, "Person") for i in range(4)]
    credits = [(1, 100 + i, "primary") for i in range(n_artists)]
    return make_catalog(
        track=[(1, "Song", 200, None, None, None, False)],
        consumer_track_rating=ratings,
        artist=artists,
        track_artist=credits,
    )


def test_top_rated_joined_count_multiplies_by_credit_rows(make_catalog):
    for n_artists, expected in ((0, 3), (1, 3), (4, 12)):
        cat = _fanout_catalog(make_catalog, n_artists)
        got = rows(reports.top_rated_tracks(cat, min_ratings=1, limit=5))
        assert got[0][3] == D("4.67")
        assert got[0][4] == expected
        distinct = rows(reports.top_rated_tracks(cat, min_ratings=1, limit=5, count_mode="distinct"))
        assert distinct[0][4] == 3


def test_top_rated_having_sees_inflated_count(make_catalog):
    cat = _fanout_catalog(make_catalog, 4)
    assert rows(reports.top_rated_tracks(cat, min_ratings=12, limit=5))
    assert not rows(reports.top_rated_tracks(cat, min_ratings=12, limit=5, count_mode="distinct"))


def test_top_rated_artist_list_and_ties(make_catalog):
    cat = make_catalog(
        track=[(i, "Same", 100, None, None, None, False) for i in (3, 1, 2)] + [(9, "Orphan", 1, None, None, None, False)],
        consumer_track_rating=[(1, i, 5, T0) for i in (1, 2, 3)] + [(1, 7, 5, T0), (1, 9, None, T0)],
        artist=[(10, "Bo", None, None, None), (11, "Al", None, None, None), (12, None, None, None, None)],
        track_artist=[(1, 10, "x"), (1, 11, "x"), (1, 12, "x"), (2, 12, "x")],
    )
    got = rows(reports.top_rated_tracks(cat, min_ratings=1, limit=10, count_mode="distinct"))
    # track 7 has no track row (inner join drops it); track 9 only has a NULL rating.
    assert [r[0] for r in got] == [1, 2, 3]
    assert got[0][2] == "Al, Bo"
    assert got[1][2] is None  # only a NULL-named artist
    assert got[2][2] is None  # no credits at all


def test_popular_genres_rating_weighted_and_empty_genre(make_catalog):
    cat = make_catalog(
        genre=[(1, "Rock", None, None), (2, "Jazz", None, None), (3, "Empty", None, None)],
        track_genre=[(1, 1), (2, 1), (3, 2)],
        consumer_track_rating=[(1, 1, 10, T0), (2, 1, 10, T0), (3, 1, 10, T0), (1, 2, 1, T0)],
    )
    got = rows(reports.popular_genres(cat, limit=10))
    # Rock: tracks 1,2; ratings 10,10,10,1 -> 31/4 = 7.75 (not the mean of track means, 5.5).
    assert got == [(1, "Rock", 2, D("7.75")), (2, "Jazz", 1, None), (3, "Empty", 0, None)]


def test_most_prolific_album_count_by_appearance(make_catalog):
    cat = make_catalog(
        artist=[(1, "A", None, None, None), (2, "B", None, None, None), (3, "Idle", None, None, None)],
        track_artist=[(10, 1, "x"), (11, 1, "x"), (10, 2, "x")],
        track_album=[(10, 100, 1), (10, 101, 1), (11, 101, 2), (11, 102, 1)],
    )
    got = rows(reports.most_prolific_artists(cat, limit=10))
    assert got == [(1, "A", 2, 3), (2, "B", 1, 2)]


def test_label_catalog_size_keeps_empty_labels(make_catalog):
    cat = make_catalog(
        label=[(1, "L1", "X", 1900, None), (2, "L2", None, 1901, None)],
        label_album=[(1, 10), (1, 11)],
        label_artist=[(2, 5, 1990, None)],
    )
    assert rows(reports.label_catalog_size(cat, limit=10)) == [(1, "L1", "X", 2, 0), (2, "L2", None, 0, 1)]


def test_genre_tree_roots_first_one_level(make_catalog):
    cat = make_catalog(
        genre=[
            (1, "Root", None, None),
            (2, "Child", None, 1),
            (3, "Grandchild", None, 2),
            (4, "Orphan", None, None),
        ]
    )
    got = rows(reports.genre_tree(cat, limit=10))
    assert got == [(4, "Orphan", None, None), (1, "Root", None, None), (3, "Grandchild", None, "Child"), (2, "Child", None, "Root")]


def test_recent_reviews_needs_track_and_consumer(make_catalog):
    cat = make_catalog(
        track=[(1, "Song", 1, None, None, None, False)],
        consumer=[(5, "Fan")],
        review=[
            (1, 5, "ok", T0, 5, 1),
            (2, 4, "newer", T0 + dt.timedelta(days=1), 5, 1),
            (3, 3, "orphan track", T0 + dt.timedelta(days=2), 5, 99),
            (4, 3, "no date", None, 5, 1),
        ],
    )
    got = rows(reports.recent_reviews(cat, limit=10))
    assert [r[0] for r in got] == [2, 1, 4]
    assert got[0][4:] == ("Song", "Fan")


def test_limit_zero_gives_no_rows(make_catalog):
    cat = _fanout_catalog(make_catalog, 1)
    assert rows(reports.top_rated_tracks(cat, limit=0)) == []


def test_top_rated_artists_in_linguistic_order(make_catalog):
    cat = make_catalog(
        track=[(1, "Song", 200, None, None, None, False)],
        consumer_track_rating=[(1, 1, 5, T0)],
        artist=[(10, "Alex", None, None, None), (11, "Aleš", None, None, None), (12, "Alena", None, None, None)],
        track_artist=[(1, 10, "x"), (1, 11, "x"), (1, 12, "x")],
    )
    binary = rows(reports.top_rated_tracks(cat))[0][2]
    linguistic = rows(reports.top_rated_tracks(cat, collation="UNICODE"))[0][2]
    assert binary == "Alena, Alex, Aleš"
    assert linguistic == "Alena, Aleš, Alex"


def test_negative_limit_is_an_error(make_catalog):
    import pytest

    cat = _fanout_catalog(make_catalog, 1)
    with pytest.raises(Exception):
        rows(reports.top_rated_tracks(cat, limit=-1))


def test_coverage_includes_present_optional_columns(spark):
    from cadenza.catalog import Catalog
    from cadenza.operators import profile
    from cadenza.schemas import TABLES, schema

    tables = {t: spark.createDataFrame([], schema(t)) for t in TABLES}
    tables["label"] = spark.createDataFrame(
        [(1, "L1", None, None, "https://x", "g1"), (2, "L2", None, None, None, None)],
        "label_id long, name string, country string, founded_year int, website string, mb_label_gid string",
    )
    got = {(r[0], r[1]): (r[2], r[3], r[4]) for r in rows(profile.coverage_report(Catalog(tables)))}
    assert got[("label", "website")] == (2, 1, D("50.00"))
    assert got[("label", "mb_label_gid")] == (2, 1, D("50.00"))
    assert got[("track", "bpm")] == (0, 0, None)


def test_row_counts_report_empty_tables(make_catalog):
    from cadenza.operators import profile

    cat = make_catalog(genre=[(1, "Rock", None, None)])
    got = dict(rows(profile.table_row_counts(cat)))
    assert got["genre"] == 1 and got["track"] == 0 and len(got) == 27
