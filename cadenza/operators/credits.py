"""Detail and credit look-ups for key sets.

Every operator takes a key set (see ``plans.keys``): one id gives exactly
the reference's columns; a list, a DataFrame of keys or ``None`` (all keys)
puts the key column in front and makes it lead the sort. The key set is
applied to the bridge table first, so a list of ids becomes a Parquet filter
and a DataFrame becomes a semi join before any dimension is joined. Where a
name orders the rows, ``collation`` orders them linguistically.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions.ordering import asc, desc, desc_nulls_last, text_key
from ..functions.roles import PLAIN_PROFILE, role_label
from ..plans.keys import KeySet, is_single, restrict
from .common import artist_names, count_per_key, genre_names


def _finish(
    df: DataFrame, ids: KeySet, key: str, out_key: str, cols: list, order: list[Column], ordered: bool = True
) -> DataFrame:
    """Sort (key first when several keys are asked for), then project.

    ``ordered=False`` skips the global sort, which for an all-keys export is
    a range-partitioning shuffle of the whole result; rows then come in
    join order.
    """
    if is_single(ids):
        return (df.orderBy(*order) if ordered else df).select(*cols)
    keyed = df.withColumn(out_key, F.col(key)) if out_key != key else df
    if ordered:
        keyed = keyed.orderBy(asc(out_key), *order)
    return keyed.select(out_key, *cols)


def _artist_dim(cat: Catalog, id_alias: str, name_alias: str) -> DataFrame:
    return cat.artist.select(F.col("user_id").alias(id_alias), F.col("name").alias(name_alias))


def track_detail(
    cat: Catalog, track_ids: KeySet = None, collation: str | None = None, ordered: bool = True
) -> DataFrame:
    """track_id, title, duration_sec, bpm, key, mode, explicit_flag, artists, genres.

    The reference also left-joins the primary ISRC but never reads it and
    aggregates only with DISTINCT, so that join is left out.
    """
    tracks = restrict(
        cat.track.select("track_id", "title", "duration_sec", "bpm", "key", "mode", "explicit_flag"),
        "track_id",
        track_ids,
    )
    ta = restrict(cat.track_artist, "track_id", track_ids)
    tg = restrict(cat.track_genre, "track_id", track_ids)
    out = (
        tracks.join(artist_names(ta, cat.artist, collation=collation), "track_id", "left")
        .join(genre_names(tg, cat.genre, collation=collation), "track_id", "left")
        .select("track_id", "title", "duration_sec", "bpm", "key", "mode", "explicit_flag", "artists", "genres")
    )
    return out.orderBy(asc("track_id")) if ordered else out


def artist_tracks(
    cat: Catalog, artist_ids: KeySet = None, ordered: bool = True, collation: str | None = None
) -> DataFrame:
    """[artist_id,] track_id, title, duration_sec, role; by title."""
    ta = restrict(cat.track_artist.select("artist_id", "track_id", "role"), "artist_id", artist_ids)
    df = ta.join(cat.track.select("track_id", "title", "duration_sec"), "track_id")
    return _finish(
        df,
        artist_ids,
        "artist_id",
        "artist_id",
        ["track_id", "title", "duration_sec", "role"],
        [text_key("title", collation), asc("track_id")],
        ordered=ordered,
    )


def album_tracks(
    cat: Catalog, album_ids: KeySet = None, ordered: bool = True, collation: str | None = None
) -> DataFrame:
    """[album_id,] track_id, title, track_number, duration_sec; by track number."""
    ta = restrict(cat.track_album.select("album_id", "track_id", "track_number"), "album_id", album_ids)
    df = ta.join(cat.track.select("track_id", "title", "duration_sec"), "track_id")
    return _finish(
        df,
        album_ids,
        "album_id",
        "album_id",
        ["track_id", "title", "track_number", "duration_sec"],
        [asc("track_number"), text_key("title", collation), asc("track_id")],
        ordered=ordered,
    )


def track_songwriters(
    cat: Catalog, track_ids: KeySet = None, ordered: bool = True, collation: str | None = None
) -> DataFrame:
    """[track_id,] track_title, songwriter, contribution; by songwriter."""
    ts = restrict(cat.track_songwriter.select("track_id", "artist_id", "contribution"), "track_id", track_ids)
    df = ts.join(cat.track.select("track_id", F.col("title").alias("track_title")), "track_id").join(
        _artist_dim(cat, "artist_id", "songwriter"), "artist_id"
    )
    return _finish(
        df,
        track_ids,
        "track_id",
        "track_id",
        ["track_title", "songwriter", "contribution"],
        [text_key("songwriter", collation), asc("artist_id")],
        ordered=ordered,
    )


def track_producers(
    cat: Catalog, track_ids: KeySet = None, ordered: bool = True, collation: str | None = None
) -> DataFrame:
    """[track_id,] track_title, producer, credit_type; by producer name."""
    tp = restrict(cat.track_producer.select("track_id", "producer_id", "credit_type"), "track_id", track_ids)
    df = tp.join(cat.track.select("track_id", F.col("title").alias("track_title")), "track_id").join(
        cat.producer.select("producer_id", F.col("name").alias("producer")), "producer_id"
    )
    return _finish(
        df,
        track_ids,
        "track_id",
        "track_id",
        ["track_title", "producer", "credit_type"],
        [text_key("producer", collation), asc("producer_id")],
        ordered=ordered,
    )


def group_members(
    cat: Catalog, group_ids: KeySet = None, ordered: bool = True, collation: str | None = None
) -> DataFrame:
    """[group_id,] group_name, member_name, instrument, join_year, leave_year."""
    am = restrict(cat.artist_member, "group_artist_id", group_ids)
    df = am.join(_artist_dim(cat, "group_artist_id", "group_name"), "group_artist_id").join(
        _artist_dim(cat, "member_artist_id", "member_name"), "member_artist_id"
    )
    return _finish(
        df,
        group_ids,
        "group_artist_id",
        "group_id",
        ["group_name", "member_name", "instrument", "join_year", "leave_year"],
        [asc("join_year"), text_key("member_name", collation), asc("member_artist_id")],
        ordered=ordered,
    )


def user_playlists(cat: Catalog, user_ids: KeySet = None, assume_keys: bool = True, ordered: bool = True) -> DataFrame:
    """[user_id,] playlist_id, name, is_public, created_date, track_count; newest first.

    A playlist may have several makers, so with several users the rows are
    per (user, playlist). Empty playlists stay, with 0 tracks.
    """
    made = restrict(cat.makes.select("user_id", "playlist_id"), "user_id", user_ids)
    lists = made.join(cat.playlist.select("playlist_id", "name", "is_public", "created_date"), "playlist_id")
    entries = cat.playlist_track.select("playlist_id", "track_id")
    if user_ids is not None:
        entries = entries.join(made.select("playlist_id"), "playlist_id", "left_semi")
    counts = count_per_key(entries, "playlist_id", "track_id", "track_count", assume_keys=assume_keys)
    df = lists.join(counts, "playlist_id", "left").withColumn(
        "track_count", F.coalesce("track_count", F.lit(0)).cast("bigint")
    )
    return _finish(
        df,
        user_ids,
        "user_id",
        "user_id",
        ["playlist_id", "name", "is_public", "created_date", "track_count"],
        [desc_nulls_last("created_date"), asc("playlist_id")],
        ordered=ordered,
    )


def user_playlist_list(
    cat: Catalog, user_ids: KeySet = None, ordered: bool = True, collation: str | None = None
) -> DataFrame:
    """[user_id,] playlist_id, name; by name."""
    made = restrict(cat.makes.select("user_id", "playlist_id"), "user_id", user_ids)
    df = made.join(cat.playlist.select("playlist_id", "name"), "playlist_id")
    return _finish(
        df, user_ids, "user_id", "user_id", ["playlist_id", "name"], [text_key("name", collation), asc("playlist_id")], ordered=ordered
    )


def playlist_tracks(
    cat: Catalog, playlist_ids: KeySet = None, ordered: bool = True, collation: str | None = None
) -> DataFrame:
    """[playlist_id,] track_id, title, duration_sec, added_at; oldest addition first."""
    pt = restrict(cat.playlist_track.select("playlist_id", "track_id", "added_at"), "playlist_id", playlist_ids)
    df = pt.join(cat.track.select("track_id", "title", "duration_sec"), "track_id")
    return _finish(
        df,
        playlist_ids,
        "playlist_id",
        "playlist_id",
        ["track_id", "title", "duration_sec", "added_at"],
        [asc("added_at"), text_key("title", collation), asc("track_id")],
        ordered=ordered,
    )


def track_rights(cat: Catalog, track_ids: KeySet = None, ordered: bool = True) -> DataFrame:
    """[track_id,] track_title, holder_name, pro_affiliation, rights_type, percentage."""
    tr = restrict(
        cat.track_rights_holder.select("track_id", "rights_id", "rights_type", "percentage"), "track_id", track_ids
    )
    df = tr.join(cat.track.select("track_id", F.col("title").alias("track_title")), "track_id").join(
        cat.rights_holder.select("rights_id", "holder_name", "pro_affiliation"), "rights_id"
    )
    return _finish(
        df,
        track_ids,
        "track_id",
        "track_id",
        ["track_title", "holder_name", "pro_affiliation", "rights_type", "percentage"],
        [desc_nulls_last("percentage"), asc("rights_id")],
        ordered=ordered,
    )


def track_isrcs(cat: Catalog, track_ids: KeySet = None, ordered: bool = True) -> DataFrame:
    """[track_id,] track_title, isrc, is_primary; primary first."""
    ti = restrict(cat.track_isrc.select("track_id", "isrc", "is_primary"), "track_id", track_ids)
    df = ti.join(cat.track.select("track_id", F.col("title").alias("track_title")), "track_id")
    return _finish(
        df,
        track_ids,
        "track_id",
        "track_id",
        ["track_title", "isrc", "is_primary"],
        [desc("is_primary"), asc("isrc")],
        ordered=ordered,
    )


def artist_producer_links(
    cat: Catalog, artist_ids: KeySet = None, ordered: bool = True, collation: str | None = None
) -> DataFrame:
    """[artist_id,] artist_name, producer_name, producer_id; by producer name."""
    mb = restrict(cat.may_be.select("artist_id", "producer_id"), "artist_id", artist_ids)
    df = mb.join(_artist_dim(cat, "artist_id", "artist_name"), "artist_id").join(
        cat.producer.select("producer_id", F.col("name").alias("producer_name")), "producer_id"
    )
    return _finish(
        df,
        artist_ids,
        "artist_id",
        "artist_id",
        ["artist_name", "producer_name", "producer_id"],
        [text_key("producer_name", collation), asc("producer_id")],
        ordered=ordered,
    )


def consumer_reviews(cat: Catalog, consumer_ids: KeySet = None, ordered: bool = True) -> DataFrame:
    """[consumer_id,] review_id, rating, review_text, created_at, track_title.

    Linked through written_by; the track comes from the review row itself.
    """
    wb = restrict(cat.written_by.select("consumer_id", "review_id"), "consumer_id", consumer_ids)
    df = wb.join(
        cat.review.select("review_id", "rating", "review_text", "created_at", "track_id"), "review_id"
    ).join(cat.track.select("track_id", F.col("title").alias("track_title")), "track_id")
    return _finish(
        df,
        consumer_ids,
        "consumer_id",
        "consumer_id",
        ["review_id", "rating", "review_text", "created_at", "track_title"],
        [desc_nulls_last("created_at"), asc("review_id")],
        ordered=ordered,
    )


def track_reviews(cat: Catalog, track_ids: KeySet = None, ordered: bool = True) -> DataFrame:
    """[track_id,] review_id, rating, review_text, created_at, reviewer.

    Linked through gets; the reviewer comes from the review row itself.
    """
    g = restrict(cat.gets.select("review_id", "track_id"), "track_id", track_ids)
    df = g.join(
        cat.review.select("review_id", "rating", "review_text", "created_at", "consumer_id"), "review_id"
    ).join(cat.consumer.select(F.col("user_id").alias("consumer_id"), F.col("display_name").alias("reviewer")), "consumer_id")
    return _finish(
        df,
        track_ids,
        "track_id",
        "track_id",
        ["review_id", "rating", "review_text", "created_at", "reviewer"],
        [desc_nulls_last("created_at"), asc("review_id")],
        ordered=ordered,
    )


def user_profiles(cat: Catalog, user_ids: KeySet = None, ordered: bool = True) -> DataFrame:
    """user_id, username, email, join_date, country, display_name, artist_name, artist_type, role."""
    users = restrict(cat.users.select("user_id", "username", "email", "join_date", "country"), "user_id", user_ids)
    consumers = restrict(cat.consumer, "user_id", user_ids).select(
        "user_id", F.col("user_id").alias("consumer_key"), "display_name"
    )
    artists = restrict(cat.artist, "user_id", user_ids).select(
        "user_id", F.col("user_id").alias("artist_key"), F.col("name").alias("artist_name"), F.col("type").alias("artist_type")
    )
    out = (
        users.join(consumers, "user_id", "left")
        .join(artists, "user_id", "left")
        .select(
            "user_id",
            "username",
            "email",
            "join_date",
            "country",
            "display_name",
            "artist_name",
            "artist_type",
            role_label("artist_key", "consumer_key", PLAIN_PROFILE).alias("role"),
        )
    )
    return out.orderBy(asc("user_id")) if ordered else out
