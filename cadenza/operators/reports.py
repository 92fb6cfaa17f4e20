"""Whole-catalog reports.

Each report aggregates bridge tables by their key *before* joining
dimensions (partial + final hash aggregation, so a hot key is combined
map-side), keeps only the top-k rows, and only then fetches wide columns and
name lists for those k rows through size-bounded broadcasts. The final
re-sort of the k joined rows is ``orderBy + limit`` (one take-ordered step,
no range-partitioning pass).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions.aggregates import avg2
from ..functions.ordering import asc, asc_nulls_first, desc, desc_nulls_last, text_key
from ..plans.keys import bounded_broadcast, top_rows
from .common import artist_names, count_per_key

COUNT_MODES = ("joined", "distinct")


def rating_totals(cat: Catalog) -> DataFrame:
    """``track_id, rating_sum, rating_cnt`` over non-NULL consumer ratings."""
    r = cat.consumer_track_rating.filter(F.col("rating").isNotNull())
    return r.groupBy("track_id").agg(
        F.sum("rating").cast("bigint").alias("rating_sum"),
        F.count("rating").alias("rating_cnt"),
    )


def top_rated_tracks(
    cat: Catalog,
    min_ratings: int = 1,
    limit: int = 10,
    count_mode: str = "joined",
    collation: str | None = None,
) -> DataFrame:
    """Tracks by average consumer rating, then by rating count.

    ``count_mode='joined'`` keeps the reference's count, taken after the
    ratings were joined with the track's credit rows: ratings x max(1,
    credit rows). It is computed from two per-track aggregates instead of
    the exploding join. ``'distinct'`` counts each rating once. The average
    is the same in both modes (the fan-out repeats every rating equally).
    """
    if count_mode not in COUNT_MODES:
        raise ValueError(f"count_mode must be one of {COUNT_MODES}")
    totals = rating_totals(cat)
    # JOIN Track: ratings of unknown tracks do not count. Only the key column
    # of the dimension takes part; titles are fetched for the top-k. An inner
    # join with the distinct keys, because a semi join would be pushed below
    # the aggregate and shuffle raw ratings instead of per-track partials.
    totals = totals.join(cat.track.select("track_id").distinct(), "track_id")
    if count_mode == "joined":
        credits = cat.track_artist.groupBy("track_id").agg(F.count(F.lit(1)).alias("credit_rows"))
        totals = totals.join(credits, "track_id", "left")
        num = F.col("rating_cnt") * F.greatest(F.coalesce(F.col("credit_rows"), F.lit(0)), F.lit(1))
    else:
        num = F.col("rating_cnt")
    scored = totals.select(
        "track_id",
        avg2("rating_sum", "rating_cnt").alias("avg_rating"),
        num.cast("bigint").alias("num_ratings"),
    ).filter(F.col("num_ratings") >= F.lit(min_ratings))
    order = [desc("avg_rating"), desc("num_ratings"), asc("track_id")]
    top = top_rows(scored, order, limit)
    top_b = bounded_broadcast(top, limit)
    titled = cat.track.select("track_id", "title").join(top_b, "track_id")
    names = artist_names(cat.track_artist, cat.artist, top.select("track_id"), bound=limit, collation=collation)
    return (
        titled.join(names, "track_id", "left")
        .select("track_id", "title", "artists", "avg_rating", "num_ratings")
        .orderBy(*order)
        .limit(limit)
    )


def popular_genres(cat: Catalog, limit: int = 10, assume_keys: bool = True) -> DataFrame:
    """Genres by tagged-track count, then by rating-weighted average rating.

    The average runs over every (tagged track, rating) pair, i.e. sums and
    counts of ratings per track are added up per genre; genres with no
    tracks stay with count 0 and a NULL average.
    """
    totals = rating_totals(cat)
    tagged = cat.track_genre.select("genre_id", "track_id").join(totals, "track_id", "left")
    track_count = F.count("track_id") if assume_keys else F.count_distinct("track_id")
    per_genre = tagged.groupBy("genre_id").agg(
        track_count.alias("track_count"),
        F.sum("rating_sum").alias("rating_sum"),
        F.sum("rating_cnt").alias("rating_cnt"),
    )
    out = cat.genre.select("genre_id", "name").join(per_genre, "genre_id", "left").select(
        "genre_id",
        "name",
        F.coalesce("track_count", F.lit(0)).cast("bigint").alias("track_count"),
        avg2("rating_sum", "rating_cnt").alias("avg_rating"),
    )
    return out.orderBy(desc("track_count"), desc_nulls_last("avg_rating"), asc("genre_id")).limit(limit)


def most_prolific_artists(cat: Catalog, limit: int = 10, assume_keys: bool = True) -> DataFrame:
    """Artists by credited track count (> 0), with the albums those tracks are on.

    The order depends on the track count alone, so album counts are computed
    for the top-k artists only: their credit rows are joined with the
    track-album bridge and the distinct (artist, album) pairs counted.
    """
    tracks = count_per_key(cat.track_artist, "artist_id", "track_id", "track_count", assume_keys=assume_keys)
    ranked = (
        cat.artist.select(F.col("user_id").alias("artist_id"), "name")
        .join(tracks, "artist_id")
        .filter(F.col("track_count") > 0)
    )
    order = [desc("track_count"), asc("artist_id")]
    top = top_rows(ranked, order, limit)
    credits = cat.track_artist.select("artist_id", "track_id").join(
        bounded_broadcast(top.select("artist_id"), limit), "artist_id", "left_semi"
    )
    pairs = credits.join(cat.track_album.select("track_id", "album_id"), "track_id").select("artist_id", "album_id")
    albums = pairs.groupBy("artist_id").agg(F.count_distinct("album_id").alias("album_count"))
    return (
        top.join(albums, "artist_id", "left")
        .select(
            "artist_id",
            "name",
            F.col("track_count").cast("bigint").alias("track_count"),
            F.coalesce("album_count", F.lit(0)).cast("bigint").alias("album_count"),
        )
        .orderBy(*order)
        .limit(limit)
    )


def recent_reviews(cat: Catalog, limit: int = 10) -> DataFrame:
    """Newest reviews with track title and reviewer name.

    The inner joins only decide *which* reviews qualify, so the top-k is
    taken over narrow key columns first; review text, title and reviewer
    are looked up for the k survivors.
    """
    narrow = (
        cat.review.select("review_id", "created_at", "track_id", "consumer_id")
        .join(cat.track.select("track_id"), "track_id", "left_semi")
        .join(cat.consumer.select(F.col("user_id").alias("consumer_id")), "consumer_id", "left_semi")
    )
    order = [desc_nulls_last("created_at"), asc("review_id")]
    top = bounded_broadcast(top_rows(narrow, order, limit), limit)
    body = cat.review.select("review_id", "rating", "review_text").join(top, "review_id")
    return (
        body.join(bounded_broadcast(cat.track.select("track_id", "title").join(top.select("track_id"), "track_id", "left_semi"), limit), "track_id")
        .join(
            bounded_broadcast(
                cat.consumer.select(F.col("user_id").alias("consumer_id"), "display_name").join(
                    top.select("consumer_id"), "consumer_id", "left_semi"
                ),
                limit,
            ),
            "consumer_id",
        )
        .select(
            "review_id",
            "rating",
            "review_text",
            "created_at",
            F.col("title").alias("track_title"),
            F.col("display_name").alias("reviewer"),
        )
        .orderBy(*order)
        .limit(limit)
    )


def label_catalog_size(cat: Catalog, limit: int = 10, assume_keys: bool = True) -> DataFrame:
    """Labels by album count, then artist count (labels with none stay, as 0)."""
    albums = count_per_key(cat.label_album, "label_id", "album_id", "album_count", assume_keys=assume_keys)
    artists = count_per_key(cat.label_artist, "label_id", "artist_id", "artist_count", assume_keys=assume_keys)
    out = (
        cat.label.select("label_id", "name", "country")
        .join(albums, "label_id", "left")
        .join(artists, "label_id", "left")
        .select(
            "label_id",
            "name",
            "country",
            F.coalesce("album_count", F.lit(0)).cast("bigint").alias("album_count"),
            F.coalesce("artist_count", F.lit(0)).cast("bigint").alias("artist_count"),
        )
    )
    return out.orderBy(desc("album_count"), desc("artist_count"), asc("label_id")).limit(limit)


def genre_tree(cat: Catalog, limit: int = 50, collation: str | None = None) -> DataFrame:
    """Genres with their direct parent's name; roots (no parent) first."""
    by_parent = F.collate("parent_genre", collation) if collation else F.col("parent_genre")
    parent = cat.genre.select(F.col("genre_id").alias("parent_genre_id"), F.col("name").alias("parent_genre"))
    out = cat.genre.select("genre_id", "name", "description", "parent_genre_id").join(parent, "parent_genre_id", "left")
    return (
        out.orderBy(asc_nulls_first(by_parent), text_key("name", collation), asc("genre_id"))
        .limit(limit)
        .select("genre_id", "name", "description", "parent_genre")
    )
