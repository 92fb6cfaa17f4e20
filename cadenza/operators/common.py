"""Building blocks shared by the operators: per-key counts and name lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import collated_names, distinct_names
from ..plans.keys import bounded_broadcast


def count_per_key(bridge: DataFrame, key: str, value: str, alias: str, *, assume_keys: bool = True) -> DataFrame:
    """``COUNT(DISTINCT value)`` per ``key`` over a bridge table.

    Junction tables carry a composite primary key, so the distinct count
    equals a plain count and needs no second aggregation level. With
    ``assume_keys=False`` the distinct count is computed for real.
    """
    agg = F.count(value) if assume_keys else F.count_distinct(value)
    return bridge.groupBy(key).agg(agg.alias(alias))


def scope(df: DataFrame, key: str, keys: DataFrame | None, bound: int | None = None) -> DataFrame:
    """Restrict ``df`` to the keys in ``keys`` (``None`` = no restriction).

    ``bound`` is a static upper bound of the key rows (e.g. a top-k limit);
    only then is the key side broadcast by hint.
    """
    if keys is None:
        return df
    return df.join(bounded_broadcast(keys.select(key), bound), key, "left_semi")


def name_list(named: DataFrame, key: str, alias: str, collation: str | None = None) -> DataFrame:
    """``key -> 'a, b, ...'`` over (key, name) rows: distinct, sorted, NULL if none.

    Binary order by default (the oracle's order). With a ``collation`` (e.g.
    'UNICODE', linguistic: Alena, Aleš, Alex) the pairs are deduplicated
    first, since Spark allows no DISTINCT next to a collated order.
    """
    if collation is None:
        return named.groupBy(key).agg(distinct_names("name").alias(alias))
    pairs = named.filter(F.col("name").isNotNull()).select(key, "name").distinct()
    return pairs.groupBy(key).agg(collated_names("name", collation).alias(alias))


def artist_names(
    track_artist: DataFrame,
    artist: DataFrame,
    track_keys: DataFrame | None = None,
    bound: int | None = None,
    alias: str = "artists",
    collation: str | None = None,
) -> DataFrame:
    """``track_id -> 'name, name, ...'`` (distinct, sorted, NULL if none).

    Bridge rows are cut to the wanted tracks before the artist join, so a
    top-k caller only touches the credits of its k tracks.
    """
    ta = scope(track_artist.select("track_id", "artist_id"), "track_id", track_keys, bound)
    named = ta.join(artist.select(F.col("user_id").alias("artist_id"), "name"), "artist_id")
    return name_list(named, "track_id", alias, collation)


def genre_names(
    track_genre: DataFrame,
    genre: DataFrame,
    track_keys: DataFrame | None = None,
    bound: int | None = None,
    alias: str = "genres",
    collation: str | None = None,
) -> DataFrame:
    tg = scope(track_genre.select("track_id", "genre_id"), "track_id", track_keys, bound)
    named = tg.join(genre.select("genre_id", "name"), "genre_id")
    return name_list(named, "track_id", alias, collation)
