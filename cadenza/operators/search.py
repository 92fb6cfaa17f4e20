"""Whole-table search: case-folded substring match, then top-k.

The match reads the trigram projection of the table where the catalog has one
and the term has three plain characters or more, and verifies the rows of the
term's rarest trigram; else it is a full parallel scan (a leading-wildcard
LIKE cannot use Parquet statistics). Both read only the columns the result
needs and give the same rows.
The sort key of every search lives on the searched table, so the top-k is
taken first and evaluated once (``top_rows``), and the bridge tables are
touched only for those k rows, via a broadcast of at most ``limit`` keys. The joined result (at most ``limit``
rows) is put back in order with ``orderBy + limit`` again, which plans as a
single take-ordered step instead of a range-partitioned global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions.ordering import asc, desc_nulls_last, text_key
from ..functions.roles import PLAIN_SEARCH, role_label
from ..functions.text import any_match
from ..plans.keys import bounded_broadcast, top_rows
from ..sources.projections import term_grams
from .common import artist_names, count_per_key, scope


def _top(df: DataFrame, order: list, limit: int) -> DataFrame:
    return df.orderBy(*order).limit(limit)


def matching(cat: Catalog, table: str, columns: list[str], term: str) -> DataFrame:
    """Rows of ``table`` of which one of ``columns`` matches ``term``.

    All trigrams of the term stand in every match, so the rows of the rarest
    one hold all matches; LIKE, on those rows, checks the rest.
    """
    postings, grams = cat.projection(f"search_{table}"), term_grams(term)
    if postings is None or grams is None:
        return cat[table].filter(any_match(columns, term))
    return postings.filter(F.col("gram") == _rarest(cat, table, grams)).drop("gram").filter(any_match(columns, term))


def _rarest(cat: Catalog, table: str, grams: list[str]) -> str:
    """The trigram with the fewest rows in the stored counts, which are of the base rows: a choice of what to read, not of results."""
    counts = cat.gram_counts(f"search_{table}")
    if counts is None or len(grams) == 1:
        return grams[0]
    stored = {r["gram"]: r["n"] for r in counts.filter(F.col("gram").isin(grams)).collect()}  # at most one row per trigram of the term
    return min(grams, key=lambda g: stored.get(g, 0))


def search_tracks(cat: Catalog, term: str, limit: int = 20, collation: str | None = None) -> DataFrame:
    """track_id, title, duration_sec, artists, explicit_flag; by title.

    ``collation`` orders the rows and the artist list linguistically instead of by code point.
    """
    order = [text_key("title", collation), asc("track_id")]
    hits = matching(cat, "track", ["title"], term).select("track_id", "title", "duration_sec", "explicit_flag")
    top = top_rows(hits, order, limit)
    names = artist_names(cat.track_artist, cat.artist, top.select("track_id"), bound=limit, collation=collation)
    return (
        top.join(bounded_broadcast(names, limit), "track_id", "left")
        .select("track_id", "title", "duration_sec", "artists", "explicit_flag")
        .orderBy(*order)
        .limit(limit)
    )


def search_artists(
    cat: Catalog, term: str, limit: int = 20, assume_keys: bool = True, collation: str | None = None
) -> DataFrame:
    """artist_id, name, country, type, formed_year, track_count; by name."""
    order = [text_key("name", collation), asc("artist_id")]
    hits = matching(cat, "artist", ["name"], term).select(
        F.col("user_id").alias("artist_id"), "name", "country", "type", "formed_year"
    )
    top = top_rows(hits, order, limit)
    credits = scope(cat.track_artist.select("artist_id", "track_id"), "artist_id", top, bound=limit)
    counts = count_per_key(credits, "artist_id", "track_id", "track_count", assume_keys=assume_keys)
    return (
        top.join(bounded_broadcast(counts, limit), "artist_id", "left")
        .select(
            "artist_id",
            "name",
            "country",
            "type",
            "formed_year",
            F.coalesce("track_count", F.lit(0)).cast("bigint").alias("track_count"),
        )
        .orderBy(*order)
        .limit(limit)
    )


def search_albums(
    cat: Catalog, term: str, limit: int = 20, assume_keys: bool = True, collation: str | None = None
) -> DataFrame:
    """album_id, title, release_date, explicit_flag, track_count; newest first."""
    order = [desc_nulls_last("release_date"), text_key("title", collation), asc("album_id")]
    hits = matching(cat, "album", ["title"], term).select("album_id", "title", "release_date", "explicit_flag")
    top = top_rows(hits, order, limit)
    on_album = scope(cat.track_album.select("album_id", "track_id"), "album_id", top, bound=limit)
    counts = count_per_key(on_album, "album_id", "track_id", "track_count", assume_keys=assume_keys)
    return (
        top.join(bounded_broadcast(counts, limit), "album_id", "left")
        .select(
            "album_id",
            "title",
            "release_date",
            "explicit_flag",
            F.coalesce("track_count", F.lit(0)).cast("bigint").alias("track_count"),
        )
        .orderBy(*order)
        .limit(limit)
    )


def search_users(cat: Catalog, term: str, limit: int = 20, collation: str | None = None) -> DataFrame:
    """user_id, username, email, join_date, country, role; by username.

    The term is matched against username or e-mail.
    """
    order = [text_key("username", collation), asc("user_id")]
    hits = matching(cat, "users", ["username", "email"], term).select("user_id", "username", "email", "join_date", "country")
    top = top_rows(hits, order, limit)
    keys = top.select("user_id")
    artists = scope(cat.artist.select("user_id"), "user_id", keys, bound=limit).select(
        "user_id", F.col("user_id").alias("artist_key")
    )
    consumers = scope(cat.consumer.select("user_id"), "user_id", keys, bound=limit).select(
        "user_id", F.col("user_id").alias("consumer_key")
    )
    return (
        top.join(bounded_broadcast(artists, limit), "user_id", "left")
        .join(bounded_broadcast(consumers, limit), "user_id", "left")
        .select(
            "user_id",
            "username",
            "email",
            "join_date",
            "country",
            role_label("artist_key", "consumer_key", PLAIN_SEARCH).alias("role"),
        )
        .orderBy(*order)
        .limit(limit)
    )


def search_producers(cat: Catalog, term: str, limit: int = 20, collation: str | None = None) -> DataFrame:
    """producer_id, name, country, birth_year, artist_alias; by name."""
    order = [text_key("name", collation), asc("producer_id")]
    hits = matching(cat, "producer", ["name"], term).select("producer_id", "name", "country", "birth_year", "artist_id")
    top = top_rows(hits, order, limit)
    alias = scope(
        cat.artist.select(F.col("user_id").alias("artist_id"), F.col("name").alias("artist_alias")),
        "artist_id",
        top,
        bound=limit,
    )
    return (
        top.join(bounded_broadcast(alias, limit), "artist_id", "left")
        .select("producer_id", "name", "country", "birth_year", "artist_alias")
        .orderBy(*order)
        .limit(limit)
    )


def search_labels(
    cat: Catalog, term: str, limit: int = 20, assume_keys: bool = True, collation: str | None = None
) -> DataFrame:
    """label_id, name, country, founded_year, website, album_count, artist_count."""
    order = [text_key("name", collation), asc("label_id")]
    hits = matching(cat, "label", ["name"], term).select("label_id", "name", "country", "founded_year", "website")
    top = top_rows(hits, order, limit)
    albums = count_per_key(
        scope(cat.label_album.select("label_id", "album_id"), "label_id", top, bound=limit),
        "label_id",
        "album_id",
        "album_count",
        assume_keys=assume_keys,
    )
    artists = count_per_key(
        scope(cat.label_artist.select("label_id", "artist_id"), "label_id", top, bound=limit),
        "label_id",
        "artist_id",
        "artist_count",
        assume_keys=assume_keys,
    )
    return (
        top.join(bounded_broadcast(albums, limit), "label_id", "left")
        .join(bounded_broadcast(artists, limit), "label_id", "left")
        .select(
            "label_id",
            "name",
            "country",
            "founded_year",
            "website",
            F.coalesce("album_count", F.lit(0)).cast("bigint").alias("album_count"),
            F.coalesce("artist_count", F.lit(0)).cast("bigint").alias("artist_count"),
        )
        .orderBy(*order)
        .limit(limit)
    )


def search_rightsholders(cat: Catalog, term: str, limit: int = 20, collation: str | None = None) -> DataFrame:
    """rights_id, holder_name, pro_affiliation, contact_email; by holder name."""
    order = [text_key("holder_name", collation), asc("rights_id")]
    hits = matching(cat, "rights_holder", ["holder_name"], term).select("rights_id", "holder_name", "pro_affiliation", "contact_email")
    return _top(hits, order, limit)


def find_groups(cat: Catalog, term: str, limit: int = 10, collation: str | None = None) -> DataFrame:
    """group_id, name of matching artists that have at least one member."""
    order = [text_key("name", collation), asc("group_id")]
    groups = cat.artist_member.select(F.col("group_artist_id").alias("group_id")).distinct()
    hits = (
        matching(cat, "artist", ["name"], term)
        .select(F.col("user_id").alias("group_id"), "name")
        .join(groups, "group_id", "left_semi")
    )
    return _top(hits, order, limit)


def find_consumers(cat: Catalog, term: str, limit: int = 10, collation: str | None = None) -> DataFrame:
    """consumer_id, display_name, username; term on display name or username.

    Each side is searched by itself; the keys found on either side then cut
    both tables before they meet.
    """
    order = [text_key("display_name", collation), asc("consumer_id")]
    by_name = matching(cat, "consumer", ["display_name"], term).select("user_id")
    by_user = matching(cat, "users", ["username"], term).select("user_id")
    found = by_name.unionByName(by_user).distinct()
    consumers = cat.consumer.select("user_id", "display_name").join(found, "user_id", "left_semi")
    users = cat.users.select("user_id", "username").join(found, "user_id", "left_semi")
    hits = consumers.join(users, "user_id").withColumnRenamed("user_id", "consumer_id")
    return _top(hits, order, limit).select("consumer_id", "display_name", "username")


def top_keys(df: DataFrame, key: str, limit: int) -> DataFrame:
    """A search result's key column, broadcastable (at most ``limit`` rows)."""
    return bounded_broadcast(df.select(key), limit)


# ---------------------------------------------------------------- search, then drill down


def group_members_by_name(cat: Catalog, term: str, limit: int = 10, collation: str | None = None) -> DataFrame:
    """Members of the groups ``find_groups`` returns for ``term`` (key set = its ids)."""
    from .credits import group_members

    groups = find_groups(cat, term, limit, collation)
    return group_members(cat, bounded_broadcast(groups.select("group_id"), limit), collation=collation)


def consumer_reviews_by_name(cat: Catalog, term: str, limit: int = 10, collation: str | None = None) -> DataFrame:
    """Reviews of the consumers ``find_consumers`` returns for ``term``."""
    from .credits import consumer_reviews

    found = find_consumers(cat, term, limit, collation)
    return consumer_reviews(cat, bounded_broadcast(found.select("consumer_id"), limit))
