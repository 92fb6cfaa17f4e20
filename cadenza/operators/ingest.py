"""Write jobs: batches of requests in, validated rows and rejects out.

The reference inserts one row per interactive prompt. Here a batch of
requests is validated set-wise (semi/anti joins against the catalog),
accepted rows get dense new ids, and every job returns DataFrames: the
rows to append to each target table plus the rejects with a reason.
Committing them (appending to the stored tables) is the caller's step;
``streaming.feeds`` does it per micro-batch.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions.ordering import asc
from ..plans.ids import assign_ids

# Answers read as "public" when creating a playlist; a
# missing answer takes the default "yes".
PUBLIC_ANSWERS = ("yes", "y", "true")

REVIEW_REQUEST_COLUMNS = ("request_id", "consumer_id", "track_id", "rating", "review_text")
PLAYLIST_REQUEST_COLUMNS = ("request_id", "user_id", "name", "description", "public")
REQUEST_TYPES = {
    "request_id": "bigint",
    "add_id": "bigint",
    "consumer_id": "bigint",
    "user_id": "bigint",
    "track_id": "bigint",
    "playlist_id": "bigint",
    "rating": "int",
    "review_text": "string",
    "name": "string",
    "description": "string",
    "public": "string",
}


def _requests(df: DataFrame, columns) -> DataFrame:
    """The request columns, cast to the catalog's types (CSV inference may differ)."""
    return df.select(*[F.col(c).cast(REQUEST_TYPES[c]).alias(c) for c in columns])


def _ts(value: dt.datetime | str | None) -> Column:
    if value is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(value if isinstance(value, str) else value.isoformat(sep=" ")).cast("timestamp_ntz")


def _date(value: dt.date | str | None) -> Column:
    if value is None:
        return F.current_date()
    return F.lit(str(value)).cast("date")


def _exists(df: DataFrame, column: str, parent: DataFrame, parent_column: str, flag: str) -> DataFrame:
    """Add boolean ``flag``: does ``column`` have a row in ``parent``?"""
    return _found(df, [column], parent.select(F.col(parent_column).alias(column)), flag)


def _found(df: DataFrame, keys: list[str], parent: DataFrame, flag: str) -> DataFrame:
    """Add boolean ``flag``: are the ``keys`` of the row among the rows of ``parent``?

    A semi and an anti join, so a key that ``parent`` repeats (Parquet
    enforces none) multiplies no request. Both share their shuffles, and with
    plain shuffles on both sides adaptive execution splits a key that very
    many requests name.
    """
    hit = df.join(parent, keys, "left_semi").withColumn(flag, F.lit(True))
    return hit.unionByName(df.join(parent, keys, "left_anti").withColumn(flag, F.lit(False)))


def _first_failure(checks: list[tuple[Column, str]]) -> Column:
    """Reason of the first failing check, NULL when all pass."""
    expr = None
    for ok, reason in reversed(checks):
        expr = F.when(~ok, F.lit(reason)).otherwise(expr if expr is not None else F.lit(None).cast("string"))
    return expr


def _max_id(df: DataFrame, column: str) -> Column:
    """Current maximum id as a scalar subquery (0 for an empty table)."""
    return df.select(F.coalesce(F.max(column), F.lit(0)).cast("bigint")).scalar()


@dataclass(frozen=True)
class ReviewBatch:
    review: DataFrame  # new Review rows
    written_by: DataFrame  # (consumer_id, review_id)
    gets: DataFrame  # (review_id, track_id)
    rejects: DataFrame  # (request_id, reason)


def validate_review_requests(cat: Catalog, requests: DataFrame, rating_range: tuple[int, int] = (1, 5)) -> DataFrame:
    """Requests with ``reason`` (NULL = accepted).

    Checks in the reference's order: the track exists, the rating is within
    ``rating_range``, the consumer exists.
    """
    lo, hi = rating_range
    req = _requests(requests, REVIEW_REQUEST_COLUMNS)
    req = _exists(req, "track_id", cat.track, "track_id", "_track_ok")
    req = _exists(req, "consumer_id", cat.consumer, "user_id", "_consumer_ok")
    rating_ok = F.coalesce(F.col("rating").between(lo, hi), F.lit(False))
    return req.withColumn(
        "reason",
        _first_failure(
            [
                (F.col("_track_ok"), "unknown track"),
                (rating_ok, "rating out of range"),
                (F.col("_consumer_ok"), "unknown consumer"),
            ]
        ),
    ).drop("_track_ok", "_consumer_ok")


def ingest_reviews(
    cat: Catalog,
    requests: DataFrame,
    rating_range: tuple[int, int] = (1, 5),
    batch_ts: dt.datetime | str | None = None,
) -> ReviewBatch:
    """Validate review requests and build the three insert sets.

    An empty text is stored as NULL. All accepted reviews share
    ``batch_ts`` (default: now). New ids follow the current maximum in
    request order. The three outputs are projections of one accepted set,
    materialised once in the shared checkpoint folder by the id assignment,
    so all three see the same evaluation (one timestamp, one numbering) even
    if a task is retried after an executor loss.
    """
    checked = validate_review_requests(cat, requests, rating_range)
    accepted = checked.filter(F.col("reason").isNull()).select(
        "request_id",
        F.col("rating").cast("int").alias("rating"),
        F.when(F.col("review_text") == "", F.lit(None)).otherwise(F.col("review_text")).alias("review_text"),
        _ts(batch_ts).alias("created_at"),
        "consumer_id",
        "track_id",
    )
    numbered = assign_ids(accepted, ["request_id"], "review_id", _max_id(cat.review, "review_id"))
    review = numbered.select("review_id", "rating", "review_text", "created_at", "consumer_id", "track_id")
    return ReviewBatch(
        review=review,
        written_by=numbered.select("consumer_id", "review_id"),
        gets=numbered.select("review_id", "track_id"),
        rejects=checked.filter(F.col("reason").isNotNull()).select("request_id", "reason"),
    )


@dataclass(frozen=True)
class PlaylistBatch:
    playlist: DataFrame
    makes: DataFrame
    rejects: DataFrame


def ingest_playlists(
    cat: Catalog,
    requests: DataFrame,
    batch_date: dt.date | str | None = None,
) -> PlaylistBatch:
    """Validate playlist requests: a name is required and the user must exist.

    Empty descriptions become NULL; ``public`` reads yes/y/true (any case)
    as public, a missing answer as the default "yes".
    """
    checked, numbered = _number_playlists(cat, requests, batch_date)
    return PlaylistBatch(
        playlist=numbered.select(*NEW_PLAYLIST),
        makes=numbered.select("user_id", "playlist_id"),
        rejects=checked.filter(F.col("reason").isNotNull()).select("request_id", "reason"),
    )


NEW_PLAYLIST = ("playlist_id", "name", "description", "created_date", "is_public", "user_id")


def _number_playlists(cat: Catalog, requests: DataFrame, batch_date: dt.date | str | None) -> tuple[DataFrame, DataFrame]:
    """Playlist requests with ``reason``, and the accepted ones with their ids (written once)."""
    req = _requests(requests, PLAYLIST_REQUEST_COLUMNS)
    req = _exists(req, "user_id", cat.users, "user_id", "_user_ok")
    name_ok = F.coalesce(F.col("name") != "", F.lit(False))
    checked = req.withColumn(
        "reason", _first_failure([(name_ok, "name required"), (F.col("_user_ok"), "unknown user")])
    ).drop("_user_ok")
    answer = F.lower(F.coalesce(F.nullif(F.col("public"), F.lit("")), F.lit("yes")))
    accepted = checked.filter(F.col("reason").isNull()).select(
        "request_id",
        "name",
        F.when(F.col("description") == "", F.lit(None)).otherwise(F.col("description")).alias("description"),
        _date(batch_date).alias("created_date"),
        answer.isin(*PUBLIC_ANSWERS).alias("is_public"),
        "user_id",
    )
    return checked, assign_ids(accepted, ["request_id"], "playlist_id", _max_id(cat.playlist, "playlist_id"))


@dataclass(frozen=True)
class PlaylistWithTracksBatch:
    playlist: DataFrame
    makes: DataFrame
    playlist_track: DataFrame
    rejects: DataFrame  # (kind 'playlist' / 'track', request_id, add_id, reason)


def ingest_playlists_with_tracks(
    cat: Catalog,
    requests: DataFrame,
    adds: DataFrame,
    batch_date: dt.date | str | None = None,
    batch_ts: dt.datetime | str | None = None,
) -> PlaylistWithTracksBatch:
    """Create playlists and put their first tracks on them, in one job.

    ``adds`` has add_id, request_id, playlist_id and track_id. A row with a
    request_id goes to the playlist that this request of the same batch
    creates, one without to the stored playlist ``playlist_id``. Playlists
    are accepted and numbered first; then every add succeeds or fails alone,
    as in ``playlist_add``, and a failed add leaves its playlist in place.
    Adds of a rejected request fail with 'playlist not created'. A
    request_id names one request of the batch.
    """
    checked, numbered = _number_playlists(cat, requests, batch_date)
    req = adds.select(*[F.col(c).cast(REQUEST_TYPES[c]).alias(c) for c in ("add_id", "request_id", "playlist_id", "track_id")])
    created = numbered.select("request_id", F.col("playlist_id").alias("_created"))
    to_new = req.filter(F.col("request_id").isNotNull()).join(created, "request_id", "left")
    to_new = to_new.select("add_id", "request_id", F.col("_created").alias("playlist_id"), "track_id", F.col("_created").isNotNull().alias("_pl_ok"))
    to_stored = _exists(req.filter(F.col("request_id").isNull()), "playlist_id", cat.playlist, "playlist_id", "_pl_ok")
    unknown = F.col("_pl_ok") | F.col("request_id").isNull()
    both = _check_adds(
        cat, to_new.unionByName(to_stored), [(unknown, "playlist not created"), (F.col("_pl_ok"), "unknown playlist")], "add_id"
    )
    rejected = both.filter(F.col("reason").isNotNull()).select(F.lit("track").alias("kind"), "request_id", "add_id", "reason")
    refused = checked.filter(F.col("reason").isNotNull()).select(
        F.lit("playlist").alias("kind"), "request_id", F.lit(None).cast("bigint").alias("add_id"), "reason"
    )
    return PlaylistWithTracksBatch(
        playlist=numbered.select(*NEW_PLAYLIST),
        makes=numbered.select("user_id", "playlist_id"),
        playlist_track=both.filter(F.col("reason").isNull()).select("playlist_id", "track_id", _ts(batch_ts).alias("added_at")),
        rejects=refused.unionByName(rejected),
    )


@dataclass(frozen=True)
class PlaylistAdds:
    added: DataFrame  # new playlist_track rows
    rejects: DataFrame  # (request_id, playlist_id, track_id, reason)


def playlist_add(cat: Catalog, requests: DataFrame, batch_ts: dt.datetime | str | None = None) -> PlaylistAdds:
    """Add (playlist_id, track_id) pairs; each request succeeds or fails alone.

    Rejects: unknown playlist, unknown track, pair already on the playlist,
    or a repeat of an earlier request for the same pair in this batch.
    ``requests`` has request_id, playlist_id, track_id.
    """
    requests = _requests(requests, ("request_id", "playlist_id", "track_id"))
    req = _exists(requests, "playlist_id", cat.playlist, "playlist_id", "_pl_ok")
    checked = _check_adds(cat, req, [(F.col("_pl_ok"), "unknown playlist")])
    added = checked.filter(F.col("reason").isNull()).select("playlist_id", "track_id", _ts(batch_ts).alias("added_at"))
    rejects = checked.filter(F.col("reason").isNotNull()).select("request_id", "playlist_id", "track_id", "reason")
    return PlaylistAdds(added, rejects)


def _check_adds(cat: Catalog, req: DataFrame, playlist_checks: list[tuple[Column, str]], order: str = "request_id") -> DataFrame:
    """Adds with ``reason`` (NULL = accepted): the playlist's checks, then the track, the pair, and earlier adds of the batch."""
    pair = ["playlist_id", "track_id"]
    req = _exists(req, "track_id", cat.track, "track_id", "_tr_ok")
    req = _found(req, pair, cat.playlist_track.select(*pair), "_present")
    # First request per pair: a partial aggregate (a pair requested very
    # often is combined map-side), not a window over the whole group.
    firsts = req.groupBy(*pair).agg(F.min(order).alias("_first_id"))
    req = req.join(firsts, pair, "left").withColumn("_first", F.col(order) == F.col("_first_id"))
    return req.withColumn(
        "reason",
        _first_failure(
            [
                *playlist_checks,
                (F.col("_tr_ok"), "unknown track"),
                (~F.col("_present"), "already on playlist"),
                (F.col("_first"), "duplicate in batch"),
            ]
        ),
    )


@dataclass(frozen=True)
class PlaylistRemovals:
    remaining: DataFrame  # playlist_track after the removals
    removed: DataFrame  # rows removed (the RETURNING set)
    rejects: DataFrame  # requests whose pair was not on the playlist (any more)


def playlist_remove(cat: Catalog, pairs: DataFrame) -> PlaylistRemovals:
    """Remove (playlist_id, track_id) pairs from playlist_track.

    With a ``request_id`` each request is answered by itself: the first one
    for a pair (by request_id) removes it, a later one finds it gone and is
    rejected. Without one a rejected pair is listed once.
    """
    pair = ["playlist_id", "track_id"]
    answered = "request_id" in pairs.columns
    asked = _requests(pairs, ("request_id", *pair) if answered else pair)
    keys = asked.select(*pair).distinct()  # on the right below, where a pair asked for very often could not be split
    pt = cat.playlist_track
    if answered:
        firsts = asked.groupBy(*pair).agg(F.min("request_id").alias("_first_id"))
        rejects = (
            _found(asked, pair, pt.select(*pair), "_present")
            .join(firsts, pair)
            .filter(~F.col("_present") | (F.col("request_id") != F.col("_first_id")))
            .select("request_id", *pair)
        )
    else:
        rejects = keys.join(pt.select(*pair), pair, "left_anti")
    return PlaylistRemovals(
        remaining=pt.join(keys, pair, "left_anti"),
        removed=pt.join(keys, pair, "left_semi"),
        rejects=rejects.withColumn("reason", F.lit("not on playlist")),
    )


_BEFORE_ALL = -(2**63)  # sequence number given to rows present before the batch


def apply_playlist_changes(cat: Catalog, changes: DataFrame) -> DataFrame:
    """Replay a log of adds and removes onto playlist_track, set-wise.

    ``changes``: playlist_id, track_id, op ('add' / 'remove'), seq, ts.
    Adds naming an unknown playlist or track fail and change nothing.
    Existing rows count as adds before every change. Per pair, the last
    remove wins over everything before it; the pair is present afterwards
    iff some add comes after that remove, and its ``added_at`` is the
    ``ts`` of the first such add (a second add while present is a key
    violation and changes nothing). Two grouped aggregates, no replay loop;
    pairs the log does not touch pass through without being regrouped.
    """
    pair = ["playlist_id", "track_id"]
    log = changes.select(*[F.col(c).cast("bigint").alias(c) for c in pair], "op", F.col("seq").cast("bigint").alias("seq"), F.col("ts").cast("timestamp_ntz").alias("ts"))
    adds = (
        log.filter(F.col("op") == "add")
        .join(cat.playlist.select("playlist_id"), "playlist_id", "left_semi")
        .join(cat.track.select("track_id"), "track_id", "left_semi")
        .select(*pair, "seq", "ts")
    )
    last_remove = log.filter(F.col("op") == "remove").groupBy(*pair).agg(F.max("seq").alias("last_remove"))
    touched = log.select(*pair).distinct()
    pt = cat.playlist_track.select(*pair, "added_at")
    untouched = pt.join(touched, pair, "left_anti")
    before = pt.join(touched, pair, "left_semi").select(*pair, F.lit(_BEFORE_ALL).alias("seq"), F.col("added_at").alias("ts"))
    candidates = before.unionByName(adds).join(last_remove, pair, "left").filter(
        F.col("last_remove").isNull() | (F.col("seq") > F.col("last_remove"))
    )
    survivors = candidates.groupBy(*pair).agg(F.min_by("ts", "seq").alias("added_at"))
    return untouched.unionByName(survivors)
