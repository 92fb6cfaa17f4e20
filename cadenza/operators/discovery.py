"""Look-ups the reference declares (indexes, comments) without a query.

Tempo/key discovery over the audio-feature columns, ISRC look-up, a
whole-word title search next to the substring one, and one canonical ISRC
per track.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions.ordering import asc, desc, text_key
from ..functions.text import whole_word_match
from ..plans.keys import bounded_broadcast, top_rows
from .common import artist_names


def tracks_by_audio(
    cat: Catalog,
    bpm_lo: float | None = None,
    bpm_hi: float | None = None,
    key: str | None = None,
    mode: str | None = None,
) -> DataFrame:
    """track_id, title, bpm, key, mode for tracks in a tempo range (bounds inclusive).

    The range and equality predicates reach the Parquet scan as pushed
    filters. The stored table is in the order of its keys, so they skip
    little of it; where the catalog has the projection ``audio_track``
    (stored in a space-filling order of tempo, key and mode) that is read
    instead, and row groups and pages apart from the asked range are skipped
    whichever of the three is asked for.
    """
    stored = cat.projection("audio_track")
    df = (cat.track if stored is None else stored).select("track_id", "title", "bpm", "key", "mode")
    if bpm_lo is not None:
        df = df.filter(F.col("bpm") >= F.lit(bpm_lo).cast("decimal(6,2)"))
    if bpm_hi is not None:
        df = df.filter(F.col("bpm") <= F.lit(bpm_hi).cast("decimal(6,2)"))
    if key is not None:
        df = df.filter(F.col("key") == key)
    if mode is not None:
        df = df.filter(F.col("mode") == mode)
    return df.orderBy(asc("bpm"), asc("track_id"))


def tracks_by_isrc(cat: Catalog, isrcs: list[str] | DataFrame | None = None) -> DataFrame:
    """isrc, track_id, title, is_primary for the given ISRCs (``None`` = all)."""
    ti = cat.track_isrc.select("isrc", "track_id", "is_primary")
    if isinstance(isrcs, DataFrame):
        ti = ti.join(isrcs.select(F.col(isrcs.columns[0]).alias("isrc")), "isrc", "left_semi")
    elif isrcs is not None:
        ti = ti.filter(F.col("isrc").isin(sorted(set(isrcs))))
    return (
        ti.join(cat.track.select("track_id", "title"), "track_id")
        .select("isrc", "track_id", "title", "is_primary")
        .orderBy(asc("isrc"), asc("track_id"))
    )


def search_tracks_word(cat: Catalog, term: str, limit: int = 20, collation: str | None = None) -> DataFrame:
    """Like ``search_tracks`` but the term must stand as a whole word."""
    order = [text_key("title", collation), asc("track_id")]
    hits = cat.track.select("track_id", "title", "duration_sec", "explicit_flag").filter(whole_word_match("title", term))
    top = top_rows(hits, order, limit)
    names = artist_names(cat.track_artist, cat.artist, top.select("track_id"), bound=limit, collation=collation)
    return (
        top.join(bounded_broadcast(names, limit), "track_id", "left")
        .select("track_id", "title", "duration_sec", "artists", "explicit_flag")
        .orderBy(*order)
        .limit(limit)
    )


def canonical_isrc(cat: Catalog) -> DataFrame:
    """track_id, isrc: one ISRC per track, primary ones first, then the smallest.

    ``min_by`` over a (not-primary, isrc) struct is a partial aggregate, so a
    track with very many codes is reduced map-side.
    """
    rank = F.struct((~F.coalesce(F.col("is_primary"), F.lit(False))).alias("secondary"), F.col("isrc"))
    return (
        cat.track_isrc.filter(F.col("isrc").isNotNull())
        .groupBy("track_id")
        .agg(F.min_by("isrc", rank).alias("isrc"))
        .orderBy(asc("track_id"))
    )


def primary_isrc_conflicts(cat: Catalog) -> DataFrame:
    """track_id, primary_count for tracks that do not have exactly one primary ISRC."""
    counts = cat.track_isrc.groupBy("track_id").agg(
        F.count(F.when(F.col("is_primary"), 1)).alias("primary_count")
    )
    return counts.filter(F.col("primary_count") != 1).orderBy(desc("primary_count"), asc("track_id"))
