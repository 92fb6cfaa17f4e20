"""Projections: a table stored once more, in the order of another look-up.

``search_<table>`` holds one row per trigram of the searched text with the
columns that the search returns, ordered by trigram: a substring search reads
the rows of the rarest trigram of its term and verifies them by LIKE, instead
of scanning the table. ``audio_track`` holds the audio features in a
space-filling order of tempo, key and mode, so filters on any of the three
skip row groups and pages by their statistics.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import column_names

GRAM = 3

# The columns each search matches.
SEARCHED: dict[str, tuple[str, ...]] = {
    "track": ("title",),
    "artist": ("name",),
    "album": ("title",),
    "users": ("username", "email"),
    "consumer": ("display_name",),
    "producer": ("name",),
    "label": ("name",),
    "rights_holder": ("holder_name",),
}
AUDIO_COLUMNS = ("track_id", "title", "bpm", "key", "mode")


@dataclass(frozen=True)
class Projection:
    table: str
    build: Callable[[DataFrame], DataFrame]
    order: tuple[str, ...]
    counted: bool = False  # keep the number of rows per trigram beside it


def folded(column: str | Column) -> Column:
    """The text that a search compares: lower case, NULL as empty."""
    c = F.col(column) if isinstance(column, str) else column
    return F.lower(F.coalesce(c, F.lit("")))


def trigrams(*columns: str | Column) -> Column:
    """Array of the different trigrams of the folded texts (empty for shorter texts)."""
    return F.array_distinct(F.concat(*map(_grams, columns)))


def _grams(column: str | Column) -> Column:
    text = folded(column)
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (GRAM - 1), F.lit(1)))
    grams = F.transform(starts, lambda i: text.substr(i, F.lit(GRAM)))
    return F.filter(grams, lambda g: F.length(g) == GRAM)


def _postings(table: str) -> Projection:
    columns = column_names(table)

    def build(df: DataFrame) -> DataFrame:
        return df.select(F.explode(trigrams(*SEARCHED[table])).alias("gram"), *columns)

    return Projection(table, build, ("gram", SEARCHED[table][0]), counted=True)


# The bits of tempo (8), key (4) and mode (2), taken in turn from the highest down.
_BIT_ORDER = ("b7", "k3", "m1", "b6", "k2", "m0", "b5", "k1", "b4", "k0", "b3", "b2", "b1", "b0")


def audio_order(bpm: str = "bpm", key: str = "key", mode: str = "mode") -> Column:
    """Place on a Z-order curve over tempo, key (by its first letter) and mode; NULLs lie at 0, unknown modes at the end."""
    codes = {
        "b": F.least(F.greatest(F.floor(F.coalesce(F.col(bpm), F.lit(0))).cast("int"), F.lit(0)), F.lit(255)),
        "k": F.coalesce(F.ascii(F.col(key)), F.lit(64)).bitwiseAND(15),
        "m": F.when(F.col(mode) == "major", 1).when(F.col(mode) == "minor", 2).when(F.col(mode).isNull(), 0).otherwise(3),
    }
    place = F.lit(0)
    for name in _BIT_ORDER:
        bit = F.shiftright(codes[name[0]], int(name[1])).bitwiseAND(1)
        place = place * 2 + bit
    return place


def _audio(df: DataFrame) -> DataFrame:
    return df.select(audio_order().alias("place"), *AUDIO_COLUMNS)


PROJECTIONS: dict[str, Projection] = {f"search_{t}": _postings(t) for t in SEARCHED} | {
    "audio_track": Projection("track", _audio, ("place", "bpm"))
}


def gram_counts(postings: DataFrame) -> DataFrame:
    return postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


def term_grams(term: str) -> list[str] | None:
    """Trigrams that every match of ``term`` holds; None if there are none or the term has wildcards.

    Terms that are not plain ASCII keep the scan: how the engine folds them
    is its own matter.
    """
    if len(term) < GRAM or not term.isascii() or any(c in term for c in "%_\\"):
        return None
    low = term.lower()
    return sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})
