"""User role label derived from the IS-A tables (artist, consumer)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Role labels of the user search and profile queries.
BOTH = "Artist + Consumer"
ARTIST = "Artist"
CONSUMER = "Consumer"
PLAIN_SEARCH = "User"
PLAIN_PROFILE = "User only"


def role_label(artist_key: str | Column, consumer_key: str | Column, plain: str = PLAIN_SEARCH) -> Column:
    """CASE over the presence of the user in ``artist`` and ``consumer``."""
    a = F.col(artist_key) if isinstance(artist_key, str) else artist_key
    c = F.col(consumer_key) if isinstance(consumer_key, str) else consumer_key
    return (
        F.when(a.isNotNull() & c.isNotNull(), F.lit(BOTH))
        .when(a.isNotNull(), F.lit(ARTIST))
        .when(c.isNotNull(), F.lit(CONSUMER))
        .otherwise(F.lit(plain))
    )
