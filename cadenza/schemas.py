"""Catalog data model: table schemas, keys and foreign keys, held as data.

Every table is declared once here. Readers conform incoming data to these
schemas (``conform``), the integrity jobs walk ``PRIMARY_KEYS`` /
``UNIQUES`` / ``FOREIGN_KEYS`` and the cascade job walks the same graph.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Spark DDL per table. Keys are BIGINT, other whole numbers INT, timestamps
# have no zone. Columns that no operator ever projects (password hashes,
# external gids, bios) are optional: ``conform`` keeps them when present.
TABLE_DDL: dict[str, str] = {
    "users": "user_id BIGINT, username STRING, email STRING, join_date DATE, country STRING",
    "artist": "user_id BIGINT, name STRING, country STRING, formed_year INT, type STRING",
    "consumer": "user_id BIGINT, display_name STRING",
    "album": "album_id BIGINT, title STRING, release_date DATE, explicit_flag BOOLEAN",
    "track": (
        "track_id BIGINT, title STRING, duration_sec INT, bpm DECIMAL(6,2), key STRING, "
        "mode STRING, explicit_flag BOOLEAN"
    ),
    "genre": "genre_id BIGINT, name STRING, description STRING, parent_genre_id BIGINT",
    "label": "label_id BIGINT, name STRING, country STRING, founded_year INT, website STRING",
    "rights_holder": "rights_id BIGINT, holder_name STRING, pro_affiliation STRING, contact_email STRING",
    "producer": "producer_id BIGINT, name STRING, country STRING, birth_year INT, artist_id BIGINT",
    "playlist": "playlist_id BIGINT, name STRING, created_date DATE, is_public BOOLEAN, user_id BIGINT",
    "review": (
        "review_id BIGINT, rating INT, review_text STRING, created_at TIMESTAMP_NTZ, "
        "consumer_id BIGINT, track_id BIGINT"
    ),
    "makes": "user_id BIGINT, playlist_id BIGINT",
    "playlist_track": "playlist_id BIGINT, track_id BIGINT, added_at TIMESTAMP_NTZ",
    "consumer_track_rating": "user_id BIGINT, track_id BIGINT, rating INT, rated_at TIMESTAMP_NTZ",
    "written_by": "consumer_id BIGINT, review_id BIGINT",
    "gets": "review_id BIGINT, track_id BIGINT",
    "may_be": "artist_id BIGINT, producer_id BIGINT",
    "track_artist": "track_id BIGINT, artist_id BIGINT, role STRING",
    "track_songwriter": "track_id BIGINT, artist_id BIGINT, contribution STRING",
    "artist_member": (
        "group_artist_id BIGINT, member_artist_id BIGINT, instrument STRING, join_year INT, leave_year INT"
    ),
    "track_album": "track_id BIGINT, album_id BIGINT, track_number INT",
    "label_album": "label_id BIGINT, album_id BIGINT",
    "label_artist": "label_id BIGINT, artist_id BIGINT, start_year INT, end_year INT",
    "track_producer": "track_id BIGINT, producer_id BIGINT, credit_type STRING",
    "track_genre": "track_id BIGINT, genre_id BIGINT",
    "track_rights_holder": "track_id BIGINT, rights_id BIGINT, rights_type STRING, percentage DOUBLE",
    "track_isrc": "track_id BIGINT, isrc STRING, is_primary BOOLEAN",
}

TABLES: tuple[str, ...] = tuple(TABLE_DDL)

OPTIONAL_DDL: dict[str, str] = {
    "users": "password_hash STRING",
    "artist": "bio STRING, mb_artist_gid STRING",
    "album": "mb_release_group_gid STRING",
    "track": "isrc STRING, mb_recording_gid STRING",
    "genre": "mb_genre_gid STRING",
    "label": "mb_label_gid STRING",
    "producer": "bio STRING, mb_artist_gid STRING",
    "playlist": "description STRING",
}

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "users": ("user_id",),
    "artist": ("user_id",),
    "consumer": ("user_id",),
    "album": ("album_id",),
    "track": ("track_id",),
    "genre": ("genre_id",),
    "label": ("label_id",),
    "rights_holder": ("rights_id",),
    "producer": ("producer_id",),
    "playlist": ("playlist_id",),
    "review": ("review_id",),
    "makes": ("user_id", "playlist_id"),
    "playlist_track": ("playlist_id", "track_id"),
    "consumer_track_rating": ("user_id", "track_id"),
    "written_by": ("consumer_id", "review_id"),
    "gets": ("review_id", "track_id"),
    "may_be": ("artist_id", "producer_id"),
    "track_artist": ("track_id", "artist_id"),
    "track_songwriter": ("track_id", "artist_id"),
    "artist_member": ("group_artist_id", "member_artist_id"),
    "track_album": ("track_id", "album_id"),
    "label_album": ("label_id", "album_id"),
    "label_artist": ("label_id", "artist_id"),
    "track_producer": ("track_id", "producer_id"),
    "track_genre": ("track_id", "genre_id"),
    "track_rights_holder": ("track_id", "rights_id"),
    "track_isrc": ("track_id", "isrc"),
}

# Single-column UNIQUE constraints (NULLs may repeat). All of them sit on
# optional columns; a check on an absent column reports nothing.
UNIQUES: tuple[tuple[str, str], ...] = (
    ("artist", "mb_artist_gid"),
    ("album", "mb_release_group_gid"),
    ("track", "isrc"),
    ("track", "mb_recording_gid"),
    ("genre", "mb_genre_gid"),
    ("label", "mb_label_gid"),
    ("producer", "mb_artist_gid"),
)


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_column: str
    on_delete: str = "cascade"  # or "set_null"

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column}->{self.parent}.{self.parent_column}"


def _fk(child: str, column: str, parent: str, parent_column: str, on_delete: str = "cascade") -> ForeignKey:
    return ForeignKey(child, column, parent, parent_column, on_delete)


FOREIGN_KEYS: tuple[ForeignKey, ...] = (
    _fk("artist", "user_id", "users", "user_id"),
    _fk("consumer", "user_id", "users", "user_id"),
    _fk("genre", "parent_genre_id", "genre", "genre_id", "set_null"),
    _fk("producer", "artist_id", "artist", "user_id", "set_null"),
    _fk("playlist", "user_id", "users", "user_id"),
    _fk("review", "consumer_id", "consumer", "user_id"),
    _fk("review", "track_id", "track", "track_id"),
    _fk("makes", "user_id", "users", "user_id"),
    _fk("makes", "playlist_id", "playlist", "playlist_id"),
    _fk("playlist_track", "playlist_id", "playlist", "playlist_id"),
    _fk("playlist_track", "track_id", "track", "track_id"),
    _fk("consumer_track_rating", "user_id", "consumer", "user_id"),
    _fk("consumer_track_rating", "track_id", "track", "track_id"),
    _fk("written_by", "consumer_id", "consumer", "user_id"),
    _fk("written_by", "review_id", "review", "review_id"),
    _fk("gets", "review_id", "review", "review_id"),
    _fk("gets", "track_id", "track", "track_id"),
    _fk("may_be", "artist_id", "artist", "user_id"),
    _fk("may_be", "producer_id", "producer", "producer_id"),
    _fk("track_artist", "track_id", "track", "track_id"),
    _fk("track_artist", "artist_id", "artist", "user_id"),
    _fk("track_songwriter", "track_id", "track", "track_id"),
    _fk("track_songwriter", "artist_id", "artist", "user_id"),
    _fk("artist_member", "group_artist_id", "artist", "user_id"),
    _fk("artist_member", "member_artist_id", "artist", "user_id"),
    _fk("track_album", "track_id", "track", "track_id"),
    _fk("track_album", "album_id", "album", "album_id"),
    _fk("label_album", "label_id", "label", "label_id"),
    _fk("label_album", "album_id", "album", "album_id"),
    _fk("label_artist", "label_id", "label", "label_id"),
    _fk("label_artist", "artist_id", "artist", "user_id"),
    _fk("track_producer", "track_id", "track", "track_id"),
    _fk("track_producer", "producer_id", "producer", "producer_id"),
    _fk("track_genre", "track_id", "track", "track_id"),
    _fk("track_genre", "genre_id", "genre", "genre_id"),
    _fk("track_rights_holder", "track_id", "track", "track_id"),
    _fk("track_rights_holder", "rights_id", "rights_holder", "rights_id"),
    # Not declared in the reference DDL; inferred from the queries that read it.
    _fk("track_isrc", "track_id", "track", "track_id"),
)


_SIMPLE_TYPES: dict[str, DataType] = {
    "BIGINT": LongType(),
    "INT": IntegerType(),
    "STRING": StringType(),
    "DATE": DateType(),
    "BOOLEAN": BooleanType(),
    "DOUBLE": DoubleType(),
    "TIMESTAMP_NTZ": TimestampNTZType(),
}


def _parse_ddl(ddl: str) -> StructType:
    """Parse the small DDL subset above without a running JVM."""
    fields = []
    for part in re.split(r",\s*(?![^()]*\))", ddl):
        name, type_text = part.strip().split(None, 1)
        type_text = type_text.strip().upper()
        dec = re.fullmatch(r"DECIMAL\((\d+),(\d+)\)", type_text)
        data_type = DecimalType(int(dec.group(1)), int(dec.group(2))) if dec else _SIMPLE_TYPES[type_text]
        fields.append(StructField(name, data_type, True))
    return StructType(fields)


def schema(table: str) -> StructType:
    return _parse_ddl(TABLE_DDL[table])


def optional_schema(table: str) -> StructType | None:
    ddl = OPTIONAL_DDL.get(table)
    return _parse_ddl(ddl) if ddl else None


def column_names(table: str) -> list[str]:
    return [f.name for f in schema(table).fields]


class SchemaMismatch(ValueError):
    pass


def conform(table: str, df: DataFrame, *, strict: bool = False) -> DataFrame:
    """Project ``df`` onto the declared schema of ``table``.

    Required columns must exist; they are cast to the declared type when the
    cast is lossless in kind (e.g. int → bigint). ``strict`` demands exact
    types instead. Declared optional columns are kept when present; any other
    column is dropped (column pruning then keeps it out of the scan).
    """
    declared = schema(table)
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in declared.fields if f.name not in have]
    if missing:
        raise SchemaMismatch(f"{table}: missing columns {missing}")
    cols = []
    for f in declared.fields:
        if have[f.name] != f.dataType:
            if strict:
                raise SchemaMismatch(f"{table}.{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f.name))
    opt = optional_schema(table)
    if opt is not None:
        for f in opt.fields:
            if f.name in have:
                cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*cols)
