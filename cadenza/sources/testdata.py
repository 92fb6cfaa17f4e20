"""Catalog built from the driver's TPC-H-style test tables.

Fixed values: the mapping below is the fixture definition of FIXTURES.md
(section A.2). Each entry is one dialect-neutral SELECT over the driver
tables; the same text runs in Spark SQL and in DuckDB, so the oracle SQL is
generated from this very dict (``with_clause``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..catalog import Catalog
from ..schemas import TABLES, conform

SOURCE_TABLES: tuple[str, ...] = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

# Fixture mapping (FIXTURES.md A.2), one SELECT per catalog table.
MAPPING_SQL: dict[str, str] = {
    "users": (
        "SELECT c_custkey AS user_id, CASE WHEN c_custkey%11=0 THEN NULL ELSE c_name END AS username, "
        "CASE WHEN c_custkey%7=0 THEN NULL ELSE lower(c_name)||'@example.com' END AS email, "
        "CASE WHEN c_custkey%5=0 THEN NULL ELSE DATE '2015-01-01'+CAST(c_custkey%3000 AS INT) END AS join_date, "
        "n_name AS country FROM customer JOIN nation ON c_nationkey=n_nationkey"
    ),
    "artist": (
        "SELECT s_suppkey AS user_id, CASE WHEN s_suppkey%13=5 THEN NULL ELSE s_name END AS name, "
        "n_name AS country, CAST(1950+s_suppkey%70 AS INT) AS formed_year, "
        "CASE WHEN s_suppkey%2=0 THEN 'Group' ELSE 'Person' END AS type "
        "FROM supplier JOIN nation ON s_nationkey=n_nationkey"
    ),
    "consumer": (
        "SELECT c_custkey AS user_id, CASE WHEN c_custkey%17=0 THEN NULL "
        "ELSE 'fan '||c_mktsegment||' '||CAST(c_custkey AS VARCHAR(20)) END AS display_name "
        "FROM customer WHERE c_custkey%3<>0"
    ),
    "album": (
        "SELECT o_orderkey AS album_id, o_orderpriority||' vol '||CAST(o_orderkey%50 AS VARCHAR(20)) AS title, "
        "CASE WHEN o_orderkey%19=0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS release_date, "
        "FALSE AS explicit_flag FROM orders"
    ),
    "track": (
        "SELECT p_partkey AS track_id, CASE WHEN p_partkey%23=0 THEN NULL ELSE p_name END AS title, "
        "CASE WHEN p_partkey%19=0 THEN NULL ELSE p_size*10 END AS duration_sec, "
        "CASE WHEN p_partkey%5=0 THEN NULL ELSE CAST(CAST(6000+(p_partkey*37)%14000 AS DECIMAL(10,0))"
        "*CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(6,2)) END AS bpm, "
        "CASE WHEN p_partkey%5=0 THEN NULL ELSE substring('CDEFGAB',CAST(p_partkey%7+1 AS INT),1) END AS key, "
        "CASE WHEN p_partkey%5=0 THEN NULL WHEN p_partkey%2=0 THEN 'major' ELSE 'minor' END AS mode, "
        "p_partkey%10=0 AS explicit_flag FROM part"
    ),
    "genre": (
        "SELECT CAST(r_regionkey AS BIGINT) AS genre_id, r_name AS name, "
        "CAST(NULL AS VARCHAR(100)) AS description, CAST(NULL AS BIGINT) AS parent_genre_id FROM region "
        "UNION ALL SELECT CAST(100+n_nationkey AS BIGINT), n_name, 'sub-genre', CAST(n_regionkey AS BIGINT) FROM nation"
    ),
    "label": (
        "SELECT CAST(n_nationkey AS BIGINT) AS label_id, 'Label '||n_name AS name, "
        "CASE WHEN n_nationkey%6=0 THEN NULL ELSE n_name END AS country, "
        "CAST(1900+n_nationkey AS INT) AS founded_year, "
        "CASE WHEN n_nationkey%4=0 THEN 'https://label'||CAST(n_nationkey AS VARCHAR(20))||'.example' "
        "ELSE NULL END AS website FROM nation"
    ),
    "rights_holder": (
        "SELECT CAST(n_nationkey AS BIGINT) AS rights_id, 'Rights '||n_name AS holder_name, "
        "CASE WHEN n_nationkey%3=0 THEN 'PRO' ELSE NULL END AS pro_affiliation, "
        "CAST(NULL AS VARCHAR(100)) AS contact_email FROM nation"
    ),
    "producer": (
        "SELECT s_suppkey AS producer_id, 'Prod '||s_name AS name, n_name AS country, "
        "CAST(1930+s_suppkey%60 AS INT) AS birth_year, "
        "CASE WHEN s_suppkey%8=0 THEN s_suppkey ELSE NULL END AS artist_id "
        "FROM supplier JOIN nation ON s_nationkey=n_nationkey WHERE s_suppkey%4=0"
    ),
    "playlist": (
        "SELECT o_orderkey AS playlist_id, 'Mix '||o_orderpriority AS name, "
        "CASE WHEN o_orderkey%13=0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS created_date, "
        "o_orderkey%3<>0 AS is_public, o_custkey AS user_id FROM orders WHERE o_orderstatus='O'"
    ),
    "review": (
        "SELECT event_id AS review_id, CAST(1+event_id%10 AS INT) AS rating, "
        "CASE WHEN event_id%6=0 THEN NULL ELSE event_type||' '||props END AS review_text, "
        "ts AS created_at, user_id AS consumer_id, (event_id*7)%(SELECT count(*) FROM part) AS track_id FROM events WHERE user_id%3<>0"
    ),
    "makes": "SELECT o_custkey AS user_id, o_orderkey AS playlist_id FROM orders WHERE o_orderstatus='O'",
    "playlist_track": (
        "SELECT l_orderkey AS playlist_id, l_partkey AS track_id, min(l_shipdate) AS added_at "
        "FROM lineitem JOIN orders ON l_orderkey=o_orderkey WHERE o_orderstatus='O' "
        "GROUP BY l_orderkey,l_partkey"
    ),
    "consumer_track_rating": (
        "SELECT o_custkey AS user_id, l_partkey AS track_id, "
        "CAST(max(1+CAST(l_quantity AS INT)%10) AS INT) AS rating, max(l_shipdate) AS rated_at "
        "FROM lineitem JOIN orders ON l_orderkey=o_orderkey WHERE o_custkey%3<>0 GROUP BY o_custkey,l_partkey"
    ),
    "written_by": "SELECT user_id AS consumer_id, event_id AS review_id FROM events WHERE user_id%3<>0",
    "gets": "SELECT event_id AS review_id, (event_id*7)%(SELECT count(*) FROM part) AS track_id FROM events WHERE user_id%3<>0",
    "may_be": "SELECT s_suppkey AS artist_id, s_suppkey AS producer_id FROM supplier WHERE s_suppkey%8=0",
    "track_artist": (
        "SELECT l_partkey AS track_id, l_suppkey AS artist_id, "
        "CASE WHEN min(l_returnflag)='A' THEN 'primary' ELSE 'vocal' END AS role "
        "FROM lineitem WHERE l_partkey%29<>0 GROUP BY l_partkey,l_suppkey"
    ),
    "track_songwriter": (
        "SELECT DISTINCT l_partkey AS track_id, l_suppkey AS artist_id, 'writer' AS contribution "
        "FROM lineitem WHERE l_returnflag='R'"
    ),
    "artist_member": (
        "SELECT g.s_suppkey AS group_artist_id, m.s_suppkey AS member_artist_id, "
        "CASE WHEN m.s_suppkey%3=0 THEN NULL ELSE 'instr '||CAST(m.s_suppkey%5 AS VARCHAR(20)) END AS instrument, "
        "CASE WHEN m.s_suppkey%4=1 THEN NULL ELSE CAST(1990+m.s_suppkey%20 AS INT) END AS join_year, "
        "CASE WHEN m.s_suppkey%4=3 THEN CAST(2010+m.s_suppkey%10 AS INT) ELSE NULL END AS leave_year "
        "FROM (SELECT s_suppkey, s_suppkey+1 AS member FROM supplier UNION ALL SELECT s_suppkey, s_suppkey+3 FROM supplier "
        "UNION ALL SELECT s_suppkey, s_suppkey+5 FROM supplier) g JOIN supplier m ON m.s_suppkey=g.member "
        "WHERE g.s_suppkey%2=0"
    ),
    "track_album": (
        "SELECT l_partkey AS track_id, l_orderkey AS album_id, "
        "CASE WHEN l_partkey%31=0 THEN NULL ELSE CAST(min(l_linenumber) AS INT) END AS track_number "
        "FROM lineitem GROUP BY l_partkey,l_orderkey"
    ),
    "label_album": (
        "SELECT CAST(c_nationkey AS BIGINT) AS label_id, o_orderkey AS album_id "
        "FROM orders JOIN customer ON o_custkey=c_custkey WHERE c_nationkey%8<>7"
    ),
    "label_artist": (
        "SELECT CAST(s_nationkey AS BIGINT) AS label_id, s_suppkey AS artist_id, "
        "CAST(1990 AS INT) AS start_year, CAST(NULL AS INT) AS end_year FROM supplier"
    ),
    "track_producer": (
        "SELECT l_partkey AS track_id, l_suppkey AS producer_id, "
        "CASE WHEN min(l_linenumber)=1 THEN 'producer' ELSE NULL END AS credit_type "
        "FROM lineitem WHERE l_suppkey%4=0 GROUP BY l_partkey,l_suppkey"
    ),
    "track_genre": (
        "SELECT p_partkey AS track_id, CAST(100+p_partkey%24 AS BIGINT) AS genre_id FROM part WHERE p_partkey%5=0 "
        "UNION ALL SELECT p_partkey, CAST(p_size%4 AS BIGINT) FROM part WHERE p_partkey%10=0"
    ),
    "track_rights_holder": (
        "SELECT l_partkey AS track_id, CAST(s_nationkey AS BIGINT) AS rights_id, 'master' AS rights_type, "
        "CASE WHEN s_nationkey%2=0 THEN NULL ELSE CAST(count(*)*5 AS DOUBLE) END AS percentage "
        "FROM lineitem JOIN supplier ON l_suppkey=s_suppkey GROUP BY l_partkey,s_nationkey"
    ),
    "track_isrc": (
        "SELECT p_partkey AS track_id, 'XX'||lpad(CAST(p_partkey AS VARCHAR(20)),10,'0') AS isrc, "
        "TRUE AS is_primary FROM part WHERE p_partkey%12<>0 "
        "UNION ALL SELECT p_partkey, 'YY'||lpad(CAST(p_partkey AS VARCHAR(20)),10,'0'), FALSE "
        "FROM part WHERE p_partkey%3=0"
    ),
}

assert tuple(MAPPING_SQL) == TABLES


def read_sources(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = SOURCE_TABLES) -> dict[str, DataFrame]:
    """The driver parquet files as DataFrames, by table name."""
    return {name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet") for name in tables}


def register_sources(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = SOURCE_TABLES) -> dict[str, DataFrame]:
    """Register the driver parquet files as temp views named after the tables."""
    sources = read_sources(spark, sf_dir, tables)
    for name, df in sources.items():
        df.createOrReplaceTempView(name)
    return sources


_SOURCE_NAME = re.compile(r"\b(" + "|".join(SOURCE_TABLES) + r")\b")


def _bound_sql(sql: str) -> str:
    """The mapping text with each source table name turned into a ``{name}`` slot."""
    return _SOURCE_NAME.sub(lambda m: "{" + m.group(1) + "}", sql)


def from_testdata(spark: SparkSession, sf_dir: str) -> Catalog:
    """Map the driver tables in ``sf_dir`` onto the 27 catalog tables.

    Each catalog table is a lazily evaluated DataFrame. The source tables are
    bound to the SQL text as DataFrame arguments of ``spark.sql`` rather than
    as session-wide temp views, so catalogs of several folders (or several
    threads) never see each other's tables.
    """
    sources = read_sources(spark, sf_dir)
    tables = {}
    for name, sql in MAPPING_SQL.items():
        used = {t: sources[t] for t in set(_SOURCE_NAME.findall(sql))}
        tables[name] = conform(name, spark.sql(_bound_sql(sql), **used))
    return Catalog(tables, sources)


def with_clause(tables: list[str] | tuple[str, ...] | None = None) -> str:
    """``WITH`` list that defines the mapped catalog tables for an oracle query."""
    names = TABLES if tables is None else [t for t in TABLES if t in set(tables)]
    return "WITH " + ",\n".join(f"{name} AS ({MAPPING_SQL[name]})" for name in names)
