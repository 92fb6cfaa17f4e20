"""Read the catalog straight from the relational database it lives in.

Each table becomes a partitioned JDBC scan: the rows are cut into stripes of
about ``rows_per_stripe`` rows at quantiles of the leading key column, so a
large table gets many stripes and a small one a single read, and sparse or
skewed keys still give even stripes. Column pruning and simple filters are
pushed into the database's SQL, and the result is conformed to the declared
schema. Needs the database's JDBC driver on the classpath.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..schemas import PRIMARY_KEYS, TABLES, conform

# Table names in the source database (PostgreSQL folds
# unquoted names to lower case; "User" is quoted because USER is reserved).
DB_TABLE_NAMES: dict[str, str] = {name: name for name in TABLES}
DB_TABLE_NAMES.update({"users": '"User"', "rights_holder": "rightsholder", "track_rights_holder": "track_rightsholder"})


def jdbc_read_options(
    url: str,
    table: str,
    bounds: tuple[int, int] | None = None,
    num_partitions: int = 1,
    fetch_size: int = 10_000,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')`` for one catalog table."""
    opts = {"url": url, "dbtable": DB_TABLE_NAMES[table], "fetchsize": str(fetch_size)}
    pk = PRIMARY_KEYS[table]
    if bounds is not None and num_partitions > 1:
        lo, hi = bounds
        opts.update(
            {
                "partitionColumn": pk[0],
                "lowerBound": str(lo),
                "upperBound": str(hi + 1),
                "numPartitions": str(num_partitions),
            }
        )
    opts.update(extra or {})
    return opts


#: Rows that one stripe reads.
ROWS_PER_STRIPE = 500_000


def stripe_query(table: str, key: str, stripes: int) -> str:
    """SQL for the least key of each of ``stripes`` equal shares of the rows (one row per share)."""
    shares = f"SELECT {key} AS k, NTILE({stripes}) OVER (ORDER BY {key}) AS share FROM {table} WHERE {key} IS NOT NULL"
    return f"SELECT MIN(k) AS k FROM ({shares}) shares GROUP BY share"


def stripe_predicates(key: str, least: list[int]) -> list[str]:
    """One WHERE condition per stripe from the least keys of the shares; together they hold every row once.

    A key that fills several shares is one stripe (its rows cannot be told
    apart by the key); the first stripe takes the rows without key.
    """
    starts = sorted(set(least))[1:]
    if not starts:
        return [f"({key} IS NULL OR {key} IS NOT NULL)"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in itertools.pairwise(starts)]
    return [f"{key} < {starts[0]} OR {key} IS NULL", *inner, f"{key} >= {starts[-1]}"]


def _query(spark: SparkSession, url: str, sql: str, extra: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, query=sql, **extra).load()


def read_table(
    spark: SparkSession, url: str, table: str, rows_per_stripe: int = ROWS_PER_STRIPE, extra: dict[str, str] | None = None
) -> DataFrame:
    """One table as a parallel scan; its rows are counted and cut into stripes by the database."""
    extra = dict(extra or {})
    name, key = DB_TABLE_NAMES[table], PRIMARY_KEYS[table][0]
    rows = int(_query(spark, url, f"SELECT COUNT(*) AS n FROM {name}", extra).first()["n"])
    stripes = -(-rows // rows_per_stripe)
    if stripes > 1:
        least = [int(r["k"]) for r in _query(spark, url, stripe_query(name, key, stripes), extra).collect()]  # one row per stripe
        options = {"fetchsize": "10000", **extra}
        df = spark.read.jdbc(url, name, predicates=stripe_predicates(key, least), properties=options)
    else:
        df = spark.read.format("jdbc").options(**jdbc_read_options(url, table, extra=extra)).load()
    return conform(table, df.select(*[F.col(c) for c in df.columns]))


def jdbc_catalog(
    spark: SparkSession,
    url: str,
    user: str | None = None,
    password: str | None = None,
    rows_per_stripe: int = ROWS_PER_STRIPE,
    driver: str = "org.postgresql.Driver",
    tables: tuple[str, ...] = TABLES,
) -> Catalog:
    """Catalog whose tables are parallel JDBC scans of the source database."""
    extra = {"driver": driver}
    if user is not None:
        extra["user"] = user
    if password is not None:
        extra["password"] = password
    return Catalog({t: read_table(spark, url, t, rows_per_stripe, extra) for t in tables})
