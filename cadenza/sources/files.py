"""Stored catalogs: typed Parquet (or CSV) folders, one per table.

``save_catalog`` writes each table range-partitioned and sorted by its
lookup key, so Parquet min/max statistics let key filters skip row groups
(the role the reference's B-tree indexes play); columns that are looked up
by value carry bloom filters; projections (``sources.projections``) hold
tables once more in the order of another look-up; bridges can be bucketed so
that joins on their key need no shuffle. ``load_catalog`` reads with the
declared schema, never inferring one, and fails on a mismatch.

A stored catalog changes by batches. Each batch writes rows to append and
primary keys to remove below its own folders and is published by one marker
that carries its commit number. A removal holds the commit number its job had
read (``as_of``) and hides the rows of that key committed up to then: rows
that a later batch (or the same one) appends under the same key stay.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..catalog import Catalog
from ..schemas import PRIMARY_KEYS, TABLES, conform, optional_schema, schema
from .projections import PROJECTIONS, gram_counts

# Column each table is clustered by: the key most look-ups filter on.
LOOKUP_KEYS: dict[str, str] = {name: PRIMARY_KEYS[name][0] for name in TABLES}

# Columns looked up by value that are no clustering key: one bloom filter per
# row group. Their values hardly repeat, so a dictionary would not pay.
BLOOM_COLUMNS: dict[str, tuple[str, ...]] = {
    "users": ("email",),
    "artist": ("mb_artist_gid",),
    "album": ("mb_release_group_gid",),
    "track": ("isrc", "mb_recording_gid"),
    "genre": ("mb_genre_gid",),
    "label": ("mb_label_gid",),
    "producer": ("mb_artist_gid",),
    "track_isrc": ("isrc",),
}

# Tables that join on track_id, for ``save_catalog(buckets=...)``.
BUCKET_KEYS: dict[str, str] = {
    name: "track_id"
    for name in (
        "track",
        "track_artist",
        "track_songwriter",
        "track_album",
        "track_producer",
        "track_genre",
        "track_rights_holder",
        "track_isrc",
    )
}

APPENDS = "_appends"
REMOVES = "_removes"
COMMITS = "_commits"
SEQUENCE = "_sequence"
LAYOUT = "_layout"
PROJECTED = "_projections"
BATCH_COLUMN = "batch_id"
STREAM_COLUMN = "stream_id"
SEQ, AS_OF = "_seq", "_as_of"


@dataclass(frozen=True)
class Changes:
    """What a write job does to a stored catalog, by table.

    ``removes`` holds primary keys of rows the job has read; ``appends`` are
    rows that come after the removals, so an update is a key in one and the
    new row in the other.
    """

    appends: dict[str, DataFrame] = field(default_factory=dict)
    removes: dict[str, DataFrame] = field(default_factory=dict)


def _path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def append_path(root: str, table: str) -> str:
    """Folder of rows appended to ``table`` by write jobs, partitioned by stream and batch id."""
    return f"{root.rstrip('/')}/{APPENDS}/{table}"


def remove_path(root: str, table: str) -> str:
    """Folder of keys removed from ``table`` by write jobs, partitioned by stream and batch id."""
    return f"{root.rstrip('/')}/{REMOVES}/{table}"


def _of_batch(folder: str, stream_id: str, batch_id: int) -> str:
    return f"{folder}/{STREAM_COLUMN}={stream_id}/{BATCH_COLUMN}={batch_id}"


def write_appends(df: DataFrame, root: str, table: str, stream_id: str, batch_id: int) -> None:
    """Write one batch's rows for ``table``, replacing that batch's earlier attempt.

    Overwrites exactly the folder of this stream and batch, also with no
    rows, so a retried micro-batch leaves only what its last attempt wrote
    and no other stream's batch is touched. Readers see the rows once
    ``commit_batch`` has published the batch.
    """
    df.write.mode("overwrite").parquet(_of_batch(append_path(root, table), stream_id, batch_id))


def write_removes(keys: DataFrame, root: str, table: str, stream_id: str, batch_id: int, as_of: int) -> None:
    """Write one batch's removed primary keys for ``table``, as ``write_appends`` does its rows.

    ``as_of`` is the commit number of the catalog that the keys were read from.
    """
    rows = keys.select(*PRIMARY_KEYS[table]).distinct().withColumn(AS_OF, F.lit(as_of).cast("bigint"))
    rows.write.mode("overwrite").parquet(_of_batch(remove_path(root, table), stream_id, batch_id))


def commit_batch(spark: SparkSession, root: str, stream_id: str, batch_id: int) -> None:
    """Publish all tables of a batch at once: one marker, written after the tables, with the next commit number."""
    marker = spark.range(0, 1, 1, 1).select(F.lit(_next_number(spark, root)).cast("bigint").alias(SEQ))
    marker.write.mode("overwrite").parquet(_of_batch(append_path(root, COMMITS), stream_id, batch_id))


def is_committed(spark: SparkSession, root: str, stream_id: str, batch_id: int) -> bool:
    return _exists(spark, f"{_of_batch(append_path(root, COMMITS), stream_id, batch_id)}/_SUCCESS")


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return fs.exists(hpath)


def _next_number(spark: SparkSession, root: str) -> int:
    """Take the next commit number.

    A number is taken by creating its file, which fails where it exists: two
    committers never share one (on stores without that check, let one job
    commit at a time). Only the newest file is kept; a crash leaves a gap.
    """
    folder = f"{root.rstrip('/')}/{SEQUENCE}"
    fs, hpath = _fs(spark, folder)
    fs.mkdirs(hpath)
    taken = [int(s.getPath().getName()) for s in fs.listStatus(hpath) if s.getPath().getName().isdigit()]
    number = max(taken, default=0) + 1
    while True:
        _, mine = _fs(spark, f"{folder}/{number}")
        try:
            fs.create(mine, False).close()
            break
        except Py4JJavaError:
            if not fs.exists(mine):
                raise
            number += 1
    for old in taken:
        fs.delete(_fs(spark, f"{folder}/{old}")[1], False)
    return number


def _published(spark: SparkSession, root: str) -> DataFrame | None:
    """(stream_id, batch_id, _seq) of the committed batches as of now; the listing is made once."""
    path = append_path(root, COMMITS)
    if not _exists(spark, path):
        return None
    found = spark.read.schema(f"{SEQ} bigint, {STREAM_COLUMN} string, {BATCH_COLUMN} bigint").parquet(path)
    return found.withColumn(SEQ, F.coalesce(SEQ, F.lit(0)))


#: Quotes within a value are doubled, backslashes and spaces stand for themselves. Values
#: may not hold line breaks: files are split at them.
CSV_OPTIONS = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_EMPTY = "\x01"  # what a quoted empty value is read as, to tell it from an unquoted one, which is NULL
CSV_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # Spark's own format ends at milliseconds


def save_table(df: DataFrame, path: str, cluster_by: str | None = None, fmt: str = "parquet", bloom: tuple[str, ...] = ()) -> None:
    """Write one table, clustered by ``cluster_by``, with bloom filters on the ``bloom`` columns it has.

    ``repartitionByRange`` without a partition count lets AQE size the
    output partitions (``spark.sql.adaptive.advisoryPartitionSizeInBytes``),
    so file sizes follow the data rather than a fixed count.
    """
    if cluster_by:
        df = df.repartitionByRange(F.col(cluster_by)).sortWithinPartitions(cluster_by)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.options(**CSV_OPTIONS, timestampFormat=CSV_TIMESTAMP, timestampNTZFormat=CSV_TIMESTAMP).csv(path)
        return
    _with_bloom(writer, [c for c in bloom if c in df.columns]).format(fmt).save(path)


def _with_bloom(writer, columns: list[str]):
    if columns:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.enable.dictionary#{c}", "false")
    return writer


def _save_bucketed(df: DataFrame, path: str, key: str, buckets: int, bloom: tuple[str, ...]) -> None:
    """One sorted file per bucket of ``key``. The table entry is only the way to the bucketed writer and is dropped."""
    spark = df.sparkSession
    entry = f"cadenza_write_{abs(hash(path))}"
    spark.sql(f"DROP TABLE IF EXISTS {entry}")
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    _with_bloom(writer.bucketBy(buckets, key).sortBy(key), [c for c in bloom if c in df.columns]).saveAsTable(entry)
    spark.sql(f"DROP TABLE {entry}")


def _open_bucketed(spark: SparkSession, path: str, table: str, buckets: int) -> DataFrame:
    """The files of ``_save_bucketed`` as a session table, which alone tells the planner of the buckets."""
    entry = f"cadenza_{table}_{abs(hash(path))}"
    found = spark.read.parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.fields)
    key = BUCKET_KEYS[table]
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {entry}")
    spark.sql(
        f"CREATE TABLE {entry} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    return spark.table(entry)


def save_catalog(
    cat: Catalog,
    root: str,
    fmt: str = "parquet",
    cluster: bool = True,
    projections: tuple[str, ...] = (),
    buckets: int | None = None,
) -> None:
    """Write every table of ``cat`` below ``root``.

    ``projections`` names second copies for other look-ups
    (``tuple(PROJECTIONS)`` for all); ``buckets`` stores the tables of ``BUCKET_KEYS``
    in that many buckets of their key instead of key ranges. A loaded catalog
    saved to a new root is its compaction: batches become base rows.
    """
    spark = cat.spark
    bucketed = []
    for name in TABLES:
        if name not in cat:
            continue
        bloom = BLOOM_COLUMNS.get(name, ())
        if buckets and name in BUCKET_KEYS and fmt == "parquet":
            _save_bucketed(cat[name], _path(root, name), BUCKET_KEYS[name], buckets, bloom)
            bucketed.append((name, buckets))
        else:
            save_table(cat[name], _path(root, name), LOOKUP_KEYS[name] if cluster else None, fmt, bloom)
    if bucketed:
        spark.createDataFrame(bucketed, "table_name string, buckets int").coalesce(1).write.mode("overwrite").parquet(_path(root, LAYOUT))
    for name in projections:
        projection = PROJECTIONS[name]
        path = f"{_path(root, PROJECTED)}/{name}"
        rows = projection.build(cat[projection.table])
        writer = rows.repartitionByRange(*projection.order).sortWithinPartitions(*projection.order).write.mode("overwrite")
        # Small row groups and pages: a look-up reads little besides what it asks for.
        writer.option("parquet.block.size", str(16 << 20)).option("parquet.page.row.count.limit", "2000").parquet(path)
        if projection.counted:
            counts = gram_counts(spark.read.parquet(path))
            counts.repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}_counts")


def read_table(spark: SparkSession, path: str, table: str, fmt: str = "parquet", strict: bool = True) -> DataFrame:
    declared = schema(table)
    if fmt == "csv":
        # Columns by the names in the header, then typed: a value that does
        # not parse fails the read instead of becoming NULL.
        df = spark.read.options(**CSV_OPTIONS, emptyValue=CSV_EMPTY).csv(path)
        types = {f.name: f.dataType for s in (declared, optional_schema(table)) if s for f in s.fields}
        told = {c: F.when(F.col(c) == CSV_EMPTY, F.lit("" if types[c] == StringType() else None)).otherwise(F.col(c)) for c in df.columns if c in types}
        typed = df.select(*[v.cast(types[c]).alias(c) for c, v in told.items()])
        return conform(table, typed, strict=strict)
    return _conformed(spark.read.format(fmt).load(path), table, strict)


def _conformed(df: DataFrame, table: str, strict: bool) -> DataFrame:
    have = {f.name for f in df.schema.fields}
    opt = optional_schema(table)
    keep = [f.name for f in schema(table).fields] + [f.name for f in (opt.fields if opt else []) if f.name in have]
    return conform(table, df.select(*[c for c in keep if c in have]), strict=strict)


def load_catalog(
    spark: SparkSession,
    root: str,
    fmt: str = "parquet",
    strict: bool = True,
    tables: tuple[str, ...] = TABLES,
    skip_batch: tuple[str, int] | None = None,
    skip_stream: str | None = None,
) -> Catalog:
    """The tables under ``root``, each opened when it is first asked for; all of them show the batches committed now.

    Base rows and committed appends whose key no later removal hides, in
    Parquet whatever the format of the base tables. ``skip_batch`` (stream
    id, batch id) leaves out one batch (a retried batch must not see its own
    earlier attempt), ``skip_stream`` all batches of a stream. ``as_of`` of
    the result is the largest commit number, those left out included.
    Projections follow the changes: keys removed are left out of them, rows
    appended are added as they are read.
    """
    published, as_of = _published(spark, root), 0  # listed before the rows, so every batch in it is complete
    if published is not None:
        as_of = published.agg(F.coalesce(F.max(SEQ), F.lit(0))).first()[0]
        if skip_batch is not None:
            published = published.filter(~((F.col(STREAM_COLUMN) == skip_batch[0]) & (F.col(BATCH_COLUMN) == skip_batch[1])))
        if skip_stream is not None:
            published = published.filter(F.col(STREAM_COLUMN) != skip_stream)
    layout = {}
    if _exists(spark, _path(root, LAYOUT)):
        layout = {r["table_name"]: r["buckets"] for r in spark.read.parquet(_path(root, LAYOUT)).collect()}  # one row per table

    @functools.cache
    def gone(name: str) -> DataFrame | None:
        return None if published is None else _removed(spark, root, name, published)

    @functools.cache
    def added(name: str) -> DataFrame | None:
        return None if published is None else _appended(spark, root, name, published, gone(name))

    def table(name: str) -> DataFrame:
        path = _path(root, name)
        base = _conformed(_open_bucketed(spark, path, name, layout[name]), name, strict) if name in layout else read_table(spark, path, name, fmt, strict)
        rows = _without(base, name, gone(name))
        return rows if added(name) is None else rows.unionByName(added(name), allowMissingColumns=True)

    def projected(name: str) -> DataFrame:
        of = PROJECTIONS[name].table
        rows = _without(spark.read.parquet(f"{_path(root, PROJECTED)}/{name}"), of, gone(of))
        return rows if added(of) is None else rows.unionByName(PROJECTIONS[name].build(added(of)))

    stored = [n for n, p in PROJECTIONS.items() if p.table in tables and _exists(spark, f"{_path(root, PROJECTED)}/{n}")]
    counted = [n for n in stored if PROJECTIONS[n].counted]
    return Catalog(
        {name: functools.partial(table, name) for name in tables},
        projections={name: functools.partial(projected, name) for name in stored},
        gram_counts={name: functools.partial(spark.read.parquet, f"{_path(root, PROJECTED)}/{name}_counts") for name in counted},
        as_of=as_of,
    )


def _batches(spark: SparkSession, path: str, published: DataFrame) -> DataFrame | None:
    """Rows of the published batches below ``path``, with their commit number."""
    if not _exists(spark, path):
        return None
    batch = [STREAM_COLUMN, BATCH_COLUMN]
    found = spark.read.parquet(path).schema
    # The types of the folder names are stated: a stream id may look like a number.
    written = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.fields if f.name not in batch)
    rows = spark.read.schema(f"{written}, {STREAM_COLUMN} string, {BATCH_COLUMN} bigint").parquet(path)
    return rows.join(published, batch).drop(*batch)


def _removed(spark: SparkSession, root: str, table: str, published: DataFrame) -> DataFrame | None:
    """Removed keys of ``table`` with the largest commit number up to which they are removed."""
    rows = _batches(spark, remove_path(root, table), published)
    return None if rows is None else rows.groupBy(*PRIMARY_KEYS[table]).agg(F.max(AS_OF).alias(AS_OF))


def _without(rows: DataFrame, table: str, gone: DataFrame | None) -> DataFrame:
    """Base rows (commit number 0) without the removed keys."""
    if gone is None:
        return rows
    pk = list(PRIMARY_KEYS[table])
    return rows.join(gone.select(*pk), pk, "left_anti").select(*rows.columns)


def _appended(spark: SparkSession, root: str, table: str, published: DataFrame, gone: DataFrame | None) -> DataFrame | None:
    rows = _batches(spark, append_path(root, table), published)
    if rows is None:
        return None
    if gone is not None:
        later = rows.join(gone, list(PRIMARY_KEYS[table]), "left").filter(F.col(AS_OF).isNull() | (F.col(SEQ) > F.col(AS_OF)))
        rows = later.select(*rows.columns)
    return conform(table, rows.drop(SEQ), strict=False)


def commit_changes(spark: SparkSession, root: str, changes: Changes, stream_id: str, batch_id: int, as_of: int) -> None:
    """Write the tables of ``changes`` and publish them as one batch; a batch already published is left alone."""
    if is_committed(spark, root, stream_id, batch_id):
        return
    for table, keys in changes.removes.items():
        write_removes(keys, root, table, stream_id, batch_id, as_of)
    for table, rows in changes.appends.items():
        write_appends(rows, root, table, stream_id, batch_id)
    commit_batch(spark, root, stream_id, batch_id)
