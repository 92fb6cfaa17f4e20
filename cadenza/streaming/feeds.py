"""Structured Streaming front-end for the write jobs.

A request feed (files landing in a folder, or any streaming source) is read
with ``readStream``; every micro-batch runs one write job from
``operators.ingest`` (or a delete of ``operators.integrity``) against the
stored catalog and writes its rows and removed keys under
``<root>/_appends`` and ``<root>/_removes``,
``<table>/stream_id=<s>/batch_id=<n>``. The stream id
is made once and kept beside the stream's checkpoint, so a second stream, or
one started with a new checkpoint, never shares a batch with another. A batch
is published by one marker after all of its tables are written: a crash in
between shows readers nothing, the replay overwrites its own folders, and a
batch that is already published is not run again.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..catalog import Catalog
from ..operators import ingest, integrity
from ..plans.keys import KeySet
from ..schemas import PRIMARY_KEYS
from ..sources.files import Changes, commit_batch, is_committed, load_catalog, write_appends, write_removes

# A job gives the rows to append by table, or a batch with removals.
Job = Callable[[Catalog, DataFrame, int], dict[str, DataFrame] | Changes]

REVIEW_REQUEST_SCHEMA = "request_id BIGINT, consumer_id BIGINT, track_id BIGINT, rating INT, review_text STRING"
PLAYLIST_ADD_SCHEMA = "request_id BIGINT, playlist_id BIGINT, track_id BIGINT"
PLAYLIST_REMOVE_SCHEMA = PLAYLIST_ADD_SCHEMA


def review_job(rating_range: tuple[int, int] = (1, 5)) -> Job:
    def run(cat: Catalog, requests: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        batch = ingest.ingest_reviews(cat, requests, rating_range, batch_ts=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        return {
            "review": batch.review,
            "written_by": batch.written_by,
            "gets": batch.gets,
            "_rejects_review": batch.rejects,
        }

    return run


def playlist_add_job() -> Job:
    def run(cat: Catalog, requests: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        out = ingest.playlist_add(cat, requests, batch_ts=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        return {"playlist_track": out.added, "_rejects_playlist_add": out.rejects}

    return run


def playlist_remove_job() -> Job:
    """Requests (request_id, playlist_id, track_id) that take tracks off playlists."""

    def run(cat: Catalog, requests: DataFrame, batch_id: int) -> Changes:
        out = ingest.playlist_remove(cat, requests)
        return Changes({"_rejects_playlist_remove": out.rejects}, {"playlist_track": out.removed})

    return run


def cascade_delete_job(table: str) -> Job:
    """Requests with the key of ``table``: those rows go, with all that depends on them."""

    def run(cat: Catalog, requests: DataFrame, batch_id: int) -> Changes:
        keys: KeySet = requests.select(PRIMARY_KEYS[table][0])
        return integrity.cascade_delete(cat, table, keys).changes()

    return run


def stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """The id of the stream with this checkpoint; made at its first start."""
    path = f"{checkpoint_location.rstrip('/')}/cadenza_stream_id"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException:
        made = f"s{uuid.uuid4().hex}"
        spark.createDataFrame([(made,)], "value string").coalesce(1).write.text(path)
        return made


def catalog_sink(root: str, job: Job, stream: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler applying ``job`` to each micro-batch of the stream with id ``stream``."""

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        if is_committed(spark, root, stream, batch_id):
            return
        cat = load_catalog(spark, root, skip_batch=(stream, batch_id))
        out = job(cat, batch_df, batch_id)
        changes = out if isinstance(out, Changes) else Changes(out)
        for table, keys in changes.removes.items():
            write_removes(keys, root, table, stream, batch_id, cat.as_of)
        for table, df in changes.appends.items():
            write_appends(df, root, table, stream, batch_id)
        commit_batch(spark, root, stream, batch_id)

    return handle


def start_ingest_stream(
    spark: SparkSession,
    requests: DataFrame,
    root: str,
    job: Job,
    checkpoint_location: str,
    trigger: dict | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Run ``job`` over a streaming DataFrame of requests.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g.
    ``{"availableNow": True}`` to drain what has landed and stop, or
    ``{"processingTime": "1 minute"}``).
    """
    sink = catalog_sink(root, job, stream_id(spark, checkpoint_location))
    writer = requests.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_location)
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def request_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Files landing under ``path`` as a stream of requests (explicit schema)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
