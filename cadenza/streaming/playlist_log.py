"""A playlist change log (adds and removes) applied as a stream.

Keyed state per (playlist, track) pair holds the last remove and the adds
after it, so any split of the log into micro-batches, in any order of
arrival, comes to what ``ingest.apply_playlist_changes`` gives for the whole
log. Each micro-batch yields the new state of the pairs it touched; the sink
turns that into removals and appends of the stored catalog, one committed
batch each.

The state store must be RocksDB (``STATE_STORE``): state then lies on disk
and in the checkpoint, and a pair with many adds is no object in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..catalog import Catalog
from ..sources.files import Changes, commit_changes, is_committed, load_catalog
from .feeds import stream_id

CHANGE_SCHEMA = "playlist_id BIGINT, track_id BIGINT, op STRING, seq BIGINT, ts TIMESTAMP_NTZ"
PAIR_STATE = "playlist_id BIGINT, track_id BIGINT, last_remove BIGINT, first_seq BIGINT, first_ts STRING"
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}
PAIR = ("playlist_id", "track_id")


class PairLog(StatefulProcessor):
    """Last remove and later adds of one pair; yields both and the earliest of these adds.

    An add at or before the last remove has no effect, whenever it arrives.
    Of two adds with one sequence number the earlier time counts.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_remove", "seq BIGINT")
        self.first = handle.getValueState("first_add", "seq BIGINT, ts STRING")
        self.adds = handle.getMapState("adds", "seq BIGINT", "ts STRING")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        first = tuple(self.first.get()) if self.first.exists() else None
        newest = last
        adds: dict[int, str] = {}
        for row in rows:
            if row.op == "remove":
                newest = row.seq if newest is None else max(newest, row.seq)
            elif row.seq not in adds or row.ts < adds[row.seq]:
                adds[row.seq] = row.ts
        for seq, ts in adds.items():
            if newest is not None and seq <= newest:
                continue
            if self.adds.containsKey((seq,)):
                ts = min(ts, self.adds.getValue((seq,))[0])
            self.adds.updateValue((seq,), (ts,))
            if first is None or (seq, ts) < first:
                first = (seq, ts)
        if newest != last:
            self.last.update((newest,))
            gone = [k for k in self.adds.keys() if k[0] <= newest]
            for k in gone:
                self.adds.removeKey(k)
            if first is not None and first[0] <= newest:
                first = min(((k[0], v[0]) for k, v in self.adds.iterator()), default=None)
        if first is None:
            self.first.clear()
        else:
            self.first.update(first)
        seq, ts = first or (None, None)
        yield Row(playlist_id=key[0], track_id=key[1], last_remove=newest, first_seq=seq, first_ts=ts)

    def close(self) -> None:
        pass


def pair_states(changes: DataFrame, cat: Catalog) -> DataFrame:
    """State of every pair that a micro-batch of ``changes`` (CHANGE_SCHEMA) touches.

    Adds that name an unknown playlist or track fail and leave no state; the
    two tables are read as they stand in ``cat``.
    """
    log = changes.filter(F.col("seq").isNotNull() & F.col("op").isin("add", "remove") & F.col(PAIR[0]).isNotNull() & F.col(PAIR[1]).isNotNull())
    log = log.withColumn("ts", F.col("ts").cast("string"))
    adds = log.filter(F.col("op") == "add")
    adds = adds.join(cat.playlist.select("playlist_id"), "playlist_id", "left_semi").join(cat.track.select("track_id"), "track_id", "left_semi")
    known = log.filter(F.col("op") == "remove").unionByName(adds)
    return known.groupBy(*PAIR).transformWithState(
        statefulProcessor=PairLog(), outputStructType=PAIR_STATE, outputMode="Update", timeMode="None"
    )


def pair_changes(outside: Catalog, states: DataFrame) -> Changes:
    """The batch that brings the stored rows of the touched pairs to their state.

    ``outside`` is the catalog without what this log did before: its rows are
    adds before every change, so they stand unless the pair was removed.
    """
    pair = list(PAIR)
    stored = outside.playlist_track.select(*pair, F.col("added_at").alias("_stored_at"), F.lit(True).alias("_stored"))
    joined = states.join(stored, pair, "left")
    stands = F.col("last_remove").isNull() & F.col("_stored").isNotNull()
    rows = joined.filter(stands | F.col("first_seq").isNotNull()).select(
        *pair, F.when(stands, F.col("_stored_at")).otherwise(F.col("first_ts").cast("timestamp_ntz")).alias("added_at")
    )
    return Changes({"playlist_track": rows}, {"playlist_track": states.select(*pair)})


def playlist_log_sink(root: str, stream: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler: one committed batch per micro-batch of pair states."""

    def handle(states: DataFrame, batch_id: int) -> None:
        spark = states.sparkSession
        if is_committed(spark, root, stream, batch_id):
            return
        outside = load_catalog(spark, root, skip_stream=stream, tables=("playlist_track",))
        commit_changes(spark, root, pair_changes(outside, states), stream, batch_id, outside.as_of)

    return handle


def start_playlist_log(
    spark: SparkSession, changes: DataFrame, root: str, checkpoint_location: str, trigger: dict | None = None
) -> StreamingQuery:
    """Apply a streaming DataFrame of playlist changes to the catalog stored at ``root``."""
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    sink = playlist_log_sink(root, stream_id(spark, checkpoint_location))
    states = pair_states(changes, load_catalog(spark, root, tables=("playlist", "track")))
    writer = states.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint_location)
    return (writer.trigger(**trigger) if trigger else writer).start()
