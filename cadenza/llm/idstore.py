"""Keyed store of token ids: raw payload shards and a minimal perfect hash index.

``write`` lays the ids of all documents down in ascending doc_id order as
payload shards (little-endian uint32, nothing else) and builds the index:
keys are dealt to segments by hash, and each segment gets a minimal perfect
hash function by hash-and-displace plus one table in its order with the
fingerprint, shard, offset and length of every key. ``lookup`` evaluates the
function, compares the stored fingerprint and reads the payload: one probe
(in the segment's index file, read once by a task for all its keys there) and
one ranged read per key.

Files, all below one folder:

* ``ids-<task>-<attempt>.u16`` or ``.u32``: ids of a range of documents, in
  16 bits where the whole vocabulary fits, else in 32. The attempt's name is part of the row that reports the file, so a repeated task leaves an
  unused file but never a mixed one.
* ``index-<segment>-<attempt>.mph``: ``MAGIC``, then uint32 number of keys n,
  number of displacements m and hash seed; int64[m] displacements; then, in
  the function's order, uint32[n] fingerprints, uint32[n] shard numbers,
  uint64[n] offsets (in ids), uint32[n] lengths.

A key is (doc_id, occurrence): occurrence 0 is the first row of that doc_id,
further rows with the same doc_id follow in the order of the first ``PREFIX``
characters of their texts, then of a hash, then of the whole texts.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .common import filesystem, materialise, memo_encoder, scratch_path

END_ID = 0
MAGIC = b"CDZMPH01"
KINDS = {"u16": np.dtype("<u2"), "u32": np.dtype("<u4")}
#: Expected keys per segment of the index.
SEGMENT_KEYS = 20_000
#: Keys per displacement.
LOAD = 4
#: Characters of a text by which rows of one doc_id are dealt to shards (a hash of the whole text deals on).
PREFIX = 16
NULL_KEY = 0x6E756C6C  # stands for a null doc_id, with its own flag in the hash


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, a bijection on 64 bits."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(doc_id: np.ndarray, is_null: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    """64-bit hash of (doc_id, occurrence); without repeats and nulls it has no collisions."""
    ids = np.where(is_null, NULL_KEY, doc_id).astype(np.int64).view(np.uint64)
    extra = occurrence.astype(np.uint64) * np.uint64(2) + is_null.astype(np.uint64)
    with np.errstate(over="ignore"):
        return _mix(ids + np.uint64(0x9E3779B97F4A7C15) + _mix(extra) * (extra > 0))


def fingerprint(h: np.ndarray) -> np.ndarray:
    return (_mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)


def segment_of(h: np.ndarray, segments: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(segments)).astype(np.int32)


def _moved(h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """Slot of keys among n after displacement d."""
    with np.errstate(over="ignore"):
        return (_mix(h + d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)


def _group(h: np.ndarray, seed: int, m: int) -> np.ndarray:
    return (_mix(h ^ np.uint64(seed + 77)) % np.uint64(m)).astype(np.int64)


def _slot(h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """A negative displacement d names slot -d - 1 itself: the place of a key that is alone in its group."""
    return np.where(d < 0, -d - 1, _moved(h, np.where(d < 0, 0, d), n))


#: Displacements tried per group before the next seed.
TRIES = 1 << 20


def _displace(keys: np.ndarray, taken: np.ndarray) -> int | None:
    """Smallest displacement that puts all ``keys`` on free, different slots; marks them taken."""
    n, block, base = len(taken), 64, 0
    while base < TRIES:
        tries = _moved(keys[:, None], np.arange(base, base + block, dtype=np.uint64)[None, :], n)
        for k in np.flatnonzero(~taken[tries].any(axis=0)).tolist():
            slots = tries[:, k]
            if len(set(slots.tolist())) == len(keys):
                taken[slots] = True
                return base + k
        base, block = base + block, min(2 * block, 4096)
    return None


def build(h: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """(displacements, seed, slot of every key) of a minimal perfect hash over distinct hashes."""
    n = len(h)
    if len(np.unique(h)) != n:
        raise ValueError("two keys have one 64-bit hash")
    m = -(-n // LOAD)
    for seed in range(64):
        group = _group(h, seed, m)
        order = np.argsort(group, kind="stable")
        sizes = np.bincount(group, minlength=m)
        begins = np.r_[0, np.cumsum(sizes)]
        taken = np.zeros(n, dtype=bool)
        d = np.zeros(m, dtype=np.int64)
        for g in np.argsort(-sizes, kind="stable").tolist():  # the largest groups first
            if sizes[g] < 2:
                alone = np.flatnonzero(sizes == 1)
                d[alone] = -np.flatnonzero(~taken) - 1
                return d, seed, _slot(h, d[group], n)
            found = _displace(h[order[begins[g] : begins[g + 1]]], taken)
            if found is None:
                break
            d[g] = found
        else:
            return d, seed, _slot(h, d[group], n)
    raise ValueError("no seed gives a perfect hash")


def probe(h: np.ndarray, d: np.ndarray, seed: int, n: int) -> np.ndarray:
    """Slots of keys; those not in the index land anywhere."""
    return _slot(h, d[_group(h, seed, len(d))], n)


_TABLE = (("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u4"))


def dump_segment(h: np.ndarray, shard: np.ndarray, offset: np.ndarray, length: np.ndarray) -> bytes:
    d, seed, slot = build(h)
    n = len(h)
    parts = [MAGIC, np.array([n, len(d), seed], dtype="<u4").tobytes(), d.astype("<i8").tobytes()]
    for (_, kind), values in zip(_TABLE, (fingerprint(h), shard, offset, length), strict=True):
        column = np.zeros(n, dtype=kind)
        column[slot] = values
        parts.append(column.tobytes())
    return b"".join(parts)


def probe_segment(raw: bytes, h: np.ndarray) -> pd.DataFrame:
    """Rows (hit, shard, offset, length) for hashes, from the bytes of an index file."""
    if raw[:8] != MAGIC:
        raise ValueError("not an index file")
    n, m, seed = np.frombuffer(raw, "<u4", 3, 8).tolist()
    at = 20
    d = np.frombuffer(raw, "<i8", m, at)
    at += 8 * m
    slot = probe(h, d, seed, n)
    out = {}
    for name, kind in _TABLE:
        out[name] = np.frombuffer(raw, kind, n, at)[slot]
        at += n * np.dtype(kind).itemsize
    hit = out.pop("fingerprint") == fingerprint(h)
    return pd.DataFrame({"hit": hit, **{k: v.astype(np.int64) for k, v in out.items()}})


@dataclass
class IdStore:
    """What a written store consists of. ``shards`` has one entry per payload file, ``index`` one per segment."""

    spark: SparkSession
    folder: str
    shards: list[tuple[str, int]] = field(default_factory=list)  # (file, ids in all earlier files)
    index: dict[int, str] = field(default_factory=dict)
    segments: int = 0
    keys: DataFrame | None = None  # doc_id, occurrence of every row


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, *, end_id: int = END_ID, segment_keys: int = SEGMENT_KEYS) -> IdStore:
    """Encode ``docs(doc_id, text)`` and write payload shards and index files.

    Null text is empty: its only id is the end id. Rows with equal doc_id are
    kept, ordered by text as the module says and told apart by their
    occurrence; a null doc_id sorts first. Columns besides doc_id and text are
    ignored. Rows of a repeated or null doc_id are dealt to shards by their
    texts; only those that repeat the text as well stay together. Within a
    shard nothing is held but one batch.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "idstore")
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", F.substring("text", 1, PREFIX), F.xxhash64("text")]
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(width, *order).sortWithinPartitions(*order, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = memo_encoder(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        task = TaskContext.get().partitionId()
        store, where = filesystem(folder)
        kind = "u16" if max(len(encoder.spaced), end_id + 1) <= 1 << 16 else "u32"
        name, sink, at = f"ids-{task:06d}-{uuid.uuid4().hex[:12]}.{kind}", None, 0
        last, occurrence = object(), 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                sink = sink or store.open_output_stream(f"{where}/{name}")
                ids = batch.column("doc_id").to_pylist()
                raws = encoder.encode_column(batch.column("text"))
                turns, lengths = [], []
                for doc, raw in zip(ids, raws, strict=True):
                    occurrence = occurrence + 1 if doc == last else 0
                    last = doc
                    turns.append(occurrence)
                    lengths.append(len(raw) // 4 + 1)
                    sink.write(np.frombuffer(raw + end, "<u4").astype(KINDS[kind]).tobytes())
                offsets = at + np.r_[0, np.cumsum(lengths)[:-1]]
                at += sum(lengths)
                n = len(ids)
                columns = [batch.column("doc_id"), pa.array(turns, pa.int64()), pa.array([task] * n, pa.int32())]
                columns += [pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), pa.array([name] * n)]
                yield _with_hash(pa.record_batch(columns, names=["doc_id", "occurrence", "task", "offset", "length", "file"]))
        finally:
            if sink is not None:
                sink.close()

    entries = materialise(ordered.mapInArrow(run, ENTRY), "entries")
    store = IdStore(spark, folder)
    ends = [F.min_by("doc_id", "offset").alias("first"), F.max_by("doc_id", "offset").alias("last"), F.max_by("occurrence", "offset").alias("turn")]
    tasks = entries.groupBy("task", "file").agg(F.sum("length").alias("n"), F.count("*").alias("docs"), *ends).orderBy("task").collect()
    entries = _counted_on(entries, tasks)
    total = 0
    for t in tasks:  # one row per payload file
        store.shards.append((t["file"], total))
        total += t["n"]
    store.keys = entries.select("doc_id", "occurrence")
    if tasks:
        store.segments = max(1, -(-sum(t["docs"] for t in tasks) // segment_keys))
        shard_of = {t["task"]: k for k, t in enumerate(tasks)}
        store.index = _write_index(entries, folder, store.segments, shard_of)
    return store


def _counted_on(entries: DataFrame, tasks: list[Row]) -> DataFrame:
    """``entries`` with the occurrences of a doc_id counted on from task to task; ``tasks`` has one row per payload file."""
    begun, last, so_far = [], object(), 0
    for t in tasks:
        base = so_far if t["first"] == last else 0
        if base:
            begun.append((t["task"], last, base))
        alone = t["first"] == t["last"]  # the task has rows of one doc_id only
        last, so_far = t["last"], t["turn"] + 1 + (base if alone else 0)
    if not begun:
        return entries
    bases = entries.sparkSession.createDataFrame(begun, "at_task int, at_doc long, base long")
    met = (F.col("task") == F.col("at_task")) & F.col("doc_id").eqNullSafe(F.col("at_doc"))
    joined = entries.join(F.broadcast(bases), met, "left")  # at most one row per payload file
    counted = joined.withColumn("occurrence", F.col("occurrence") + F.coalesce("base", F.lit(0)))
    return counted.select(*(c for c in entries.columns if c != "h")).mapInArrow(_hashed, ENTRY)


ENTRY = "doc_id long, occurrence long, task int, offset long, length long, file string, h long"


def _with_hash(b: pa.RecordBatch) -> pa.RecordBatch:
    """Adds the column h, the hash of (doc_id, occurrence)."""
    doc = b.column("doc_id")
    h = key_hash(doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False), b.column("occurrence").to_numpy())
    return b.append_column("h", pa.array(h.view(np.int64)))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return map(_with_hash, batches)


def _write_index(entries: DataFrame, folder: str, segments: int, shard_of: dict[int, int]) -> dict[int, str]:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        store, where = filesystem(folder)
        name = f"index-{key[0]:08d}-{uuid.uuid4().hex[:12]}.mph"
        shard = rows["task"].map(shard_of).to_numpy()
        raw = dump_segment(rows["h"].to_numpy().view(np.uint64), shard, rows["offset"].to_numpy(), rows["length"].to_numpy())
        with store.open_output_stream(f"{where}/{name}") as sink:
            sink.write(raw)
        return pd.DataFrame({"segment": [key[0]], "file": [name]})

    dealt = entries.select(_segment(segments).alias("segment"), "h", "task", "offset", "length")
    made = materialise(dealt.groupBy("segment").applyInPandas(run, "segment int, file string"), "index")
    return {r["segment"]: r["file"] for r in made.collect()}  # one row per segment


def _segment(segments: int) -> Column:
    """``segment_of`` for the column h."""
    return F.pmod(F.shiftrightunsigned("h", 32), F.lit(segments)).cast("int")


def locate(store: IdStore, keys: DataFrame) -> DataFrame:
    """Probe the index for ``keys(doc_id, occurrence)``: adds shard, offset and length, null where the key is unknown."""
    if not store.index:
        return keys.select("doc_id", "occurrence", *(F.lit(None).cast(t).alias(c) for c, t in (("shard", "long"), ("offset", "long"), ("length", "long"))))
    folder, index, segments = store.folder, store.index, store.segments

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = filesystem(folder)
        held: tuple[int, bytes] = (-1, b"")
        for b in batches:
            segment, h = b.column("segment").to_numpy(), b.column("h").to_numpy().view(np.uint64)
            for s in np.unique(segment).tolist():  # rows come sorted by segment
                at = np.flatnonzero(segment == s)
                if s not in index:
                    found = pd.DataFrame({"hit": [False] * len(at), "shard": 0, "offset": 0, "length": 0})
                else:
                    if held[0] != s:
                        with fs.open_input_stream(f"{where}/{index[s]}") as source:
                            held = (s, source.read())
                    found = probe_segment(held[1], h[at])
                miss = ~found["hit"].to_numpy()
                part = b.take(pa.array(at))
                columns = [pa.array(found[c].to_numpy(), pa.int64(), mask=miss) for c in ("shard", "offset", "length")]
                yield pa.record_batch([part.column("doc_id"), part.column("occurrence"), *columns], names=["doc_id", "occurrence", "shard", "offset", "length"])

    width = int(store.spark.conf.get("spark.sql.shuffle.partitions"))
    h = keys.select(F.col("doc_id").cast("long"), F.col("occurrence").cast("long")).mapInArrow(_hashed, "doc_id long, occurrence long, h long")
    dealt = h.withColumn("segment", _segment(segments)).repartitionByRange(width, "segment", "h").sortWithinPartitions("segment")
    return dealt.mapInArrow(run, "doc_id long, occurrence long, shard long, offset long, length long")


def read(store: IdStore, keys: DataFrame | None = None, *, with_ids: bool = False) -> DataFrame:
    """Ids of ``keys`` (all rows of the store if not given), read back from the files.

    Returns doc_id, occurrence, start (ids of all rows before it), n_tokens,
    ids_crc32 and, if asked, ``ids`` as little-endian uint32 bytes. Keys that
    the store does not hold come back with nulls.
    """
    folder, shards = store.folder, store.shards
    found = locate(store, store.keys if keys is None else keys)
    width = int(store.spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartitionByRange(width, "shard", "offset").sortWithinPartitions("shard", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = filesystem(folder)
        held, source = None, None
        try:
            for b in batches:
                rows = []
                for shard, offset, length in zip(*(b.column(c).to_pylist() for c in ("shard", "offset", "length")), strict=True):
                    if shard is None:
                        rows.append((None, None, None, None))
                        continue
                    if held != shard:
                        if source is not None:
                            source.close()
                        held, source = shard, fs.open_input_file(f"{where}/{shards[shard][0]}")
                    kind = KINDS[shards[shard][0].rpartition(".")[2]]
                    raw = np.frombuffer(source.read_at(kind.itemsize * length, kind.itemsize * offset), kind).astype("<u4").tobytes()
                    rows.append((shards[shard][1] + offset, len(raw) // 4, zlib.crc32(raw), raw if with_ids else None))
                start, n, crc, ids = zip(*rows, strict=True) if rows else ((),) * 4
                columns = [b.column("doc_id"), b.column("occurrence"), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "occurrence", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.record_batch(columns, names=names)
        finally:
            if source is not None:
                source.close()

    return dealt.mapInArrow(run, "doc_id long, occurrence long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))
