"""SimHash near-duplicates with pivot distance tables.

A fingerprint has a bit set where more than half of the shingle hashes have
it. Two fingerprints link at ``max_bits`` or fewer differing bits; documents
of one connected component are one group.

Distances to many fixed reference fingerprints (the pivot table) discard
pairs: two fingerprints within r bits have distances to every reference that
differ by at most r, so the largest coordinate difference is a lower bound of
their distance, and only survivors are verified by exclusive or. In 64 bits
distances to a reference crowd around 32, so references alone cannot deal
fingerprints out to tasks: that is done by blocks of bits. With b blocks and
at most r differing bits at least b - r blocks agree, so each set of b - r
blocks makes one key, and every link has a common key (complete for any r).

Copies: links are looked for between distinct fingerprints only, so copies of
one text meet in a map-side aggregate and never in a pair. Buckets of a key
that hold more than ``BUCKET`` fingerprints are split into chunks, and each
pair of chunks is a task of its own; every task returns a spanning forest of
its links, not the links themselves.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, map_batches, materialise, release, texts_of

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BLOCKS = 6
PIVOTS = 24
#: Fingerprints of one key that one task compares with one another.
BUCKET = 4096

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text: str, words: int = SHINGLE_WORDS) -> list[bytes]:
    """Space-joined runs of ``words`` words in UTF-8; the whole sequence if there are fewer, none without words."""
    found = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()  # bytes split at \\x20 and \\x09-\\x0D only
    if not found:
        return []
    joined = b" ".join(found)
    ends = list(itertools.accumulate(map(len, found), lambda a, n: a + n + 1))
    if len(found) <= words:
        return [joined]
    starts = [0, *(e + 1 for e in ends[:-1])]
    return [joined[a:b] for a, b in zip(starts, ends[words - 1 :], strict=False)]


def fingerprint(grams: list[bytes], seed: int = SEED) -> int:
    """64-bit majority of the shingles' XXH64 values; 0 without shingles."""
    if not grams:
        return 0
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(g, seed) for g in grams), dtype="<u8", count=len(grams))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, *, words: int = SHINGLE_WORDS, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) and the ``keep`` columns (longs): fp is the fingerprint as a signed long."""

    def make():
        def step(batch: pa.RecordBatch):
            fps = np.array([fingerprint(shingles(t, words), seed) for t in texts_of(batch)], dtype=np.uint64)
            yield pa.record_batch([batch.column("doc_id"), pa.array(fps.view(np.int64)), *map(batch.column, keep)], names=["doc_id", "fp", *keep])

        return step

    schema = ", ".join(f"{c} long" for c in ("doc_id", "fp", *keep))
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text", *keep), make, schema)


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: XXH64 of their numbers."""
    return np.array([xxhash.xxh64_intdigest(str(i), 0) for i in range(count)], dtype=np.uint64)


def pivot_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distances to every reference, one row per reference."""
    return np.bitwise_count(fps[None, :] ^ refs[:, None]).astype(np.int8)


def survivors(fps: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (a, b), those within ``max_bits``: discarded reference by reference, then verified."""
    for row in table:
        if not len(a):
            return a, b
        near = np.abs(row[a] - row[b]) <= max_bits
        a, b = a[near], b[near]
    near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
    return a[near], b[near]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each of n rows by the links (a, b)."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        if (la == lb).all():
            break
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    return label


def links_within(run: np.ndarray, fps: np.ndarray, refs: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among rows with equal ``run`` number; rows come sorted by it."""
    table = pivot_table(fps, refs)
    found_a, found_b = [], []
    begins = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    sizes = np.diff(np.r_[begins, len(run)])
    small = np.repeat(sizes <= 64, sizes)
    for off in range(1, int(min(sizes.max(), 64))):  # all short runs at once, by distance within the run
        a = np.flatnonzero((run[off:] == run[:-off]) & small[off:])
        x, y = survivors(fps, table, a, a + off, max_bits)
        found_a.append(x)
        found_b.append(y)
    for begin, size in zip(begins[sizes > 64].tolist(), sizes[sizes > 64].tolist(), strict=True):
        # A long run is sorted by its distance to the first reference: only rows within max_bits of it are paired.
        order = begin + np.argsort(table[0, begin : begin + size], kind="stable")
        first = table[0, order]
        upto = np.searchsorted(first, first + max_bits, side="right")
        label = np.arange(size)
        for at in range(0, size, 256):
            count = upto[at : at + 256] - np.arange(at, min(at + 256, size)) - 1
            left = np.repeat(np.arange(at, min(at + 256, size)), count)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
            apart = label[left] != label[right]  # rows joined already need no further link
            x, y = survivors(fps, table, order[left[apart]], order[right[apart]], max_bits)
            if len(x):
                found_a.append(x)
                found_b.append(y)
                place = np.empty(size, dtype=np.int64)
                place[order - begin] = np.arange(size)
                label = _forest(size, np.r_[place[x - begin], np.arange(size)], np.r_[place[y - begin], label])
    if not found_a:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    label = _forest(len(run), np.concatenate(found_a), np.concatenate(found_b))
    rows = np.flatnonzero(label != np.arange(len(run)))
    return rows, label[rows]


def block_masks(blocks: int = BLOCKS, max_bits: int = MAX_BITS) -> list[int]:
    """A mask for each set of ``blocks - max_bits`` of the blocks, as signed longs."""
    if not 0 <= max_bits < blocks <= 64:
        raise ValueError("max_bits must be smaller than blocks")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    single = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edges)]
    masks = [sum(c) for c in itertools.combinations(single, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, *, max_bits: int = MAX_BITS, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fps(fp)`` that span every group of near fingerprints."""
    key = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(block_masks(blocks, max_bits))]))
    keyed = fps.select("fp", key.alias("k")).select("fp", "k.c", "k.v")
    counts = materialise(keyed.groupBy("c", "v").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    shared = keyed.join(counts, ["c", "v"])
    chunks = F.ceil(F.col("n") / bucket).cast("int")
    chunk = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = shared.select("c", "v", "fp", chunks.alias("chunks"), chunk.alias("chunk")).select("*", other.alias("other"))
    pair = dealt.select("c", "v", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "fp")
    width = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = pair.repartition(width, "c", "v", "i", "j").sortWithinPartitions("c", "v", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        refs = pivots()
        kept: list[np.ndarray] | None = None  # rows of a run that the next batch may go on with

        def out(columns: list[np.ndarray]):
            if not len(columns[0]):
                return
            keys, f = columns[:-1], columns[-1]
            new = np.zeros(len(f), dtype=bool)
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            a, b = links_within(np.cumsum(new), f.view(np.uint64), refs, max_bits)
            if len(a):
                yield pa.record_batch([pa.array(f[a]), pa.array(f[b])], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("c", "v", "i", "j", "fp")]
            if kept is not None:
                columns = [np.concatenate(x) for x in zip(kept, columns, strict=True)]
            if not len(columns[0]):
                continue
            same = np.ones(len(columns[0]), dtype=bool)
            for k in columns[:-1]:
                same &= k == k[-1]
            cut = int(np.flatnonzero(~same)[-1]) + 1 if (~same).any() else 0
            yield from out([x[:cut] for x in columns])
            kept = [x[cut:] for x in columns]
        if kept is not None:
            yield from out(kept)

    return sorted_.mapInArrow(run, "a long, b long")


def _members(distinct: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """(fp, root) of the fingerprints ``distinct(fp)`` that are linked to another."""
    members = components(links(distinct.select("fp"), max_bits=max_bits, blocks=blocks))
    return materialise(members.withColumnsRenamed({"node": "fp"}), "members")


def near_duplicates(docs: DataFrame, *, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, fp (signed), fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id of the group. Null and empty texts
    have fingerprint zero and are linked like any other; a null doc_id gets
    the component_id of its group (null if the group has none). Repeated rows
    give repeated rows. Other columns are ignored; no rows give no rows.
    """
    fps = materialise(fingerprints(docs, words=words), "fingerprints")
    distinct = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    members = _members(distinct, max_bits, blocks)
    roots = members.join(distinct, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    linked = members.join(roots, "root").select("fp", "component_id")
    class_of = materialise(
        distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id")), "classes"
    )
    return fps.join(class_of, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, key: str, *, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """The ``key`` of one row per group of ``docs(doc_id, text, key)``; ``key`` is a long that no two rows share.

    The row is the smallest by doc_id (null last), hash of the text and
    ``key``. Rows meet in map-side aggregates only, first by fingerprint.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("row_hash"), F.col(key).alias("row_key"))
    fps = fingerprints(rows, words=words, keep=("row_hash", "row_key"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash", "row_key")
    distinct = materialise(fps.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    groups = distinct.join(_members(distinct, max_bits, blocks), "fp", "left")
    first = groups.groupBy(F.coalesce("root", "fp").alias("group")).agg(F.min("first").alias("first"))
    return first.select(F.col("first.row_key").alias(key))
