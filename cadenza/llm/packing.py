"""Best-fit packing by bin completion.

``pieces`` turns documents into pieces of at most ``capacity`` tokens (only a
longer document is cut, its first piece taking the remainder), ``plan_bins``
packs the *histogram* of piece lengths, and ``pack`` gives every piece its
place in that plan.

The plan needs only the number of pieces per length (at most ``capacity``
counts, whatever the corpus), so the search runs on the driver over a bounded
input while every row stays on the executors: a piece finds its place from
its rank among the pieces of equal length. The search is bin completion: the
largest open length gets each undominated filling of the space beside it,
branches are cut by the waste bound, and best-fit solutions serve as
incumbents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, memo_encoder

CAPACITY = 1024
END_ID = 2
#: Branch-and-bound nodes before the incumbent (a whole, valid packing) is returned.
NODE_LIMIT = 4_000
#: A best-fit solution of what is still open is tried as incumbent at every so many closed kinds of sequence.
INCUMBENT_EVERY = 16
#: Fillings tried per node, best first.
FILLINGS = 24


@dataclass(frozen=True)
class Bins:
    """``count`` equal sequences, each filled with ``lengths`` (descending) in this order."""

    lengths: tuple[int, ...]
    count: int


def _best_fit(counts: dict[int, int], capacity: int) -> list[Bins]:
    """Best-fit decreasing over a histogram: sequences in equal states are filled together."""
    states: dict[tuple[int, ...], int] = {}
    room: dict[int, list[tuple[int, ...]]] = {}

    def put(items: tuple[int, ...], n: int) -> None:
        if items not in states:
            room.setdefault(capacity - sum(items), []).append(items)
        states[items] = states.get(items, 0) + n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            space = min((r for r in room if r >= length and room[r]), default=None)
            if space is None:
                fit = min(capacity // length, left)
                n = left // fit
                put((length,) * fit, n)
                left -= n * fit
                continue
            items = room[space][-1]
            have, fit = states[items], min(space // length, left)
            n = min(have, left // fit)
            states[items] = have - n
            if states[items] == 0:
                del states[items]
                room[space].pop()
            put(items + (length,) * fit, n)
            left -= n * fit
    return [Bins(items, n) for items, n in states.items() if n]


def _size(bins: list[Bins]) -> int:
    return sum(b.count for b in bins)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's bound: large items alone, medium ones beside the space they leave."""
    best = -(-sum(k * n for k, n in counts.items()) // capacity)
    sizes = sorted(counts)
    for k in [0, *(s for s in sizes if s <= capacity // 2)]:
        big = sum(n for s, n in counts.items() if s > capacity - k)
        half = [(s, n) for s, n in counts.items() if capacity // 2 < s <= capacity - k]
        small = sum(s * n for s, n in counts.items() if k <= s <= capacity // 2)
        n_half = sum(n for _, n in half)
        spare = n_half * capacity - sum(s * n for s, n in half)
        best = max(best, big + n_half + max(0, -(-(small - spare) // capacity)))
    return best


def fillings(counts: dict[int, int], space: int, limit: int = FILLINGS) -> list[tuple[int, ...]]:
    """Undominated sets of lengths for ``space``, least waste first.

    A set that leaves room for another open length is dominated by itself
    plus that length, so only maximal sets count; of sets with one length
    each, a shorter one is dominated by the longest that fits.
    """
    sizes = sorted((s for s, n in counts.items() if n and s <= space), reverse=True)
    found: dict[tuple[int, ...], int] = {}
    budget = [40 * limit]

    def grow(at: int, left: int, chosen: tuple[int, ...]) -> None:
        if budget[0] <= 0 or (left and len(found) >= 4 * limit):
            return
        budget[0] -= 1
        fits = [i for i in range(at, len(sizes)) if sizes[i] <= left and counts[sizes[i]] > chosen.count(sizes[i])]
        if not fits:
            smallest = next((s for s in reversed(sizes) if s <= left and counts[s] > chosen.count(s)), None)
            if smallest is None:
                found[chosen] = left
            return
        for i in fits[: limit if chosen else None]:
            grow(i, left - sizes[i], (*chosen, sizes[i]))
            if len(chosen) >= 1 and i == fits[0] and sizes[i] == left:
                return  # nothing leaves less waste

    grow(0, space, ())
    singles = [c for c in found if len(c) == 1]
    longest = max(singles, default=None)
    return sorted((c for c in found if len(c) != 1 or c == longest), key=lambda c: (found[c], len(c), [-x for x in c]))[:limit]


def _complete(counts: dict[int, int], capacity: int, target: int, best: list[Bins], node_limit: int) -> list[Bins]:
    """Depth-first bin completion; the best packing found, at worst ``best``.

    One step closes as many sequences of one kind as the counts allow. The
    waste bound cuts: closed sequences plus the bound of what is open must
    stay below the incumbent. Steps are made and taken back in one table of
    open counts, so memory follows the depth.
    """
    limit, result = _size(best), best
    open_ = dict(counts)
    tokens = sum(k * n for k, n in open_.items())
    closed: list[Bins] = []
    used = 0
    frames = [iter(_options(open_, capacity))]
    for _ in range(node_limit):
        while frames and (step := next(frames[-1], None)) is None:
            frames.pop()
            if closed:
                back = closed.pop()
                used -= back.count
                for s in back.lengths:
                    open_[s] = open_.get(s, 0) + back.count
                    tokens += s * back.count
        if not frames:
            break
        times = min(open_[s] // step.count(s) for s in set(step))
        for s in step:
            open_[s] -= times
            tokens -= s * times
            if not open_[s]:
                del open_[s]
        closed.append(Bins(step, times))
        used += times
        if used + -(-tokens // capacity) < limit:
            if len(closed) % INCUMBENT_EVERY == 1 or not open_:
                tail = _best_fit(open_, capacity)
                if used + _size(tail) < limit:
                    limit, result = used + _size(tail), [*closed, *tail]
                    if limit <= target:
                        break
            frames.append(iter(_options(open_, capacity) if open_ else []))
        else:
            frames.append(iter([]))
    return result


def _options(open_: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Fillings of a sequence around the largest open length."""
    first = max(open_)
    rest = {**open_, first: open_[first] - 1}
    return [(first, *more) for more in fillings(rest, capacity - first) or [()]]


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY, node_limit: int = NODE_LIMIT) -> list[Bins]:
    """Sequences for a histogram of lengths (each from 1 to ``capacity``)."""
    counts = {int(k): int(n) for k, n in counts.items() if n > 0}
    if not counts:
        return []
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError(f"lengths must be from 1 to {capacity}")
    best = _best_fit(counts, capacity)
    target = lower_bound(counts, capacity)
    if _size(best) > target:
        best = _complete(counts, capacity, target, best, node_limit)
    return best


def slots(bins: list[Bins]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, per sequence, first sequence, offset): where the pieces of each rank go."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for b in bins:
        at = 0
        for length in sorted(set(b.lengths), reverse=True):
            per = b.lengths.count(length)
            out.setdefault(length, []).append((ranks.get(length, 0), per, sequence, at))
            ranks[length] = ranks.get(length, 0) + per * b.count
            at += per * length
        sequence += b.count
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenise whole texts and cut only documents longer than ``capacity``.

    ``with_ids`` adds the ids themselves as little-endian uint32 bytes. The
    columns ``task`` and ``local`` number the pieces of each length within
    the task that made them.
    """
    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int32(), "ids_crc32": pa.int64()}
    if with_ids:
        kinds["ids"] = pa.binary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = memo_encoder(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows: list[tuple] = []
            for doc, raw in zip(batch.column("doc_id").to_pylist(), encoder.encode_column(batch.column("text")), strict=True):
                raw += end
                n = len(raw) // 4
                at, count = 0, -(-n // capacity)
                for k in range(count):
                    stop = n - capacity * (count - 1 - k)
                    ids = raw[4 * at : 4 * stop]
                    rows.append((doc, k, at, stop - at, zlib.crc32(ids), ids))
                    at = stop
            lengths = np.array([r[3] for r in rows], dtype=np.int64)
            local = seen[lengths] + _rank_among_equals(lengths)
            seen += np.bincount(lengths, minlength=capacity + 1)
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=False)]
            yield pa.record_batch([*columns, pa.array(np.full(len(rows), task), pa.int32()), pa.array(local)], names=[*kinds, "task", "local"])

    schema = PIECES + (", ids binary" if with_ids else "") + ", task int, local long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _rank_among_equals(values: np.ndarray) -> np.ndarray:
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    begins = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    rank = np.arange(len(values)) - np.repeat(begins, np.diff(np.r_[begins, len(values)]))
    out = np.empty(len(values), dtype=np.int64)
    out[order] = rank
    return out


def pack(
    docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, node_limit: int = NODE_LIMIT
) -> DataFrame:
    """Pack the token ids of ``docs(doc_id, text)`` into sequences of at most ``capacity``.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset
    (and ``ids`` if asked). Null text is empty, and an empty document is its
    end id alone; repeated rows and null ids are packed as they come, each
    row by itself; columns besides doc_id and text are ignored; no rows give
    no rows. Pieces of equal length are interchangeable: which takes which
    place follows the written table of pieces.
    """
    cut = materialise(pieces(docs, tokenizer, capacity=capacity, end_id=end_id, with_ids=with_ids), "pieces")
    sums = materialise(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    counts = {r["length"]: r["total"] for r in sums.groupBy("length").agg(F.sum("n").alias("total")).collect()}
    places = slots(plan_bins(counts, capacity, node_limit))
    # One row per task and length: the window never sees the pieces themselves.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(base, ["task", "length"]).withColumn("rank", F.col("base") + F.col("local"))
    keep = [c for c in cut.columns if c not in ("task", "local")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(ranks), dtype=np.int64), np.empty(len(ranks), dtype=np.int64)
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                table = places[length]
                row = table[np.searchsorted(table[:, 0], ranks[at], side="right") - 1]
                nth = ranks[at] - row[:, 0]
                sequence[at] = row[:, 2] + nth // row[:, 1]
                offset[at] = row[:, 3] + nth % row[:, 1] * length
            yield pa.record_batch([*(batch.column(c) for c in keep), pa.array(sequence), pa.array(offset)], names=[*keep, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema if f.name in keep)
    return ranked.select(*keep, "rank").mapInArrow(run, schema + ", sequence_id long, offset long")
