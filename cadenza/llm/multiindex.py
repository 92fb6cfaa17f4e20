"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut into two halves, each quantised by its own codebook; a cell
is a pair of codewords. A query walks the pairs in ascending order of summed
distance with a heap until the cells hold enough entries, and these entries
are reranked by the exact inner product.

Largest inner product becomes smallest distance by one more coordinate:
sqrt(M^2 - |x|^2) for the vectors (M the largest norm), 0 for queries.

How many entries are enough is measured, not guessed: for at most
``CALIBRATION`` queries, chosen by hash, all entries are searched, and the
walk goes as far as the ``RECALL`` share of their true neighbours needs. It
is a small share of structured vectors and a large one of random ones.

Codebooks are fitted on a bounded sample (about ``SAMPLE`` vectors, chosen by
hash); every vector is indexed. Copies of a vector are one entry with the
smallest ``k`` + 1 of their ids, which is all that a result of k can need. The
walk needs only the table of cell sizes (``CODES`` squared numbers). Cells
with one first codeword are kept together and split into blocks of rows and
blocks of queries; a task works on pairs of blocks, in which a query meets
the rows of its cells only.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

CODES = 24
SAMPLE = 20_000
LLOYD = 12
SEED = 11
CALIBRATION = 200
RECALL = 0.96
K = 20
#: Rows and queries of one block of a cell.
ROW_BLOCK = 2048
QUERY_BLOCK = 512


def valid(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v): rows whose vector is not null, not zero and has only finite components; v as doubles."""
    v = F.col("v")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.where(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """A list column as rows of ``width`` doubles, shorter ones padded with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def lloyd(x: np.ndarray, k: int, rounds: int = LLOYD, seed: int = SEED) -> np.ndarray:
    """k-means; codewords without points are dealt anew to the farthest points."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(rounds):
        d = squared(x, centres)
        own = d.argmin(axis=1)
        sizes = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        full = sizes > 0
        centres[full] = sums[full] / sizes[full, None]
        empty = np.flatnonzero(~full)
        centres[empty] = x[np.argsort(-d.min(axis=1), kind="stable")[: len(empty)]]
    return centres


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(axis=1)[None, :]


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells (i * codes + j) in ascending order of first[i] + second[j] until they hold ``enough`` entries."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    da, db = first[a].tolist(), second[b].tolist()
    codes = len(db)
    heap, seen = [(da[0] + db[0], 0, 0)], {(0, 0)}
    cells, held = [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * codes + int(b[j])
        if sizes[cell]:
            cells.append(cell)
            held += int(sizes[cell])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(da) and q < codes and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (da[p] + db[q], p, q))
    return cells


class Index:
    """Codebooks and cell sizes; entries as a written table (cell, ids, v)."""

    def __init__(self, vectors: DataFrame, *, codes: int = CODES, sample: int = SAMPLE, k: int = K):
        """``vectors(id, v)`` as ``valid`` gives them."""
        self.k, self.codes = k, codes
        shape = vectors.agg(F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)), F.count("*")).first()
        self.width, self.norm2, rows = shape[0] or 0, shape[1] or 0.0, shape[2]
        self.entries: DataFrame | None = None
        if not rows:
            return
        # Copies: only the k + 1 smallest ids of a vector can be in a result; the window keeps them before it shuffles.
        rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
        few = vectors.select("id", "v", rank.alias("nth")).where(F.col("nth") <= k + 1)
        distinct = materialise(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
        share = F.pmod(F.xxhash64("v"), F.lit(1_000_003)) / F.lit(1_000_003.0)
        drawn = distinct.where(share * F.lit(float(max(distinct.count(), 1))) < F.lit(float(sample))).select("v").toArrow()
        x = self._augmented(matrix(drawn.column("v").combine_chunks(), self.width)) if drawn.num_rows else np.zeros((0, self.width + 1))
        if not len(x):
            x = self._augmented(matrix(distinct.limit(codes).select("v").toArrow().column("v").combine_chunks(), self.width))
        x = x[np.lexsort(x.T)]
        self.half = (self.width + 1) // 2
        self.books = [lloyd(x[:, : self.half], codes), lloyd(x[:, self.half :], codes)]
        coded = materialise(distinct.mapInArrow(self._coder(), "cell int, ids array<long>, v array<double>"), "cells")
        self.sizes = np.zeros(len(self.books[0]) * len(self.books[1]), dtype=np.int64)
        for r in coded.groupBy("cell").agg(F.count("*").alias("n")).collect():  # at most codes squared rows
            self.sizes[r["cell"]] = r["n"]
        self.entries = coded

    def _augmented(self, x: np.ndarray) -> np.ndarray:
        return np.c_[x, np.sqrt(np.maximum(self.norm2 - (x * x).sum(axis=1), 0))]

    def _coder(self):
        width, half, books, augmented = self.width, self.half, self.books, self._augmented_by(self.norm2)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                x = augmented(matrix(b.column("v"), width))
                i, j = squared(x[:, :half], books[0]).argmin(axis=1), squared(x[:, half:], books[1]).argmin(axis=1)
                cell = (i * len(books[1]) + j).astype(np.int32)
                yield pa.record_batch([pa.array(cell), b.column("ids"), b.column("v")], names=["cell", "ids", "v"])

        return run

    @staticmethod
    def _augmented_by(norm2: float):
        return lambda x: np.c_[x, np.sqrt(np.maximum(norm2 - (x * x).sum(axis=1), 0))]


def positions(index: Index, queries: pa.Table, neighbours: dict[int, list[int]]) -> list[int]:
    """For each true neighbour's cell, the entries that a walk holds when it has reached that cell."""
    x = np.c_[matrix(queries.column("v").combine_chunks(), index.width), np.zeros(queries.num_rows)]
    first, second = squared(x[:, : index.half], index.books[0]), squared(x[:, index.half :], index.books[1])
    out = []
    for q, a, b in zip(queries.column("id").to_pylist(), first, second, strict=True):
        order = walk(a, b, index.sizes, int(index.sizes.sum()))
        held = dict(zip(order, np.cumsum(index.sizes[order]).tolist(), strict=True))
        out += [held[c] for c in neighbours.get(q, [])]
    return out


def calibrate(index: Index, queries: DataFrame, *, sample: int = CALIBRATION, recall: float = RECALL) -> int:
    """Entries that a walk must hold to meet ``recall`` of the true neighbours of a bounded sample of ``queries``."""
    share = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    drawn = queries.where(share * F.lit(float(queries.count())) < F.lit(float(sample))).limit(2 * sample).toArrow()
    if not drawn.num_rows:
        drawn = queries.limit(sample).toArrow()
    width, k = index.width, index.k
    q, asked = matrix(drawn.column("v").combine_chunks(), width), drawn.column("id").to_numpy()

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            dots = q @ matrix(b.column("v"), width).T
            ids = b.column("ids")
            alone = np.where(np.diff(ids.offsets.to_numpy()) == 1, ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()], -1)
            dots[(asked[:, None] == alone[None, :]) & (alone >= 0)] = -np.inf
            kept = min(k, dots.shape[1])
            top = np.argpartition(-dots, kept - 1, axis=1)[:, :kept]
            row = np.repeat(np.arange(len(q)), kept)
            yield pa.record_batch([pa.array(asked[row]), pa.array(dots[row, top.ravel()]), b.column("cell").take(pa.array(top.ravel()))], names=["id", "dot", "cell"])

    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("dot"), "cell"))
    met = index.entries.select("cell", "ids", "v").mapInArrow(best, "id long, dot double, cell int")
    true: dict[int, list[int]] = {}
    for r in met.select("id", "cell", rank.alias("n")).where(F.col("n") <= k).collect():  # k rows for each query of the sample
        true.setdefault(r["id"], []).append(r["cell"])
    return int(np.quantile(positions(index, drawn, true), recall, method="higher"))


def search(index: Index, queries: DataFrame, *, k: int | None = None, probe: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` entries of largest inner product that each query of ``queries(id, v)`` meets, its own id left out.

    ``probe`` is the number of entries at which a walk ends (measured if not
    given). Ties go to the smaller vec_id. A query that is repeated is
    answered once.
    """
    k = k or index.k
    spark = queries.sparkSession
    rows = materialise(queries.select("id", "v").dropDuplicates(["id"]), "queries")
    if index.entries is None or rows.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    probe = probe or calibrate(index, rows)
    books, sizes, half, width = index.books, index.sizes, index.half, index.width
    codes = len(books[1])

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("seconds", pa.binary())]))
        for b in batches:
            if not b.num_rows:
                continue
            x = np.c_[matrix(b.column("v"), width), np.zeros(b.num_rows)]
            walks = []
            for p, q in zip(squared(x[:, :half], books[0]), squared(x[:, half:], books[1]), strict=True):
                met = np.zeros((len(books[0]), codes), dtype=bool)
                met.ravel()[walk(p, q, sizes, probe)] = True
                walks.append([{"first": i, "seconds": np.packbits(met[i]).tobytes()} for i in np.flatnonzero(met.any(axis=1)).tolist()])
            yield pa.record_batch([b.column("id"), b.column("v"), pa.array(walks, kind)], names=["id", "v", "walk"])

    planned = rows.mapInArrow(plan, "id long, v array<double>, walk array<struct<first int, seconds binary>>")
    visits = materialise(planned.select("id", "v", F.explode("walk").alias("w")).select("id", "v", "w.*"), "walks")
    counts = {r["first"]: r["n"] for r in visits.groupBy("first").agg(F.count("*").alias("n")).collect()}  # one row per codeword
    row_blocks = [max(1, -(-int(n) // ROW_BLOCK)) for n in sizes.reshape(-1, codes).sum(axis=1)]
    query_blocks = [max(1, -(-counts.get(i, 0) // QUERY_BLOCK)) for i in range(len(books[0]))]

    def blocks(of: list[int]):
        return F.element_at(F.array(*map(F.lit, of)), F.col("first") + 1)

    def every(of: list[int]):
        return F.explode(F.sequence(F.lit(0), blocks(of) - 1))

    left = visits.select("first", F.pmod(F.xxhash64("id"), blocks(query_blocks)).cast("int").alias("q"), "id", "v", "seconds", every(row_blocks).alias("r"))
    cell = F.col("cell")
    right = index.entries.select(F.floor(cell / codes).cast("int").alias("first"), F.pmod(cell, F.lit(codes)).alias("second"), "ids", "v")
    right = right.select("first", F.pmod(F.xxhash64(F.element_at("ids", 1)), blocks(row_blocks)).cast("int").alias("r"), "second", "ids", "v", every(query_blocks).alias("q"))

    def score(key: tuple, qs: pd.DataFrame, xs: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(qs) and len(xs):
            q, x, asked = padded(qs["v"], width), padded(xs["v"], width), qs["id"].to_numpy()
            met = np.unpackbits(np.frombuffer(b"".join(qs["seconds"]), dtype=np.uint8).reshape(len(qs), -1), axis=1)[:, :codes].astype(bool)
            owner = np.repeat(np.arange(len(xs)), xs["ids"].map(len).to_numpy())
            ids, second = np.concatenate(xs["ids"].to_list()), xs["second"].to_numpy()[owner]
            for at in range(0, len(q), 64):
                own = asked[at : at + 64, None]
                dots = (q[at : at + 64] @ x.T)[:, owner]
                dots[(own == ids[None, :]) | ~met[at : at + 64][:, second]] = -np.inf
                kept = min(k, dots.shape[1])
                least = -np.partition(-dots, kept - 1, axis=1)[:, kept - 1]  # the k-th largest, less what rounding can move
                row, place = np.nonzero((dots >= least[:, None] - 1e-9 * np.abs(dots, where=np.isfinite(dots), out=np.zeros_like(dots)).max()) & np.isfinite(dots))
                found.append((own[row, 0], ids[place], exact(q[at + row], x[owner[place]])))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, dtype=t) for t in ("int64", "int64", "float64")]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    met = left.groupBy("first", "r", "q").cogroup(right.groupBy("first", "r", "q")).applyInPandas(score, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score")
    return ranked.where(F.col("rank") <= k)


def padded(vectors: pd.Series, width: int) -> np.ndarray:
    lists = vectors.to_list()
    if all(len(v) == width for v in lists):
        return np.array(lists, dtype=np.float64)
    out = np.zeros((len(lists), width))
    for row, v in zip(out, lists, strict=True):
        row[: len(v)] = v
    return out


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in one fixed order: equal vectors have equal scores wherever they are met."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += q[:, j] * x[:, j]
    return out


def nearest(vectors: DataFrame, queries: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", k: int = K, probe: int | None = None, codes: int = CODES) -> DataFrame:
    """Index ``vectors`` and search it for every row of ``queries`` (columns as in ``vectors``).

    Vectors that are null, zero, empty or hold null or non-finite components
    take no part; shorter vectors count as padded with zeros. Rows with equal
    id and vector are one candidate each time they come, so equal ids can
    fill several ranks only if their vectors differ; rows without id are
    ignored. Other columns are ignored; no rows give no rows.
    """
    rows = valid(vectors, id_column, vector_column).where("id is not null").distinct()
    asked = valid(queries, id_column, vector_column).where("id is not null")
    return search(Index(rows, codes=codes, k=k), asked, k=k, probe=probe)
