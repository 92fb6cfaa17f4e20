"""Embedding near-duplicates with an inverted multi-index.

Unit vectors are cut into two halves with a codebook each; the product of the
codebooks is a grid, and a vector lies in the cell of its two nearest
codewords. Every vector walks the grid in ascending order of summed distance
(multi-sequence traversal with a heap) while cells are no more than ``reach``
farther than its own, and meets the vectors of those cells. What it meets is
verified by the cosine of the original vectors in double precision.

``reach`` is measured for a target recall at the threshold itself: vectors of
a bounded sample are turned by just the threshold's angle in random
directions, and the walk goes as far as the ``RECALL`` share of these
partners needs from either end. Links of a larger cosine lie nearer. The
number of codewords follows the number of vectors, so that cells keep the
same size and the work per vector hardly grows.

Copies of a vector are one entry with a count. Links are counted, never
listed: a task gives the number of links of each entry and a spanning forest
of them. A link found from both ends counts once, because every entry carries
the cells that it walks: the end that meets the other adds to its own count,
and to the other's only if that one does not walk to it. Cells with many
entries or visitors are dealt out as pairs of blocks, so no cell is one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, map_batches, materialise, release
from .multiindex import lloyd, matrix, squared
from .simhash import _forest

THRESHOLD = 0.95
#: Share of links at the threshold that the walk has to meet, on a sample turned in random directions.
RECALL = 0.99
#: Entries that a cell holds on average.
CELL = 32
#: Vectors (about; chosen by hash) on which codebooks are fitted; at most a sixteenth as many codewords.
SAMPLE = 20_000
#: Vectors of the sample that are turned to measure the reach, and how often.
TURNED, TURNS = 2_000, 4
#: Entries and visitors of a cell in one pair of blocks.
BLOCK = 2048
SEED = 13
#: Cosines this near to the threshold are summed again in a fixed order.
DOUBT = 1e-9


def usable(v: Column) -> Column:
    """Whether a vector is not null, not zero and has only finite components."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled by their largest component first, so no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def grid_walk(first: np.ndarray, second: np.ndarray, reach: float) -> list[int]:
    """Cells (i * codes + j) in ascending order of first[i] + second[j], up to ``reach`` above the least."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    da, db = first[a].tolist(), second[b].tolist()
    codes, limit = len(db), da[0] + db[0] + reach
    heap, cells = [(da[0] + db[0], 0, 0)], []
    while heap:
        d, i, j = heapq.heappop(heap)
        if d > limit:
            break
        cells.append(int(a[i]) * codes + int(b[j]))
        # Every pair is reached once: down from the pair above it, or to the right in the first row.
        if i + 1 < len(da):
            heapq.heappush(heap, (da[i + 1] + db[j], i + 1, j))
        if i == 0 and j + 1 < codes:
            heapq.heappush(heap, (da[0] + db[j + 1], 0, j + 1))
    return cells


class Grid:
    """Two codebooks and the reach of a walk, fitted on a bounded sample of unit vectors."""

    def __init__(self, sample: np.ndarray, codes: int, *, threshold: float = THRESHOLD, recall: float = RECALL, reach: float | None = None):
        self.half = sample.shape[1] // 2
        sample = sample[np.lexsort(sample.T)]  # the fit does not depend on the order of rows
        self.books = [lloyd(sample[:, : self.half], codes), lloyd(sample[:, self.half :], codes)]
        self.codes = len(self.books[1])
        self.reach = self._measured(sample, threshold, recall) if reach is None else reach

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squared(x[:, : self.half], self.books[0]), squared(x[:, self.half :], self.books[1])

    def _measured(self, sample: np.ndarray, threshold: float, recall: float) -> float:
        rng = np.random.default_rng(SEED)
        x = np.tile(sample[rng.permutation(len(sample))[:TURNED]], (TURNS, 1))
        aside = rng.normal(size=x.shape)
        aside -= (aside * x).sum(axis=1, keepdims=True) * x
        aside /= np.maximum(np.sqrt((aside * aside).sum(axis=1, keepdims=True)), 1e-300)
        y = threshold * x + np.sqrt(max(0.0, 1 - threshold * threshold)) * aside

        def beyond(of: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
            """How much farther than its own the cell of the other is."""
            return sum(d[np.arange(len(d)), o.argmin(axis=1)] - d.min(axis=1) for d, o in zip(of, other, strict=True))

        dx, dy = self.distances(x), self.distances(y)
        return float(np.quantile(np.minimum(beyond(dx, dy), beyond(dy, dx)), recall, method="higher"))

    def placed(self, x: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """Cell and walk of unit vectors; a walk begins with the own cell."""
        walks: list[list[int]] = []
        for at in range(0, len(x), 1024):
            walks += (grid_walk(a, b, self.reach) for a, b in zip(*self.distances(x[at : at + 1024]), strict=True))
        return np.array([w[0] for w in walks], dtype=np.int32), walks


def linked(q: np.ndarray, x: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of unit vectors ``q`` and ``x`` have a cosine of ``threshold`` or more."""
    dots = q @ x.T
    out = dots >= threshold
    row, place = np.nonzero(np.abs(dots - threshold) <= DOUBT)  # rounding of the product may tip these: one order of summing decides
    if len(row):
        total = np.zeros(len(row))
        for j in range(x.shape[1]):
            total += q[row, j] * x[place, j]
        out[row, place] = total >= threshold
    return out


def block_links(members: tuple, visitors: tuple, cell: int, cells: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of the ``visitors`` of a cell to its ``members``: (entries, links to add, ends of a spanning forest a, b).

    Both are (entry numbers, copies, own cells, walks, unit vectors).
    """
    m_node, m_copies, _, m_walks, m_x = members
    v_node, v_copies, v_cell, _, v_x = visitors
    number = np.unique(np.r_[m_node, v_node])
    m_at, v_at = np.searchsorted(number, m_node), np.searchsorted(number, v_node)
    count = np.zeros(len(number), dtype=np.int64)
    label = np.arange(len(number))
    walked: np.ndarray | None = None  # (member, cell) of the members' walks
    for at in range(0, len(v_node), 256):
        near = linked(v_x[at : at + 256], m_x, threshold)
        near &= v_node[at : at + 256, None] != m_node[None, :]
        if not near.any():
            continue
        count[v_at[at : at + 256]] += near @ m_copies
        away = np.flatnonzero(v_cell[at : at + 256] != cell)
        row, place = np.nonzero(near[away])
        if len(row):  # members that do not walk to the visitor's cell do not meet it themselves
            row = away[row]
            if walked is None:
                walked = np.concatenate([np.asarray(w, dtype=np.int64) + k * cells for k, w in enumerate(m_walks)])
            alone = ~np.isin(v_cell[at + row].astype(np.int64) + place * cells, walked)
            np.add.at(count, m_at[place[alone]], v_copies[at + row[alone]])
        row, place = np.nonzero(near)
        a, b = v_at[at + row], m_at[place]
        apart = label[a] != label[b]
        if apart.any():
            label = _forest(len(number), np.r_[a[apart], np.arange(len(number))], np.r_[b[apart], label])
    rows = np.flatnonzero(label != np.arange(len(number)))
    met = np.flatnonzero(count)
    return number[met], count[met], number[rows], number[label[rows]]


ENTRY = "node long, copies long, own int, walk array<int>, v array<double>"


def entries_in_cells(entries: DataFrame, grid: Grid, width: int) -> DataFrame:
    """``entries(node, copies, v)`` with their cell and walk, unit vectors for ``v``."""

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            x = unit(matrix(batch.column("v"), width))
            own, walks = grid.placed(x)
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, width, dtype=np.int32)), pa.array(x.ravel()))
            columns = [batch.column("node"), batch.column("copies"), pa.array(own), pa.array(walks, pa.list_(pa.int32())), vectors]
            yield pa.record_batch(columns, names=["node", "copies", "own", "walk", "v"])

        return step

    return map_batches(entries.select("node", "copies", F.col("v").cast("array<double>").alias("v")), make, ENTRY)


def links(placed: DataFrame, cells: int, width: int, *, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Rows (node, links, other) of all blocks of all cells: links to add to ``node``, or (links null) a link of a spanning forest.

    ``placed`` are written rows of ``ENTRY``.
    """
    visits = placed.select("own", F.explode("walk").alias("cell"))
    sizes = visits.groupBy("cell").agg(F.count("*").alias("visitors"), F.count_if(F.col("own") == F.col("cell")).alias("members"))
    # No size is promised for the cells with many rows: the planner chooses the join from the size of the written table.
    hot = materialise(
        sizes.where(F.greatest("visitors", "members") > block).select(
            F.col("cell").alias("hot_cell"), F.ceil(F.col("members") / block).cast("int").alias("row_blocks"), F.ceil(F.col("visitors") / block).cast("int").alias("visit_blocks")
        ),
        "hot-cells",
    )

    def dealt(rows: DataFrame, kind: int, own_blocks: str, other_blocks: str, own: str, other: str) -> DataFrame:
        """One copy of each row for each block of the other side; a row's own block follows from its number."""
        with_blocks = rows.join(hot, F.col("cell") == F.col("hot_cell"), "left")
        mine = F.pmod(F.xxhash64("node"), F.coalesce(own_blocks, F.lit(1))).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(other_blocks, F.lit(1)) - 1))
        return with_blocks.select("cell", mine.alias(own), every.alias(other), F.lit(kind).alias("kind"), "node", "copies", "own", "walk", "v")

    members = dealt(placed.withColumn("cell", F.col("own")), 0, "row_blocks", "visit_blocks", "i", "j")
    # A visitor's walk is not looked at: only its own cell is.
    visitors = placed.withColumn("cell", F.explode("walk")).withColumn("walk", F.lit(None).cast("array<int>"))
    visitors = dealt(visitors, 1, "visit_blocks", "row_blocks", "j", "i").select(members.columns)
    keys = ["cell", "i", "j"]
    n = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = members.unionByName(visitors).repartition(n, *keys).sortWithinPartitions(*keys, "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        kept: pa.Table | None = None  # rows of a block pair that the next batch may go on with

        def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
            key = np.stack([table.column(c).to_numpy() for c in keys])
            begins = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)])
            kind, node = table.column("kind").to_numpy(), table.column("node").to_numpy()
            copies, own = table.column("copies").to_numpy(), table.column("own").to_numpy()
            x = matrix(table.column("v").combine_chunks(), width)
            walks = table.column("walk")
            found = []
            for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(node)], strict=True):
                mid = a + int(np.searchsorted(kind[a:b], 1))
                if a < mid < b:
                    member, visitor = slice(a, mid), slice(mid, b)
                    of = (node[member], copies[member], own[member], walks.slice(a, mid - a).to_pylist(), x[member])
                    by = (node[visitor], copies[visitor], own[visitor], None, x[visitor])
                    found.append(block_links(of, by, int(key[0, a]), cells, threshold))
            if found:
                n, c, p, q = (np.concatenate(f) for f in zip(*found, strict=True))
                if len(n):
                    yield pa.record_batch([pa.array(n), pa.array(c), pa.nulls(len(n), pa.int64())], names=["node", "links", "other"])
                if len(p):
                    yield pa.record_batch([pa.array(p), pa.nulls(len(p), pa.int64()), pa.array(q)], names=["node", "links", "other"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if kept is not None:
                table = pa.concat_tables([kept, table])
            key = np.stack([table.column(c).to_numpy() for c in keys])
            other = np.flatnonzero((key != key[:, -1:]).any(axis=0))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from out(table.slice(0, cut))
            kept = table.slice(cut)
        if kept is not None:
            yield from out(kept)

    return sorted_.mapInArrow(run, "node long, links long, other long")


def near_duplicates(
    vectors: DataFrame,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    reach: float | None = None,
    codes: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Rows link when the cosine of their vectors is ``threshold`` or more;
    n_links counts the other rows linked to a row, component_id is the
    smallest vec_id reachable over links, and kept says that the row has it.
    ``reach`` and ``codes`` are chosen as the module says if not given; an
    infinite reach meets every pair.

    Vectors that are null, zero or empty or hold null or non-finite
    components link with nothing; shorter vectors count as padded with zeros.
    Repeated rows are rows of their own and link with one another, as do
    copies of a vector under other ids. A row without id links like any
    other, and is kept only in a component without any id. Other columns are
    ignored; no rows give no rows.
    """
    v = F.col("v")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("v")).withColumn("ok", usable(v))
    # Two 64-bit hashes with different seeds stand for a vector where copies meet.
    digest = {"h1": F.xxhash64(v), "h2": F.xxhash64(F.lit(1), v)}
    good = rows.where("ok").withColumns(digest)
    own = F.when(~F.col("ok"), F.col("vec_id"))
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), own.alias("component_id"), F.lit(True).alias("kept"))
    distinct = good.groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"), F.first("v").alias("v"))
    entries = materialise(distinct.withColumn("node", F.monotonically_increasing_id()), "entries")
    shape = entries.agg(F.count("*"), F.max(F.size("v"))).first()
    if not shape[0]:
        return alone
    width = max(2, shape[1])
    share = F.pmod(F.col("h1"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    drawn = entries.where(share * F.lit(float(shape[0])) < F.lit(float(SAMPLE))).select(v.cast("array<double>").alias("v")).limit(2 * SAMPLE).toArrow()
    if not drawn.num_rows:
        drawn = entries.select(v.cast("array<double>").alias("v")).limit(SAMPLE).toArrow()
    sample = unit(matrix(drawn.column("v").combine_chunks(), width))
    wanted = codes or max(1, min(SAMPLE // 16, round((shape[0] / CELL) ** 0.5)))
    grid = Grid(sample, wanted, threshold=threshold, recall=recall, reach=reach)
    placed = materialise(entries_in_cells(entries, grid, width), "placed")
    found = materialise(links(placed, len(grid.books[0]) * grid.codes, width, threshold=threshold, block=block), "links")
    counts = found.where("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    members = materialise(components(edges), "members")
    first = entries.select("node", "first_id")
    roots = members.join(first, "node").groupBy("root").agg(F.min("first_id").alias("least"))
    reached = members.join(roots, "root").select("node", "least")
    answer = entries.select("h1", "h2", "copies", "first_id", "node").join(counts, "node", "left").join(reached, "node", "left")
    answer = answer.select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "first_id").alias("component_id")
    )
    out = good.select("vec_id", "h1", "h2").join(materialise(answer, "answer").hint("merge"), ["h1", "h2"])
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")).unionByName(alone)
