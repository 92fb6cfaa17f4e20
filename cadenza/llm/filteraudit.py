"""Filter interaction audit with count-weighted decision diagrams.

Every document gets a failure mask: one bit for each filter that it fails.
What a sequence of filters removes depends on the masks only, so documents
meet in one grouped count of (part, mask), at most 2 to the number of filters
rows for a part however many documents it holds.

For each part a decision diagram of its masks is built: level k tests the
k-th filter of an order, a leaf holds the counts of one mask, equal
sub-diagrams are one node, and every node carries the counts below it. Another
order of two neighbouring filters is a swap of two neighbouring levels, which
rewrites those two levels and nothing else; all orders are visited by one
chain of such swaps. In each order the path on which everything passes yields
the steps: what a step removes is the weight of the failing child, what it
keeps that of the passing one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, texts_of

#: The filters, in the order of their bits.
FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITAL_PERCENT = 5
SYMBOLS = "#$%&*|"
#: Bit of the filter that needs the whole table: an earlier document has the same text.
COPY = 1 << FILTERS.index("E")

Counts = tuple[int, ...]

_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: str) -> int:
    """Mask of the filters A to D, which depend on the text alone."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # at \\x20 and \\x09-\\x0D only
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    failed = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words),
        100 * capitals > MAX_CAPITAL_PERCENT * len(text),
        any(s in text for s in SYMBOLS),
    )
    return sum(1 << k for k, f in enumerate(failed) if f)


class Diagram:
    """Decision diagram of failure masks whose nodes carry counts.

    ``masks`` maps a mask to its counts; ``order`` lists the filters (bit
    numbers) from the root down. Every path tests every filter, so a node
    belongs to one level and ``levels[k]`` is that level's table of
    (pass child, fail child) -> node.
    """

    def __init__(self, masks: dict[int, Counts], filters: int, counts: int):
        self.order = list(range(filters))
        self.children: list[tuple[int, int]] = []
        self.weight: list[Counts] = []
        self.levels: list[dict[tuple[int, int], int]] = [{} for _ in range(filters)]
        self.leaves: dict[Counts, int] = {}
        self.empty = (0,) * counts
        self.root = self._build(0, 0, masks)

    def _build(self, level: int, mask: int, masks: dict[int, Counts]) -> int:
        if level == len(self.order):
            return self._leaf(masks.get(mask, self.empty))
        return self._node(level, self._build(level + 1, mask, masks), self._build(level + 1, mask | 1 << level, masks))

    def _add(self, children: tuple[int, int], weight: Counts) -> int:
        self.children.append(children)
        self.weight.append(weight)
        return len(self.weight) - 1

    def _leaf(self, counts: Counts) -> int:
        if counts not in self.leaves:
            self.leaves[counts] = self._add((-1, -1), counts)
        return self.leaves[counts]

    def _node(self, level: int, passed: int, failed: int) -> int:
        table = self.levels[level]
        if (passed, failed) not in table:
            both = tuple(a + b for a, b in zip(self.weight[passed], self.weight[failed], strict=True))
            table[passed, failed] = self._add((passed, failed), both)
        return table[passed, failed]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the level below it.

        A node of the upper level stays the same node for those above it:
        only its two children are made anew from the four grandchildren.
        """
        upper, self.levels[level], self.levels[level + 1] = self.levels[level], {}, {}
        for (passed, failed), node in upper.items():
            (pp, pf), (fp, ff) = self.children[passed], self.children[failed]
            self.children[node] = self._node(level + 1, pp, fp), self._node(level + 1, pf, ff)
            self.levels[level][self.children[node]] = node
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[Counts, Counts]]:
        """(kept, removed) counts of each filter along the path on which everything passes."""
        out, node = [], self.root
        for _ in self.order:
            node, failed = self.children[node]
            out.append((self.weight[node], self.weight[failed]))
        return out


def swap_chain(n: int) -> list[int]:
    """Levels to swap, one after the other, so that all n! orders come up once each (plain changes)."""
    if n < 2:
        return []
    out: list[int] = []
    for k, inner in enumerate([*swap_chain(n - 1), None]):
        out += range(n - 2, -1, -1) if k % 2 == 0 else range(n - 1)
        if inner is not None:
            out.append(inner + (k % 2 == 0))  # the last filter stands before the others after it has moved up
    return out


def audit_part(masks: dict[int, Counts], names: str) -> Iterator[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, other counts removed.., shapley) for every order and step.

    The first of a mask's counts is its documents. A filter at the root
    removes all that fail it, and one at the last level those that fail
    nothing else.
    """
    width = len(next(iter(masks.values()), (0,)))
    diagram = Diagram(masks, len(names), width)
    orders: list[tuple[list[int], list[tuple[Counts, Counts]]]] = [(list(diagram.order), diagram.steps())]
    for level in swap_chain(len(names)):
        diagram.swap(level)
        orders.append((list(diagram.order), diagram.steps()))
    fails, alone, shapley = ([0] * len(names) for _ in range(3))
    for order, steps in orders:
        fails[order[0]], alone[order[-1]] = steps[0][1][0], steps[-1][1][0]
        for f, (_, removed) in zip(order, steps, strict=True):
            shapley[f] += removed[0]
    for order, steps in orders:
        label = "".join(names[f] for f in order)
        for k, (f, (kept, removed)) in enumerate(zip(order, steps, strict=True)):
            yield (label, k + 1, kept[0], removed[0], fails[f] - removed[0], alone[f], *removed[1:], shapley[f])


def audit_masks(masks: DataFrame, names: str, others: tuple[str, ...] = ()) -> DataFrame:
    """Audit of ``masks(part, mask, n, *others)``, one row per part and mask.

    Returns part, filter_order, step, kept, removed, redundant, unique_fails,
    ``<other>_lost`` for each of ``others``, and shapley. ``names`` has one
    letter per filter, bit 0 first. A part's masks become one row: at most 2
    to the number of filters entries.
    """
    values = [F.col(c).cast("long").alias(f"c{k}") for k, c in enumerate(("n", *others))]
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", *values)).alias("masks"))
    out = {"kept": "long", "removed": "long", "redundant": "long", "unique_fails": "long", **{f"{c}_lost": "long" for c in others}, "shapley": "long"}
    kinds = [pa.string(), pa.int32(), *(pa.int64() for _ in out)]

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, entries in zip(batch.column("part").to_pylist(), batch.column("masks").to_pylist(), strict=True):
                counted = {e["mask"]: tuple(e[f"c{k}"] for k in range(1 + len(others))) for e in entries}
                columns = list(zip(*audit_part(counted, names), strict=True))
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.record_batch([pa.array([part] * math.factorial(len(names)) * len(names), pa.string()), *arrays], names=["part", "filter_order", "step", *out])

        return step

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} {t}" for c, t in out.items())
    return map_batches(parts, make, schema)


def failure_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest) of every document; digest is the SHA-256 of the text."""

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts = texts_of(batch)
            masks = pa.array([text_failures(t) for t in texts], pa.int32())
            digests = pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts], pa.binary())
            yield pa.record_batch([batch.column("doc_id"), batch.column("part"), masks, digests], names=["doc_id", "part", "mask", "digest"])

        return step

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "text")
    return map_batches(rows, make, "doc_id long, part string, mask int, digest binary")


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic) of ``docs(doc_id, text, source)`` with ``labels(doc_id, quality, toxic)``.

    Copies meet in a map-side minimum of their doc_id by digest, and only
    digests that occur more than once are joined back. Both joins have the
    documents on the left, where adaptive execution splits a hot digest or a
    hot doc_id; they are sort-merge joins at every size, since neither right
    side has a bound.
    """
    rows = materialise(failure_rows(docs), "failures")
    copies = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("texts")).where("texts > 1").select("digest", "first_id")
    flags = labels.where("quality = 1 or toxic = 1").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    flags = flags.agg(F.max(F.col("quality") == 1).alias("is_good"), F.max(F.col("toxic") == 1).alias("is_toxic"))
    marked = rows.join(copies.hint("merge"), "digest", "left").join(flags.hint("merge"), "doc_id", "left")
    mask = F.when(F.col("doc_id") > F.col("first_id"), F.col("mask").bitwiseOR(F.lit(COPY))).otherwise(F.col("mask"))
    return marked.groupBy("part", mask.alias("mask")).agg(
        F.count("*").alias("n"), F.count_if(F.coalesce("is_good", F.lit(False))).alias("good"), F.count_if(F.coalesce("is_toxic", F.lit(False))).alias("toxic")
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Audit of the filters A to E over ``docs``: one row per part, order and step, zeros included.

    A part is a value of ``source``; null is the part of the empty string.
    Null text is the empty text. A document without doc_id is no copy of
    another and makes none; repeated rows count as often as they come and are
    not copies of one another; of repeated labels any that is 1 holds.
    Further columns are ignored; no documents give no rows.
    """
    return audit_masks(document_masks(docs, labels), FILTERS, ("good", "toxic"))


#: DuckDB: every order and step is counted from the masks by itself.
ORACLE_SQL = r"""
    WITH texts AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
    ), flags AS (
        SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
    ), failed AS (
        SELECT doc_id, part,
               CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END
               || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
               || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 'C' ELSE '' END
               || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
               || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
        FROM texts
    ), masks AS (
        SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic
        FROM failed LEFT JOIN flags USING (doc_id) GROUP BY part, fails
    ), letters AS (
        SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
    ), orders AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
    ), steps AS (
        SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
        FROM orders, range(1, 6) AS s(step)
    ), counted AS (
        SELECT part, filter_order, step, own,
               CAST(coalesce(sum(n) FILTER (WHERE NOT contains(fails, own) AND translate(fails, before, '') = fails), 0) AS BIGINT) AS kept,
               CAST(coalesce(sum(n) FILTER (WHERE contains(fails, own) AND translate(fails, before, '') = fails), 0) AS BIGINT) AS removed,
               CAST(coalesce(sum(n) FILTER (WHERE contains(fails, own) AND translate(fails, before, '') <> fails), 0) AS BIGINT) AS redundant,
               CAST(coalesce(sum(n) FILTER (WHERE fails = own), 0) AS BIGINT) AS unique_fails,
               CAST(coalesce(sum(good) FILTER (WHERE contains(fails, own) AND translate(fails, before, '') = fails), 0) AS BIGINT) AS good_lost,
               CAST(coalesce(sum(toxic) FILTER (WHERE contains(fails, own) AND translate(fails, before, '') = fails), 0) AS BIGINT) AS toxic_lost
        FROM masks, steps GROUP BY part, filter_order, step, own
    )
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
    FROM counted
"""
