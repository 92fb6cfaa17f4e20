"""Target-distribution importance resampling over hashed n-grams.

Documents that look like the target texts are drawn: the gain of a hash
bucket is the log ratio of its smoothed shares in the target and in the
corpus, a document's weight the mean gain of its features, and Gumbel noise
from its doc_id makes the largest scores a weighted draw without replacement.

Features are found by batch concatenation: the texts of a group are joined
with a sentinel byte that no word holds, one regular expression pass finds
all words, ``searchsorted`` of the word starts among the document offsets
tells each word's document, and n-grams whose words are of two documents are
masked out before the ``bincount``. The hash of an n-gram is put together
from the hashes of its words, CRC-32 being linear, so no n-gram is ever
spelled out.

The texts are read twice (corpus counts, then weights), which is cheaper than
to keep the features of all of them. What is collected is one count per
bucket. The draw needs the rank of the drawn documents only: a histogram of
the scores (integers between fixed limits) gives the score at which the draw
ends, and the rows at or above it are numbered by range partitions.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ids import assign_ids
from .common import materialise, release

MAX_N = 2
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: Bytes of text joined at once (a longer document is joined alone).
GROUP_BYTES = 1 << 19
#: Words up to this length are appended to a hash by table, longer ones by zlib.
TABLE_LENGTH = 48

SENTINEL = b"\x00"
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@functools.cache
def _shift_table(length: int) -> np.ndarray:
    """4 x 256 values: what each byte of a CRC-32 becomes when ``length`` bytes follow."""
    zeros = bytes(length)
    rest = zlib.crc32(zeros, 0)
    return np.array([[zlib.crc32(zeros, b << 8 * k) ^ rest for b in range(256)] for k in range(4)], dtype=np.uint32)


def append_crc(before: np.ndarray, words: list[bytes], crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of texts with CRC-32 ``before``, each followed by the word beside it."""
    out = np.empty(len(before), dtype=np.uint32)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        if length <= TABLE_LENGTH:
            table, x = _shift_table(length), before[at]
            out[at] = table[0][x & 255] ^ table[1][x >> 8 & 255] ^ table[2][x >> 16 & 255] ^ table[3][x >> 24] ^ crc[at]
        else:
            out[at] = [zlib.crc32(words[k], b) for k, b in zip(at.tolist(), before[at].tolist(), strict=True)]
    return out


def group_features(joined: bytes, starts: np.ndarray, *, max_n: int = MAX_N, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per document, document of each feature, bucket of each feature).

    ``joined`` is lower-cased UTF-8 of documents, each followed by the
    sentinel; ``starts`` are their offsets in it, ascending.
    """
    found = list(WORD.finditer(joined))
    at = np.fromiter(map(re.Match.start, found), dtype=np.int64, count=len(found))
    words = list(map(re.Match.group, found))
    crc = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    doc = np.searchsorted(starts, at, side="right") - 1
    docs, hashes, gram = [doc], [crc], crc
    blank = np.uint32(zlib.crc32(b" "))
    space = _shift_table(1)
    for n in range(1, max_n):
        # ``gram`` holds the (n)-gram that begins at each word; the word n further on is appended.
        x = gram[:-1]
        spaced = space[0][x & 255] ^ space[1][x >> 8 & 255] ^ space[2][x >> 16 & 255] ^ space[3][x >> 24] ^ blank
        gram = append_crc(spaced, words[n:], crc[n:], lengths[n:])
        same = doc[: len(gram)] == doc[n:]  # documents come one after the other: equal ends mean one document
        docs.append(doc[: len(gram)][same])
        hashes.append(gram[same])
        if not len(gram):
            break
    return np.bincount(doc, minlength=len(starts)), np.concatenate(docs), np.concatenate(hashes) % np.uint32(buckets)


def groups(column: pa.Array) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first row, row after the last, joined texts, offsets) of a text column, null as empty."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + GROUP_BYTES, side="right")))
        texts = column.slice(at, stop - at).to_pylist()
        joined = b"".join(itertools.chain.from_iterable(((t or "").encode("utf-8", "surrogatepass"), SENTINEL) for t in texts)).translate(_LOWER)
        yield at, stop, joined, np.cumsum(sizes[at:stop] + 1) - sizes[at:stop] - 1
        at = stop


def bucket_counts(texts: DataFrame, *, max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all ``texts(text)`` in each bucket. A task sends one count per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, joined, starts in groups(batch.column("text")):
                total += np.bincount(group_features(joined, starts, max_n=max_n, buckets=buckets)[2], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.record_batch([pa.array(met.astype(np.int32)), pa.array(total[met])], names=["bucket", "n"])

    counts = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in counts.collect():  # at most one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, in thousandths of a natural log, floored."""
    size, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    rows = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size)))) for s, t in rows], dtype=np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of a document in thousandths, from its doc_id alone (null: the empty string)."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, *, max_n: int = MAX_N, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = []
            for _, _, joined, starts in groups(batch.column("text")):
                n_words, doc, bucket = group_features(joined, starts, max_n=max_n, buckets=buckets)
                n_features = np.bincount(doc, minlength=len(starts))
                total = np.bincount(doc, weights=gain[bucket], minlength=len(starts)).astype(np.int64)  # far below 2^53, so exact
                columns.append((n_words, n_features, total // np.maximum(n_features, 1)))
            n_words, n_features, weight = (np.concatenate(c) for c in zip(*columns, strict=True))
            score = weight + np.fromiter((noise(i, seed) for i in batch.column("doc_id").to_pylist()), dtype=np.int64, count=batch.num_rows)
            yield pa.record_batch(
                [batch.column("doc_id"), *(pa.array(c.astype(np.int64)) for c in (n_words, n_features, weight, score))],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(
    docs: DataFrame, target: DataFrame, *, percent: int = PERCENT, min_words: int = MIN_WORDS, max_n: int = MAX_N, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_features, weight, score, rank; drawn towards ``target(text)``.

    ``percent`` of the documents with ``min_words`` words or more are drawn,
    those of the highest scores, ties to the smaller doc_id; rank is null
    where a document is not drawn. Null and empty texts have no features and
    weight 0 and are not drawn. Repeated rows are drawn by themselves, one
    after the other; a null doc_id has noise of its own and comes after equal
    scores. Further columns are ignored; no rows give no rows; without target
    texts all buckets of the target are equally likely.
    """
    corpus = bucket_counts(docs, max_n=max_n, buckets=buckets)
    gain = gains(corpus, bucket_counts(target, max_n=max_n, buckets=buckets))
    rows = materialise(scores(docs, gain, max_n=max_n, seed=seed), "scores")
    histogram = rows.where(F.col("n_words") >= min_words).groupBy("score").agg(F.count("*").alias("n"))
    # Scores are integers between limits set by the number of buckets and doubles: the window has a bounded number of rows.
    upto = F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    everyone = F.sum("n").over(Window.partitionBy())
    steps = histogram.select("score", upto.alias("upto"), F.floor(everyone * percent / 100).cast("long").alias("draw"))
    last = steps.where("draw > 0 and upto >= draw").orderBy("upto").first()
    none = F.lit(None).cast("long").alias("rank")
    out = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*out, none)
    can = (F.col("n_words") >= min_words) & (F.col("score") >= last["score"])
    top = rows.where(can).withColumns({"falling": -F.col("score"), "no_id": F.col("doc_id").isNull()})
    ranked = assign_ids(top, ["falling", "no_id", "doc_id"], "place")
    rank = F.when(F.col("place") <= last["draw"], F.col("place"))
    return ranked.select(*out, rank.alias("rank")).unionByName(rows.where(~can).select(*out, none))


_CRC_STEP = "xor(c >> 8, table_[CAST(xor(c, b) & 255 AS BIGINT) + 1])"

#: DuckDB: features spelled out, their CRC-32 byte by byte.
ORACLE_SQL = rf"""
    WITH bits AS (
        SELECT list(v ORDER BY i) AS table_ FROM (
            SELECT i, list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
            FROM range(256) AS r(i))
    ), words AS (
        SELECT 0 AS target, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
    ), spelled AS (
        SELECT target, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM words
    ), features AS (
        SELECT target, doc_id, unnest(ws) AS f FROM spelled
        UNION ALL SELECT target, doc_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM spelled
    ), per_doc AS (
        SELECT target, doc_id, f, count(*) AS n FROM features GROUP BY target, doc_id, f
    ), hashed AS (
        SELECT f, CAST(xor(list_reduce(
            list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, strlen(f) + 1), lambda k: CAST(('0x' || substr(hex(f), 2 * k - 1, 2)) AS BIGINT))),
            lambda c, b: {_CRC_STEP}), 4294967295) % 10000 AS BIGINT) AS bucket
        FROM (SELECT DISTINCT f FROM per_doc), bits
    ), bucketed AS (
        SELECT target, doc_id, bucket, sum(n) AS n FROM per_doc JOIN hashed USING (f) GROUP BY target, doc_id, bucket
    ), counts AS (
        SELECT bucket, coalesce(sum(n) FILTER (WHERE target = 0), 0) AS s, coalesce(sum(n) FILTER (WHERE target = 1), 0) AS t FROM bucketed GROUP BY bucket
    ), totals AS (
        SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts
    ), gains AS (
        SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST(s_all AS DOUBLE) + 10000) / ((CAST(s AS DOUBLE) + 1) * (CAST(t_all AS DOUBLE) + 10000)))) AS BIGINT) AS gain
        FROM counts, totals
    ), weights AS (
        SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
        FROM bucketed JOIN gains USING (bucket) WHERE target = 0 GROUP BY doc_id
    ), scored AS (
        SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(ws) >= 20 AS can,
               coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST(('0x' || substr(sha256('7:' || CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
        FROM (SELECT doc_id, ws FROM spelled WHERE target = 0) LEFT JOIN weights USING (doc_id)
    ), placed AS (
        SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE can
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 25 // 100 THEN CAST(place AS BIGINT) END AS rank
    FROM scored LEFT JOIN placed USING (doc_id)
"""
