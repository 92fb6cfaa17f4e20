"""Quality rules: robust multivariate outliers among documents of one language and source.

Every text becomes a short vector of transformed statistics. For each
(language, source) group a minimum-covariance-determinant estimate of centre
and scatter is found by concentration steps, and a document is rejected when
its Mahalanobis distance from its group's estimate is beyond a chi-square
quantile (or when it fails the base rules). The steps begin at several
estimates side by side (``STARTS``), and each group keeps the end of least
determinant.

A concentration step keeps the ``SUPPORT`` share of each group that lies
nearest to the current estimate. It is one aggregate: distances fall into
narrow logarithmic bins, every (group, bin) sums counts and moments, and the
bins are taken in order until the share is reached, ties and copies with
their whole bin. So no group is ever gathered, and a hot source costs one row
per bin and task. Small groups lean on their language and languages on the
whole corpus through ``PRIOR_ROWS`` pseudo-rows, smoothly and at every size.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, materialise, texts_of

SYMBOLS = "#*$%&|<>"
MARKS = ".,!?"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Share of a group that an estimate rests on.
SUPPORT = 0.75
STEPS = 4
#: Where the steps begin: the corpus medians or the group's own medians with the floors as scatter, or the group's mean and scatter.
STARTS = ("corpus", "group", "mean")
#: Pseudo-rows with which a group's parent (language, then corpus) enters its estimate.
PRIOR_ROWS = 50.0
#: Tail probability of the chi-square cut-off for clean Gaussian data.
ALPHA = 1e-5
#: Bins per doubling of the squared distance.
BINS = 16

#: Pseudo-words added to every text: very short texts lie near the typical vector.
PSEUDO_WORDS = 30.0
#: Typical values that the pseudo-words carry (a rate per word, or characters per word).
TYPICAL = {"length": 5.0, "symbols": 0.0, "marks": 0.15, "capitals": 0.02, "echoes": 0.0}
FEATURES = list(TYPICAL)
#: Smallest standard deviation that an estimate can have, in transformed units.
FLOOR = {"length": 0.08, "symbols": 0.03, "marks": 0.08, "capitals": 0.05, "echoes": 0.05}

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
_SPACES = "\t\n\v\f\r "


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.encode("utf-8", "surrogatepass").split()  # at \\x20 and \\x09-\\x0D only
    chars = len(text) - sum(map(text.count, _SPACES))
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), _repeated(words)


def _repeated(words: list[bytes]) -> int:
    """Words inside a 5-word window that occurs at least twice."""
    windows = list(zip(*(words[k:] for k in range(WINDOW)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    count, upto = 0, 0
    for at, w in enumerate(windows):
        if seen[w] > 1:
            count += at + WINDOW - max(at, upto)
            upto = at + WINDOW
    return count


def vector(text: str, n_words: int, word_chars: int, n_symbols: int) -> list[float]:
    """Transformed statistics: log of the mean word length, and the arcsine root of rates in [0, 1]."""
    raw = text.encode("utf-8", "surrogatepass")
    capitals = len(raw) - len(raw.translate(None, _UPPER))
    letters = capitals + len(raw) - len(raw.translate(None, _LOWER))
    words = raw.split()
    echoes = sum(map(bytes.__eq__, words, itertools.islice(words, 1, None)))

    def rate(count: float, per: float, pseudo: float, typical: float) -> float:
        return math.asin(math.sqrt(min(1.0, (count + pseudo * typical) / (per + pseudo))))

    chars = PSEUDO_WORDS * TYPICAL["length"]
    return [
        math.log((word_chars + chars) / (n_words + PSEUDO_WORDS)),
        rate(n_symbols, word_chars, chars, TYPICAL["symbols"]),
        rate(sum(map(text.count, MARKS)), n_words, PSEUDO_WORDS, TYPICAL["marks"]),
        rate(capitals, letters, chars, TYPICAL["capitals"]),
        rate(echoes, n_words, PSEUDO_WORDS, TYPICAL["echoes"]),
    ]


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, row_hash, the base counts, base_failed and the vector ``x`` of every document."""

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts = texts_of(batch)
            counts = [base_counts(t) for t in texts]
            x = [vector(t, *c[:3]) for t, c in zip(texts, counts, strict=True)]
            failed = [c[0] < MIN_WORDS or 100 * c[4] > MAX_REPEAT_PERCENT * c[0] for c in counts]
            keep = [batch.column(c) for c in ("doc_id", "lang", "source", "row_hash")]
            columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
            yield pa.record_batch(
                [*keep, *columns, pa.array(failed), *(pa.array(v, pa.float64()) for v in zip(*x, strict=True))],
                names=["doc_id", "lang", "source", "row_hash", *COUNTS, "base_failed", *FEATURES],
            )

        return step

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"), F.col("source").cast("string"), F.xxhash64("text").alias("row_hash"))
    schema = "doc_id long, lang string, source string, row_hash long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, " + ", ".join(f"{f} double" for f in FEATURES)
    return map_batches(rows, make, schema)


def _lower_gamma(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function, by its series."""
    if x <= 0:
        return 0.0
    term = total = 1.0 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= x / k
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def _upper_gamma(a: float, x: float) -> float:
    """Its complement; for a large x by the continued fraction, which keeps small tails exact."""
    if x < a + 1:
        return 1.0 - _lower_gamma(a, x)
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi2_quantile(tail: float, p: int) -> float:
    """x with P(chi-square_p > x) = tail."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _upper_gamma(p / 2, mid / 2) > tail else (low, mid)
    return (low + high) / 2


def consistency(support: float, p: int) -> float:
    """Factor that makes the scatter of the nearest share unbiased for Gaussian data."""
    return support / _lower_gamma(p / 2 + 1, chi2_quantile(1 - support, p) / 2)


P = len(FEATURES)
_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
_SUMS = [f"s{i}" for i in range(P)] + [f"q{i}_{j}" for i, j in _PAIRS]
_CENTRE = [f"m{i}" for i in range(P)]
_WHITE = [f"w{i}_{j}" for i in range(P) for j in range(i + 1)]
_MODEL = ["lang", "source", *_CENTRE, *_WHITE, "log_det"]


def whitening(n: float, s: np.ndarray, q: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(centre, inverse Cholesky factor of the scatter) from count, sums and sums of products."""
    centre = s / n
    scatter = (q / n - np.outer(centre, centre)) * scale
    scatter = (scatter + scatter.T) / 2
    spread, axes = np.linalg.eigh(scatter)
    scatter = axes @ np.diag(np.maximum(spread, 0)) @ axes.T + np.diag([f * f for f in FLOOR.values()])
    return centre, np.linalg.inv(np.linalg.cholesky(scatter))


def _squared_distance() -> Column:
    x = [F.col(f) - F.col(m) for f, m in zip(FEATURES, _CENTRE, strict=True)]
    parts = [sum((F.col(f"w{i}_{j}") * x[j] for j in range(i + 1)), F.lit(0.0)) for i in range(P)]
    return sum((a * a for a in parts), F.lit(0.0))


def _moments() -> list[Column]:
    return [F.count("*").cast("double").alias("n"), *(F.sum(FEATURES[i]).alias(f"s{i}") for i in range(P)), *(F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"q{i}_{j}") for i, j in _PAIRS)]


def _models(sums: DataFrame, scale: float, prior_rows: float) -> DataFrame:
    """Estimates per start and group from ``sums`` (start, lang, source, n, moments), leaning on language and corpus; log_det is the log determinant of the scatter."""
    totals = [F.sum(c).alias(c) for c in ("n", *_SUMS)]
    languages = sums.groupBy("start", "lang").agg(*totals)
    corpus = languages.groupBy("start").agg(*totals)

    def lean(own: DataFrame, parent: DataFrame, *more: str) -> DataFrame:
        up = parent.select(*(F.col(c).alias(f"p_{c}") for c in parent.columns))
        on = F.col("start") == up["p_start"]
        for c in more:
            on = on & F.col(c).eqNullSafe(up[f"p_{c}"])
        both = own.join(up if more else F.broadcast(up), on)  # the corpus is one row a start
        weight = F.lit(prior_rows) / F.col("p_n")
        return both.select(*(c for c in own.columns if c not in ("n", *_SUMS)), *((F.col(c) + weight * F.col(f"p_{c}")).alias(c) for c in ("n", *_SUMS)))

    groups = lean(sums, lean(languages, corpus), "lang")

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.to_dict("records"):
                q = np.empty((P, P))
                for i, j in _PAIRS:
                    q[i, j] = q[j, i] = r[f"q{i}_{j}"]
                centre, white = whitening(r["n"], np.array([r[f"s{i}"] for i in range(P)]), q, scale)
                rows.append([r["start"], r["lang"], r["source"], *centre, *(white[i, j] for i in range(P) for j in range(i + 1)), -2 * float(np.log(np.diag(white)).sum())])
            yield pd.DataFrame(rows, columns=["start", *_MODEL])

    return groups.mapInPandas(fit, "start string, lang string, source string, " + ", ".join(f"{c} double" for c in _MODEL[2:]))


def _near(rows: DataFrame, models: DataFrame) -> DataFrame:
    """``rows`` with their squared distance from each model of their group."""
    m = models.withColumnsRenamed({"lang": "g_lang", "source": "g_source"})
    on = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    return rows.join(m, on).withColumn("d2", _squared_distance()).drop(*_CENTRE, *_WHITE, "g_lang", "g_source", "log_det")


def _first_models(rows: DataFrame, starts: tuple[str, ...], prior_rows: float) -> DataFrame:
    """The estimates that the steps begin at, per start and group."""
    floors = [F.lit(1 / FLOOR[FEATURES[i]] if i == j else 0.0).alias(f"w{i}_{j}") for i in range(P) for j in range(i + 1)]
    flat = [*floors, F.lit(0.0).alias("log_det")]
    medians = [F.percentile_approx(f, 0.5, 10_000).alias(m) for f, m in zip(FEATURES, _CENTRE, strict=True)]
    parts = []
    if "corpus" in starts:
        centre = rows.agg(*medians).first()
        parts.append(rows.select("lang", "source").distinct().select(F.lit("corpus").alias("start"), "lang", "source", *(F.lit(centre[m] or 0.0).alias(m) for m in _CENTRE), *flat))
    if "group" in starts:
        parts.append(rows.groupBy("lang", "source").agg(*medians).select(F.lit("group").alias("start"), "lang", "source", *_CENTRE, *flat))
    if "mean" in starts:
        sums = rows.groupBy(F.lit("mean").alias("start"), "lang", "source").agg(*_moments())
        parts.append(_models(sums, 1.0, prior_rows))
    return functools.reduce(DataFrame.unionByName, parts)


def estimate(stats: DataFrame, *, support: float = SUPPORT, steps: int = STEPS, prior_rows: float = PRIOR_ROWS, starts: tuple[str, ...] = STARTS) -> DataFrame:
    """MCD estimates per (lang, source) of ``stats``: centre m0.., whitening matrix w0_0.., log_det and the start it came from.

    Rows that fail the base rules take no part. Of the ends that ``starts``
    lead to, each group has the one of least determinant of the scatter
    (determinants that agree to nine places: the start that is named first).
    """
    rows = stats.where("not base_failed").select("lang", "source", *FEATURES)
    models = materialise(_first_models(rows, starts, prior_rows), "starts")
    for _ in range(steps):
        near = _near(rows, models)
        bins = near.groupBy("start", "lang", "source", F.floor(F.log2(F.col("d2") + F.lit(1e-6)) * BINS).alias("bin")).agg(*_moments())
        group = Window.partitionBy("start", "lang", "source")
        bins = bins.withColumns(
            {
                "before": F.coalesce(F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
                "all": F.sum("n").over(group),
            }
        )
        chosen = bins.where(F.col("before") < F.col("all") * support)
        sums = materialise(chosen.groupBy("start", "lang", "source").agg(*(F.sum(c).alias(c) for c in ("n", *_SUMS))), "moments")
        models = materialise(_models(sums, consistency(support, P), prior_rows), "models")
    order = F.array_position(F.array(*map(F.lit, starts)), F.col("start"))
    least = F.min_by(F.struct("start", *_MODEL[2:]), F.struct(F.round("log_det", 9), order)).alias("best")
    return models.groupBy("lang", "source").agg(least).select("lang", "source", "best.*")


def quality(docs: DataFrame, *, alpha: float = ALPHA, support: float = SUPPORT, steps: int = STEPS, prior_rows: float = PRIOR_ROWS) -> DataFrame:
    """One row per row of ``docs(doc_id, text, lang, source)``.

    Returns doc_id, the base counts, base_failed, kept, distance2 (squared
    Mahalanobis distance; null where base_failed), and row_hash (xxhash64 of
    the text). Null and empty texts have no words and fail the base rules; a
    null language or source is a group of its own; repeated rows count as
    often as they come; further columns are ignored; no rows give no rows.
    """
    stats = materialise(statistics(docs), "statistics")
    models = estimate(stats, support=support, steps=steps, prior_rows=prior_rows)
    good = _near(stats.where("not base_failed"), models).withColumnRenamed("d2", "distance2").drop("start")
    out = good.unionByName(stats.where("base_failed").withColumn("distance2", F.lit(None).cast("double")))
    cut = chi2_quantile(alpha, P)
    kept = ~F.col("base_failed") & (F.col("distance2") <= F.lit(cut))
    return out.select("doc_id", *COUNTS, "base_failed", F.coalesce(kept, F.lit(False)).alias("kept"), "distance2", "row_hash")
