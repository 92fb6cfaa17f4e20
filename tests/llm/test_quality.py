import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cadenza.llm import quality as Q


def reference_counts(text):
    """Straight from the definition."""
    text = text or ""
    word = r"[^\x20\x09-\x0D]+"
    words = re.findall(word, text)
    lines = [x for x in text.split("\n") if re.search(word, x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(inside),
    )


@pytest.mark.parametrize(
    "text", [None, "", " \n\t", "a", "a b c d e a b c d e", "x " * 40, "é\x85y\x1cz", "l\nl\n\n \nl\n l", "# * | <b>", "a b c d e f a b c d e g b c d e f"]
)
def test_base_counts(text):
    assert Q.base_counts(text or "") == reference_counts(text)


def test_chi_square():
    assert Q.chi2_quantile(0.05, 5) == pytest.approx(11.0705, abs=1e-3)
    assert Q.chi2_quantile(1e-9, 2) == pytest.approx(-2 * math.log(1e-9), rel=1e-9)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200_000, 5))
    d = (x**2).sum(1)
    near = x[d <= np.quantile(d, 0.75)]
    assert near.var(0).mean() * Q.consistency(0.75, 5) == pytest.approx(1, abs=0.02)


def reference_models(rows, support, steps, prior, starts):
    """The same estimates with every row in memory: per group the (log determinant, start, centre, whitening) of the best end."""
    x = np.array([r["x"] for r in rows])
    keys = [(r["lang"], r["source"]) for r in rows]
    places = {k: np.array([i for i, own in enumerate(keys) if own == k]) for k in set(keys)}
    flat = np.diag([1 / f for f in Q.FLOOR.values()])

    def fit(chosen, scale):
        sums = {k: np.array([len(at), x[at].sum(0), x[at].T @ x[at]], dtype=object) for k, at in chosen.items()}
        corpus = sum(sums.values())
        languages = {g: sum(v for k, v in sums.items() if k[0] == g) for g in {k[0] for k in sums}}
        languages = {g: v + corpus * (prior / corpus[0]) for g, v in languages.items()}
        return {k: Q.whitening(*(own + languages[k[0]] * (prior / languages[k[0]][0])), scale) for k, own in sums.items()}

    def median(at):
        return np.quantile(x[at], 0.5, axis=0, method="inverted_cdf")

    ends = {}
    for nr, start in enumerate(starts):
        everything = np.arange(len(x))
        models = fit(places, 1.0) if start == "mean" else {k: (median(everything if start == "corpus" else at), flat) for k, at in places.items()}
        for _ in range(steps):
            chosen = {}
            for k, at in places.items():
                bins = np.floor(np.log2((((x[at] - models[k][0]) @ models[k][1].T) ** 2).sum(1) + 1e-6) * Q.BINS)
                chosen[k] = at[[(bins < b).sum() < support * len(at) for b in bins]]
            models = fit(chosen, Q.consistency(support, Q.P))
        for k, (centre, white) in models.items():
            ends.setdefault(k, []).append((round(-2 * np.log(np.diag(white)).sum(), 9), nr, centre, white))
    return {k: min(found, key=lambda e: e[:2]) for k, found in ends.items()}


def reference_distances(rows, support, steps, prior, starts=Q.STARTS):
    models = reference_models(rows, support, steps, prior, starts)
    return [(((np.array(r["x"]) - models[r["lang"], r["source"]][2]) @ models[r["lang"], r["source"]][3].T) ** 2).sum() for r in rows]


def corpus(spark, n=400):
    rnd = random.Random(5)
    words = ["the", "of", "and", "river", "stone,", "house.", "walked", "Under", "light", "again!"]
    rows = []
    for i in range(n):
        w = [rnd.choice(words) + rnd.choice("abcdefgh") for _ in range(rnd.randint(12, 80))]
        if i % 40 == 7:
            w = [x + rnd.choice(["###", "$$$", "%%%"]) for x in w]
        elif i % 40 == 9:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w), rnd.choice(["en", "de", None]), "hot" if i % 3 else f"s{i % 5}", 0, 1.0))
    rows += [(1000 + i, rows[0][1], "en", "hot", 0, 1.0) for i in range(60)]
    rows += [(2000, None, "en", "hot", 0, 1.0), (2001, "", None, None, 0, 1.0), (None, "x y", "en", None, 0, 1.0), (2002, "long words here " * 2000, "en", "hot", 0, 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept int, n double").repartition(3)


def test_against_rows_in_memory(spark):
    docs = corpus(spark)
    got = {(r.doc_id): r for r in Q.quality(docs).collect()}
    rows = []
    for r in docs.collect():
        c = reference_counts(r.text)
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == c
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        assert g.base_failed == failed
        if failed:
            assert g.kept is False and g.distance2 is None
        else:
            rows.append({"lang": r.lang, "source": r.source, "x": Q.vector(r.text, *c[:3]), "id": r.doc_id})
    want = reference_distances(rows, Q.SUPPORT, Q.STEPS, Q.PRIOR_ROWS)
    cut = Q.chi2_quantile(Q.ALPHA, Q.P)
    for r, d in zip(rows, want, strict=True):
        assert got[r["id"]].distance2 == pytest.approx(d, rel=1e-6, abs=1e-9)
        assert got[r["id"]].kept == (d <= cut)
    junk = [got[i].kept for i in range(400) if i % 40 in (7, 9) and not got[i].base_failed]
    clean = [got[i].kept for i in range(400) if i % 40 not in (7, 9) and not got[i].base_failed]
    assert len(junk) > 10 and sum(junk) <= 0.2 * len(junk) and all(clean)


def test_each_group_keeps_the_least_determinant(spark):
    """A group far from the corpus median, whose outliers lie at that median, is found from its own medians."""
    rng = np.random.default_rng(8)
    near, far = rng.normal(0, 0.05, (400, Q.P)), rng.normal(0, 0.12, (130, Q.P)) + np.array([2.0, 0, 0, 0, 0])
    rows = [("en", "plain", False, *map(float, v)) for v in near]
    rows += [("xx", "odd", False, *map(float, v)) for v in far] + [("xx", "odd", False, *map(float, v)) for v in rng.normal(0, 0.01, (30, Q.P))]
    stats = spark.createDataFrame(rows, "lang string, source string, base_failed boolean, " + ", ".join(f"{f} double" for f in Q.FEATURES)).repartition(4)

    def found(starts):
        return {(r.lang, r.source): r for r in Q.estimate(stats, starts=starts, prior_rows=0.0, steps=2).collect()}

    alone = [found((s,)) for s in Q.STARTS]
    best = found(Q.STARTS)
    for key, r in best.items():
        assert r.log_det == pytest.approx(min(a[key].log_det for a in alone), abs=1e-8)
    odd = best["xx", "odd"]
    assert odd.start == "group" and odd.log_det < alone[0]["xx", "odd"].log_det - 1
    want = reference_models([{"lang": r[0], "source": r[1], "x": r[3:]} for r in rows], Q.SUPPORT, 2, 0.0, Q.STARTS)
    assert {k: (Q.STARTS[v[1]], pytest.approx(v[0], abs=1e-6)) for k, v in want.items()} == {k: (r.start, r.log_det) for k, r in best.items()}


def test_no_documents(spark):
    assert Q.quality(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).collect() == []


def test_labelled_documents(spark):
    """Labelled good documents stay, most of the labelled bad ones go."""
    sf = "/root/testdata/sf0.01"
    got = Q.quality(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    seen = Counter((r.quality, r.kept) for r in got.where("not base_failed").collect())
    assert seen[(1, False)] == 0 and seen[(0, False)] > 5 * seen[(0, True)]
