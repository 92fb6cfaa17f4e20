import math

import numpy as np
import pytest

from cadenza.llm import multiindex as M

SF = "/root/testdata/sf0.1"


def brute(rows, queries, k):
    """rows, queries: (id, vector)."""

    def good(v):
        return v is not None and any(v) and all(x is not None and math.isfinite(x) for x in v)

    cand = [(i, v) for i, v in rows if i is not None and good(v)]
    out = {}
    for q, v in queries:
        if q is None or not good(v):
            continue
        scored = sorted({(-sum(a * b for a, b in zip(v, x)), i) for i, x in cand if i != q})
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_walk_takes_cells_by_summed_distance():
    rng = np.random.default_rng(1)
    a, b, sizes = rng.random(7), rng.random(5), rng.integers(0, 4, 35)
    cells = M.walk(a, b, sizes, 30)
    order = sorted((a[c // 5] + b[c % 5], c) for c in range(35) if sizes[c])
    assert cells == [c for _, c in order[: len(cells)]] and sizes[cells].sum() >= 30 > sizes[cells[:-1]].sum()
    assert sorted(M.walk(a, b, sizes, 10**9)) == np.flatnonzero(sizes).tolist()


def test_whole_walk_is_exact_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(M, "ROW_BLOCK", 7)
    monkeypatch.setattr(M, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(150)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 1.0, 0.0]) for i in range(60)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 6), (2003, [1.0, None]), (2004, [float("nan")] * 6), (2005, [float("inf"), 1.0]), (2006, [1.0, 2.0]), (None, [1.0] * 6), (3, rows[3][1])]
    df = spark.createDataFrame([(*r, 1, 0.5) for r in rows], "vec_id long, embedding array<double>, rank int, score double").repartition(4)
    got = {}
    for r in M.nearest(df, df.where("vec_id % 20 = 0 or vec_id >= 2000"), k=5, probe=10**9, codes=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, pytest.approx(r.score, abs=1e-9)))
        assert r.rank == len(got[r.query_id])
    want = brute(rows, [r for r in rows if r[0] is not None and (r[0] % 20 == 0 or r[0] >= 2000)], 5)
    assert want == got and 2006 in got and len(got) == len(want)


def test_recall(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    x = {r.vec_id: r.embedding for r in df.collect()}
    ids = np.array(sorted(x))
    mat = np.array([x[i] for i in ids], dtype=np.float64)
    got = {}
    for r in M.nearest(df, df.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert set(got) == {i for i in x if i % 20 == 0}
    met = 0
    for q, found in got.items():
        dots = mat @ np.array(x[q], dtype=np.float64)
        dots[ids == q] = -np.inf
        met += len(set(found) & set(ids[np.argsort(-dots, kind="stable")[:20]].tolist()))
        assert len(found) == 20 and all(s == pytest.approx(dots[np.searchsorted(ids, i)], abs=1e-12) for i, s in found.items())
    assert met >= 0.9 * 20 * len(got)


def test_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], schema)
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in M.nearest(one, one.where("vec_id = 0")).collect()] == [(0, 1, 1, 0.5)]
    none = spark.createDataFrame([], schema)
    assert M.nearest(none, none).collect() == [] and M.nearest(one, none).collect() == []
