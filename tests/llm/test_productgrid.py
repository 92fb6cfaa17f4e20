import itertools
import math

import numpy as np
import pytest

from cadenza.llm import productgrid as G


def cosine(a, b):
    n = max(len(a), len(b))
    a, b = ([x / max(map(abs, v)) for x in v] + [0.0] * (n - len(v)) for v in (a, b))
    return math.fsum(x * y for x, y in zip(a, b)) / math.sqrt(math.fsum(x * x for x in a)) / math.sqrt(math.fsum(x * x for x in b))


def brute(rows, threshold=G.THRESHOLD):
    """Sorted (vec_id, n_links, component_id, kept) of rows (vec_id, vector)."""
    good = [v is not None and any(v) and all(x is not None and math.isfinite(x) for x in v) for _, v in rows]
    n = len(rows)
    near = [[] for _ in rows]
    for i, j in itertools.combinations([k for k in range(n) if good[k]], 2):
        if cosine(rows[i][1], rows[j][1]) >= threshold:
            near[i].append(j)
            near[j].append(i)
    out, seen = [], {}
    for i in range(n):
        if i not in seen:
            todo, group = [i], {i}
            while todo:
                for j in near[todo.pop()]:
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            ids = [rows[k][0] for k in group if rows[k][0] is not None]
            seen |= dict.fromkeys(group, min(ids, default=None))
        out.append((rows[i][0], len(near[i]), seen[i], rows[i][0] == seen[i]))
    return sorted(out, key=str)


def got(df, **options):
    return sorted((tuple(r) for r in G.near_duplicates(df, **options).collect()), key=str)


def turned(rng, u, cos):
    e = rng.normal(size=len(u))
    e -= e @ u * u
    return cos * u + math.sqrt(1 - cos * cos) * e / np.linalg.norm(e)


def test_walk_order_and_reach():
    rng = np.random.default_rng(1)
    a, b = rng.random(6), rng.random(9)
    every = sorted((a[i] + b[j], i * 9 + j) for i in range(6) for j in range(9))
    assert G.grid_walk(a, b, math.inf) == [c for _, c in every]
    assert G.grid_walk(a, b, 0.4) == [c for d, c in every if d <= every[0][0] + 0.4]


@pytest.mark.parametrize("block", [3, 5000])
def test_every_pair_met_equals_brute_force_on_odd_rows(spark, block):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 6))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(100 + i, [float(x) for x in turned(rng, base[i % 5] / np.linalg.norm(base[i % 5]), c)]) for i, c in enumerate([0.9501, 0.96, 0.99, 0.9499, 0.97] * 8)]
    rows += [(300 + i, rows[3][1]) for i in range(20)] + [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, [9.0, 9.0, -9.0]), (None, None)]
    rows += [(400, [1e-200] * 6), (401, [1e200] * 6), (402, [1.0]), (403, [2.0, 0.0]), (404, []), (405, [0.0] * 6), (406, [1.0, None]), (407, [float("nan")] * 6), (408, [float("inf"), 1.0])]
    df = spark.createDataFrame([(*r, 1, True, 5, 0) for r in rows], "vec_id long, embedding array<double>, node long, ok boolean, h1 int, copies int").repartition(5)
    assert got(df, reach=math.inf, codes=4, block=block) == brute(rows)


def test_links_found_from_one_end_count_once(spark):
    # A short reach makes many walks one-sided; whatever is found must be a link, once for each end.
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(100 + i, [float(x) for x in turned(rng, base[i % 20] / np.linalg.norm(base[i % 20]), 0.955)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = {r[0]: r for r in brute(rows)}
    some = 0
    for reach in (0.0, 0.05, 0.2):
        found = got(df, reach=reach, codes=9)
        assert sum(r[1] for r in found) % 2 == 0
        assert all(r[1] <= want[r[0]][1] and r[2] >= want[r[0]][2] for r in found)
        some += 0 < sum(r[1] for r in found) < sum(r[1] for r in want.values())
    assert some


def test_recall_at_the_threshold_itself(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(4000, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    pairs = np.array([turned(rng, base[i], 0.951) for i in range(1000)])
    hot = np.array([turned(rng, base[3999], 0.98) for _ in range(700)])
    x = np.concatenate([base, pairs, hot]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(6)
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1)[:, None]
    true = (y @ y.T >= G.THRESHOLD).sum(axis=1) - 1
    found = {r.vec_id: r.n_links for r in G.near_duplicates(df).collect()}
    assert len(found) == len(x) and all(found[i] <= n for i, n in enumerate(true))
    assert sum(found.values()) >= 0.98 * true.sum()
    lone = [i for i in range(4000, 5000) if true[i] == 1]
    assert len(lone) > 900 and sum(found[i] for i in lone) >= 0.97 * len(lone)


def test_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert got(spark.createDataFrame([], schema)) == []
    assert got(spark.createDataFrame([(5, None)], schema)) == [(5, 0, 5, True)]
    assert got(spark.createDataFrame([(5, [1.0]), (3, [2.0])], schema)) == [(3, 1, 3, True), (5, 1, 3, False)]
