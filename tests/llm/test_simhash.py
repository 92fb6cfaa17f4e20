import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cadenza.llm import simhash


def reference_fingerprint(text):
    """Straight from the definition."""
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reference_components(rows, max_bits):
    """All pairs, union by search."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (rows[i][1] ^ rows[j][1]).bit_count() <= max_bits:
            parent[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    low = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return [low[find(i)] for i in range(len(rows))]


@pytest.mark.parametrize("text", [None, "", " ", "One", "one two", "A b C d e", "é\x1cÉ x y z\x85 w", "w " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(simhash.shingles(text or "")) == reference_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b cé")).alias("h")).first()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest("a b cé", 42)


def planted(seed, n=120):
    """Fingerprints with chains and dense balls around a few centres."""
    rnd = random.Random(seed)
    out = [rnd.getrandbits(64) for _ in range(n)] + [0, 0, 1, 7, 0b1111]
    for centre in out[:6]:
        at = centre
        for _ in range(12):
            for _ in range(rnd.randint(1, 4)):
                at ^= 1 << rnd.randrange(64)
            out.append(at)
        out += [centre ^ (1 << i) for i in range(40)]
    return out


def as_signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize(("seed", "max_bits", "blocks", "bucket"), [(1, 3, 6, 4096), (2, 3, 6, 7), (3, 0, 4, 4096), (4, 2, 4, 16), (5, 3, 4, 90)])
def test_components_of_links(spark, seed, max_bits, blocks, bucket):
    from cadenza.llm.common import components

    fps = sorted(set(planted(seed)))
    df = spark.createDataFrame([(as_signed(x),) for x in fps], "fp long")
    found = {r.node: r.root for r in components(simhash.links(df, max_bits=max_bits, blocks=blocks, bucket=bucket)).collect()}
    got = [found.get(as_signed(x), as_signed(x)) for x in fps]
    want = reference_components([(as_signed(x), x) for x in fps], max_bits)
    assert got == want


def test_long_runs_keep_every_group():
    rnd = random.Random(9)
    centres = [rnd.getrandbits(64) for _ in range(5)]
    fps = np.array(sorted({c ^ (1 << i) ^ (1 << j) for c in centres for i in range(20) for j in range(20)}), dtype=np.uint64)
    a, b = simhash.links_within(np.zeros(len(fps), dtype=np.int64), fps, simhash.pivots(), 3)
    assert len(a) < len(fps)
    label = simhash._forest(len(fps), a, b)
    want = reference_components([(i, int(x)) for i, x in enumerate(fps)], 3)
    assert label.tolist() == want


def test_pivots_discard_only_far_pairs():
    fps = np.array(planted(3), dtype=np.uint64)
    a, b = np.triu_indices(len(fps), 1)
    x, y = simhash.survivors(fps, simhash.pivot_table(fps, simhash.pivots()), a, b, 3)
    assert set(zip(x.tolist(), y.tolist())) == {(i, j) for i, j in zip(a.tolist(), b.tolist()) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 3}


def test_documents(spark, odd_docs):
    extra = [(100 + i, t, "c", 1) for i, t in enumerate(["The cat sat on the mat by the door", "the CAT sat on the mat by the door", "the cat  sat on\nthe mat by the door"])]
    docs = odd_docs.unionByName(spark.createDataFrame(extra, odd_docs.schema))
    rows = [(r.doc_id, reference_fingerprint(r.text)) for r in docs.collect()]
    want = sorted(zip([r[0] for r in rows], [f"{r[1]:016x}" for r in rows], reference_components(rows, 3)), key=str)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == want


def test_no_documents(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
