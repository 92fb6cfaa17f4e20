import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cadenza.llm import packing
from cadenza.llm.packing import Bins, fillings, lower_bound, plan_bins


def optimum(lengths, capacity):
    """Fewest bins by trying every assignment (small inputs)."""
    best = len(lengths)
    bins = []

    def put(i):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity:
                bins[k] += lengths[i]
                put(i + 1)
                bins[k] -= lengths[i]
        bins.append(lengths[i])
        put(i + 1)
        bins.pop()

    put(0)
    return best


@pytest.mark.parametrize("seed", range(25))
def test_plan_is_optimal_on_small_inputs(seed):
    rnd = random.Random(seed)
    lengths = sorted((rnd.randint(1, 60) for _ in range(rnd.randint(0, 10))), reverse=True)
    bins = plan_bins(Counter(lengths), 60)
    assert sum(b.count for b in bins) == (optimum(lengths, 60) if lengths else 0)
    assert Counter(itertools.chain.from_iterable(b.lengths * b.count for b in bins)) == Counter(lengths)
    assert all(sum(b.lengths) <= 60 for b in bins)


def test_completion_beats_best_fit():
    counts = {44: 1, 24: 1, 22: 1, 21: 1, 17: 1, 8: 1, 6: 2, 3: 3, 2: 5}
    best_fit = sum(b.count for b in packing._best_fit({6: 2, 5: 2, 4: 2, 3: 2}, 18))
    assert sum(b.count for b in plan_bins({6: 2, 5: 2, 4: 2, 3: 2}, 18)) <= best_fit
    bins = plan_bins(counts, 61)
    assert sum(b.count for b in bins) >= lower_bound(counts, 61)


def test_fillings_are_maximal():
    for f in fillings({5: 2, 3: 1, 2: 1}, 10):
        left = 10 - sum(f)
        rest = Counter({5: 2, 3: 1, 2: 1}) - Counter(f)
        assert all(k > left for k in rest)


def test_lengths_are_checked():
    with pytest.raises(ValueError):
        plan_bins({0: 1}, 10)
    assert plan_bins({}, 10) == []
    assert plan_bins({10: 3}, 10) == [Bins((10,), 3)]


def test_pack_whole(odd_docs, byte_bpe, library):
    for capacity in (16, 1024):
        rows = packing.pack(odd_docs, byte_bpe, capacity=capacity, with_ids=True).collect()
        by_seq = defaultdict(list)
        for r in rows:
            assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
            by_seq[r.sequence_id].append((r.offset, r.length))
        for places in by_seq.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= capacity
        total = sum(r.length for r in rows)
        assert len(by_seq) >= -(-total // capacity)
        want = Counter((d.doc_id, tuple(library.encode(d.text or "", add_special_tokens=False).ids + [2])) for d in odd_docs.collect())
        single = Counter()
        chunks = defaultdict(dict)
        for r in rows:
            ids = tuple(np.frombuffer(r.ids, "<u4").tolist())
            if r.piece == 0 and r.length < capacity and sum(x.doc_id == r.doc_id for x in rows) == 1:
                single[(r.doc_id, ids)] += 1
            chunks[r.doc_id][r.start] = ids
        for key in single:
            assert want[key] == single[key]
        whole = [k for k in want if k[0] == len(odd_docs.columns) + 10]
        for doc, ids in whole:
            assert tuple(itertools.chain.from_iterable(v for _, v in sorted(chunks[doc].items()))) == ids
        assert Counter(r.length for r in rows if r.length == capacity)[capacity] >= sum((len(ids) - 1) // capacity for _, ids in want)


def test_no_documents(spark, byte_bpe):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(empty, byte_bpe).collect() == []
