import zlib

import numpy as np
import pytest
from pyspark.sql import Row

from cadenza.llm import idstore


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 1000, 20000])
def test_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    h = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    d, seed, slot = idstore.build(h)
    assert sorted(slot.tolist()) == list(range(len(h)))
    assert (idstore.probe(h, d, seed, len(h)) == slot).all()
    assert len(d) == -(-len(h) // idstore.LOAD)


def test_index_file_rejects_unknown_keys():
    h = idstore._mix(np.arange(5000, dtype=np.uint64))
    raw = idstore.dump_segment(h, np.arange(5000) % 7, np.arange(5000) * 10, np.full(5000, 3))
    found = idstore.probe_segment(raw, h)
    assert found["hit"].all() and (found["offset"] == np.arange(5000) * 10).all() and (found["shard"] == np.arange(5000) % 7).all()
    assert idstore.probe_segment(raw, idstore._mix(np.arange(10**6, 10**6 + 5000, dtype=np.uint64)))["hit"].sum() <= 2
    with pytest.raises(ValueError):
        idstore.probe_segment(b"x" * 64, h)


def test_equal_hashes_are_refused():
    with pytest.raises(ValueError):
        idstore.build(np.array([1, 1], dtype=np.uint64))


@pytest.mark.parametrize("segment_keys", [4, 20000])
def test_round_trip(odd_docs, byte_bpe, library, segment_keys):
    store = idstore.write(odd_docs, byte_bpe, segment_keys=segment_keys)
    got = idstore.read(store, with_ids=True).collect()
    rows = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    start, want, seen = 0, [], {}
    for r in rows:
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [0], dtype="<u4").tobytes()
        turn = seen[r.doc_id] = seen.get(r.doc_id, -1) + 1
        want.append((r.doc_id, turn, start, len(ids) // 4, zlib.crc32(ids), ids))
        start += len(ids) // 4
    assert sorted(map(tuple, got), key=lambda x: x[2]) == want


def test_rows_of_a_hot_id_are_dealt_over_shards(spark, byte_bpe, library):
    texts = [f"text {i % 900}" for i in range(2000)] + ["x" * 70 + str(i) for i in range(500)]
    rows = [(7, t) for t in texts] + [(None, t) for t in texts[:800]] + [(i, f"other {i}") for i in range(500)]
    store = idstore.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), byte_bpe, segment_keys=300)
    located = idstore.locate(store, store.keys).collect()
    assert len({r.shard for r in located if r.doc_id == 7}) > 1
    assert sorted(r.occurrence for r in located if r.doc_id == 7) == list(range(2501))
    got = sorted(idstore.read(store, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.start for r in got] == np.r_[0, np.cumsum([r.n_tokens for r in got])[:-1]].tolist()
    assert [(r.doc_id is not None, r.doc_id or 0, r.occurrence) for r in got] == sorted((r.doc_id is not None, r.doc_id or 0, r.occurrence) for r in got)
    back = sorted((r.doc_id or -1, library.decode(np.frombuffer(r.ids, "<u4")[:-1].tolist())) for r in got)
    assert back == sorted((doc or -1, t) for doc, t in rows)


def test_occurrences_are_counted_on_over_whole_shards(spark):
    rows = [(1, 0, 0), (5, 0, 0), (5, 0, 1), (5, 1, 1), (5, 0, 2), (6, 0, 2)]
    entries = spark.createDataFrame([(*r, 0, 1, "f", 0) for r in rows], idstore.ENTRY)
    tasks = [Row(task=0, first=1, last=5, turn=0), Row(task=1, first=5, last=5, turn=1), Row(task=2, first=5, last=6, turn=0)]
    got = idstore._counted_on(entries, tasks).where("doc_id = 5").orderBy("task", "occurrence").collect()
    assert [r.occurrence for r in got] == [0, 1, 2, 3]
    assert len({r.h for r in got}) == 4


def test_lookup_of_some_keys(spark, odd_docs, byte_bpe):
    store = idstore.write(odd_docs, byte_bpe, segment_keys=5)
    keys = spark.createDataFrame([(1, 0), (999999, 0), (5, 1), (5, 9)], "doc_id long, occurrence long")
    got = {(r.doc_id, r.occurrence): r.n_tokens for r in idstore.read(store, keys).collect()}
    assert got[(1, 0)] == 1 and got[(999999, 0)] is None and got[(5, 1)] > 0 and got[(5, 9)] is None


def test_no_documents(spark, byte_bpe):
    store = idstore.write(spark.createDataFrame([], "doc_id long, text string"), byte_bpe)
    assert idstore.read(store).collect() == []
