import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from cadenza.llm import resample as R

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, max_n=2):
    words = WORDS.findall((text or "").translate(ASCII_LOWER))
    return words, [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, percent=25, min_words=20, max_n=2, buckets=10_000):
    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for f in features(t, max_n)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = counts(x for _, x in docs), counts(target)
    gain = [math.floor(1000 * math.log((b + 1.0) * (sum(s) + buckets) / ((a + 1.0) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, x in docs:
        words, found = features(x, max_n)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found) // max(len(found), 1)
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    can = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(can[: len(can) * percent // 100]):
        r[4] = place + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_group_features_are_those_of_each_text():
    texts = ["The cat's HAT", "", None, "one", "Éé 12ab\x00cd, Straße naïve tab", "x" * 300 + " " + "y" * 49 + " y " + "z" * 48, "a b a b a", " "]
    import pyarrow as pa

    parts = list(R.groups(pa.array(texts, pa.string())))
    assert len(parts) == 1 and parts[0][:2] == (0, len(texts))
    for max_n in (1, 2, 4):
        words, doc, bucket = R.group_features(*parts[0][2:], max_n=max_n)
        assert words.tolist() == [len(features(t)[0]) for t in texts]
        for k, t in enumerate(texts):
            assert sorted(bucket[doc == k].tolist()) == sorted(zlib.crc32(f.encode()) % 10_000 for f in features(t, max_n)[1])


def test_groups_cover_every_row(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(R, "GROUP_BYTES", 10)
    texts = ["abc", "defghijklmnop", None, "", "q", "é" * 20, "z"]
    seen = []
    for a, b, joined, starts in R.groups(pa.array(["skipped", *texts], pa.string()).slice(1)):
        assert len(starts) == b - a and joined.count(b"\x00") == b - a
        seen += [joined[x:].split(b"\x00")[0].decode() for x in starts]
    assert seen == [t or "" for t in texts]


def test_resample_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(80)] + ["straße", "naïve", "Ünder", "don't"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 5, 19, 20, 21, 60])))) for i in range(300)]
    docs += [(400, None), (401, ""), (402, "..."), (403, "long " * 100_000), (404, "x" * 200_000), (5, docs[5][1]), (5, "again " * 30), (None, "no id " * 30), (None, None)]
    docs += [(500 + i, "same words " * 20) for i in range(200)]
    target = ["w1 w2 w3 w1 w2", None, "", "straße W4"]
    df = spark.createDataFrame([(*d, 1, "p") for d in docs], "doc_id long, text string, rank int, place string").repartition(4)
    tf = spark.createDataFrame([(t,) for t in target], "text string").repartition(2)
    got = R.resample(df, tf)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {f.dataType.simpleString() for f in got.schema} == {"bigint"}
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, target)
    got = R.resample(df, tf, percent=100, min_words=0, max_n=3, buckets=97)
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    want = brute(docs, target, 100, 0, 3, 97)
    # Two rows of one doc_id and score may take each other's place.
    assert [r[:4] for r in rows] == [r[:4] for r in want] and sorted(r[4] for r in rows) == sorted(r[4] for r in want)


def test_no_rows_and_nothing_to_draw(spark):
    schema = "doc_id long, text string"
    none = spark.createDataFrame([], schema)
    one = spark.createDataFrame([(1, "too few words"), (2, None)], schema)
    assert R.resample(none, none).collect() == []
    assert sorted(tuple(r) for r in R.resample(one, none).collect()) == brute([(1, "too few words"), (2, None)], [])
    assert all(r.rank is None for r in R.resample(one, one, min_words=0).collect())


def test_crc_of_appended_words():
    rng = np.random.default_rng(1)
    words = [rng.bytes(n) for n in (1, 2, 7, 48, 49, 500, 3)]
    before = [rng.bytes(n) for n in (0, 1, 5, 9, 70, 3, 8)]
    crc = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
    got = R.append_crc(np.array([zlib.crc32(b) for b in before], dtype=np.uint32), words, crc, np.array(list(map(len, words))))
    assert got.tolist() == [zlib.crc32(b + w) for b, w in zip(before, words)]
    assert R.noise(None) == R.noise(None) and pytest.approx(R.noise(1), abs=30_000) == 0
