import random
import zlib

import numpy as np
import pytest

from cadenza.llm import langid as L


def samples(n=1500, seed=3):
    rnd = random.Random(seed)
    parts = {"aa": ["tion", "the", "ing", "ou"], "bb": ["eux", "que", "é", "ou"], "cc": ["sch", "ung", "ö", "er"]}
    return [("".join(rnd.choice(p) for _ in range(rnd.randint(1, 4))).encode(), lang) for lang, p in parts.items() for _ in range(n)]


def test_windows_label_every_position_once():
    text = "Ünder the  sea " + "x" * 1000 + " ÉTÉ\n\n" + "漢" * 300
    data = L.positions(text)
    assert data == ("ünder the sea " + "x" * 1000 + " été " + "漢" * 300).encode()
    cut = L.windows(data)
    assert b"".join(w[first:end] for w, first, end in cut) == data and len(cut) == 4
    assert all(end - first <= L.WINDOW and len(w) <= L.WINDOW + 2 * L.OVERLAP for w, first, end in cut)
    assert L.windows(L.positions(" \n")) == []


def test_passages_are_bounded_and_span_the_text():
    text = "".join(f"word{i} " for i in range(400)).strip()
    found = L.passages(text)
    assert len(found) == L.PASSAGES_PER_DOC and found[0] == text[: L.PASSAGE].encode() and found[-1] == text[-L.PASSAGE :].encode()
    assert L.passages("Été") == ["été".encode()] and L.passages("") == L.passages("12 34") == []


def test_gradients_match_differences():
    net = L.Network.fresh(["a", "b", "c"])
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    batch, target = [b"hello", b"wo", b"r"], np.array([0, 1, 2])
    _, g = L.gradients(net, batch, target)
    rng = np.random.default_rng(0)
    for name, w in net.weights.items():
        for _ in range(4):
            at = (int(rng.choice([104, 101, 119])), int(rng.integers(w.shape[1]))) if name == "embed" else tuple(int(rng.integers(n)) for n in w.shape)
            keep, eps = w[at], 1e-3
            w[at] = keep + eps
            up, _ = L.gradients(net, batch, target)
            w[at] = keep - eps
            down, _ = L.gradients(net, batch, target)
            w[at] = keep
            assert g[name][at] == pytest.approx((up - down) / (2 * eps), rel=2e-2, abs=2e-5)


def test_pooled_labels_do_not_depend_on_the_batch():
    net = L.train(samples(100), epochs=1)
    words = [b"a", b"tionou", b"schung" * 400, b"", b"eux"]
    alone = np.concatenate([L.pooled(net, [w]) for w in words])
    assert L.pooled(net, words) == pytest.approx(alone, abs=1e-5)
    assert alone.sum(axis=1) == pytest.approx([len(w) for w in words], rel=1e-4)


def test_states_run_across_words_and_windows():
    """A word's labels depend on the words around it, and windows give nearly what one run over the whole text gives."""
    net = L.train(samples(200), epochs=2)
    alone, among = L.pooled(net, [b"ou"])[0], L.pooled(net, [b"sch ung ou sch ung"])[0] - L.pooled(net, [b"sch ung sch ung"])[0]
    assert np.abs(alone - among).max() > 1e-3
    text = L.positions(" ".join(s.decode() for s, _ in samples(400)))
    assert len(L.windows(text)) > 10
    codes, _, active = L.pad([text])
    logits = net.weights["out"].T @ np.concatenate([L._run(net, codes, active, d)[0] for d in "fb"], axis=1) + net.weights["bias"][:, None]
    whole = L._softmax(logits).sum(axis=(0, 2))
    assert L.pooled(net, [text])[0] == pytest.approx(whole, rel=5e-3)


def test_training_learns():
    net = L.train(samples(), epochs=4)
    test = samples(200, seed=9)
    p = L.pooled(net, [s for s, _ in test])
    good = np.mean([net.labels[i] == lang for i, (_, lang) in zip(p.argmax(axis=1), test, strict=True)])
    assert good > 0.85
    assert L.train([]).labels == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    out = [r for r in rows if r.held_out and len(r.text) > 50]
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.97


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from pyspark.sql import functions as F

    wrong = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    usable = ~L.held_out(F.col("doc_id"))
    assert L.sample(docs, usable) == L.sample(wrong, usable)


def test_odd_rows(spark, odd_docs):
    from pyspark.sql import functions as F

    docs = odd_docs.withColumn("lang", F.when(F.length("text") > 3, F.lit("en")).otherwise(F.lit(None))).withColumn("score", F.lit("x"))
    rows = L.identify(docs).collect()
    assert len(rows) == docs.count()
    got = {(r.doc_id, r.row_hash): r.lang_pred for r in rows}
    want = {(d.doc_id, d.h): any(ch.isalpha() for ch in d.text or "") for d in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    assert {k: v != "und" for k, v in got.items()} == want
    unlabelled = L.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert all(r.lang_pred == "und" and r.score == 0 for r in unlabelled)
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert L.identify(empty).collect() == []


def test_sample_is_bounded_by_ids_whatever_repeats(spark):
    from pyspark.sql import functions as F

    text = F.concat(F.lit("alpha beta gamma "), F.when(F.col("id") % 2 == 0, F.lit("delta")).otherwise(F.lit("kappa")))
    rows = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"))
    rows = rows.unionByName(spark.range(3000).select((F.col("id") + 100).alias("doc_id"), text.alias("text"), F.lit("en").alias("lang")))
    found = L.sample(rows, F.lit(True), docs_per_language=50)
    assert 0 < len(found) <= 150
