"""Every stage against brute force on its own input."""

import corpus_pipeline as pipeline
import pytest
from cadenza.llm import langid, quality
from test_pii import reference_spans
from test_simhash import reference_components, reference_fingerprint

from cadenza.llm import pii

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage, as written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame(
        [(900001, None, None, None, None), (900002, "", "en", "src0", 0), (None, "12345 67890 " * 9, "en", None, 9), (900003, docs.first().text, "en", "src0", 5)], docs.schema
    )
    docs = docs.unionByName(extra)
    out = []
    for name, stage in pipeline.STAGES:
        made = pipeline.materialise(stage(spark, docs, SF), "test")
        out.append((name, docs, made))
        docs = made
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_columns_stay(stages):
    for _, docs, made in stages[:-1]:
        assert made.columns == docs.columns


def test_quality(stages):
    _, docs, made = stages[0]
    kept = {(r.doc_id, r.row_hash) for r in quality.quality(docs).where("kept").collect()}
    hashed = docs.withColumn("h", pipeline.F.xxhash64("text")).collect()
    assert rows(made) == sorted((tuple(r)[:-1] for r in hashed if (r.doc_id, r.h) in kept), key=str)
    assert 0.5 * docs.count() < made.count() < docs.count()


def test_language(stages):
    _, docs, made = stages[1]
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in made.collect()}
    found = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert all(found[d].lang_pred == "und" or found[d].score < pipeline.MIN_LANGUAGE_SCORE for d in gone)


def test_near_duplicates(stages):
    _, docs, made = stages[2]
    own = [(r.doc_id, reference_fingerprint(r.text)) for r in docs.collect()]
    assert {r.doc_id for r in made.collect()} == set(reference_components(own, 3))
    assert 900003 not in {r.doc_id for r in made.collect()}


def test_personal_data(stages):
    _, docs, made = stages[3]
    before = {r.doc_id: r for r in docs.collect()}
    for r in made.collect():
        assert r.text == pii.masked(before[r.doc_id].text, pii.base_spans(before[r.doc_id].text)) and not reference_spans(r.text)
        assert r.n_chars == len(r.text)


def test_packing(stages):
    _, docs, made = stages[4]
    assert {r.doc_id for r in made.collect()} == {r.doc_id for r in docs.collect()}
    bins = {}
    for r in made.collect():
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in b) <= 1024 for b in bins.values())


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_one_row_of_each_near_duplicate_group(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b, c, d, e, f = (r.text for r in docs.where("length(text) > 300").orderBy("doc_id").limit(6).collect())
    rows = [
        (1, a), (2, a), (2, b),  # doc_id 2 repeats with a text of its own
        (None, a), (None, c),  # a copy and a unique text without doc_id
        (3, d), (3, d), (3, d),  # a repeated row
        (None, e), (None, e), (None, e),  # a group without any doc_id
        (None, f), (9, f),
    ]
    rows = spark.createDataFrame([(i, t, "en", "src0", k) for k, (i, t) in enumerate(rows)], docs.schema).repartition(4)
    texts = [a, b, c, d, e, f]
    own = [(k, reference_fingerprint(t)) for k, t in enumerate(texts)]
    assert reference_components(own, 3) == list(range(6))
    made = pipeline.near_duplicate_stage(spark, rows, SF)
    assert made.columns == docs.columns
    got = [(r.doc_id, texts.index(r.text)) for r in made.collect()]
    assert sorted(got, key=str) == sorted([(1, 0), (2, 1), (None, 2), (3, 3), (None, 4), (9, 5)], key=str)


def test_extra_columns_with_the_names_of_helpers_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60)
    names = ["r_id", "R_HASH", "near_dup_row", "f_id", "f_hash", "found", "row_hash", "row_key", "fp", "lang_pred"]
    for k, name in enumerate(names):
        docs = docs.withColumn(name, pipeline.F.lit(f"{name}{k}"))
    for _, stage in pipeline.STAGES[:-1]:
        made = pipeline.materialise(stage(spark, docs, SF), "test")
        assert made.columns == docs.columns
        assert [r[name] for r in made.limit(1).collect() for name in names] == [f"{name}{k}" for k, name in enumerate(names)]
        docs = made
    assert pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count() > 20
