"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``. A stage's result is written as Parquet
and read again as the next one's ``docs``. Decisions are joined back to the
rows by doc_id and the hash of the text (null-safe), so rows that repeat a
doc_id with another text are decided by themselves. Only rejected keys are
joined; where they are a share of all documents they have no size bound, so
that join is a sort-merge join at every size. Near-duplicates keep one row of
a group, which may repeat another in all columns, so there each row gets a
written number first and the numbers of the kept rows are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import langid, packing, pii, quality, simhash
from cadenza.llm.common import materialise, scratch_path, unused
from cadenza.llm.queries import BYTE_BPE, table

#: Pooled probability below which a document's language counts as not identified.
MIN_LANGUAGE_SCORE = 0.25


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, hash of the text) is not in ``rejected(doc_id, row_hash)``."""
    id_, hash_ = unused(docs, "r_id"), unused(docs, "r_hash")
    keys = materialise(rejected.select(F.col("doc_id").alias(id_), F.col("row_hash").alias(hash_)).distinct(), "rejected").hint("merge")
    own = F.xxhash64("text")
    return docs.join(keys, F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & own.eqNullSafe(F.col(hash_)), "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that pass the base rules and lie near their group's robust estimate."""
    return _without(docs, quality.quality(docs).where("not kept"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without an identified language."""
    found = langid.identify(docs)
    return _without(docs, found.where((F.col("lang_pred") == langid.UNKNOWN) | (F.col("score") < MIN_LANGUAGE_SCORE)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each SimHash group: the smallest by doc_id (null last), then by hash of the text, then any one."""
    row = unused(docs, "near_dup_row")
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    kept = materialise(simhash.representatives(rows, row), "kept").hint("merge")
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token ids of all documents into sequences."""
    return packing.pack(docs, BYTE_BPE)


STAGES = [
    ("quality rules", quality_stage),
    ("language ID", language_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("PII", personal_data_stage),
    ("best-fit packing", packing_stage),
]

#: Trained models and iterated graphs are beyond SQL: tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return out
        path = scratch_path(spark, f"stage{k}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
