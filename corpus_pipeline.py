"""The corpus pipeline over ``documents``: quality classifier, exact de-duplication, n-gram Jaccard join, best-fit packing.

Each stage works on all rows that the one before it kept, written as Parquet and read again. The first three return the
columns they were given; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import exact_dedup, ngram_join, packing, quality
from assayer.llm.common import ROW_KEY, narrow, row_keyed
from assayer.llm.lm_scoring import remainder
from assayer.llm.queries import BYTE_BPE, SEQUENCE_TOKENS, table
from assayer.session import pinned, scratch_path

SHINGLE_WORDS = 5
PERCENT = 80
# No SQL: the classifier is trained, and the packing is a procedure. The tests hold the stages against brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject. It learns from the labels that query op9 learns from."""
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 3) != 1)
    return quality.filtered(docs, labels)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal texts (A-Z in lower case) the row with the largest id, or one row where none has an id.

    Rows are dropped one by one: others that share their id stay. Rows that repeat both id and text stay together here, as
    ``op6`` marks them; the next stage leaves one of them.
    """
    rows = row_keyed(docs)
    found = exact_dedup.deduplicated(rows, exact_dedup.DigestIndex(spark), row_key=ROW_KEY)
    return _without(docs, rows, found.where("NOT kept").select(ROW_KEY))


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: one with the smallest id, or any where none has an id.

    Rows are joined and dropped one by one, whatever ids they share. Texts without words are no copies of anything and stay.
    """
    rows = row_keyed(docs)
    found = ngram_join.joined(rows, PERCENT, SHINGLE_WORDS, id_column=ROW_KEY).select(ROW_KEY, "component_id")
    others = pinned(found.where(F.col("component_id") != F.col(ROW_KEY)))
    groups = others.union(others.select(F.col("component_id").alias(ROW_KEY), "component_id").distinct())
    groups = pinned(rows.select(ROW_KEY, "doc_id").join(narrow(pinned(groups)), ROW_KEY))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", ROW_KEY)
    best = pinned(groups.groupBy("component_id").agg(F.min(place)[ROW_KEY].alias("best")))
    dropped = groups.join(narrow(best), "component_id").where(F.col("best") != F.col(ROW_KEY))
    return _without(docs, rows, dropped.select(ROW_KEY))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed."""
    return packing.best_fit(docs, BYTE_BPE, SEQUENCE_TOKENS)


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_jaccard_join", ngram_join_stage),
    ("best_fit_packing", packing_stage),
]


def _without(docs: DataFrame, rows: DataFrame, dropped: DataFrame) -> DataFrame:
    return rows.join(narrow(pinned(dropped)), ROW_KEY, "left_anti").select(docs.columns)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
