"""Exact de-duplication against a persistent index of digests.

The index is a table bucketed and sorted by digest. The digests of new data are aggregated to one row each, those that the
index already holds are removed by a sort-merge anti-join against its buckets, and the rest is appended. All of it is
DataFrame work; a text is read once, to make its digest.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm.common import lower_az, picked
from assayer.session import pinned, scratch_path

BUCKETS = 64  # of an index at least
BUCKET_ROWS = 2_000_000  # of its first batch; more rows get more buckets


class DigestIndex:
    """The digests seen so far: (digest, keep_id, batch), in buckets sorted by digest.

    With a ``path`` the index stays: its files are there until the caller removes them, and ``DigestIndex(spark, path=path)``
    opens it again, in a later session too. Without one it is a scratch table of this application. The number of buckets
    follows from the first batch and is kept beside the files.
    """

    def __init__(self, spark: SparkSession, table: str | None = None, buckets: int | None = None, path: str | None = None):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = table or f"digests_{uuid.uuid4().hex}"
        if path and not spark.catalog.tableExists(self.table) and self._there(self._note):
            self.buckets = spark.read.parquet(self._note).first()["buckets"]
            self._define()

    @property
    def _note(self) -> str:
        return f"{self.path.rstrip('/')}-buckets"

    def _there(self, path: str) -> bool:
        found = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(found)

    def _define(self) -> None:
        place = (self.path or scratch_path(self.spark, self.table)).replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id {self._kind}, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )

    _kind = "BIGINT"

    def _made(self, groups: DataFrame) -> None:
        if self.spark.catalog.tableExists(self.table):
            return
        self._kind = groups.schema["keep_id"].dataType.simpleString()
        self.buckets = self.buckets or max(BUCKETS, -(-groups.count() // BUCKET_ROWS))
        if self.path:
            self.spark.createDataFrame([(self.buckets,)], "buckets int").write.mode("overwrite").parquet(self._note)
        self._define()

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, groups: DataFrame, batch: str | None = None) -> DataFrame:
        """Appends the groups whose digest is new. Returns all groups with the row that stays and whether it is of this batch.

        A batch that comes again under its name, as after a lost driver, is told from itself: what it has added before counts as
        new, and nothing is added twice. Unnamed batches are all different.
        """
        self._made(groups)
        batch = batch or uuid.uuid4().hex
        seen = self.rows().select("digest").hint("merge")
        fresh = pinned(groups.join(seen, "digest", "left_anti")).withColumn("batch", F.lit(batch))
        writer = fresh.select("digest", "keep_id", "batch").write.format("parquet").mode("append")
        writer.bucketBy(self.buckets or self._buckets(), "digest").sortBy("digest").saveAsTable(self.table)
        known = groups.drop("keep_id").join(self.rows().hint("merge"), "digest")
        return known.withColumn("new", F.col("batch") == batch).drop("batch")

    def _buckets(self) -> int:
        """Of a table that was there before."""
        found = self.spark.sql(f"DESCRIBE EXTENDED {self.table}").where("col_name = 'Num Buckets'").first()
        self.buckets = int(found["data_type"])
        return self.buckets

    def compacted(self, path: str) -> DigestIndex:
        """The same index at another path, each bucket in one file again; the old one is left as it is."""
        other = DigestIndex(self.spark, buckets=self.buckets or self._buckets(), path=path)
        rows = self.rows()
        other._made(rows)
        writer = rows.repartition(other.buckets, "digest").write.format("parquet").mode("append")
        writer.bucketBy(other.buckets, "digest").sortBy("digest").saveAsTable(other.table)
        return other


def digests(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and the SHA-256 of the text with A-Z in lower case; a null text counts as empty."""
    rows = picked(documents, doc_id=id_column, text=text_column)
    return rows.select("doc_id", _digest("text").alias("digest"))


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(lower_az(F.coalesce(text, F.lit(""))), 256))


def deduplicated(
    documents: DataFrame,
    index: DigestIndex,
    id_column: str = "doc_id",
    text_column: str = "text",
    row_key: str | None = None,
    batch: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of the new documents with equal texts the one with the largest id stays, unless the index already holds the text: then
    none stays and keep_id names the earlier row. Rows without an id stay only where a whole group has none; rows that
    repeat an id with the same text are all marked as kept. An empty table gives no rows and leaves the index as it was.
    ``batch`` names the documents: given again, they get the same result again. Texts of any length are taken whole.

    With ``row_key``, a column that tells all rows apart, the result has it too, and of a group without ids only the row with
    the smallest key is kept.
    """
    rows = digests(documents, id_column, text_column)
    if row_key:
        keys = picked(documents, row_key=row_key, doc_id=id_column, text=text_column)
        rows = keys.select("row_key", "doc_id", _digest("text").alias("digest"))
    rows = pinned(rows)
    first = [F.min("row_key").alias("first_key")] if row_key else []
    groups = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), *first)
    groups = pinned(groups)
    known = pinned(index.add(groups, batch))
    kept = F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    if row_key:
        kept &= F.col("keep_id").isNotNull() | (F.col("row_key") == F.col("first_key"))
    return rows.join(known, "digest").select(
        *([F.col("row_key").alias(row_key)] if row_key else []),
        "doc_id",
        "keep_id",
        "group_size",
        kept.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
