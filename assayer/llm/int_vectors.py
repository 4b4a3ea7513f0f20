"""Integer vectors for exact searches: scaling, numpy matrices of packed rows, and streams of units of work."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm.common import picked

LARGEST = 1 << 24  # components are held within this bound after scaling, so that inner products fit 64 bits


def scaled(embeddings: DataFrame, scale: int, id_column: str, vector_column: str, **more: str) -> DataFrame:
    """Rows (vec_id, vector, …) whose components x have become floor(scale * x), x as double.

    Rows without an id, and vectors that are null or hold a null, NaN or infinite component, are left out. ``more`` names
    further columns to carry.
    """
    rows = picked(embeddings, vec_id=id_column, vector=vector_column, **more)
    rows = rows.withColumns({"vec_id": F.col("vec_id").cast("bigint"), "vector": F.col("vector").cast("array<double>")})
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.col("vec_id").isNotNull())
    return rows.withColumn("vector", F.transform("vector", lambda x: _held(F.floor(F.lit(float(scale)) * x))))


def _held(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(-LARGEST)), F.lit(LARGEST)).cast("int")


def inner_product(a: str, b: str) -> Column:
    """Of two columns of integer vectors of equal length."""
    products = F.zip_with(a, b, lambda x, y: x.cast("bigint") * y.cast("bigint"))
    return F.aggregate(products, F.lit(0).cast("bigint"), lambda total, x: total + x)


def matrix(vectors: pa.ChunkedArray, size: int) -> np.ndarray:
    """The rows of a list column as a matrix of 32-bit integers."""
    return vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(len(vectors), size)


def unpacked(packed: bytes, rows: int) -> np.ndarray:
    """A matrix for products: of doubles where these are exact, else of 64-bit integers."""
    values = np.frombuffer(packed, dtype="<i4").reshape(rows, len(packed) // 4 // rows)
    largest = int(np.abs(values).max(initial=0))
    return values.astype(np.float64 if values.shape[1] * largest * LARGEST < 1 << 53 else np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of one matrix with all rows (or the one vector) of another, as 64-bit integers."""
    if a.dtype != b.dtype:
        a, b = a.astype(np.int64), b.astype(np.int64)
    return (a @ b.T).astype(np.int64)


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """The sorted rows with increasing numbers in the order they are in; the numbers have gaps."""
    return rows.withColumn(name, F.monotonically_increasing_id())


def dealt(units: DataFrame, keys: list[str], order: list[str], count: int) -> DataFrame:
    """The rows of each unit (``keys``) in one task and in order; as many tasks as there are units, up to some thousands."""
    spread = units.repartition(max(1, min(count, 20_000)), *keys)
    return spread.sortWithinPartitions(*keys, *order)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of a stream one by one, as only one of them may be large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def parallel_floor(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
