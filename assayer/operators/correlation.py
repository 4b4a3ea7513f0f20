"""Pearson correlation of all pairs of numeric columns, pairwise complete."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayer.config import DEFAULTS, LIMITS, Limits, Thresholds
from assayer.functions.columns import nan_to_null, numeric_columns, numeric_value
from assayer.functions.relations import one_row_per, small_relation

_PAIR_SCHEMA = (
    "a int, b int, n double, mean_a double, mean_b double, dev_a double, dev_b double, dev_ab double"
)


def _ratio(cross, left, right):
    spread = F.sqrt(left) * F.sqrt(right)
    r = F.when(spread > 0, cross / spread)
    # a column that holds an infinity has no correlation
    return F.when(r.isNotNull() & ~F.isnan(r), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def _few_columns(df: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
    """One aggregate in the JVM; the number of expressions grows with the pairs."""
    aggregates = []
    for k, (i, j) in enumerate(pairs):
        a, b = numeric_value(df.columns[i]), numeric_value(df.columns[j])
        left, right = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
        aggregates += [
            F.covar_pop(a, b).alias(f"c{k}"),
            F.var_pop(left).alias(f"a{k}"),
            F.var_pop(right).alias(f"b{k}"),
            # rounding leaves a constant column some variance
            (F.min(left) < F.max(left)).alias(f"va{k}"),
            (F.min(right) < F.max(right)).alias(f"vb{k}"),
        ]
    return one_row_per(
        df.agg(*aggregates),
        [
            F.struct(
                F.lit(i).alias("a"),
                F.lit(j).alias("b"),
                F.when(
                    F.col(f"va{k}") & F.col(f"vb{k}"), _ratio(F.col(f"c{k}"), F.col(f"a{k}"), F.col(f"b{k}"))
                ).alias("r"),
            )
            for k, (i, j) in enumerate(pairs)
        ],
    )


def _pair_kernel():
    """The function that runs in the tasks, self-contained so that it can be shipped by value."""

    def of_batch(x: np.ndarray) -> list[np.ndarray]:
        """n, mean_a, mean_b, dev_a, dev_b, dev_ab as matrices over column pairs."""
        present = ~np.isnan(x)
        mask = present.astype(float)
        # subtracting an actual value first makes a constant column exactly zero
        first = np.array([c[p][0] if p.any() else 0.0 for c, p in zip(x.T, present.T)])
        shifted = np.where(present, x - first, 0.0)
        centre = shifted.sum(0) / np.maximum(mask.sum(0), 1.0)
        shifted = np.where(present, shifted - centre, 0.0)
        n = mask.T @ mask
        mean = (shifted.T @ mask) / np.maximum(n, 1.0)
        dev = np.maximum((shifted**2).T @ mask - n * mean**2, 0.0)
        cross = shifted.T @ shifted - n * mean * mean.T
        origin = (first + centre)[:, None]
        return [n, mean + origin, (mean + origin).T, dev, dev.T, cross]

    def merge(left: list[np.ndarray] | None, right: list[np.ndarray]) -> list[np.ndarray]:
        """Combine two sets of pair moments; working on differences of means keeps it stable."""
        if left is None:
            return right
        n = left[0] + right[0]
        part = right[0] / np.maximum(n, 1.0)
        steps = [np.where((left[0] > 0) & (right[0] > 0), right[k] - left[k], 0.0) for k in (1, 2)]
        means = [np.where(left[0] > 0, left[k] + steps[k - 1] * part, right[k]) for k in (1, 2)]
        both = left[0] * part
        return [
            n,
            *means,
            left[3] + right[3] + steps[0] ** 2 * both,
            left[4] + right[4] + steps[1] ** 2 * both,
            left[5] + right[5] + steps[0] * steps[1] * both,
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Fold the batches of a task into one row per pair of columns."""
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
                total = merge(total, of_batch(x))
        if total is None:
            return
        a, b = np.triu_indices(total[0].shape[0], 1)
        arrays = [pa.array(a.astype("int32")), pa.array(b.astype("int32"))] + [pa.array(m[a, b]) for m in total]
        yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "n", "mean_a", "mean_b", "dev_a", "dev_b", "dev_ab"])

    return run


def _many_columns(df: DataFrame, ordinals: list[int]) -> DataFrame:
    """Matrix products inside the tasks; one row per pair and task is shuffled."""
    numbers = df.select([numeric_value(df.columns[i]).alias(str(i)) for i in ordinals])
    partial = numbers.mapInArrow(_pair_kernel(), _PAIR_SCHEMA).where("n > 0")
    of_pair = Window.partitionBy("a", "b")

    def centred(mean: str):
        whole = F.sum(F.col("n") * F.col(mean)).over(of_pair) / F.sum("n").over(of_pair)
        same = F.min(mean).over(of_pair) == F.max(mean).over(of_pair)
        return F.when(same, F.lit(0.0)).otherwise(F.col(mean) - whole)

    merged = (
        partial.withColumn("off_a", centred("mean_a"))
        .withColumn("off_b", centred("mean_b"))
        .groupBy("a", "b")
        .agg(
            F.sum(F.col("dev_a") + F.col("n") * F.col("off_a") * F.col("off_a")).alias("dev_a"),
            F.sum(F.col("dev_b") + F.col("n") * F.col("off_b") * F.col("off_b")).alias("dev_b"),
            F.sum(F.col("dev_ab") + F.col("n") * F.col("off_a") * F.col("off_b")).alias("dev_ab"),
        )
    )
    place = F.array(*[F.lit(i) for i in ordinals])
    return merged.select(
        F.get(place, F.col("a")).alias("a"),
        F.get(place, F.col("b")).alias("b"),
        _ratio(F.col("dev_ab"), F.col("dev_a"), F.col("dev_b")).alias("r"),
    )


def correlations(df: DataFrame, columns: list[str] | None = None, limits: Limits = LIMITS) -> DataFrame:
    """(ordinal_a, ordinal_b, col_a, col_b, r) for a before b; r is null where undefined."""
    df = nan_to_null(df)
    chosen = set(numeric_columns(df) if columns is None else columns)
    ordinals = [i for i, c in enumerate(df.columns) if c in chosen]
    pairs = list(combinations(ordinals, 2))
    schema = {"ordinal_a": "int", "ordinal_b": "int", "col_a": "string", "col_b": "string"}
    names = small_relation(df.sparkSession, schema, [(i, j, df.columns[i], df.columns[j]) for i, j in pairs])
    if not pairs:
        return names.withColumn("r", F.lit(None).cast("double"))
    found = _few_columns(df, pairs) if len(ordinals) <= limits.pairwise_columns else _many_columns(df, ordinals)
    return names.join(
        F.broadcast(found.withColumnsRenamed({"a": "ordinal_a", "b": "ordinal_b"})), ["ordinal_a", "ordinal_b"], "left"
    )


def high_correlations(
    df: DataFrame, columns: list[str] | None = None, rules: Thresholds = DEFAULTS, limits: Limits = LIMITS
) -> DataFrame:
    """Pairs with |r| at or above the threshold, strongest first."""
    return strongest(correlations(df, columns, limits), rules)


def strongest(pairs: DataFrame, rules: Thresholds = DEFAULTS) -> DataFrame:
    return pairs.where(F.abs("r") >= rules.high_correlation).orderBy(F.desc(F.abs("r")), "ordinal_a", "ordinal_b")
