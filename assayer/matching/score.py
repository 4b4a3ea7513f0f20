"""A match score from several components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.functions.ranking import shares_up_to
from assayer.session import pinned

# What each component counts in the score; they add up to one.
WEIGHTS = {"weighted_coverage": 0.4, "coverage_right": 0.2, "coverage_left": 0.1, "cosine": 0.3}


def match_scores(pairs: DataFrame, k: int = 10, weights: dict[str, float] | None = None, of: str = "left_id", other: str = "right_id") -> DataFrame:
    """The ``k`` best pairs for each ``of``: all columns of ``pairs``, a ``score`` from 0 to 1, and ``rank``.

    Components of different scale count by their place: each is replaced by the share of all pairs that have no larger value,
    and the score is their weighted mean, to nine digits. A null component counts 0. Equal scores go to smaller ``other``.

    The shares come from counts per different value and a range sort of these. The k best are kept inside every task before
    pairs are shuffled, so an ``of`` with a third of all pairs is k rows a task.
    """
    weights = WEIGHTS if weights is None else weights
    pairs = pinned(pairs)
    found, total = pairs, None
    for i, (name, weight) in enumerate(weights.items()):
        shares = shares_up_to(pairs, name, f"share_{i}")
        found = found.join(shares.withColumnRenamed(name, f"value_{i}"), F.col(name) == F.col(f"value_{i}"), "left")
        part = F.lit(weight) * F.coalesce(f"share_{i}", F.lit(0.0))
        total = part if total is None else total + part
    score = F.round(total / sum(weights.values()), 9).alias("score")
    order = Window.partitionBy(of).orderBy(F.desc("score"), other)
    ranked = found.select(*pairs.columns, score).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k)
