"""Models trained by aggregation: multinomial naive Bayes for categories, ridge regression for amounts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.functions.relations import small_relation
from assayer.matching.text_vectors import term_rows
from assayer.session import pinned

MAX_COLUMNS = 2_000  # of a regression; its Gram matrix reaches the driver
TOLERANCE = 1e-9
COMMON_WEIGHTS = 200_000  # of the most frequent terms, one a class, that every task gets


def classified(counts: DataFrame, texts: DataFrame, label: str, learned: Column, smoothing: float = 1.0) -> DataFrame:
    """(id, learned, label, predicted, score, margin) by multinomial naive Bayes.

    ``counts`` are those of ``text_vectors.term_counts``, ``texts`` (id, ``label``) with one row per text; ``learned`` is a
    condition on ``id`` that chooses the texts to learn from, of which those with a label count. With V different terms in training, a class of n_c
    texts and t_c words gives ln(n_c / n) + sum of tf ln((t_cw + s) / (t_c + s (V + 1))); a term never seen is the one beyond V.
    ``score`` is that of the predicted class, ``margin`` what it has above the next one (null with one class only). Equal scores
    go to the first label. Without any text to learn from, predictions are null.

    A term takes part in the classes that have it; what all others give depends on the number of words alone, so the rows that
    are joined grow with the terms, not with terms times classes.
    """
    texts = pinned(texts.select("id", F.col(label).alias("label"), F.coalesce(learned, F.lit(False)).alias("learned")))
    given = texts.where("learned AND label IS NOT NULL").select("id", "label")
    rows = term_rows(counts)
    counted = term_rows(counts.join(given, "id"), "label").groupBy("label", "term").agg(F.sum("tf").alias("n"))
    counted = pinned(counted)
    vocabulary = counted.select("term").distinct().count()
    classes = given.groupBy("label").agg(F.count(F.lit(1)).alias("texts"))
    classes = classes.join(counted.groupBy("label").agg(F.sum("n").alias("words")), "label", "left")
    whole = F.sum("texts").over(Window.partitionBy(F.lit(0)))  # one row a class
    base = F.coalesce("words", F.lit(0)) + F.lit(smoothing * (vocabulary + 1))
    classes = classes.select("label", F.log(F.col("texts") / whole).alias("prior"), base.alias("base"), F.log(F.lit(smoothing) / base).alias("unseen"))
    classes = pinned(classes)
    weights = counted.join(classes, "label").select(
        "term", "label", (F.log((F.col("n") + smoothing) / F.col("base")) - F.col("unseen")).alias("gain")
    )
    totals = counts.select("id", F.aggregate("tfs", F.lit(0).cast("bigint"), lambda total, n: total + n).alias("words"))
    # the most frequent terms are looked up where their texts are, the others by a join
    frequent = counted.groupBy("term").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "term")
    frequent = F.broadcast(pinned(frequent.limit(max(1, COMMON_WEIGHTS // max(1, classes.count()))).select("term")))
    common = rows.join(F.broadcast(pinned(weights.join(frequent, "term"))), "term")
    rare = rows.join(frequent, "term", "left_anti").join(weights.join(frequent, "term", "left_anti"), "term")
    gains = common.select("id", "label", (F.col("tf") * F.col("gain")).alias("gain")).groupBy("id", "label").agg(F.sum("gain").alias("gain"))
    seen = gains.union(rare.select("id", "label", F.col("tf") * F.col("gain"))).groupBy("id", "label").agg(F.sum("gain").alias("gain"))
    scores = texts.select("id").join(totals, "id", "left").join(F.broadcast(_bounded(classes)))
    scores = scores.join(seen, ["id", "label"], "left")
    score = F.col("prior") + F.coalesce("words", F.lit(0)) * F.col("unseen") + F.coalesce("gain", F.lit(0.0))
    order = Window.partitionBy("id").orderBy(F.desc("score"), "label")
    ranked = scores.select("id", "label", score.alias("score")).withColumn("next", F.lead("score").over(order))
    best = ranked.withColumn("place", F.row_number().over(order)).where("place = 1")
    best = best.select("id", F.col("label").alias("predicted"), "score", (F.col("score") - F.col("next")).alias("margin"))
    return texts.join(best, "id", "left").select("id", "learned", "label", "predicted", "score", "margin")


def _bounded(classes: DataFrame, limit: int = 10_000) -> DataFrame:
    if classes.count() > limit:
        raise ValueError(f"more than {limit} classes")
    return classes


@dataclass(frozen=True)
class Regression:
    """``coefficients`` holds (ordinal, term, coefficient, status) with status ``fitted``, ``baseline`` or ``collinear``;
    ``diagnostics`` one row (n, left_out, r2, rmse)."""

    coefficients: DataFrame
    diagnostics: DataFrame


def _partial(batches: Iterator[pa.RecordBatch], numeric: int, levels: list[list], centres: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The Gram matrix of one task: intercept, numbers, one column a level, and the target last."""
    width = 2 + numeric + sum(len(x) for x in levels)
    total = np.zeros((width, width))
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [np.ones(n)]
        columns += [batch.column(i).to_numpy(zero_copy_only=False) - centres[i] for i in range(numeric)]
        for k, known in enumerate(levels):
            codes = batch.column(numeric + 1 + k).to_pylist()
            columns += [np.fromiter((c == level for c in codes), dtype=float, count=n) for level in known]
        columns.append(batch.column(numeric).to_numpy(zero_copy_only=False) - centres[numeric])
        rows = np.stack(columns)
        total += rows @ rows.T
    at = np.arange(width * width)
    yield pa.RecordBatch.from_pydict({"at": pa.array(at), "value": pa.array(total.ravel())})


def regression(df: DataFrame, target: str, numeric: list[str], categorical: list[str], ridge: float = 0.0) -> Regression:
    """Least squares of ``target`` on numbers and categories, with a penalty of ``ridge`` times the squares (not the intercept's).

    The first level of each category, in order, is its baseline; a null level is a level of its own, named ``null``, and comes
    last. Rows with a null, NaN or infinite number or target are left out and counted. A column that is a combination of those
    before it gets no coefficient and the status ``collinear``, unless a penalty settles it. Without usable rows all
    coefficients are null. Names are read as ``category=level``.

    Two scans: one for means, row counts and levels, one for the Gram matrix around those means. Each task returns one matrix; the
    sums have p x p numbers for p columns, of which ``MAX_COLUMNS`` are allowed, whatever the rows.
    """
    spark = df.sparkSession
    plain = df.select(
        *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(numeric)],
        F.col(f"`{target}`").cast("double").alias("y"),
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0null")).alias(f"c{i}") for i, c in enumerate(categorical)],
    )
    numbers = [*[f"x{i}" for i in range(len(numeric))], "y"]
    fine = F.lit(True)
    for name in numbers:
        fine &= F.col(name).isNotNull() & ~F.isnan(name) & (F.abs(name) < float("inf"))
    usable = plain.where(F.coalesce(fine, F.lit(False)))
    means = usable.agg(F.count(F.lit(1)).alias("n"), *[F.mean(c).alias(c) for c in numbers]).first()
    left_out = plain.count() - means["n"]
    levels = []
    for i in range(len(categorical)):
        some = [r[0] for r in usable.select(f"c{i}").distinct().limit(MAX_COLUMNS + 1).collect()]
        levels.append(sorted(some, key=lambda x: (x == "\0null", x)))
    width = 1 + len(numeric) + sum(len(x) for x in levels)
    if width > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} columns of numbers and levels")
    centres = np.array([means[c] or 0.0 for c in numbers])
    parts = usable.mapInArrow(lambda b: _partial(b, len(numeric), levels, centres), "at bigint, value double")
    gram = np.zeros((width + 1) ** 2)
    for row in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():
        gram[row["at"]] = row["value"]
    gram = gram.reshape(width + 1, width + 1)
    names = ["intercept", *numeric]
    baselines = set()
    for c, known in zip(categorical, levels, strict=True):
        if known:
            baselines.add(len(names))
        names += [f"{c}={'null' if level == chr(0) + 'null' else level}" for level in known]
    chosen = _independent(gram, [i for i in range(width) if i not in baselines], ridge) if means["n"] else []
    penalty = np.diag([0.0 if i == 0 else ridge for i in chosen])
    inner = gram[np.ix_(chosen, chosen)] + penalty
    found = np.linalg.solve(inner, gram[chosen, -1]) if chosen else np.zeros(0)
    residual = max(0.0, float(gram[-1, -1] - 2 * found @ gram[chosen, -1] + found @ gram[np.ix_(chosen, chosen)] @ found))
    values = dict(zip(chosen, found.tolist(), strict=True))
    if 0 in values:  # back from the means
        values[0] += centres[-1] - sum(values.get(1 + i, 0.0) * centres[i] for i in range(len(numeric)))
    rows = []
    for i, name in enumerate(names):
        status = "baseline" if i in baselines else "fitted" if i in values else "collinear"
        rows.append((i, name, values.get(i), status))
    spread = float(gram[-1, -1] - gram[0, -1] ** 2 / max(1, means["n"]))
    fit = (means["n"], left_out, 1 - residual / spread if spread > 0 else None, (residual / means["n"]) ** 0.5 if means["n"] else None)
    coefficients = small_relation(spark, {"ordinal": "int", "term": "string", "coefficient": "double", "status": "string"}, rows)
    return Regression(coefficients, small_relation(spark, {"n": "bigint", "left_out": "bigint", "r2": "double", "rmse": "double"}, [fit]))


def _independent(gram: np.ndarray, columns: list[int], ridge: float) -> list[int]:
    """The columns that are no combination of those before them, by what elimination leaves on the diagonal."""
    if ridge > 0:
        return columns
    chosen: list[int] = []
    for i in columns:
        whole = gram[i, i]
        rest = whole
        if chosen:
            part = gram[chosen, i]
            rest = whole - part @ np.linalg.solve(gram[np.ix_(chosen, chosen)], part)
        if whole > 0 and rest > TOLERANCE * whole:
            chosen.append(i)
    return chosen
