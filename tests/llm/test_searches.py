"""Exact top-k search and hard-negative mining against brute force, on odd rows too."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayer.llm import hard_negatives, top_k_search
from assayer.llm.hard_negatives import Bucket

SCHEMA = "vec_id bigint, embedding array<float>, label int, node string, score string, size int"


def usable(rows, scale):
    """Places, ids, labels and integer vectors of the rows that take part."""
    found = []
    for place, (vec_id, vector, label) in enumerate(rows):
        if vec_id is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            exact = [math.floor(scale * float(np.float32(x))) for x in vector]
            found.append((place, vec_id, label, [max(-(2**24), min(2**24, x)) for x in exact]))
    return found


def product(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


def vectors(draw, groups, copies, size=12):
    rows = []
    for _ in range(groups):
        centre = draw.standard_normal(size)
        rows += [(centre + 0.2 * draw.standard_normal(size)).tolist() for _ in range(copies)]
    return rows


def odd_rows(first):
    vector = [0.5] * 12
    odd = [None, [], [], [0.0] * 12, [math.nan] * 12, [math.inf] + vector[1:], [None] + vector[1:], [1e30] + vector[1:], vector, vector]
    odd += [[0.5] * 5, [0.25] * 5, [-0.5] * 5]
    return [(first + 20 * (i // 2), v, i % 3) for i, v in enumerate(odd)] + [(None, vector, 1), (first + 7, vector, None)]


def expected_top(rows, k, scale):
    taking = usable(rows, scale)
    found = []
    for place, query, _, q in taking:
        if query % 20 == 0:
            others = sorted((-product(q, v), i) for p, i, _, v in taking if p != place and len(v) == len(q))
            found += [(query, rank, i, -s) for rank, (s, i) in enumerate(others[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize("shape", ["copies and odd rows", "few", "no queries"])
def test_top_k(spark, shape, monkeypatch):
    monkeypatch.setattr(top_k_search, "BLOCK", 32)
    monkeypatch.setattr(top_k_search, "QUERIES", 8)
    draw = np.random.default_rng(5)
    rows = [(i, v, 0) for i, v in enumerate(vectors(draw, 12, 30))]
    if shape == "copies and odd rows":  # a third of all rows is one vector, queries among them, and one id is there twice
        rows = [(i, rows[3][1] if i % 3 == 0 else v, 0) for i, v, _ in rows] + [(40, rows[3][1], 0), (40, rows[3][1], 0), (60, rows[1][1], 1)]
        rows += odd_rows(1000) + odd_rows(1000)
    if shape == "few":
        rows = rows[:7]
    if shape == "no queries":
        rows = [(20 * i + 1, v, 0) for i, v, _ in rows]
    df = spark.createDataFrame([(*r, "n", "s", 1) for r in rows], SCHEMA)
    found = top_k_search.top_k(df, F.col("vec_id") % 20 == 0, k=6)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == expected_top(rows, 6, 64)


def test_top_k_of_large_components(spark):
    """Scores beyond the exact range of doubles, in whole numbers."""
    rows = [(i, [200_000.0 - i, 150_000.25 + (i % 3), -3.0], 0) for i in range(0, 60, 5)]
    df = spark.createDataFrame([(*r, "n", "s", 1) for r in rows], SCHEMA)
    found = top_k_search.top_k(df, F.col("vec_id") % 20 == 0, k=4)
    assert sorted(map(tuple, found.collect())) == expected_top(rows, 4, 64)


def relabelled(vec_id, label):
    if label is None:
        return None
    return (label + 1) % 10 if vec_id % 7 == 0 else label


def expected_mined(rows, positives, negatives, scale):
    taking = [(p, i, relabelled(i, c), v) for p, i, c, v in usable(rows, scale) if c is not None]
    found = []
    for place, anchor, label, q in taking:
        if anchor % 100:
            continue
        others = sorted((-product(q, v), i, c == label) for p, i, c, v in taking if p != place and len(v) == len(q))
        for p, positive, _ in [o for o in others if o[2]][:positives]:
            hard = [(s, i) for s, i, same in others if not same and 30 * -p <= 100 * -s <= 90 * -p]
            found += [(anchor, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(hard[:negatives], 1)]
    return sorted(found)


LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


@pytest.mark.parametrize("shape", ["copies and odd rows", "lengths", "empty"])
def test_hard_negatives(spark, shape, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET", 40)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 4)
    monkeypatch.setattr(hard_negatives, "STRIP", 2)
    draw = np.random.default_rng(6)
    rows = [(5 * i, v, i % 4) for i, v in enumerate(vectors(draw, 6, 60))]
    if shape == "copies and odd rows":  # a third of all rows is one vector and label
        rows = [(i, rows[3][1], 2) if k % 3 == 0 else (i, v, c) for k, (i, v, c) in enumerate(rows)] + [(100, rows[2][1], 2)] * 2
        rows += odd_rows(1000) + odd_rows(1100)
    if shape == "lengths":
        rows = [(i, [x * 1.3 ** (k % 9) for x in v], c) for k, (i, v, c) in enumerate(rows)]
    if shape == "empty":
        rows = []
    df = spark.createDataFrame([(*r, "n", "s", 1) for r in rows], SCHEMA)
    found = hard_negatives.mined(df, F.col("vec_id") % 100 == 0, 3, 4, label=F.expr(LABEL))
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert found.columns == columns
    assert sorted(map(tuple, found.collect())) == expected_mined(rows, 3, 4, 256)


def test_ranges_lose_no_row_and_rule_rows_out():
    draw = np.random.default_rng(8)
    checked = kept = 0
    for size in (1, 2, 3, 8, 64):
        values = np.floor(100 * draw.standard_normal((300, size))).astype("<i4")
        values[:20] = 0
        values[20:40] *= 5
        unit, _ = hard_negatives._units(values)
        order = np.argsort(unit, axis=0).T.astype("<u2")
        row = {"node": np.arange(300, dtype="<i8").tobytes(), "ids": np.arange(300, dtype="<i8").tobytes()}
        bucket = Bucket(row | {"matrix": values.tobytes(), "sorted": np.ascontiguousarray(order).tobytes()})
        for q in [*values[:60:3], *(values[100:110] * 7)]:
            (direction,), (length,) = hard_negatives._units(q[None, :])
            scores = values.astype(np.int64) @ q.astype(np.int64)
            for least in {1, int(scores.max()), int(scores.max()) + 1, int(np.sort(scores)[-5]), int(0.9 * scores.max())}:
                some = bucket.candidates(direction, length, least)
                if some is not None and least > 0:
                    assert set(np.flatnonzero(scores >= least)) <= set(some.tolist())
                    checked, kept = checked + 300, kept + len(some)
    assert kept < 0.5 * checked
