import math
import threading
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from assayer.config import Limits, Thresholds
from assayer.operators import correlation, frequency, numeric, quantiles
from assayer.plans import profiling
from assayer.session import together


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    n = 3000
    data = pd.DataFrame(
        {
            "heavy": np.where(rng.random(n) < 0.35, 7.0, rng.normal(0, 50, n)),
            "skewed": rng.lognormal(0, 3, n),
            "flat": np.full(n, 0.1),
            "few": rng.integers(0, 4, n).astype(float),
            "sparse": np.where(rng.random(n) < 0.9, np.nan, rng.random(n)),
            "empty": np.full(n, np.nan),
        }
    )
    data["linked"] = data["skewed"] * -2 + 1
    return data


@pytest.fixture(scope="module")
def df(spark, frame):
    return spark.createDataFrame(frame).repartition(5)


@pytest.mark.parametrize(
    "limits",
    [
        Limits(),
        Limits(exact_rank_rows=200, sketch_accuracy=50),
        Limits(exact_rank_rows=5, sketch_accuracy=20, sketched_columns=3),
        Limits(exact_rank_rows=2000, sketch_accuracy=10_000),
    ],
)
def test_quantiles_are_exact_on_every_path(df, frame, limits):
    probs = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)
    found = {r["ordinal"]: r["quantiles"] for r in quantiles.exact_quantiles(df, probs=probs, limits=limits).collect()}
    for i, c in enumerate(frame.columns):
        if c == "empty":
            assert i not in found
        else:
            assert found[i] == pytest.approx(frame[c].quantile(list(probs)).tolist(), rel=1e-12), c


def test_a_long_table_needs_no_sketch(df, frame, monkeypatch):
    """The bins of one pass bracket every quantile closely enough; a sketch is for bins with too many rows."""

    def refused(*_):
        raise AssertionError("sketched")

    monkeypatch.setattr(quantiles, "_propose", refused)
    names = ["skewed", "flat", "few"]
    found = quantiles.exact_quantiles(df, names, limits=Limits(exact_rank_rows=100)).orderBy("ordinal").collect()
    for c, r in zip(names, found, strict=True):
        assert r["quantiles"] == pytest.approx(frame[c].quantile([0.25, 0.5, 0.75]).tolist(), rel=1e-12), c


@pytest.mark.parametrize(
    "values",
    [
        [1e300, -1e300, 0.0, 5.0, -0.0, 1e-300],
        [1.7e9 + i * 1e-6 for i in range(50)],
        [-math.inf, 1.0, 2.0, 2.0, 3.0],
        [1.0, 2.0, 2.0, 3.0, math.inf, math.inf],
        [float(2**62), float(2**62) + 1024.0, -float(2**62)],
        [-1e9] + [i / 64 for i in range(64)],
    ],
)
def test_quantiles_of_odd_ranges(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = tuple(k / (len(values) - 1) for k in range(len(values)))
    found = quantiles.exact_quantiles(df, probs=probs, limits=Limits(exact_rank_rows=2)).first()["quantiles"]
    assert found == sorted(values)


def test_quartiles_interpolate(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "v int")
    assert quantiles.exact_quantiles(df).first()["quantiles"] == [1.75, 2.5, 3.25]


def test_sketch_quantiles_are_an_option(df):
    assert quantiles.approximate_quantiles(df, ["few"]).count() == 1


def test_numeric_profile(df, frame):
    found = {r["column"]: r for r in numeric.numeric_profile(df).collect()}
    want = frame.describe()
    for c in frame.columns:
        assert found[c]["n"] == want[c]["count"]
        for name, row in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q1", "25%"), ("median", "50%"), ("q3", "75%"), ("max", "max")):
            value, wanted = found[c][name], want[c][row]
            assert (value is None and math.isnan(wanted)) or value == pytest.approx(wanted, rel=1e-9, abs=1e-12)


def test_one_row_has_no_deviation(spark):
    row = numeric.numeric_profile(spark.createDataFrame([(5,)], "v int")).first()
    assert row["std"] is None and row["median"] == 5.0


def test_table_without_numbers_or_rows(spark):
    assert numeric.numeric_profile(spark.createDataFrame([("a",)], "v string")).count() == 0
    assert numeric.iqr_outliers(spark.createDataFrame([("a",)], "v string")).count() == 0
    empty = spark.createDataFrame([], "v double")
    assert numeric.numeric_profile(empty).first()["n"] == 0
    assert tuple(numeric.iqr_outliers(empty).select("n", "outliers", "outlier_pct").first()) == (0, 0, 0.0)


def test_outliers(spark):
    flat = spark.createDataFrame([(float(v),) for v in (5, 5, 5, 5, 99)], "v double")
    assert numeric.iqr_outliers(flat).first()["outliers"] == 0
    # quartiles 2 and 4: the fence is -1 to 7, and 7 itself is inside
    edge = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 7)], "v double")
    assert numeric.iqr_outliers(edge).first()["outliers"] == 0
    beyond = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 7.5)], "v double")
    assert numeric.iqr_outliers(beyond).first()["outlier_pct"] == 20.0


@pytest.mark.parametrize("limits", [Limits(pairwise_columns=20), Limits(pairwise_columns=1)])
def test_correlation_on_both_paths(df, frame, limits):
    want = frame.corr()
    found = correlation.correlations(df, limits=limits).collect()
    assert len(found) == 21
    for r in found:
        wanted = want.loc[r["col_a"], r["col_b"]]
        if "flat" in (r["col_a"], r["col_b"]) or math.isnan(wanted):
            assert r["r"] is None
        else:
            assert r["r"] == pytest.approx(wanted, abs=1e-9)
    assert [(r["col_a"], r["col_b"]) for r in correlation.high_correlations(df, limits=limits).collect()] == [("skewed", "linked")]


def test_correlation_far_from_zero_is_stable(spark):
    rng = np.random.default_rng(5)
    base = rng.random(2000)
    data = pd.DataFrame({"a": 1e12 + base, "b": 1e12 + base + rng.random(2000), "c": rng.random(2000)})
    found = correlation.correlations(spark.createDataFrame(data).repartition(7), limits=Limits(pairwise_columns=1)).collect()
    want = (data - data.iloc[0]).corr()
    for r in found:
        assert r["r"] == pytest.approx(want.loc[r["col_a"], r["col_b"]], abs=1e-3)


def test_threshold_itself_is_reported(spark):
    pairs = spark.createDataFrame([(0, 1, "a", "b", 0.8), (0, 2, "a", "c", -0.79)], "ordinal_a int, ordinal_b int, col_a string, col_b string, r double")
    assert correlation.strongest(pairs).count() == 1


def test_statistics_of_all_types(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (1, true, date'2024-01-01', timestamp_ntz'2024-01-01 00:00:00', 1.10, array(1, null), map('a', 1), named_struct('x', 1, 'y', null), X'00', 0D),
        (1, false, date'2024-01-01', timestamp_ntz'2024-01-01 00:00:01', 1.10, array(1, null), map('a', 1), named_struct('x', null, 'y', 1), X'01', -0D),
        (null, null, null, null, null, null, null, null, null, double('NaN'))
        AS t(i, b, d, t, n, a, m, s, x, f)"""
    )
    found = {r["column"]: (r["missing"], r["n_unique"]) for r in frequency.column_stats(df).collect()}
    assert found == {
        "i": (1, 1), "b": (1, 2), "d": (1, 1), "t": (1, 2), "n": (1, 1), "a": (1, 1), "m": (1, 1), "s": (1, 2), "x": (1, 2), "f": (1, 1),
    }
    total = frequency.duplicate_rows(df.union(df)).first()
    assert tuple(total) == (6, 3, 3)


def test_whole_numbers_are_counted_by_words(spark):
    ends = [-(2**63), -(2**63) + 1, -65, -64, -63, -1, 0, 1, 63, 64, 65, 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in ends * 3 + [None] * 2], "v bigint").repartition(4)
    found = frequency.column_stats(df).first()
    assert (found["rows"], found["missing"], found["n_unique"]) == (38, 2, len(ends))
    nothing = frequency.column_stats(spark.createDataFrame([(None,)], "v int")).first()
    assert (nothing["rows"], nothing["missing"], nothing["n_unique"]) == (1, 1, 0)
    dense = spark.range(6400)
    shuffled = frequency._key_counts([(dense, {0: dense.schema["id"]})])
    assert shuffled.first()["n_unique"] == 6400
    assert "bit_or" in shuffled._jdf.queryExecution().executedPlan().toString()


def test_statistics_of_an_empty_table(spark):
    found = frequency.column_stats(spark.createDataFrame([], "a int, b string")).collect()
    assert [(r["rows"], r["missing_pct"], r["n_unique"]) for r in found] == [(0, 0.0, 0)] * 2
    assert [tuple(r)[2:] for r in frequency.missing_counts(spark.createDataFrame([], "a int")).collect()] == [(0, 0, 0.0)]


def test_frequencies_and_missing_make_up_the_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b" * 200,)], "v string")
    stats = frequency.column_stats(df).first()
    total = frequency.value_counts(df).groupBy().sum("n").first()[0]
    assert total + stats["missing"] == stats["rows"] == 4


def test_top_values_with_long_texts_and_ties(spark):
    head = "same beginning " * 10
    values = [head + "c"] * 3 + [head + "a"] * 3 + [head + "b"] * 3 + ["short"] * 4 + [None] * 9 + ["z", "y"]
    df = spark.createDataFrame([(v, True) for v in values], "v string, b boolean")
    counts = Counter(v for v in values if v is not None)
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))
    for limit in (1, 2, 3, 10):
        for limits in (Limits(), Limits(broadcast_bytes=0)):
            found = frequency.top_values(df, limit, ["v"], limits).orderBy("rank").collect()
            assert [(r["value"], r["n"]) for r in found] == want[:limit]
    assert [tuple(r) for r in frequency.top_values(df, 2, ["b"]).select("value", "n").collect()] == [("true", len(values))]


def test_top_values_of_nothing(spark):
    assert frequency.top_values(spark.createDataFrame([(None,)], "v string"), 5).count() == 0
    assert frequency.top_values(spark.range(3), 5).count() == 0


def test_ranking_is_cut_before_the_shuffle(spark):
    """Long values with one beginning, all as frequent: every task passes on at most ``limit`` of them."""
    head = "https://example.org/a/rather/long/path/that/all/of/the/values/have/in/common/"
    df = spark.range(4000).selectExpr(f"concat('{head}', lpad(id, 6, '0')) AS v").repartition(6)
    found = frequency.top_values(df, 3)
    assert [r["value"][-6:] for r in found.orderBy("rank").collect()] == ["000000", "000001", "000002"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_column_profile_rounds_half_to_even(spark):
    df = spark.createDataFrame([(i, "a" if i else None) for i in range(800)], "i int, s string")
    found = {r["column"]: r for r in profiling.column_profile(df).collect()}
    assert found["s"]["missing_pct"] == 0.12
    assert found["s"]["top_values"][0]["n"] == 799
    assert found["i"]["median"] == 399.5 and found["i"]["top_values"] is None


def test_explore_all(spark):
    tables = {
        "numbers": spark.createDataFrame([(1, 2.0), (2, 4.0), (3, 6.5)], "id int, y double"),
        "words": spark.createDataFrame([("a",), ("b",)], "w string"),
        "nothing": spark.createDataFrame([], "q int, r string"),
    }
    sections, failures = profiling.explore_all(tables, Thresholds())
    assert failures == {}
    assert {r["dataset"]: r["rows"] for r in sections["overview"].collect()} == {"numbers": 3, "words": 2, "nothing": 0}
    assert {r["dataset"] for r in sections["observations"].collect()} == set(tables)
    assert {r["column"] for r in sections["quality"].where("dataset = 'nothing' and check = 'empty'").collect()} == {"q", "r"}


def test_steps_run_together(spark):
    met = threading.Barrier(2, timeout=30)
    spark.sparkContext.setLocalProperty("assayer.test", "given")

    def step(name):
        met.wait()
        return name, spark.sparkContext.getLocalProperty("assayer.test")

    assert together(spark, lambda: step("a"), lambda: step("b")) == [("a", "given"), ("b", "given")]
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: 1 / 0, lambda: 1)
    assert together(spark) == []
