import pytest

from assayer.operators import quality
from assayer.operators.correlation import correlations
from assayer.operators.numeric import iqr_outliers


def facts_of(df):
    return {r["column"]: r for r in quality.column_facts(df).collect()}


def table(spark, n, **columns):
    names = list(columns)
    return spark.createDataFrame([tuple(columns[c](i) for c in names) for i in range(n)], names)


def test_three_equal_columns(spark, rows):
    df = spark.createDataFrame([(1, 1, 1, 2), (None, None, None, 3)], "a int, b int, c int, d int")
    found = rows(quality.duplicate_columns(df), "column", "other_column")
    assert found == [("a", "b"), ("a", "c"), ("b", "c")]


def test_same_values_in_another_order_are_no_copy(spark):
    df = spark.createDataFrame([(1, 2), (2, 1)], "a int, b int")
    assert quality.duplicate_columns(df).count() == 0


def test_types_decide_about_copies(spark, rows):
    whole = spark.createDataFrame([(1, 1.0), (2, 2.0)], "a long, b double")
    assert quality.duplicate_columns(whole).count() == 0
    # with a gap both are float64
    gap = spark.createDataFrame([(1, 1.0), (None, None)], "a long, b double")
    assert rows(quality.duplicate_columns(gap), "column", "other_column") == [("a", "b")]


def test_empty_columns_and_nested_columns(spark, rows):
    df = spark.sql("SELECT CAST(NULL AS INT) a, CAST(NULL AS INT) b, array(1) c, array(1) d, map(1, 2) e, map(1, 2) f")
    assert rows(quality.duplicate_columns(df), "column", "other_column") == [("a", "b"), ("c", "d"), ("e", "f")]


def test_missing_threshold_is_strict(spark):
    df = table(spark, 100, at=lambda i: None if i < 70 else i, over=lambda i: None if i < 71 else i)
    found = facts_of(df)
    assert not found["at"]["is_high_missing"] and found["over"]["is_high_missing"]


def test_identifiers(spark):
    df = table(
        spark,
        100,
        number=lambda i: i,
        text=lambda i: f"t{i}",
        measure=lambda i: i + 0.5,
        gapped=lambda i: None if i == 3 else i,
        width=lambda i: (i // 10 * 10 + min(i % 10, 5)) + 0.5,
        half_id=lambda i: i // 2,
    )
    found = {c for c, r in facts_of(df).items() if r["is_identifier"]}
    assert found == {"number", "text", "width"}


def test_high_cardinality(spark):
    df = table(spark, 100, at=lambda i: f"v{i // 2}", below=lambda i: f"v{i // 2 if i < 98 else 0}", number=lambda i: i)
    assert {c for c, r in facts_of(df).items() if r["is_high_cardinality"]} == {"at"}


def test_empty_table(spark):
    found = facts_of(spark.createDataFrame([], "id int, b string"))
    for r in found.values():
        assert r["is_constant"] and r["is_empty"] and not r["is_identifier"] and not r["is_high_missing"]


def test_roles(spark):
    df = table(
        spark, 10, final_score=lambda i: i % 3, status=lambda i: "ab"[i % 2], scores=lambda i: i % 4, y=lambda i: 1.0, id=lambda i: i
    )
    buckets = {}
    for r in quality.column_roles(quality.column_facts(df)).collect():
        buckets.setdefault(r["bucket"], set()).add(r["column"])
    assert buckets == {"targets": {"final_score", "status", "y"}, "features": {"scores"}, "identifiers": {"id"}, "drop": {"y"}}
    lists = {r["bucket"]: r["columns"] for r in quality.role_lists(quality.column_facts(df)).collect()}
    assert lists["targets"] == ["final_score", "status", "y"]


@pytest.fixture(scope="module")
def observed(spark):
    df = table(
        spark,
        60,
        id=lambda i: i,
        a=lambda i: None if i < 50 else i * 1.0,
        b=lambda i: None if i < 50 else "x",
        c=lambda i: i * 2.0 if i else 5000.0,
        d=lambda i: None if i % 5 == 0 else i // 20,
    )
    copies = quality.duplicate_columns(df)
    facts = quality.column_facts(df, duplicates=copies)
    return facts, quality.observations(facts, copies, correlations(df), iqr_outliers(df)).collect()


def test_observations_in_order(observed):
    found = observed[1]
    assert [r["seq"] for r in found] == list(range(1, len(found) + 1))
    rules = [r["rule"] for r in found]
    assert rules == [
        "most_missing", "high_missing", "high_correlation", "most_outliers", "constant", "identifiers", "features",
    ]
    # a and b miss the same share: the first column is named
    assert found[0]["columns"] == ["a"]
    assert found[3]["columns"] == ["c"] and found[3]["value"] == 1.0


def test_nothing_to_observe(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    copies = quality.duplicate_columns(df)
    found = quality.observations(quality.column_facts(df), copies, correlations(df), iqr_outliers(df)).collect()
    assert [r["rule"] for r in found] == ["no_missing", "features"]


def test_advice(observed, rows):
    found = rows(quality.recommendations(observed[0]), "section", "action", "column")
    assert ("cleaning", "drop_high_missing", "a") in found
    assert ("cleaning", "drop_constant", "b") in found
    assert ("cleaning", "impute_median", "d") in found
    assert ("encoding", "none", None) in found
    assert ("scaling", "scale", "d") in found and ("scaling", "scale", "c") in found
    assert ("ignore", "ignore", "id") in found
