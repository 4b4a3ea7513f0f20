from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from assayer.config import DEFAULTS
from assayer.functions.columns import normalize_name
from assayer.operators import keys, relations
from assayer.operators.frequency import column_stats
from assayer.plans import relationships as plan
from assayer.session import pinned


@pytest.mark.parametrize(
    "name, want",
    [("job_id", "job"), ("id", "id"), ("Company-ID", "company"), ("paid", "pa"), ("_id", "id"), ("  Zip  Code ", "zip_code"), ("***", "***")],
)
def test_normalized_names(name, want):
    assert normalize_name(name) == want


def test_single_keys(spark, rows):
    df = spark.createDataFrame([(1, "a", 1.0, None), (2, "a", 2.0, 1), (3, "b", None, 2)], "k int, s string, f double, g int")
    assert rows(keys.single_keys(column_stats(df)), "column") == [("k",)]
    assert rows(keys.all_single_keys({"t": df, "u": df.limit(0)}), "dataset", "column") == [("t", "k")]


def test_single_key_of_one_row(spark):
    assert keys.single_keys(column_stats(spark.createDataFrame([(1,)], "v int"))).count() == 1


def test_keys_that_a_scan_rules_out(spark):
    df = spark.createDataFrame([(1, 1, "x", True), (2, 1, "x", True), (3, 2, "x", False)], "a int, b int, c string, d boolean")
    assert keys.possible_keys({"t": df}) == {"t": ["a", "c"]}


def test_composite_key(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 2)], "x string, y int")
    assert rows(keys.composite_keys(df, column_stats(df))) == [("x", "y")]
    assert [tuple(r) for r in keys.table_keys(df).collect()] == [(["x", "y"], "composite")]


def test_no_composite_key_with_a_gap_or_a_single_key(spark):
    gap = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), ("b", 2)], "x string, y int")
    assert keys.composite_keys(gap, column_stats(gap)).count() == 0
    single = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 2, 2)], "k int, x int, y int")
    assert keys.composite_keys(single, column_stats(single)).count() == 0


def test_at_most_six_candidates_and_a_bonus_for_names(spark):
    names = ["a", "b", "c", "d", "e", "f", "bid"]
    df = spark.createDataFrame([tuple(i // 2 + j for j in range(7)) for i in range(8)], names)
    ranked = keys.key_candidates(column_stats(df)).orderBy("rank").collect()
    assert [r["column"] for r in ranked] == ["bid", "a", "b", "c", "d", "e"]


def test_containment_labels(spark):
    parent = spark.range(90).toDF("v")
    for size, label in ((100, "Strong"), (150, "Moderate"), (151, "Weak")):
        got = relations.containment(spark.range(size).toDF("w"), "w", parent, "v").first()
        assert (got["child_values"], got["shared_values"], got["compatibility"]) == (size, 90, label)


def test_integer_meets_double_and_text_does_not_meet_number(spark):
    whole, real = spark.createDataFrame([(1,), (2,)], "v long"), spark.createDataFrame([(1.0,), (2.5,)], "v double")
    assert relations.containment(whole, "v", real, "v").first()["containment"] == 0.5
    text = spark.createDataFrame([("1",), ("x",)], "v string")
    got = relations.containment(text, "v", whole, "v").first()
    assert got["containment"] == 0.0 and got["compatibility"] == "Incompatible"


def test_empty_sides(spark):
    some, none = spark.range(3).toDF("v"), spark.range(0).toDF("v")
    assert relations.containment(none, "v", some, "v").first()["containment"] == 0.0
    assert relations.containment(some, "v", none, "v").first()["containment"] == 0.0


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "companies": spark.createDataFrame([(i, f"n{i}") for i in range(10)], "company_id long, name string"),
        "industries": spark.createDataFrame([(i % 10, "x") for i in range(12)], "company_id long, industry string"),
        "postings": spark.createDataFrame([(i, float(i % 10) if i % 4 else None) for i in range(40)], "job_id long, company_id double"),
        "salaries": spark.createDataFrame([(i + 100, i + 8) for i in range(40)], "salary_id long, job_id long"),
        "catalog": spark.createDataFrame([(1, "a"), (2, "b")], "industry_id long, label string"),
    }


def test_foreign_keys(tables):
    found = [
        (r["child_dataset"], r["parent_dataset"], r["containment"], r["compatibility"])
        for r in relations.foreign_keys(tables).collect()
    ]
    assert found == [
        ("industries", "companies", 1.0, "Strong"),
        ("postings", "companies", 1.0, "Strong"),
        ("salaries", "postings", 0.8, "Moderate"),
        ("postings", "salaries", 0.8, "Moderate"),
        ("industries", "catalog", 0.0, "Incompatible"),
    ]


def test_guidance_and_summary(tables, rows):
    sections = plan.analyze(tables, {"broken": "PATH_NOT_FOUND"})
    pairs = rows(sections["merge_guidance"], "child_dataset", "parent_dataset")
    assert pairs == [("industries", "companies"), ("postings", "companies"), ("salaries", "postings")]
    assert rows(sections["standalone"]) == [("catalog",)]
    assert sections["summary"].first().asDict() == {
        "candidates": 5, "strong": 2, "moderate": 2, "weak": 0, "datasets": 5, "failed": 1,
    }
    mixed = {r["normalized_name"] for r in sections["matching_columns"].where("mixed_families").collect()}
    assert mixed == {"industry"}
    targets = {r["dataset"]: r["likely_targets"] for r in sections["contributions"].collect()}
    assert targets["catalog"] == ["label"] and targets["salaries"] == []
    overview = {r["dataset"]: (r["type_mix"], r["keys"]) for r in sections["overview"].collect()}
    assert overview["companies"] == ("numeric=1, text=1", ["company_id", "name"])
    assert overview["industries"][1] == []


def test_no_standalone_table_without_any_link(spark):
    tables = {"a": spark.range(3).toDF("x"), "b": spark.range(3).toDF("y")}
    links = relations.foreign_keys(tables)
    assert links.count() == 0 and relations.standalone_tables(tables, links).count() == 0


def test_more_columns_of_one_name_than_bits_in_a_word(spark, monkeypatch):
    monkeypatch.setattr(relations, "_MASK_BITS", 2)
    tables = {f"t{i}": spark.range(i % 4 + 1).toDF("id") for i in range(7)}
    found = relations.foreign_keys(tables).collect()
    assert len(found) == 7 * 6
    for r in found:
        child, parent = int(r["child_dataset"][1:]) % 4 + 1, int(r["parent_dataset"][1:]) % 4 + 1
        assert r["containment"] == min(child, parent) / child


def test_thresholds_are_parameters(spark):
    df = spark.createDataFrame([(i // 4, i % 4) for i in range(40)], "x int, y int")
    assert keys.composite_keys(df, column_stats(df)).count() == 0
    loose = replace(DEFAULTS, composite_ratio=0.0)
    assert keys.composite_keys(df, column_stats(df), loose).count() == 1


def test_foreign_keys_tell_their_parents_themselves(spark, rows):
    """The shuffle that compares values finds the keys that a count of each column finds."""
    tables = {
        "a": spark.createDataFrame([(1, "x", 1, 1.5, None), (2, "y", 1, 2.5, 1), (3, "z", 2, 2.5, 2)], "id int, t string, u int, f double, g int"),
        "b": spark.createDataFrame([(1, "x", 1, 1, 1), (2, "x", 2, 2, 2), (5, None, 3, 3, 3)], "id bigint, t string, u string, f int, g int"),
        "c": spark.createDataFrame([], "id int, t string, u int, f double, g int"),
        "d": spark.createDataFrame([(2**53,), (2**53 + 1,)], "f bigint"),
        "e": spark.createDataFrame([(float(i % 7), i) for i in range(70)], "f double, id int"),
    }
    columns = ["normalized_name", "child_dataset", "child_column", "parent_dataset", "parent_column", "containment", "compatibility"]
    found = relations.foreign_keys(tables)
    known = relations.foreign_keys(tables, keys=pinned(keys.all_single_keys(tables)))
    assert rows(found, *columns) == rows(known, *columns)
    assert [tuple(r) for r in found.select(*columns[:5]).collect()] == [tuple(r) for r in known.select(*columns[:5]).collect()]
    parents = {(r["parent_dataset"], r["parent_column"]) for r in found.collect()}
    assert parents == {("a", "id"), ("a", "t"), ("b", "id"), ("b", "u"), ("b", "f"), ("b", "g"), ("d", "f"), ("e", "id")}


def test_pairs_are_compared_by_hashes(spark, monkeypatch):
    rows = [(i // 10, i % 10, float(i % 10), f"n{i % 7}") for i in range(500)] + [(49, 9, -0.0, "n0"), (60, 1, 0.0, "x"), (60, 2, -0.0, "x")]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c double, d string")
    plans, melted = [], keys.melt
    monkeypatch.setattr(keys, "melt", lambda df, values: plans.append(melted(df, values)) or plans[-1])
    stats = keys.column_stats(df)
    found = {tuple(r) for r in keys.composite_keys(df, stats, replace(DEFAULTS, composite_ratio=0.0)).collect()}
    assert found == set()  # (49, 9) and (60, 0.0) occur twice
    assert [p.schema["value"].dataType.simpleString() for p in plans] == ["bigint"]
    whole = df.where("NOT (a = 49 AND c = 0)")
    stats = keys.column_stats(whole)
    found = {tuple(r) for r in keys.composite_keys(whole, stats, replace(DEFAULTS, composite_ratio=0.0)).collect()}
    assert found == {("a", "b")}
    # a hash that occurs again without a repeated pair is a collision
    assert not keys._repeated(whole, F.lit(1).cast("bigint"), F.col("a"), F.col("b"), 1)
    assert keys._repeated(whole, F.lit(1).cast("bigint"), F.col("a"), F.col("c"), 1)
