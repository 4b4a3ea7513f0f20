import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from assayer.config import Limits
from assayer.operators import joins
from assayer.plans import master
from assayer.plans.master import JoinSpec, build_master
from assayer.plans.star import with_fallback

SHUFFLED = Limits(broadcast_bytes=-1, hot_key_share=0.1, salts=3)
SALTED = Limits(broadcast_bytes=-1)
KEYS = st.lists(st.sampled_from([1, 2, 3, None]), min_size=1, max_size=15)


@pytest.fixture
def left(spark):
    return spark.createDataFrame([(1, "a", 9), (2, "b", 9), (None, "c", 9), (4, "d", 9)], "k int, zip string, m int")


@pytest.fixture
def right(spark):
    return spark.createDataFrame([(1, "x", 5), (1, "y", 6), (None, "n", 7), (3, "z", 8)], "k int, zip string, w int")


def test_collisions_get_the_suffix(left, right):
    assert joins.left_join(left, right, "k", "_company").columns == ["k", "zip", "m", "zip_company", "w"]


def test_suffix_that_collides_again(spark, left):
    right = spark.createDataFrame([(1, "x", "y")], "k int, zip string, zip_r string")
    with pytest.raises(ValueError, match="_r"):
        joins.left_join(left, right, "k", "_r")


@pytest.mark.parametrize("limits", [Limits(), SHUFFLED])
def test_left_rows_stay_and_copies_fan_out(left, right, rows, limits):
    want = [(1, "a", 9, "x", 5), (1, "a", 9, "y", 6), (2, "b", 9, None, None), (None, "c", 9, None, None), (4, "d", 9, None, None)]
    assert rows(joins.left_join(left, right, "k", "_r", limits=limits)) == sorted(want, key=repr)


@pytest.mark.parametrize("limits", [Limits(), SHUFFLED])
def test_null_meets_null_on_request(left, right, rows, limits):
    found = rows(joins.left_join(left, right, "k", "_r", null_safe=True, limits=limits))
    assert (None, "c", 9, "n", 7) in found and len(found) == 5


def test_diagnostics(left, right):
    row = joins.join_diagnostics(left, right, "k", "_r", "step").first()
    got = (row["rows_before"], row["rows_after"], row["right_rows"], row["duplicate_right_keys"], row["unmatched"], row["null_keys"])
    assert got == (4, 5, 4, 1, 2, 1)
    assert row["added_columns"] == ["zip_r", "w"] and row["fan_out_risk"] and row["row_count_changed"]
    assert tuple(joins.unmatched_keys(left, right, "k").first()) == (2, 1)


def test_duplicate_keys(right):
    assert joins.duplicate_keys(right, "k").first()[0] == 1
    assert joins.duplicate_keys(right, "absent").first()[0] == 0


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(KEYS, KEYS, st.booleans())
def test_diagnostics_agree_with_the_join(spark, rows, lefts, rights, null_safe):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(lefts)], "k int, i int")
    right = spark.createDataFrame([(k, j) for j, k in enumerate(rights)], "k int, j int")
    row = joins.join_diagnostics(left, right, "k", "_r", "step", null_safe).first()
    plain = joins.left_join(left, right, "k", "_r", null_safe)
    assert rows(plain) == rows(joins.left_join(left, right, "k", "_r", null_safe, SHUFFLED))
    assert plain.count() == row["rows_after"]
    matched = sum(k is not None and k in rights for k in lefts)
    assert matched + row["unmatched"] + row["null_keys"] == row["rows_before"] == len(lefts)
    known = [k for k in rights if k is not None]
    assert row["duplicate_right_keys"] == len(known) - len(set(known))


def test_hot_keys_are_few_and_null_counts(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(None,)] * 4 + [(2,)], "k int")
    assert set(joins.hot_keys(df, "k", Limits(hot_key_share=0.2))) == {1, None}


def test_large_sides_are_not_broadcast(spark, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 0)], "k int, i int")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    joined = joins.left_join(left, right, "k", "_r", limits=SHUFFLED)
    joined.explain()
    plan = capsys.readouterr().out
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "right_salt" in plan and "BroadcastExchange" not in plan
    assert joined.count() == 51


def test_a_key_with_most_rows_is_joined_whole(spark):
    left = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7 ELSE id END AS k", "id")
    right = spark.range(3000).selectExpr("id AS k", "id * 2 AS v")
    joined = joins.left_join(left, right, "k", "_r", limits=SHUFFLED)
    row = joined.selectExpr("count(*)", "count_if(k = 7 AND v = 14)", "count_if(k IS NULL AND v IS NULL)", "count(v)").first()
    assert tuple(row) == (3000, 1000, 1000, 2000)


def test_collapse(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None), (None, "z")], "k int, v string")
    assert rows(joins.collapse(df, "k", "v", "vs", "n")) == [(1, "a; b", 2)]


def test_master(spark, left, right):
    tables = {"fact": left, "dim": right}
    steps = [
        JoinSpec("dim", "k", "_dim", reduce=lambda df: joins.collapse(df, "k", "zip", "zips", "zip_count")),
        JoinSpec("gone", "k"),
    ]
    table, report = master.build_master(tables, "fact", steps, {"gone": "PATH_NOT_FOUND"})
    assert table.columns == ["k", "zip", "m", "zips", "zip_count"] and table.count() == 4
    done, skipped = report.orderBy("step").collect()
    assert (done["rows_after"], done["duplicate_right_keys"], done["skipped"]) == (4, 0, False)
    assert (skipped["rows_after"], skipped["skipped"], skipped["skip_reason"]) == (4, True, "PATH_NOT_FOUND")
    summary = master.table_report("m", table, ["other"]).first()
    assert summary["rows"] == 4 and summary["columns"] == 5 and summary["ignored"] == ["other"]


def test_master_needs_its_fact(left):
    with pytest.raises(LookupError, match="PATH_NOT_FOUND"):
        master.build_master({"dim": left}, "fact", [], {"fact": "PATH_NOT_FOUND"})


def test_text_master(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, " ")], "id int, t string")
    table, counts = master.build_text_master(df, "t")
    assert table.count() == 1 and tuple(counts.first()) == (3, 1, 1, 1)


def test_names_that_differ_by_case_and_internal_names(spark, rows):
    left = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, Name string, salt int")
    right = spark.createDataFrame([(1, "x", 7)], "K int, name string, right_salt int")
    found = joins.left_join(left, right, "k", "_r", limits=SALTED)
    assert found.columns == ["k", "Name", "salt", "name_r", "right_salt"]
    assert rows(found) == sorted([(1, "a", 5, "x", 7), (2, "b", 6, None, None)], key=repr)


def test_a_table_of_keys_alone_gets_all_salts(spark):
    left = spark.range(1000).selectExpr("CAST(1 AS INT) AS k")
    right = spark.createDataFrame([(1, "v")], "k int, v string")
    assert left.select(joins._salt(left, "k", 8).alias("s")).distinct().count() == 8
    assert joins.left_join(left, right, "k", "_r", limits=SALTED).groupBy("v").count().collect()[0]["count"] == 1000


def test_master_names_the_step_whose_key_is_missing(spark):
    tables = {"fact": spark.range(3).toDF("k"), "other": spark.range(3).toDF("x")}
    with pytest.raises(ValueError, match="step 1 .*other has no column 'k'"):
        build_master(tables, "fact", [JoinSpec("other", "k")])


def test_master_keeps_fan_out_and_keys_of_earlier_steps(spark, rows):
    tables = {
        "fact": spark.createDataFrame([(1, "f"), (2, "g")], "k int, f string"),
        "many": spark.createDataFrame([(1, 10), (1, 11)], "k int, m int"),
        "late": spark.createDataFrame([(10, "x")], "m int, l string"),
    }
    found, report = build_master(tables, "fact", [JoinSpec("many", "k"), JoinSpec("late", "m"), JoinSpec("many", "k", "_again")])
    assert found.count() == 5
    assert [(r["rows_before"], r["rows_after"]) for r in report.orderBy("step").collect()] == [(2, 3), (3, 3), (3, 5)]


def test_fallback_takes_the_first_known_value(spark):
    df = spark.createDataFrame([(1.0, 2.0, 4.0), (None, 2.0, 4.0), (None, None, 4.0), (None, None, None)], "a double, b double, c double")
    found = with_fallback(df, "v", [["a"], ["b", "c"], ["c"]]).select("v", "v_from").collect()
    assert [tuple(r) for r in found] == [(1.0, "a"), (3.0, "b and c"), (4.0, "c"), (None, None)]
