import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from assayer.functions.columns import WHITE_SPACE
from assayer.operators import clean


def test_white_space_is_what_python_strips():
    assert len(WHITE_SPACE) == 29
    assert (WHITE_SPACE + "x" + WHITE_SPACE).strip() == "x"


def test_headers(spark):
    df = spark.createDataFrame([(1, "a")], "` ID ` int, Resume_str string")
    assert clean.normalize_headers(df).columns == ["id", "resume_str"]


def test_headers_that_clash_are_named(spark):
    df = spark.range(1).selectExpr("id as A", "id as `a `")
    with pytest.raises(ValueError, match="'A', 'a '"):
        clean.normalize_headers(df)


def test_unicode_blanks(spark, rows):
    df = spark.createDataFrame([("　\tx y ",), ("  ",), (None,)], "v string")
    assert rows(clean.strip_strings(df)) == sorted([("x y",), ("",), (None,)], key=repr)


def test_equal_only_after_trimming(spark):
    df = spark.createDataFrame([("x", 1), (" x ", 1), ("y", None), ("y", None)], "v string, n int")
    assert clean.clean_table(df).count() == 2
    assert clean.clean_counts(df).first().asDict() == {
        "original_rows": 4,
        "cleaned_rows": 2,
        "duplicates_removed": 2,
    }


def test_counts_of_an_empty_table(spark):
    df = spark.createDataFrame([], "v string, n double")
    assert tuple(clean.clean_counts(df).first()) == (0, 0, 0)
    assert tuple(clean.clean_text_counts(df, "v").first()) == (0, 0, 0, 0)


def test_nan_and_null_are_one_kind_of_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "v double")
    assert clean.drop_duplicate_rows(df).count() == 2
    assert clean.drop_missing(df, ["v"]).count() == 1


def test_text_rows(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, " \t"), (3, " \t"), (4, "b")], "id int, text string")
    assert rows(clean.clean_text_rows(df, "text")) == [(1, "a"), (4, "b")]
    assert tuple(clean.clean_text_counts(df, "text").first()) == (6, 2, 2, 2)
    assert clean.clean_text_rows(df, "absent").count() == 4
    assert tuple(clean.clean_text_counts(df, "absent").first()) == (6, 2, 0, 4)


def test_long_equal_and_unequal_texts(spark):
    long = "a" * 500
    df = spark.createDataFrame([(long,), (long,), (long + "b",)], "v string")
    assert clean.clean_counts(df).first()["cleaned_rows"] == 2


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([" a", "a ", "b", " ", None]), st.sampled_from([1, None])), min_size=1, max_size=12))
def test_cleaning_twice_changes_nothing(spark, rows, data):
    once = clean.clean_table(spark.createDataFrame(data, "V string, n int"))
    assert rows(clean.clean_table(once)) == rows(once)
    want = {(v.strip() if v is not None else None, n) for v, n in data}
    assert {tuple(r) for r in once.collect()} == want


def test_duplicates_with_maps_and_dotted_names(spark):
    rows = [({"a": 1}, 1), ({"a": 1}, 1), ({"a": 2}, 1), (None, None)]
    df = spark.createDataFrame(rows, "m map<string,int>, `c.d` int")
    assert clean.drop_duplicate_rows(df).count() == 3
    assert clean.drop_missing(df, ["c.d"]).count() == 3
