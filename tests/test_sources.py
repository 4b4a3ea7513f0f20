import pytest

from assayer.plans import cleaning, inspection
from assayer.session import shared_folder
from assayer.sources import csv, discovery, loading, sinks


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub" / "deep").mkdir(parents=True)
    (tmp_path / "b.csv").write_text(" ID ,Resume_str\n1,　x y\t\n1,x y\n2,z\n")
    (tmp_path / "a.csv").write_text("id,v\n1,x\n")
    (tmp_path / "sub" / "a.csv").write_text("id,v\n9,y\n")
    (tmp_path / "sub" / "deep" / "note.txt").write_text("id\n")
    (tmp_path / "bad.csv").write_text("A,a \n1,2\n")
    return tmp_path


def test_discovery(spark, folder):
    assert [r["name"] for r in discovery.discover_csv(spark, str(folder)).collect()] == ["a.csv", "b.csv", "bad.csv", "a.csv"]
    assert [r["name"] for r in discovery.discover_csv(spark, str(folder), recursive=False).collect()] == ["a.csv", "b.csv", "bad.csv"]
    assert discovery.discover_csv(spark, str(folder / "absent")).count() == 0


def test_find_file(spark, folder):
    assert discovery.find_file(spark, str(folder), "a.csv").endswith(f"{folder.name}/a.csv")
    with pytest.raises(FileNotFoundError, match="zz.csv"):
        discovery.find_file(spark, str(folder), "zz.csv")


def test_find_table_of_many_files(spark, folder):
    sinks.write_csv(spark.range(20).repartition(3), str(folder / "sub" / "many.csv"))
    found = discovery.find_file(spark, str(folder), "many.csv")
    assert found.endswith("/sub/many.csv") and csv.read_csv(spark, found).count() == 20


def test_latin1_file_as_a_whole(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_bytes(b"id,v\n1,caf\xe9\n2,plain\n")
    assert [r["v"] for r in csv.read_csv(spark, str(path)).orderBy("id").collect()] == ["café", "plain"]
    assert csv.file_layouts(spark, str(path)).first()["encoding"] == "ISO-8859-1"


def test_quoted_newlines_and_quotes(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('id,v\n1,"a ""q"" b\nline2"\n2,"x, y"\n')
    assert [r["v"] for r in csv.read_csv(spark, str(path)).orderBy("id").collect()] == ['a "q" b\nline2', "x, y"]
    assert csv.file_layouts(spark, str(path)).first()["multi_line"]


def test_files_without_open_quotes_can_be_split(spark, folder):
    assert not csv.file_layouts(spark, str(folder / "b.csv")).first()["multi_line"]


def test_missing_tokens(spark, tmp_path):
    path = tmp_path / "m.csv"
    tokens = ["NA", "null", "None", "nan", "", '""', "#N/A", "n/a", "<NA>", "-nan"]
    path.write_text("id,v\n" + "".join(f"{i},{t}\n" for i, t in enumerate(tokens)) + "99,na\n")
    found = csv.read_csv(spark, str(path)).where("v is not null").collect()
    assert [tuple(r) for r in found] == [(99, "na")]


@pytest.mark.parametrize(
    "values, kind",
    [
        (["1", "", "3"], "bigint"),
        ([" 1", "-2 ", "+3"], "bigint"),
        (["1", "2.5", "1e3"], "double"),
        (["1.", ".5", "inf"], "double"),
        (["True", "false", ""], "boolean"),
        (["t", "yes", "true"], "string"),
        (["2024-01-01", "2024-01-02", ""], "string"),
        (["1d", "2", "3"], "string"),
        (["99999999999999999999", "1", ""], "string"),
        (["", "NA", ""], "double"),
    ],
)
def test_types_follow_from_values(spark, tmp_path, values, kind):
    path = tmp_path / "t.csv"
    path.write_text("k,v\n" + "".join(f"r,{v}\n" for v in values))
    assert csv.read_csv(spark, str(path)).dtypes[1][1] == kind


def test_one_failing_table_does_not_stop_the_others(spark, folder):
    tables, failures = loading.load_tables(spark, {"a": str(folder / "a.csv"), "z": str(folder / "zz.csv")})
    assert list(tables) == ["a"] and failures == {"z": "PATH_NOT_FOUND"}
    found = {r["dataset"]: (r["rows"], r["error"]) for r in inspection.inspect_datasets(spark, tables, failures).collect()}
    assert found == {"a": (1, None), "z": (None, "PATH_NOT_FOUND")}


def test_inspection_labels(spark):
    df = spark.createDataFrame([(1, 1, "a", True, None), (2, None, "b", False, None)], "i int, g int, s string, b boolean, e double")
    found = {r["column"]: r["label"] for r in inspection.inspect_all_columns({"t": df}).collect()}
    assert found == {"i": "int64", "g": "float64", "s": "str", "b": "bool", "e": "float64"}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_clean_all(spark, folder, fmt):
    target = str(folder / f"out-{fmt}")
    results = cleaning.clean_all(spark, str(folder), ["b.csv", "bad.csv", "zz.csv"], target, fmt)
    found = {r["dataset"]: r for r in results.collect()}
    assert (found["b.csv"]["original_rows"], found["b.csv"]["duplicates_removed"]) == (3, 1)
    assert "'A', 'a '" in found["bad.csv"]["error"] and "zz.csv" in found["zz.csv"]["error"]
    summary = cleaning.clean_summary(results).first()
    assert (summary["succeeded"], summary["failed"], summary["duplicates_removed"]) == (1, 2, 1)
    cleaned = loading.read_table(spark, found["b.csv"]["saved_path"])
    assert cleaned.columns == ["id", "resume_str"] and cleaned.count() == 2


def test_csv_round_trip_keeps_every_text(spark, tmp_path, rows):
    data = [(1, 'a "q"'), (2, "two\nlines"), (3, " spaced "), (4, "x,y"), (5, "back\\slash"), (6, None)]
    df = spark.createDataFrame(data, "id long, v string")
    for _ in range(2):
        sinks.write_csv(df, str(tmp_path / "out"))
    assert rows(csv.read_csv(spark, str(tmp_path / "out"))) == rows(df)


def test_reports(spark, tmp_path):
    findings = spark.createDataFrame([("a", ["x", "y"], None)], "rule string, columns array<string>, value double")
    for fmt in ("parquet", "json"):
        (path,) = sinks.save_report({"found": findings}, str(tmp_path / fmt), fmt)
        assert spark.read.format(fmt).load(path).first()["columns"] == ["x", "y"]
    (path,) = sinks.save_report({"found": findings}, str(tmp_path / "text"), "text")
    assert spark.read.text(path).first()["value"] == "rule=a | columns=x, y"
    with pytest.raises(ValueError):
        sinks.save_table(findings, str(tmp_path / "x"), "xml")


def test_shared_folder_is_the_one_the_cluster_names(spark):
    class Named:
        class conf:
            get = staticmethod(lambda key, default: {"spark.checkpoint.dir": "/shared/folder"}.get(key, default))

    assert shared_folder(Named) == "/shared/folder"
    assert shared_folder(spark) == shared_folder(spark)


def test_surplus_fields_fail_and_short_records_do_not(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('a,b\n1,2\n3,4,\n"x,y",6\n')
    (tmp_path / "short.csv").write_text('a,b\n1\n"x,y",6\n')
    tables, failures = loading.load_tables(spark, {n: f"{tmp_path}/{n}.csv" for n in ("bad", "short")})
    assert list(failures) == ["bad"] and "more fields" in failures["bad"]
    assert sorted((tuple(r) for r in tables["short"].collect()), key=repr) == [("1", None), ("x,y", 6)]


def test_files_with_columns_in_another_order(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,x\n")
    (tmp_path / "two.csv").write_text("b,a\ny,2\n")
    found = csv.read_csv(spark, str(tmp_path))
    assert sorted(tuple(r) for r in found.select("a", "b").collect()) == [(1, "x"), (2, "y")]
    (tmp_path / "three.csv").write_text("b,c\ny,2\n")
    with pytest.raises(ValueError, match="different columns"):
        csv.read_csv_text(spark, str(tmp_path))


@pytest.mark.parametrize(
    ("source", "target", "clash"),
    [("/a/raw", "/a/raw", True), ("file:/a/raw/x.csv", "/a/raw/", True), ("/a/raw", "/a/cleaned", False), ("s3://b/a", "/b/a", False)],
)
def test_a_source_is_never_overwritten(source, target, clash):
    if clash:
        with pytest.raises(ValueError, match="overwrite"):
            sinks.refuse_overlap(source, target)
    else:
        sinks.refuse_overlap(source, target)


def test_scratch_tables_can_be_cleared(spark):
    from assayer.session import clear_scratch, pinned

    clear_scratch(spark)
    found = pinned(spark.range(3))
    assert found.count() == 3
    assert clear_scratch(spark) == 1


def test_types_need_two_aggregates_a_column(spark, monkeypatch):
    """Every mix of what a text can be read as; what one pattern has told is not looked at again."""
    big = "9223372036854775808"
    columns = {
        "whole": (["1", " -2 ", "+3", None], "bigint"),
        "long": (["1", big, None], "string"),
        "mixed": (["1", "2.5", big], "double"),
        "inf": (["1e3", "-inf", ".5"], "double"),
        "token": (["True", "false", None], "boolean"),
        "tokens_and_numbers": (["True", "1", None], "string"),
        "text": (["1", "x", "2.5"], "string"),
        "blank": ([" ", "1", None], "string"),
        "none": ([None, None, None], "double"),
    }
    rows = [tuple((v + [None] * 4)[k] for v, _ in columns.values()) for k in range(4)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    asked, agg = [], type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *e: asked.append(len(e)) or agg(self, *e))
    found = csv.infer_types(df)
    assert dict(found.dtypes) == {c: kind for c, (_, kind) in columns.items()}
    assert asked == [2 * len(columns)]
    assert [r["whole"] for r in found.collect()] == [1, -2, 3, None]
    assert [r["token"] for r in found.collect()] == [True, False, None, None]
