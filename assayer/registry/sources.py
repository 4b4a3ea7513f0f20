"""Source and sink queries: whole tables are written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayer.functions.relations import small_relation
from assayer.operators.frequency import missing_counts
from assayer.plans.cleaning import clean_all
from assayer.registry.catalog import query
from assayer.registry.checks import per_column, with_input
from assayer.registry.inputs import source
from assayer.session import scratch_path
from assayer.sources.csv import blank_missing, file_layouts, infer_types, read_csv, read_csv_text
from assayer.sources.discovery import discover_csv, find_file
from assayer.sources.loading import failure_rows, load_tables
from assayer.sources.sinks import save_report, write_csv


def _written(spark, folder, *names: str, nested: bool = True) -> str:
    """Whole tables as CSV files below a new folder, one folder per table."""
    target = scratch_path(spark, "csv")
    for name in names:
        write_csv(source(spark, folder, name), f"{target}/raw/{name}" if nested else f"{target}/{name}")
    return target


# Bytes of the lines that hold a row, for tables whose values are whole numbers and short texts.
_BODIES = {
    "labels": "CAST(sum(strlen(CAST(doc_id AS VARCHAR)) + strlen(CAST(quality AS VARCHAR)) + strlen(CAST(toxic AS VARCHAR)) + 3)"
    " AS BIGINT)",
    "nation": "CAST(sum(strlen(CAST(n_nationkey AS VARCHAR)) + strlen(n_name) + strlen(CAST(n_regionkey AS VARCHAR)) + 3) AS BIGINT)",
}


def _listing(spark, folder, found):
    """(table_name, has_files, named, body_bytes) of a listing."""
    headers = small_relation(
        spark,
        {"table_name": "string", "header": "bigint"},
        [(t, len(",".join(source(spark, folder, t).columns)) + 1) for t in _BODIES],
    )
    table = F.element_at(F.split("path", "/"), -2)
    named = F.bool_and((F.element_at(F.split("path", "/"), -1) == F.col("name")) & F.endswith("name", F.lit(".csv")))
    tables = found.groupBy(table.alias("table_name")).agg(
        (F.count_if(F.col("bytes") > 0) > 0).alias("has_files"),
        named.alias("named"),
        F.sum("bytes").alias("bytes"),
        F.count(F.lit(1)).alias("files"),
    )
    body = F.col("bytes") - F.col("files") * F.col("header")
    return tables.join(F.broadcast(headers), "table_name", "left").select(
        "table_name", "has_files", "named", body.alias("body_bytes")
    )


@query(
    "a1_discover_files",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) > 0 AS has_files, true AS named, {size} AS body_bytes FROM {t}"
        for t, size in {**_BODIES, "orders": "NULL"}.items()
    ),
)
def discover_files(spark, folder):
    """The listing by table; ``body_bytes``: the bytes of its files without their headers, where a text shows each value."""
    found = discover_csv(spark, _written(spark, folder, *_BODIES, "orders"))
    return _listing(spark, folder, found)


@query(
    "a2_discover_flat",
    "SELECT 'above' AS place, 0 AS tables, 0::BIGINT AS body_bytes UNION ALL "
    f"SELECT 'below', 1, {_BODIES['labels']} FROM labels",
)
def discover_flat(spark, folder):
    """Files directly in a folder: those of its own table, none of the folders below it."""
    target = _written(spark, folder, "labels", "nation")
    parts = []
    for place, path in (("above", target), ("below", f"{target}/raw/labels")):
        listed = _listing(spark, folder, discover_csv(spark, path, recursive=False))
        sums = F.count(F.lit(1)).cast("int").alias("tables"), F.coalesce(F.sum("body_bytes"), F.lit(0)).alias("body_bytes")
        parts.append(listed.agg(*sums).select(F.lit(place).alias("place"), "tables", "body_bytes"))
    return parts[0].unionByName(parts[1])


@query("a3_find_file", with_input("nation", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name, n_regionkey::BIGINT AS n_regionkey FROM t"))
def find_named(spark, folder):
    target = scratch_path(spark, "csv")
    write_csv(source(spark, folder, "nation"), f"{target}/raw/nation.csv")
    return read_csv(spark, find_file(spark, target, "nation.csv"))


_FILLED_TEXTS = "SELECT doc_id, CASE WHEN text = '' THEN NULL ELSE text END AS text, lang FROM t"


@query("a4_csv_scan", with_input("texts", _FILLED_TEXTS))
def csv_scan(spark, folder):
    return read_csv(spark, f"{_written(spark, folder, 'texts')}/raw/texts")


def _latin(spark, folder) -> str:
    path = scratch_path(spark, "latin")
    frame = source(spark, folder, "latin_texts")
    frame.write.option("header", True).option("escape", '"').option("encoding", "ISO-8859-1").csv(path)
    return path


@query("a5_latin1_fallback", with_input("latin_texts", "SELECT doc_id, text, lang FROM t"))
def latin1_fallback(spark, folder):
    return read_csv(spark, _latin(spark, folder))


@query(
    "a5_file_layouts",
    with_input(
        "latin_texts",
        """SELECT bool_or(contains(text, chr(10))) AS any_multi_line,
        bool_or(regexp_matches(text, '[^\\x00-\\x7F]')) AS any_latin1 FROM t""",
    ),
)
def layouts(spark, folder):
    # a table may be written as several files, some of them with a header only
    return file_layouts(spark, _latin(spark, folder)).agg(
        F.bool_or("multi_line").alias("any_multi_line"),
        F.bool_or(F.col("encoding") == "ISO-8859-1").alias("any_latin1"),
    )


_TYPED = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
    CASE WHEN o_orderpriority IN ('N/A', 'null') THEN NULL ELSE o_orderpriority END AS o_orderpriority,
    is_final = 'True' AS is_final, open_custkey FROM t"""


@query("a6_type_inference", with_input("orders_text_dates", _TYPED))
def type_inference(spark, folder):
    path = f"{_written(spark, folder, 'orders_text_dates')}/raw/orders_text_dates"
    return infer_types(blank_missing(read_csv_text(spark, path)))


@query("a7_load_tables", "SELECT 'orders' AS dataset, count(*) AS \"rows\", CAST(NULL AS VARCHAR) AS error FROM orders UNION ALL SELECT 'absent', NULL, 'PATH_NOT_FOUND'")
def load_many(spark, folder):
    paths = {"orders": f"{folder}/orders.parquet", "absent": f"{folder}/absent.parquet"}
    tables, failures = load_tables(spark, paths)
    loaded = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("dataset"), "rows", F.lit(None).cast("string").alias("error"))
        for n, df in tables.items()
    ]
    failed = failure_rows(spark, failures).select("dataset", F.lit(None).cast("bigint").alias("rows"), "error")
    return loaded[0].unionByName(failed)


@query(
    "a8_missing_file",
    "SELECT 'absent.csv' AS dataset, false AS success, 'absent.csv' AS named UNION ALL SELECT 'orders', true, NULL FROM orders HAVING count(*) > 0",
)
def missing_file(spark, folder):
    target = scratch_path(spark, "csv")
    write_csv(source(spark, folder, "orders"), f"{target}/raw/orders.csv")
    found = clean_all(spark, target, ["orders.csv", "absent.csv"], f"{target}/cleaned")
    return found.select(
        F.when(F.col("success"), "orders").otherwise(F.col("dataset")).alias("dataset"),
        "success",
        F.regexp_extract("error", r"^(\S+)", 1).alias("named"),
    )


@query("a9_csv_sink", with_input("orders_text_dates", _TYPED))
def csv_sink(spark, folder):
    target = scratch_path(spark, "sink")
    write_csv(source(spark, folder, "orders_text_dates"), target)
    write_csv(source(spark, folder, "orders_text_dates"), target)
    return read_csv(spark, target)


@query(
    "a10_report_sink",
    per_column(
        "orders_gaps",
        list(enumerate(["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])),
        lambda i, c: f'count(*) AS "rows", count(*) - count({c}) AS missing',
    ),
)
def report_sink(spark, folder):
    found = missing_counts(source(spark, folder, "orders_gaps")).drop("missing_pct")
    (written,) = save_report({"missing": found}, scratch_path(spark, "report"))
    return spark.read.parquet(written)
