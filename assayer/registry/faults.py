"""Queries about data that is broken, odd or large, derived from whole stored tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from assayer.config import DEFAULTS, LIMITS, Limits
from assayer.functions.relations import small_relation
from assayer.operators import correlation, frequency, joins, numeric, relations
from assayer.operators.frequency import column_stats
from assayer.operators.keys import composite_keys
from assayer.plans import cleaning, inspection, profiling, relationships
from assayer.registry.catalog import query
from assayer.registry.checks import per_column
from assayer.registry.inputs import check_sql, source
from assayer.registry.integration import _BUYER, _MASTER, build
from assayer.registry.profiling import LINE_NUMBERS, ORDERS, _outliers, _PROFILE, _QUARTILES, _rounded
from assayer.registry.sources import _TYPED
from assayer.session import scratch_path
from assayer.sources.csv import read_csv
from assayer.sources.loading import load_tables
from assayer.sources.sinks import write_csv

SHUFFLED = Limits(broadcast_bytes=0, hot_key_share=1.0)
SALTED = Limits(broadcast_bytes=0)


def _surplus(spark, folder, name: str, path: str) -> str:
    """A whole table as CSV, and one more file whose record has a field too many."""
    table = source(spark, folder, name)
    write_csv(table, path)
    lines = [(",".join(table.columns),), (",".join(["1"] * (len(table.columns) + 1)),)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(path)
    return path


def _broken(spark, folder, name: str):
    """A whole table as Parquet, one part file of which is none: its schema can be read, its rows cannot."""
    path = scratch_path(spark, "broken")
    table = source(spark, folder, name)
    table.write.parquet(path)
    spark.createDataFrame([("no Parquet",)], "value string").coalesce(1).write.mode("append").text(path)
    return spark.read.schema(table.schema).parquet(path)


@query(
    "a4_malformed_file",
    "SELECT 'good' AS dataset, count(*) AS \"rows\", false AS failed FROM orders UNION ALL SELECT 'surplus', NULL, true",
)
def malformed_file(spark, folder):
    good = f"{scratch_path(spark, 'csv')}/good.csv"
    write_csv(source(spark, folder, "orders_text_dates"), good)
    bad = _surplus(spark, folder, "orders_text_dates", f"{scratch_path(spark, 'csv')}/bad.csv")
    tables, failures = load_tables(spark, {"good": good, "surplus": bad})
    rows = [(n, df.count(), False) for n, df in tables.items()] + [(n, None, True) for n in failures]
    return small_relation(spark, {"dataset": "string", "rows": "bigint", "failed": "boolean"}, rows)


@query("a4_header_order", f"WITH t AS {check_sql('orders_text_dates')} {_TYPED} UNION ALL {_TYPED}")
def header_order(spark, folder):
    path, table = scratch_path(spark, "csv"), source(spark, folder, "orders_text_dates")
    write_csv(table, path)
    turned = table.select(*reversed(table.columns))
    turned.write.mode("append").option("header", True).option("escape", '"').csv(path)
    return read_csv(spark, path)


@query(
    "a7_corrupt_file",
    "SELECT 'orders' AS dataset, count(*) AS \"rows\", false AS failed FROM orders UNION ALL SELECT 'text', NULL, true",
)
def corrupt_file(spark, folder):
    path = scratch_path(spark, "broken")
    source(spark, folder, "documents").select("text").write.text(path)
    tables, failures = load_tables(spark, {"orders": f"{folder}/orders.parquet", "text": path})
    rows = [(n, df.count(), False) for n, df in tables.items()] + [(n, None, True) for n in failures]
    return small_relation(spark, {"dataset": "string", "rows": "bigint", "failed": "boolean"}, rows)


_COPIES = "(SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {0})) FROM {0})"
_ORDERS_COPIES = f"""SELECT 'orders' AS dataset, count(*) AS "rows", 6 AS "columns", {_COPIES.format(check_sql('orders_copies'))}
    AS duplicate_rows, false AS failed FROM {check_sql('orders_copies')}"""


@query("c6_corrupt", f"{_ORDERS_COPIES} UNION ALL SELECT 'broken', NULL, NULL, NULL, true")
def inspect_corrupt(spark, folder):
    tables = {"orders": source(spark, folder, "orders_copies"), "broken": _broken(spark, folder, "customer")}
    found = inspection.inspect_datasets(spark, tables)
    return found.select("dataset", "rows", "columns", "duplicate_rows", F.col("error").isNotNull().alias("failed"))


@query("c22_corrupt", f"{_ORDERS_COPIES} UNION ALL SELECT 'broken', NULL, NULL, NULL, true")
def explore_corrupt(spark, folder):
    tables = {"orders": source(spark, folder, "orders_copies"), "broken": _broken(spark, folder, "customer")}
    sections, failures = profiling.explore_all(tables)
    found = sections["overview"].select("dataset", "rows", "columns", "duplicate_rows", F.lit(False).alias("failed"))
    kinds = {"dataset": "string", "rows": "bigint", "columns": "int", "duplicate_rows": "bigint", "failed": "boolean"}
    return found.unionByName(small_relation(spark, kinds, [(n, None, None, None, True) for n in failures]))


@query(
    "f17_corrupt",
    """SELECT 'customer' AS dataset, 'n_nationkey' AS parent, count(DISTINCT c_nationkey) FILTER (c_nationkey IN
        (SELECT n_nationkey FROM nation)) / count(DISTINCT c_nationkey) AS containment, 2 AS datasets, 1 AS failed FROM customer""",
)
def analyze_corrupt(spark, folder):
    tables = {n: source(spark, folder, n) for n in ("customer", "nation")} | {"broken": _broken(spark, folder, "supplier")}
    names = {c: c[2:] for df in tables.values() for c in df.columns}
    found = relationships.analyze(tables, name_map=names)
    counts = found["summary"].select("datasets", "failed").first()
    links = found["relationships"].where("child_dataset = 'customer' AND child_column = 'c_nationkey'")
    return links.select(
        F.col("child_dataset").alias("dataset"),
        F.col("parent_column").alias("parent"),
        "containment",
        F.lit(counts["datasets"]).alias("datasets"),
        F.lit(counts["failed"]).alias("failed"),
    )


@query(
    "b5_clean_all",
    """SELECT 'orders' AS dataset, true AS success, count(*) AS original_rows, count(*) AS cleaned_rows,
        0::BIGINT AS duplicates_removed, count(*) AS written_rows FROM orders
    UNION ALL SELECT 'onto itself', false, NULL, NULL, NULL, NULL""",
)
def clean_all(spark, folder):
    target = scratch_path(spark, "csv")
    write_csv(source(spark, folder, "orders"), f"{target}/raw/orders.csv")
    name = "orders.csv"
    found = cleaning.clean_all(spark, target, [name], f"{target}/cleaned").withColumn("dataset", F.lit("orders"))
    written = spark.read.parquet(found.first()["saved_path"]).count()
    onto = cleaning.clean_all(spark, target, [name], f"{target}/raw", "csv").withColumn("dataset", F.lit("onto itself"))
    kept = F.when(F.col("success"), F.lit(written)).cast("bigint").alias("written_rows")
    return found.unionByName(onto).select("dataset", "success", "original_rows", "cleaned_rows", "duplicates_removed", kept)


_INFINITE = """SELECT l_orderkey, l_partkey, l_tax,
    CASE WHEN l_quantity = 50 THEN CAST('Infinity' AS DOUBLE) ELSE l_quantity END AS l_quantity FROM {}"""


@query(
    "c13_infinite",
    " UNION ALL ".join(
        [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 4) AS r FROM lineitem"
         for a, b in (("l_orderkey", "l_partkey"), ("l_orderkey", "l_tax"), ("l_partkey", "l_tax"))]
        + [f"SELECT '{c}', 'l_quantity', NULL" for c in ("l_orderkey", "l_partkey", "l_tax")]
    ),
)
def infinite(spark, folder):
    df = spark.sql(_INFINITE.format("{t}"), t=source(spark, folder, "lineitem"))
    return correlation.correlations(df).select("col_a", "col_b", F.round("r", 4).alias("r"))


@query(
    "c8_large_integers",
    """SELECT 'key' AS "column", CAST(min(9007199254740993 + 2 * o_orderkey) AS VARCHAR) AS min_exact,
        CAST(max(9007199254740993 + 2 * o_orderkey) AS VARCHAR) AS max_exact FROM orders""",
)
def large_integers(spark, folder):
    df = source(spark, folder, "orders").select((F.lit(9007199254740993) + 2 * F.col("o_orderkey")).alias("key"))
    return numeric.numeric_profile(df).select("column", "min_exact", "max_exact")


@query(
    "f7_decimal_keys",
    """WITH c AS (SELECT DISTINCT 9007199254740992 + o_orderkey AS k FROM orders),
    p AS (SELECT DISTINCT 9007199254740992 + 2 * o_orderkey AS k FROM orders)
    SELECT count(*) AS child_values, count(*) FILTER (k IN (SELECT k FROM p)) AS shared_values FROM c""",
)
def decimal_keys(spark, folder):
    orders = source(spark, folder, "orders")
    whole = lambda times: (F.lit(9007199254740992) + times * F.col("o_orderkey")).cast("decimal(20,0)").alias("k")
    found = relations.containment(orders.select(whole(1)), "k", orders.select(whole(2)), "k")
    return found.select("child_values", "shared_values")


_ZEROS = """SELECT CASE WHEN o_orderkey % 8 = 0 THEN CAST(0.0 AS DOUBLE) WHEN o_orderkey % 8 = 1 THEN -CAST(0.0 AS DOUBLE)
    ELSE CAST(o_orderkey % 8 AS DOUBLE) END AS a,
    CASE WHEN o_orderkey % 8 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS b FROM {}"""


@query(
    "f3_signed_zero",
    f"""SELECT count(*) AS "rows", count(*) = (SELECT count(*) FROM (SELECT DISTINCT a + 0.0, b FROM ({_ZEROS.format('orders')})))
        AS composite FROM ({_ZEROS.format('orders')})""",
)
def signed_zero(spark, folder):
    df = spark.sql(_ZEROS.format("{t}"), t=source(spark, folder, "orders"))
    keys = composite_keys(df, column_stats(df), replace(DEFAULTS, composite_ratio=0.0))
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("composite", F.lit(keys.count() > 0))


_PREFIX = "https://example.org/" + "shared-beginning/" * 4


@query(
    "c11_shared_prefix",
    f"""SELECT '{_PREFIX}' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS value, count(*) AS n,
        CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderkey) AS INTEGER) AS "rank"
        FROM orders GROUP BY o_orderkey ORDER BY 3 LIMIT 10""",
)
def shared_prefix(spark, folder):
    url = F.concat(F.lit(_PREFIX), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    return frequency.top_values(source(spark, folder, "orders").select(url.alias("url")), 10).select("value", "n", "rank")


BRACKETED = replace(LIMITS, exact_rank_rows=1)


@query(
    "c9_describe_bracketed",
    per_column("orders_gaps", [(i, ORDERS[i]) for i in (0, 1, 3)], lambda i, c: f"{_PROFILE.format(c=c)}, {_QUARTILES.format(c=c)}"),
)
def describe_bracketed(spark, folder):
    found = numeric.numeric_profile(source(spark, folder, "orders_gaps"), limits=BRACKETED)
    return _rounded(found).drop("min_exact", "max_exact")


@query("c12_bracketed", per_column("lineitem_gaps", LINE_NUMBERS, lambda i, c: _outliers(c)))
def outliers_bracketed(spark, folder):
    found = numeric.iqr_outliers(source(spark, folder, "lineitem_gaps"), limits=BRACKETED)
    return found.select("ordinal", "column", "n", "outliers", F.round("outlier_pct", 4).alias("outlier_pct"))


_JOINED = f"""SELECT l.*, {_BUYER} FROM {check_sql('orders_gaps')} l LEFT JOIN {check_sql('buyers')} r
    ON l.o_custkey IS NOT DISTINCT FROM r.o_custkey"""


@query("g1_left_join_shuffled", _JOINED)
def left_join_shuffled(spark, folder):
    sides = source(spark, folder, "orders_gaps"), source(spark, folder, "buyers")
    return joins.left_join(*sides, "o_custkey", "_buyer", null_safe=True, limits=SHUFFLED)


@query("g1_left_join_salted", _JOINED)
def left_join_salted(spark, folder):
    sides = source(spark, folder, "orders_gaps"), source(spark, folder, "buyers")
    return joins.left_join(*sides, "o_custkey", "_buyer", null_safe=True, limits=SALTED)


@query("g7_master_shuffled", _MASTER)
def master_shuffled(spark, folder):
    return build(spark, folder, SALTED)[0]
