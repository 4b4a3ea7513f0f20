"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayer.functions.columns import WHITE_SPACE, is_blank
from assayer.functions.relations import column_list
from assayer.functions.types import columns_of, is_numeric, is_text
from assayer.operators import clean
from assayer.operators.frequency import missing_counts
from assayer.operators.numeric import iqr_outliers
from assayer.plans.cleaning import clean_results, clean_summary
from assayer.registry.catalog import query
from assayer.registry.checks import per_column, quoted, with_input
from assayer.registry.inputs import source

_WS = quoted(WHITE_SPACE)
_MEMBER = f"c_custkey, trim(c_name, {_WS}) AS c_name, c_nationkey, c_acctbal, trim(c_mktsegment, {_WS}) AS c_mktsegment"


@query("b1_headers", with_input("customer", 'SELECT c_custkey AS "id", c_name AS "full name", c_acctbal AS "balance_eur" FROM t'))
def headers(spark, folder):
    df = source(spark, folder, "customer").selectExpr("c_custkey as ` ID `", "c_name as `Full Name`", "c_acctbal as `Balance_EUR\t`")
    return clean.normalize_headers(df)


@query("b2_trim", with_input("members", f"SELECT {_MEMBER} FROM t"))
def trim(spark, folder):
    return clean.strip_strings(source(spark, folder, "members"))


@query("b3_dedup", with_input("orders_copies", "SELECT DISTINCT * FROM t"))
def dedup(spark, folder):
    return clean.drop_duplicate_rows(source(spark, folder, "orders_copies"))


@query("b4_clean", with_input("members", f"SELECT DISTINCT {_MEMBER} FROM t"))
def clean_pipeline(spark, folder):
    return clean.clean_table(source(spark, folder, "members"))


def _count_sql(name: str, inner: str, dataset: str) -> str:
    return with_input(
        name,
        f"""SELECT {quoted(dataset)} AS dataset, true AS success, (SELECT count(*) FROM t) AS original_rows,
            (SELECT count(*) FROM ({inner})) AS cleaned_rows,
            (SELECT count(*) FROM t) - (SELECT count(*) FROM ({inner})) AS duplicates_removed,
            CAST(NULL AS VARCHAR) AS error""",
    )


_RESULTS = " UNION ALL ".join(
    [
        f"SELECT * FROM ({_count_sql('members', f'SELECT DISTINCT {_MEMBER} FROM t', 'members')})",
        f"SELECT * FROM ({_count_sql('orders_copies', 'SELECT DISTINCT * FROM t', 'orders')})",
        "SELECT 'absent', false, NULL, NULL, NULL, 'PATH_NOT_FOUND'",
    ]
)


def _results(spark, folder):
    tables = {"members": source(spark, folder, "members"), "orders": source(spark, folder, "orders_copies")}
    return clean_results(tables, {"absent": "PATH_NOT_FOUND"})


@query("b5_clean_results", _RESULTS)
def results(spark, folder):
    return _results(spark, folder)


@query(
    "b5_clean_summary",
    f"""SELECT count(*) FILTER (success) AS succeeded, count(*) FILTER (NOT success) AS failed,
        CAST(sum(duplicates_removed) AS BIGINT) AS duplicates_removed, 'absent' AS failures FROM ({_RESULTS})""",
)
def summary(spark, folder):
    return clean_summary(_results(spark, folder)).withColumn("failures", F.array_join("failures", ", "))


_DISTINCT_TEXTS = "(SELECT DISTINCT doc_id, text, lang FROM t)"


@query("b6_text_clean", with_input("texts", f"SELECT * FROM {_DISTINCT_TEXTS} WHERE trim(text, {_WS}) <> ''"))
def text_clean(spark, folder):
    return clean.clean_text_rows(source(spark, folder, "texts"), "text")


@query(
    "b6_text_clean_counts",
    with_input(
        "texts",
        f"""SELECT (SELECT count(*) FROM t) AS rows_before,
            (SELECT count(*) FROM t) - (SELECT count(*) FROM {_DISTINCT_TEXTS}) AS duplicates_removed,
            (SELECT count(*) FROM {_DISTINCT_TEXTS} WHERE text IS NULL OR trim(text, {_WS}) = '') AS empty_text_removed,
            (SELECT count(*) FROM {_DISTINCT_TEXTS} WHERE trim(text, {_WS}) <> '') AS rows_after""",
    ),
)
def text_clean_counts(spark, folder):
    return clean.clean_text_counts(source(spark, folder, "texts"), "text")


@query(
    "b7_blank",
    with_input("texts", f"SELECT lang, count(*) AS blanks FROM t WHERE text IS NULL OR trim(text, {_WS}) = '' GROUP BY lang"),
)
def blank(spark, folder):
    df = source(spark, folder, "texts").where(is_blank(F.col("text")))
    return df.groupBy("lang").agg(F.count(F.lit(1)).alias("blanks"))


@query("b8_without_text_column", with_input("texts", "SELECT DISTINCT doc_id, lang FROM t"))
def without_text_column(spark, folder):
    return clean.clean_text_rows(source(spark, folder, "texts").drop("text"), "text")


@query("b9_dropna", with_input("orders_gaps", "SELECT * FROM t WHERE o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL"))
def dropna(spark, folder):
    return clean.drop_missing(source(spark, folder, "orders_gaps"), ["o_custkey", "o_orderpriority"])


@query(
    "b10_select_types",
    per_column(
        "orders_gaps",
        [(0, "o_orderkey"), (1, "o_custkey"), (2, "o_orderstatus"), (3, "o_totalprice"), (5, "o_orderpriority")],
        lambda i, c: f"'{'text' if i in (2, 5) else 'numeric'}' AS type_class, count(*) - count({c}) AS missing",
    ),
)
def select_types(spark, folder):
    df = source(spark, folder, "orders_gaps")
    numeric, text = columns_of(df.schema, is_numeric), columns_of(df.schema, is_text)
    listed = column_list(df, numeric + text).select(
        "ordinal", "column", F.when(F.col("column").isin(numeric), "numeric").otherwise("text").alias("type_class")
    )
    return listed.join(missing_counts(df.select(numeric + text)).select("column", "missing"), "column").select(
        "ordinal", "column", "type_class", "missing"
    )


@query(
    "b11_outlier_rows",
    with_input(
        "lineitem_gaps",
        """, f AS (SELECT quantile_cont(spiked_price, 0.25) AS q1, quantile_cont(spiked_price, 0.75) AS q3 FROM t)
        SELECT l_orderkey, l_linenumber, round(spiked_price, 2) AS spiked_price FROM t, f
        WHERE spiked_price < q1 - 1.5 * (q3 - q1) OR spiked_price > q3 + 1.5 * (q3 - q1)""",
    ),
)
def outlier_rows(spark, folder):
    df = source(spark, folder, "lineitem_gaps")
    fence = iqr_outliers(df, ["spiked_price"]).first()
    outside = (F.col("spiked_price") < fence["lower"]) | (F.col("spiked_price") > fence["upper"])
    return df.where(outside).select("l_orderkey", "l_linenumber", F.round("spiked_price", 2).alias("spiked_price"))
