"""Inspection and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayer.functions.types import columns_of, is_categorical, is_numeric
from assayer.operators import correlation, frequency, numeric
from assayer.plans import inspection, profiling
from assayer.registry.catalog import query
from assayer.registry.checks import per_column, quoted, with_input
from assayer.registry.inputs import check_sql, source

# All columns of the widest input.
WIDE = ["o_orderkey", "o_custkey", "buyer", "status", "o_totalprice", "gross_price", "urgent_price", "open_custkey", "spiked_price"]
WIDE += ["final_score", "currency", "o_orderdate", "o_orderpriority", "open_priority", "reference"]
ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDER_LABELS = [("int64", "float64")] * 2 + [("str", "str"), ("float64", "float64"), ("datetime64", "datetime64"), ("str", "str")]
LINES = (
    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    + ["net_price", "spiked_price", "rebate", "fee", "l_returnflag", "l_linestatus", "l_shipdate"]
)
LINE_NUMBERS = list(enumerate(LINES[:12]))


def _label(i: int, c: str) -> str:
    full, gapped = ORDER_LABELS[i]
    return f"CASE WHEN count(*) > count({c}) THEN '{gapped}' ELSE '{full}' END AS label"


_PCT = "100.0 * (count(*) - count({c})) / count(*)"


@query("c1_shape", with_input("lineitem_gaps", 'SELECT count(*) AS "rows", 15 AS "columns" FROM t'))
def shape(spark, folder):
    return frequency.shape(source(spark, folder, "lineitem_gaps"))


@query(
    "c2_schema",
    per_column("orders_gaps", list(enumerate(ORDERS)), lambda i, c: f"{_label(i, c)}, count(*) - count({c}) AS missing"),
)
def schema(spark, folder):
    return inspection.inspect_columns(source(spark, folder, "orders_gaps")).drop("missing_pct")


@query(
    "c3_missing",
    per_column(
        "lineitem_gaps", list(enumerate(LINES)), lambda i, c: f'count(*) AS "rows", count(*) - count({c}) AS missing'
    ),
)
def missing(spark, folder):
    return frequency.missing_counts(source(spark, folder, "lineitem_gaps")).drop("missing_pct")


@query(
    "c4_missing_pct",
    per_column(
        "lineitem_gaps", list(enumerate(LINES)), lambda i, c: f"round_even({_PCT.format(c=c)}, 2)::DOUBLE AS missing_pct"
    ),
)
def missing_pct(spark, folder):
    found = frequency.missing_counts(source(spark, folder, "lineitem_gaps"))
    return found.select("ordinal", "column", F.bround("missing_pct", 2).alias("missing_pct"))


def _copies_sql(name: str, label: str, columns: int) -> str:
    return (
        f"SELECT {quoted(label)} AS dataset, (SELECT count(*) FROM {check_sql(name)}) AS \"rows\", {columns} AS \"columns\", "
        f"(SELECT count(*) FROM {check_sql(name)}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {check_sql(name)})) "
        "AS duplicate_rows, CAST(NULL AS VARCHAR) AS error"
    )


@query(
    "c5_duplicate_rows",
    with_input(
        "orders_copies",
        """SELECT count(*) AS "rows", (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS distinct_rows,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS duplicate_rows FROM t""",
    ),
)
def duplicate_rows(spark, folder):
    return frequency.duplicate_rows(source(spark, folder, "orders_copies"))


@query(
    "c6_inspection",
    " UNION ALL ".join(
        [
            _copies_sql("orders_copies", "orders", 6),
            _copies_sql("texts", "texts", 3),
            _copies_sql("lineitem", "lineitem", 11),
            "SELECT 'absent', NULL, NULL, NULL, 'PATH_NOT_FOUND'",
        ]
    ),
)
def inspect(spark, folder):
    tables = {
        "orders": source(spark, folder, "orders_copies"),
        "texts": source(spark, folder, "texts"),
        "lineitem": source(spark, folder, "lineitem"),
    }
    return inspection.inspect_datasets(spark, tables, {"absent": "PATH_NOT_FOUND"})


@query("c7_distinct", per_column("lineitem_gaps", list(enumerate(LINES)), lambda i, c: f"count(DISTINCT {c}) AS n_unique"))
def distinct(spark, folder):
    return frequency.distinct_counts(source(spark, folder, "lineitem_gaps"))


@query(
    "c7_distinct_texts",
    per_column("texts", [(0, "doc_id"), (1, "text"), (2, "lang")], lambda i, c: f"count(DISTINCT {c}) AS n_unique"),
)
def distinct_texts(spark, folder):
    return frequency.distinct_counts(source(spark, folder, "texts"))


_PROFILE = (
    "count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS min, "
    "round(median({c}), 4) AS median, max({c})::DOUBLE AS max"
)
_QUARTILES = "round(quantile_cont({c}, 0.25), 4)::DOUBLE AS q1, round(quantile_cont({c}, 0.75), 4)::DOUBLE AS q3"
_ROUNDED = ("mean", "std", "q1", "median", "q3")


def _rounded(df):
    return df.withColumns({c: F.round(c, 4) for c in _ROUNDED if c in df.columns})


@query("c8_numeric_profile", per_column("lineitem_gaps", LINE_NUMBERS, lambda i, c: _PROFILE.format(c=c)))
def numeric_profile(spark, folder):
    return _rounded(numeric.numeric_profile(source(spark, folder, "lineitem_gaps")).drop("q1", "q3", "min_exact", "max_exact"))


@query(
    "c9_describe",
    per_column("orders_gaps", [(i, ORDERS[i]) for i in (0, 1, 3)], lambda i, c: f"{_PROFILE.format(c=c)}, {_QUARTILES.format(c=c)}"),
)
def describe(spark, folder):
    return _rounded(numeric.numeric_profile(source(spark, folder, "orders_gaps")).drop("min_exact", "max_exact"))


def _ranked(name: str, columns, limit: int) -> str:
    counts = " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM t "
        f"WHERE {c} IS NOT NULL GROUP BY {c}"
        for i, c in columns
    )
    return with_input(
        name,
        f""", counted AS ({counts}), ranked AS (SELECT *, CAST(row_number() OVER
        (PARTITION BY ordinal ORDER BY n DESC, value ASC) AS INTEGER) AS "rank" FROM counted)
        SELECT * FROM ranked WHERE "rank" <= {limit}""",
    )


@query(
    "c10_categorical_describe",
    with_input(
        "orders_gaps",
        " UNION ALL ".join(
            f"""SELECT {i} AS ordinal, '{c}' AS "column", count({c}) AS "count", count(DISTINCT {c}) AS "unique",
            (SELECT {c} FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
            (SELECT count(*) FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS freq FROM t"""
            for i, c in ((2, "o_orderstatus"), (5, "o_orderpriority"))
        ),
    ),
)
def categorical_describe(spark, folder):
    return profiling.categorical_describe(source(spark, folder, "orders_gaps"))


@query("c11_top_values", _ranked("members", [(1, "c_name"), (4, "c_mktsegment")], 10))
def top_values(spark, folder):
    return frequency.top_values(source(spark, folder, "members"), 10)


@query("c11_top_texts", _ranked("documents", [(1, "text"), (2, "lang"), (3, "source")], 20))
def top_texts(spark, folder):
    return frequency.top_values(source(spark, folder, "documents"), 20)


def _outliers(c: str) -> str:
    q1, q3 = f"(SELECT quantile_cont({c}, 0.25) FROM t)", f"(SELECT quantile_cont({c}, 0.75) FROM t)"
    outside = f"{c} < {q1} - 1.5 * ({q3} - {q1}) OR {c} > {q3} + 1.5 * ({q3} - {q1})"
    n = f"count(*) FILTER ({q1} <> {q3} AND ({outside}))"
    return f"count({c}) AS n, {n} AS outliers, round(coalesce(100.0 * {n} / nullif(count({c}), 0), 0), 4)::DOUBLE AS outlier_pct"


@query("c12_iqr_outliers", per_column("lineitem_gaps", LINE_NUMBERS, lambda i, c: _outliers(c)))
def iqr_outliers(spark, folder):
    found = numeric.iqr_outliers(source(spark, folder, "lineitem_gaps"))
    return found.select("ordinal", "column", "n", "outliers", F.round("outlier_pct", 4).alias("outlier_pct"))


def _pair_sql(name: str, columns, extra: str = "") -> str:
    parts = [
        f"SELECT {i} AS ordinal_a, {j} AS ordinal_b, '{a}' AS col_a, '{b}' AS col_b, corr({a}::DOUBLE, {b}::DOUBLE) AS x, "
        f"count(DISTINCT CASE WHEN {b} IS NOT NULL THEN {a} END) < 2 OR count(DISTINCT CASE WHEN {a} IS NOT NULL THEN {b} END) < 2 AS flat FROM t"
        for k, (i, a) in enumerate(columns)
        for j, b in columns[k + 1 :]
    ]
    return with_input(
        name,
        f""", pairs AS ({" UNION ALL ".join(parts)}), found AS (SELECT ordinal_a, ordinal_b, col_a, col_b,
        CASE WHEN flat OR isnan(x) THEN NULL ELSE round(x, 4) END AS r FROM pairs) SELECT * FROM found {extra}""",
    )


@query("c13_correlation", _pair_sql("lineitem_gaps", LINE_NUMBERS))
def correlations(spark, folder):
    return correlation.correlations(source(spark, folder, "lineitem_gaps")).withColumn("r", F.round("r", 4))


@query("c13_correlation_few", _pair_sql("orders_gaps", [(0, "o_orderkey"), (1, "o_custkey"), (3, "o_totalprice")]))
def correlations_few(spark, folder):
    return correlation.correlations(source(spark, folder, "orders_gaps")).withColumn("r", F.round("r", 4))


@query("c14_high_correlation", _pair_sql("lineitem_gaps", LINE_NUMBERS, "WHERE abs(r) >= 0.8"))
def high_correlation(spark, folder):
    return correlation.high_correlations(source(spark, folder, "lineitem_gaps")).withColumn("r", F.round("r", 4))


_SIZE = "CAST(count(*) * 20 + coalesce(sum(strlen(c_name)), 0) + coalesce(sum(strlen(c_mktsegment)), 0) AS BIGINT)"


@query("c15_logical_size", with_input("members", f'SELECT count(*) AS "rows", {_SIZE} AS bytes FROM t'))
def logical_size(spark, folder):
    return frequency.logical_size(source(spark, folder, "members"))


def _profile_row(i: int, c: str) -> str:
    common = (
        f"{_label(i, c)}, count(*) - count({c}) AS missing, round_even({_PCT.format(c=c)}, 2)::DOUBLE AS missing_pct, "
        f"count(DISTINCT {c}) AS n_unique"
    )
    if i in (0, 1, 3):
        numbers = ", ".join(
            f"round_even({f}, 4)::DOUBLE AS {n}"
            for n, f in (
                ("min", f"min({c})::DOUBLE"),
                ("max", f"max({c})::DOUBLE"),
                ("mean", f"avg({c})"),
                ("median", f"median({c})::DOUBLE"),
                ("std", f"stddev_samp({c})"),
            )
        )
        ends = [f"CAST({f}({c}) AS VARCHAR)" if i < 3 else "NULL::VARCHAR" for f in ("min", "max")]
        return f"{common}, {numbers}, {ends[0]} AS min_exact, {ends[1]} AS max_exact, NULL::VARCHAR AS top_values"
    none = ", ".join(f"NULL::DOUBLE AS {n}" for n in ("min", "max", "mean", "median", "std"))
    none += ", NULL::VARCHAR AS min_exact, NULL::VARCHAR AS max_exact"
    top = (
        f"(SELECT string_agg(v || '=' || n, '; ' ORDER BY n DESC, v) FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n "
        f"FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, v LIMIT 10))"
    )
    return f"{common}, {none}, {top} AS top_values"


@query("c16_column_profile", per_column("orders_gaps", list(enumerate(ORDERS)), _profile_row))
def column_profile(spark, folder):
    found = profiling.column_profile(source(spark, folder, "orders_gaps"))
    shown = F.transform("top_values", lambda v: F.concat(v["value"], F.lit("="), v["n"].cast("string")))
    return found.withColumn("top_values", F.array_join(shown, "; "))


@query(
    "c17_column_information",
    per_column(
        "orders_gaps",
        list(enumerate(ORDERS)),
        lambda i, c: f"{_label(i, c)}, count(*) - count({c}) AS missing, round({_PCT.format(c=c)}, 6)::DOUBLE AS missing_pct, "
        f"count(DISTINCT {c}) AS n_unique",
    ),
)
def column_information(spark, folder):
    df = source(spark, folder, "orders_gaps")
    found = frequency.labelled(df, frequency.column_stats(df))
    return found.select("ordinal", "column", "label", "missing", F.round("missing_pct", 6).alias("missing_pct"), "n_unique")


@query(
    "c18_overview",
    with_input(
        "orders_copies",
        """SELECT count(*) AS "rows", 6 AS "columns",
        CAST(count(*) * 32 + sum(strlen(o_orderstatus)) + sum(strlen(o_orderpriority)) AS BIGINT) AS bytes,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) AS duplicate_rows FROM t""",
    ),
)
def overview(spark, folder):
    return profiling.overview(source(spark, folder, "orders_copies"))


@query(
    "c19_numeric_section",
    per_column(
        "orders_wide",
        [(0, "o_orderkey"), (1, "o_custkey"), (2, "buyer"), (4, "o_totalprice"), (5, "gross_price"), (6, "urgent_price")]
        + [(7, "open_custkey"), (8, "spiked_price"), (9, "final_score")],
        lambda i, c: f"{_PROFILE.format(c=c)}, {_QUARTILES.format(c=c)}, {_outliers(c).split(', ', 1)[1]}",
    ),
)
def numeric_section(spark, folder):
    found = profiling.numeric_section(source(spark, folder, "orders_wide"))
    return _rounded(found).withColumn("outlier_pct", F.round("outlier_pct", 4)).withColumns(
        {c: F.col(c).cast("double") for c in ("min", "max")}
    )


@query(
    "c20_categorical_section",
    with_input(
        "documents",
        " UNION ALL ".join(
            f"""SELECT {i} AS ordinal, '{c}' AS "column", (SELECT count(DISTINCT {c}) FROM t) AS cardinality,
            v AS value, n FROM (SELECT {c} AS v, count(*) AS n FROM t WHERE {c} IS NOT NULL GROUP BY {c}
            ORDER BY n DESC, v LIMIT 20)"""
            for i, c in ((1, "text"), (2, "lang"), (3, "source"))
        ),
    ),
)
def categorical_section(spark, folder):
    df = source(spark, folder, "documents")
    chosen = columns_of(df.schema, is_categorical)
    cardinality = frequency.distinct_counts(df, chosen).select("ordinal", F.col("n_unique").alias("cardinality"))
    top = frequency.top_values(df, 20)
    return top.join(F.broadcast(cardinality), "ordinal").select("ordinal", "column", "cardinality", "value", "n")


@query(
    "c21_type_classes",
    per_column(
        "orders_wide",
        list(enumerate(WIDE)),
        lambda i, c: f"{'true' if i in (0, 1, 2, 4, 5, 6, 7, 8, 9) else 'false'} AS is_numeric, {'true' if i in (3, 10, 12, 13, 14) else 'false'} "
        f"AS is_categorical, count({c}) AS n_nonnull",
    ),
)
def type_classes(spark, folder):
    df = source(spark, folder, "orders_wide")
    numeric_names = [c for c in df.columns if is_numeric(df.schema[c].dataType)]
    categorical_names = [c for c in df.columns if is_categorical(df.schema[c].dataType)]
    return frequency.column_stats(df).select(
        "ordinal",
        "column",
        F.col("column").isin(numeric_names).alias("is_numeric"),
        F.col("column").isin(categorical_names).alias("is_categorical"),
        "n_nonnull",
    )


@query(
    "c22_explore_all",
    f"""SELECT 'members' AS dataset, (SELECT count(*) FROM {check_sql('members')}) AS "rows", 5 AS "columns",
        (SELECT {_SIZE} FROM {check_sql('members')}) AS bytes,
        (SELECT count(*) FROM {check_sql('members')}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {check_sql('members')}))
        AS duplicate_rows, 5 AS column_rows, 3 AS numeric_rows, 3 AS pair_rows,
        (SELECT least(20, count(DISTINCT c_name)) + least(20, count(DISTINCT c_mktsegment)) FROM {check_sql('members')})
        AS value_rows
    UNION ALL SELECT 'orders', (SELECT count(*) FROM {check_sql('orders_copies')}), 6,
        (SELECT CAST(count(*) * 32 + sum(strlen(o_orderstatus)) + sum(strlen(o_orderpriority)) AS BIGINT) FROM {check_sql('orders_copies')}),
        (SELECT count(*) FROM {check_sql('orders_copies')}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {check_sql('orders_copies')})),
        6, 3, 3, (SELECT least(20, count(DISTINCT o_orderstatus)) + least(20, count(DISTINCT o_orderpriority))
        FROM {check_sql('orders_copies')})""",
)
def explore_all(spark, folder):
    tables = {"members": source(spark, folder, "members"), "orders": source(spark, folder, "orders_copies")}
    sections, _ = profiling.explore_all(tables)
    found = sections["overview"].select("dataset", "rows", "columns", "bytes", "duplicate_rows")
    sizes = {"columns": "column_rows", "numeric": "numeric_rows", "correlation": "pair_rows", "top_values": "value_rows"}
    for section, name in sizes.items():
        found = found.join(sections[section].groupBy("dataset").agg(F.count(F.lit(1)).alias(name)), "dataset")
    return found
