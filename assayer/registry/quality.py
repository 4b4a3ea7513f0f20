"""Column check, role and advice queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayer.config import TARGET_WORDS
from assayer.operators import quality
from assayer.operators.correlation import correlations
from assayer.operators.numeric import iqr_outliers
from assayer.registry.catalog import query
from assayer.registry.checks import with_input
from assayer.registry.inputs import source
from assayer.session import pinned

# name, kind: integer, float, text, time
WIDE = [
    ("o_orderkey", "int"),
    ("o_custkey", "int"),
    ("buyer", "int"),
    ("status", "text"),
    ("o_totalprice", "float"),
    ("gross_price", "float"),
    ("urgent_price", "float"),
    ("open_custkey", "int"),
    ("spiked_price", "float"),
    ("final_score", "float"),
    ("currency", "text"),
    ("o_orderdate", "time"),
    ("o_orderpriority", "text"),
    ("open_priority", "text"),
    ("reference", "text"),
]
_SAME = {"int": ("int",), "float": ("float",), "text": ("text",), "time": ("time",)}

_PAIRS = " UNION ALL ".join(
    f"SELECT {i} AS ordinal_a, {j} AS ordinal_b, '{a}' AS \"column\", '{b}' AS other_column FROM t "
    f"HAVING bool_and({a} IS NOT DISTINCT FROM {b})"
    for i, (a, ka) in enumerate(WIDE)
    for j, (b, kb) in enumerate(WIDE)
    if i < j and ka in _SAME[kb]
)
_TARGETS = ", ".join(f"'{w}'" for w in TARGET_WORDS)
_STATS = " UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS \"column\", '{k}' AS kind, count(*) AS n, count(*) - count({c}) AS missing, "
    f"count(DISTINCT {c}) AS n_unique FROM t"
    for i, (c, k) in enumerate(WIDE)
)
_FACTS = f""", copies AS ({_PAIRS}), stats AS ({_STATS}), facts AS (
    SELECT *, 100.0 * missing / n > 70 AS high_missing, n_unique <= 1 AS constant, missing = n AS empty,
        (n_unique / n >= 0.95 AND (kind = 'text' OR (kind = 'int' AND missing = 0)))
            OR ("column" LIKE '%id%' AND n_unique / n > 0.5) AS identifier,
        kind = 'text' AND n_unique >= 50 AND n_unique / n >= 0.5 AS high_cardinality,
        "column" IN (SELECT other_column FROM copies) AS is_copy,
        len(list_intersect(string_split("column", '_'), [{_TARGETS}])) > 0 AS named_target
    FROM stats), roles AS (
    SELECT *, constant OR empty OR high_missing OR is_copy AS dropped,
        named_target AND NOT identifier AS target FROM facts)"""


def _sql(body: str) -> str:
    return with_input("orders_wide", f"{_FACTS} {body}")


def _wide(spark, folder):
    return source(spark, folder, "orders_wide")


@query("d1_duplicate_columns", _sql("SELECT * FROM copies"))
def duplicate_columns(spark, folder):
    return quality.duplicate_columns(_wide(spark, folder))


def _flagged(name: str, flag: str, column: str):
    @query(name, _sql(f'SELECT ordinal, "column" FROM facts WHERE {column}'))
    def run(spark, folder):
        return quality.column_facts(_wide(spark, folder)).where(F.col(flag)).select("ordinal", "column")

    return run


constant = _flagged("d2_constant", "is_constant", "constant")
empty = _flagged("d3_empty", "is_empty", "empty")
high_missing = _flagged("d4_high_missing", "is_high_missing", "high_missing")
identifiers = _flagged("d5_identifiers", "is_identifier", "identifier")
high_cardinality = _flagged("d6_high_cardinality", "is_high_cardinality", "high_cardinality")


@query(
    "d7_quality",
    _sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"check\", \"column\", NULL::VARCHAR AS other_column FROM facts WHERE {c}"
            for c in ("constant", "empty", "high_missing", "identifier", "high_cardinality")
        )
        + " UNION ALL SELECT 'duplicate', \"column\", other_column FROM copies"
    ),
)
def findings(spark, folder):
    df = _wide(spark, folder)
    copies = quality.duplicate_columns(df)
    return quality.quality_findings(quality.column_facts(df, duplicates=copies), copies)


_BUCKETS = {
    "features": "NOT identifier AND NOT dropped AND NOT target",
    "targets": "target",
    "identifiers": "identifier",
    "drop": "dropped",
}


@query(
    "e1_roles",
    _sql(" UNION ALL ".join(f"SELECT ordinal, \"column\", '{b}' AS bucket FROM roles WHERE {w}" for b, w in _BUCKETS.items())),
)
def roles(spark, folder):
    return quality.column_roles(quality.column_facts(_wide(spark, folder)))


@query(
    "e2_role_lists",
    _sql(
        " UNION ALL ".join(
            f"SELECT '{b}' AS bucket, string_agg(\"column\", ', ' ORDER BY "
            + ("ordinal" if b in ("features", "targets") else '"column"')
            + f') AS "columns" FROM roles WHERE {w}'
            for b, w in _BUCKETS.items()
        )
    ),
)
def role_lists(spark, folder):
    lists = quality.role_lists(quality.column_facts(_wide(spark, folder)))
    return lists.withColumn("columns", F.array_join("columns", ", "))


def _listed(flag: str, order: str = "ordinal") -> str:
    return f"(SELECT string_agg(\"column\", ', ' ORDER BY {order}) FROM roles WHERE {flag})"


def _list_row(place: int, rule: str, flag: str, order: str = "ordinal") -> str:
    return (
        f"SELECT {place} AS place, '{rule}' AS rule, {_listed(flag, order)} AS \"columns\", "
        f"(SELECT count(*) FROM roles WHERE {flag})::DOUBLE AS value, NULL AS said"
    )


_ADVISED = " ".join(
    f"WHEN '{rule}' THEN '{said}'"
    for rule, said in (
        ("high_missing", "more than 70% missing"),
        ("constant", "one value only, no signal"),
        ("empty", "no value at all"),
        ("duplicate_columns", "keep one of each"),
        ("targets", "may be targets, keep them out of the features"),
        ("identifiers", "identify rows, keep them out of the features"),
        ("high_cardinality", "too many values for one-hot encoding"),
        ("features", "usable as features"),
    )
)
_WORST = 'arg_max("column", missing * 1000 - ordinal)'
_MOST = 'arg_max("column", outliers * 1000 - ordinal)'


_NUMERIC = [(i, c) for i, (c, k) in enumerate(WIDE) if k in ("int", "float")]


def _outlier_count(i: int, c: str) -> str:
    q1, q3 = f"(SELECT quantile_cont({c}, 0.25) FROM t)", f"(SELECT quantile_cont({c}, 0.75) FROM t)"
    return (
        f"SELECT {i} AS ordinal, '{c}' AS \"column\", count(*) FILTER ({q1} <> {q3} AND "
        f"({c} < {q1} - 1.5 * ({q3} - {q1}) OR {c} > {q3} + 1.5 * ({q3} - {q1}))) AS outliers FROM t"
    )


_CORRELATED = " UNION ALL ".join(
    f"SELECT {i} AS a, {j} AS b, '{x} & {y}' AS pair, corr({x}::DOUBLE, {y}::DOUBLE) AS r FROM t"
    for k, (i, x) in enumerate(_NUMERIC)
    for j, y in _NUMERIC[k + 1 :]
)


@query(
    "e3_observations",
    _sql(
        f""", outliers AS ({" UNION ALL ".join(_outlier_count(i, c) for i, c in _NUMERIC)}),
        strong AS (SELECT * FROM ({_CORRELATED}) WHERE NOT isnan(r) AND abs(r) >= 0.8),
        shown AS (SELECT * FROM strong ORDER BY -round(abs(r), 9), a, b LIMIT 5),
        all_rules AS (
        SELECT 1 AS place, CASE WHEN max(missing) = 0 THEN 'no_missing' ELSE 'most_missing' END AS rule,
            CASE WHEN max(missing) = 0 THEN '' ELSE {_WORST} END AS "columns",
            round(100.0 * max(missing) / max(n), 4)::DOUBLE AS value,
            CASE WHEN max(missing) = 0 THEN 'no column has a missing value' ELSE
                {_WORST} || ' misses most values: ' || printf('%.1f%%', 100.0 * max(missing) / max(n)) END AS said FROM roles
        UNION ALL {_list_row(2, 'high_missing', 'high_missing')}
        UNION ALL SELECT 3, 'high_correlation', string_agg(pair, ', ' ORDER BY -round(abs(r), 9), a, b), count(*)::DOUBLE,
            string_agg(pair || printf(' (r=%.2f)', r), '; ' ORDER BY -round(abs(r), 9), a, b)
                || ': redundant, or one leaks the other' FROM shown HAVING count(*) > 0
        UNION ALL SELECT 4, 'most_outliers', {_MOST}, max(outliers)::DOUBLE,
            {_MOST} || ' has most values outside the fence: ' || max(outliers) FROM outliers HAVING max(outliers) > 0
        UNION ALL {_list_row(5, 'constant', 'constant')}
        UNION ALL {_list_row(6, 'empty', 'empty')}
        UNION ALL SELECT 7, 'duplicate_columns',
            string_agg(other_column || ' = ' || "column", ', ' ORDER BY ordinal_a, ordinal_b), count(*)::DOUBLE, NULL
            FROM copies HAVING count(*) > 0
        UNION ALL {_list_row(8, 'targets', 'target')}
        UNION ALL {_list_row(9, 'identifiers', 'identifier', '"column"')}
        UNION ALL {_list_row(10, 'high_cardinality', 'high_cardinality')}
        UNION ALL {_list_row(11, 'features', _BUCKETS['features'])})
        SELECT CAST(row_number() OVER (ORDER BY place) AS INTEGER) AS seq, rule, "columns", value,
            coalesce(said, "columns" || ': ' || CASE rule {_ADVISED} END) AS text FROM all_rules
        WHERE "columns" IS NOT NULL"""
    ),
)
def observations(spark, folder):
    df = _wide(spark, folder)
    copies = quality.duplicate_columns(df)
    facts = pinned(quality.column_facts(df, duplicates=copies))
    found = quality.observations(facts, copies, correlations(df), iqr_outliers(df))
    return found.select("seq", "rule", F.array_join("columns", ", ").alias("columns"), F.round("value", 4).alias("value"), "text")


def _advice(section: str, action: str, where: str) -> str:
    return f"SELECT '{section}' AS section, '{action}' AS action, ordinal, \"column\" FROM roles WHERE {where}"


_SOME_MISSING = "missing > 0 AND NOT high_missing"
_KEPT = "NOT dropped AND NOT identifier"
_ADVICE = {
    "e4_cleaning_advice": [
        ("cleaning", "drop_empty", "empty"),
        ("cleaning", "drop_constant", "constant"),
        ("cleaning", "drop_duplicate", "is_copy"),
        ("cleaning", "drop_high_missing", "high_missing"),
        ("cleaning", "impute_median", f"kind IN ('int', 'float') AND {_SOME_MISSING}"),
        ("cleaning", "impute_mode", f"kind = 'text' AND {_SOME_MISSING}"),
    ],
    "e5_encoding_advice": [
        ("encoding", "one_hot", f"kind = 'text' AND NOT high_cardinality AND {_KEPT}"),
        ("encoding", "hash_or_target", f"high_cardinality AND {_KEPT}"),
    ],
    "e6_scaling_advice": [("scaling", "scale", f"kind IN ('int', 'float') AND {_KEPT}")],
    "e7_ignore_and_keep": [
        ("ignore", "ignore", "dropped OR identifier"),
        ("keep", "keep", _BUCKETS["features"]),
    ],
}


def _advised(name: str, rows: list[tuple[str, str, str]]):
    sections = sorted({section for section, _, _ in rows})

    @query(name, _sql(" UNION ALL ".join(_advice(*row) for row in rows)))
    def run(spark, folder):
        advice = quality.recommendations(quality.column_facts(_wide(spark, folder)))
        return advice.where(F.col("section").isin(sections))

    return run


advice = {name: _advised(name, rows) for name, rows in _ADVICE.items()}
