"""Join and master table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayer.config import LIMITS
from assayer.functions.columns import WHITE_SPACE
from assayer.operators import joins
from assayer.plans import master
from assayer.plans.master import JoinSpec
from assayer.registry.catalog import query
from assayer.registry.checks import quoted
from assayer.registry.inputs import check_sql, source

_BUYER = "r.name, r.o_orderstatus AS o_orderstatus_buyer, r.o_totalprice AS o_totalprice_buyer"
_COLLAPSED = f"""(SELECT o_custkey, string_agg(priority, '; ' ORDER BY priority) AS priorities, count(*) AS priority_count
    FROM (SELECT DISTINCT o_custkey, priority FROM {check_sql('priorities')}
          WHERE o_custkey IS NOT NULL AND priority IS NOT NULL) GROUP BY o_custkey)"""


def collapsed(df):
    return joins.collapse(df, "o_custkey", "priority", "priorities", "priority_count")


@query(
    "g1_left_join_suffix",
    f"SELECT l.*, {_BUYER} FROM {check_sql('orders_gaps')} l LEFT JOIN {check_sql('buyers')} r ON l.o_custkey = r.o_custkey",
)
def left_join_suffix(spark, folder):
    return joins.left_join(source(spark, folder, "orders_gaps"), source(spark, folder, "buyers"), "o_custkey", "_buyer")


@query(
    "g1_left_join_fan_out",
    f"SELECT l.*, r.l_linenumber, r.l_quantity FROM orders l LEFT JOIN {check_sql('order_lines')} r ON l.o_orderkey = r.o_orderkey",
)
def left_join_fan_out(spark, folder):
    return joins.left_join(source(spark, folder, "orders"), source(spark, folder, "order_lines"), "o_orderkey", "_line")


@query(
    "g2_left_join_null_safe",
    f"""SELECT l.*, {_BUYER} FROM {check_sql('orders_gaps')} l LEFT JOIN {check_sql('buyers')} r
        ON l.o_custkey IS NOT DISTINCT FROM r.o_custkey""",
)
def left_join_null_safe(spark, folder):
    return joins.left_join(
        source(spark, folder, "orders_gaps"), source(spark, folder, "buyers"), "o_custkey", "_buyer", null_safe=True
    )


@query(
    "g3_duplicate_keys",
    f"SELECT count(o_custkey) - count(DISTINCT o_custkey) AS duplicate_keys FROM {check_sql('orders_gaps')}",
)
def duplicate_keys(spark, folder):
    return joins.duplicate_keys(source(spark, folder, "orders_gaps"), "o_custkey")


_UNMATCHED = f"""count(*) FILTER (l.o_custkey IS NOT NULL AND NOT EXISTS
    (SELECT 1 FROM {check_sql('buyers')} r WHERE r.o_custkey = l.o_custkey))"""


@query(
    "g4_unmatched_keys",
    f"""SELECT {_UNMATCHED} AS unmatched, count(*) FILTER (l.o_custkey IS NULL) AS null_keys FROM {check_sql('orders_gaps')} l""",
)
def unmatched_keys(spark, folder):
    return joins.unmatched_keys(source(spark, folder, "orders_gaps"), source(spark, folder, "buyers"), "o_custkey")


def _step(name: str, left: str, right: str, key: str, added: str) -> str:
    """Diagnostics of one left join, from the join itself."""
    unmatched = (
        f"(SELECT count(*) FROM {left} x WHERE x.{key} IS NOT NULL AND x.{key} NOT IN (SELECT {key} FROM {right} y WHERE {key} IS NOT NULL))"
    )
    before = f"(SELECT count(*) FROM {left})"
    after = f"(SELECT count(*) FROM {left} x LEFT JOIN {right} y ON x.{key} = y.{key})"
    copies = f"(SELECT count({key}) - count(DISTINCT {key}) FROM {right})"
    return (
        f"SELECT '{name}' AS step_name, '{key}' AS join_key, {before} AS rows_before, {after} AS rows_after, "
        f"(SELECT count(*) FROM {right}) AS right_rows, {copies} AS duplicate_right_keys, {unmatched} AS unmatched, "
        f"(SELECT count(*) FROM {left} x WHERE x.{key} IS NULL) AS null_keys, '{added}' AS added_columns, "
        f"{copies} > 0 AS fan_out_risk, {after} <> {before} AS row_count_changed, false AS skipped, "
        "CAST(NULL AS VARCHAR) AS skip_reason"
    )


_ADDED = "name, o_orderstatus_buyer, o_totalprice_buyer"


def _flat(df):
    return df.withColumn("added_columns", F.array_join("added_columns", ", "))


@query("g5_join_diagnostics", _step("+ buyers", check_sql("orders_gaps"), check_sql("buyers"), "o_custkey", _ADDED))
def join_diagnostics(spark, folder):
    return _flat(
        joins.join_diagnostics(
            source(spark, folder, "orders_gaps"), source(spark, folder, "buyers"), "o_custkey", "_buyer", "+ buyers"
        )
    )


@query(
    "g6_fan_out_warnings",
    f"""SELECT step_name, fan_out_risk, row_count_changed FROM (
        {_step('+ lines', 'orders', check_sql('order_lines'), 'o_orderkey', '')} UNION ALL
        {_step('+ totals', 'orders', check_sql('order_totals'), 'o_orderkey', '')})""",
)
def fan_out_warnings(spark, folder):
    orders = source(spark, folder, "orders")
    rows = [
        joins.join_diagnostics(orders, source(spark, folder, name), "o_orderkey", "_r", title)
        for name, title in (("order_lines", "+ lines"), ("order_totals", "+ totals"))
    ]
    return rows[0].unionByName(rows[1]).select("step_name", "fan_out_risk", "row_count_changed")


def build(spark, folder, limits=LIMITS):
    names = ("orders_gaps", "buyers", "priorities", "order_totals")
    tables = {n: source(spark, folder, n) for n in names}
    steps = [
        JoinSpec("buyers", "o_custkey", "_buyer"),
        JoinSpec("priorities", "o_custkey", "_priority", reduce=collapsed),
        JoinSpec("reviews", "o_orderkey", "_review"),
        JoinSpec("order_totals", "o_orderkey", "_total"),
    ]
    return master.build_master(tables, "orders_gaps", steps, {"reviews": "PATH_NOT_FOUND"}, limits)


_MASTER = f"""SELECT l.*, {_BUYER}, p.priorities, p.priority_count, s.quantity, s.line_count
    FROM {check_sql('orders_gaps')} l LEFT JOIN {check_sql('buyers')} r ON l.o_custkey = r.o_custkey
    LEFT JOIN {_COLLAPSED} p ON l.o_custkey = p.o_custkey
    LEFT JOIN {check_sql('order_totals')} s ON l.o_orderkey = s.o_orderkey"""


@query("g7_master_table", _MASTER)
def master_table(spark, folder):
    return build(spark, folder)[0]


@query(
    "g7_master_steps",
    f"""SELECT 1 AS step, * FROM ({_step('+ buyers', check_sql('orders_gaps'), check_sql('buyers'), 'o_custkey', _ADDED)})
    UNION ALL SELECT 2, * FROM ({_step('+ priorities', check_sql('orders_gaps'), _COLLAPSED, 'o_custkey', 'priorities, priority_count')})
    UNION ALL SELECT 3, '+ reviews', 'o_orderkey', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders), NULL, NULL, NULL,
        NULL, '', false, false, true, 'PATH_NOT_FOUND'
    UNION ALL SELECT 4, * FROM ({_step('+ order_totals', check_sql('orders_gaps'), check_sql('order_totals'), 'o_orderkey', 'quantity, line_count')})""",
)
def master_steps(spark, folder):
    return _flat(build(spark, folder)[1])


@query(
    "g8_text_master",
    f"""SELECT DISTINCT doc_id, text, lang FROM {check_sql('texts')} WHERE trim(text, {quoted(WHITE_SPACE)}) <> ''""",
)
def text_master(spark, folder):
    return master.build_text_master(source(spark, folder, "texts"), "text")[0]


@query("g9_preaggregate", f"SELECT * FROM {_COLLAPSED}")
def preaggregate(spark, folder):
    return collapsed(source(spark, folder, "priorities"))


@query(
    "g10_set_containment",
    f"""SELECT count(*) AS shared_values FROM (SELECT DISTINCT o_custkey FROM {check_sql('orders_gaps')}
        WHERE o_custkey IN (SELECT o_custkey FROM {check_sql('buyers')} WHERE o_custkey IS NOT NULL))""",
)
def set_containment(spark, folder):
    child = source(spark, folder, "orders_gaps").select("o_custkey").distinct()
    parent = source(spark, folder, "buyers").select("o_custkey").distinct()
    return child.join(parent, "o_custkey", "left_semi").agg(F.count(F.lit(1)).alias("shared_values"))


@query(
    "g11_master_report",
    f"""SELECT 'master' AS dataset, count(*) AS "rows", 13 AS "columns", CAST(count(*) * 32 + coalesce(sum(strlen(o_orderstatus)), 0)
        + coalesce(sum(strlen(o_orderpriority)), 0) + coalesce(sum(strlen(name)), 0) + coalesce(sum(strlen(o_orderstatus_buyer)), 0)
        + coalesce(sum(strlen(priorities)), 0) + count(*) * 32 AS BIGINT) AS bytes,
        'o_orderkey: bigint, o_custkey: bigint, o_orderstatus: string, o_totalprice: double, o_orderdate: timestamp_ntz, '
        || 'o_orderpriority: string, name: string, o_orderstatus_buyer: string, o_totalprice_buyer: double, priorities: string, '
        || 'priority_count: bigint, quantity: double, line_count: bigint' AS schema, 'documents, pages' AS ignored FROM ({_MASTER})""",
)
def master_report(spark, folder):
    report = master.table_report("master", build(spark, folder)[0], ["documents", "pages"])
    return report.withColumns({c: F.array_join(c, ", ") for c in ("ignored", "schema")})
