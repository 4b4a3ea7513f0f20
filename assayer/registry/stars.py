"""Star tables and values with a fallback."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayer.plans.master import JoinSpec
from assayer.plans.star import StarTable, star_tables, with_fallback
from assayer.registry.catalog import query
from assayer.registry.checks import with_input
from assayer.registry.inputs import check_sql, source
from assayer.registry.integration import _COLLAPSED, collapsed


@query(
    "j1_star_tables",
    f"""SELECT l.*, s.quantity, s.line_count, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_name, n.n_regionkey,
        p.priorities, p.priority_count
    FROM orders l LEFT JOIN {check_sql('order_totals')} s ON l.o_orderkey = s.o_orderkey
    LEFT JOIN customer c ON l.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN {_COLLAPSED} p ON c.c_custkey = p.o_custkey""",
)
def star(spark, folder):
    tables = {n: source(spark, folder, n) for n in ("orders", "order_totals", "priorities")}
    tables["customer"] = source(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")
    tables["nation"] = source(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    buyers = [JoinSpec("nation", "c_nationkey", "_nation"), JoinSpec("priorities", "o_custkey", "_priority", reduce=collapsed)]
    sales = [JoinSpec("order_totals", "o_orderkey", "_total"), JoinSpec("dim_buyers", "o_custkey", "_buyer")]
    built, _ = star_tables(tables, [StarTable("dim_buyers", "customer", buyers), StarTable("fact_orders", "orders", sales)])
    return built["fact_orders"]


@query(
    "j2_salary_fallback",
    with_input(
        "lineitem_gaps",
        """SELECT l_orderkey, l_linenumber, round(coalesce(l_discount, (l_quantity + l_tax) / 2, net_price), 6) AS amount,
        CASE WHEN l_discount IS NOT NULL THEN 'l_discount' WHEN l_quantity IS NOT NULL AND l_tax IS NOT NULL
        THEN 'l_quantity and l_tax' WHEN net_price IS NOT NULL THEN 'net_price' END AS amount_from FROM t""",
    ),
)
def salary_fallback(spark, folder):
    found = with_fallback(source(spark, folder, "lineitem_gaps"), "amount", [["l_discount"], ["l_quantity", "l_tax"], ["net_price"]])
    return found.select("l_orderkey", "l_linenumber", F.round("amount", 6).alias("amount"), "amount_from")
