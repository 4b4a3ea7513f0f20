"""Input relations of the registered queries.

The stored tables have no gap, no copy and no untrimmed text. Each template
derives such a table from a whole stored one, in SQL that Spark and the
checking engine read alike. ``{name}`` stands for a stored table.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TEMPLATES = {
    # gaps in numbers, keys and texts
    "orders_gaps": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END AS o_custkey,
               o_orderstatus,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS o_totalprice,
               o_orderdate,
               CASE WHEN o_orderstatus = 'P' AND o_totalprice > 250000 THEN NULL ELSE o_orderpriority END
                   AS o_orderpriority
        FROM {orders}""",
    "lineitem_gaps": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity END AS l_quantity,
               l_extendedprice,
               CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_discount END AS l_discount,
               l_tax,
               l_extendedprice * (1 - l_discount) AS net_price,
               CASE WHEN l_quantity > 49 THEN l_extendedprice * 100 ELSE l_extendedprice END AS spiked_price,
               CAST(NULL AS DOUBLE) AS rebate,
               CAST(5.5 AS DOUBLE) AS fee,
               l_returnflag, l_linestatus, l_shipdate
        FROM {lineitem}""",
    # copies of whole rows
    "orders_copies": """
        SELECT * FROM {orders}
        UNION ALL SELECT * FROM {orders} WHERE o_orderstatus = 'P'
        UNION ALL SELECT * FROM {orders} WHERE o_orderpriority = '1-URGENT'""",
    # texts that differ only in white space, blank texts
    "members": """
        SELECT c_custkey, concat('　 ', c_name, '\t') AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM {customer}
        UNION ALL
        SELECT c_custkey, concat(c_name, ' '), c_nationkey, c_acctbal, concat(' ', c_mktsegment) FROM {customer}
        WHERE c_mktsegment = 'BUILDING'
        UNION ALL
        SELECT c_custkey, '  ', c_nationkey, c_acctbal, CAST(NULL AS STRING) FROM {customer} WHERE c_acctbal < 0""",
    "texts": """
        SELECT doc_id, text, lang FROM {documents}
        UNION ALL SELECT doc_id, text, lang FROM {documents} WHERE lang = 'de'
        UNION ALL SELECT doc_id, CASE WHEN lang = 'fr' THEN NULL ELSE ' \t　' END, lang FROM {documents}
                  WHERE lang IN ('fr', 'es')
        UNION ALL SELECT doc_id, NULL, lang FROM {documents} WHERE lang = 'fr'""",
    # one table that triggers every column check
    "orders_wide": """
        SELECT o_orderkey, o_custkey, o_custkey AS buyer, o_orderstatus AS status, o_totalprice,
               o_totalprice * 1.1 AS gross_price,
               CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END AS urgent_price,
               CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END AS open_custkey,
               CASE WHEN o_totalprice > 499000 THEN o_totalprice * 1000 ELSE o_totalprice END AS spiked_price,
               CAST(NULL AS DOUBLE) AS final_score, 'EUR' AS currency, o_orderdate, o_orderpriority,
               CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS open_priority,
               concat('ref-', CAST(o_orderkey AS STRING)) AS reference
        FROM {orders}""",
    # a dimension whose names collide with the fact, and one with several rows per key
    "buyers": """
        SELECT c_custkey AS o_custkey, c_name AS name, c_mktsegment AS o_orderstatus, c_acctbal AS o_totalprice
        FROM {customer} WHERE c_acctbal > 2000
        UNION ALL SELECT CAST(NULL AS BIGINT), 'nobody', 'NONE', 0.0""",
    "priorities": """
        SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS priority FROM {orders}""",
    "order_totals": """
        SELECT l_orderkey AS o_orderkey, sum(l_quantity) AS quantity, count(*) AS line_count
        FROM {lineitem} GROUP BY l_orderkey""",
    "order_lines": """
        SELECT l_orderkey AS o_orderkey, l_linenumber, l_quantity FROM {lineitem}""",
    # parents that hold only a part of the child values, or hold them as text
    "regulars": "SELECT c_custkey, c_mktsegment FROM {customer} WHERE c_acctbal > 2000",
    "wealthy": "SELECT c_custkey, c_mktsegment FROM {customer} WHERE c_acctbal > 6000",
    "supplier_codes": "SELECT CAST(s_suppkey AS STRING) AS s_suppkey, s_nationkey FROM {supplier}",
    "turns": "SELECT conv_id, turn FROM {conversations}",
    "latin_texts": """
        SELECT doc_id, regexp_replace(text, '[^\t\n\r -ÿ]', '?'{global_flag}) AS text, lang FROM {documents}""",
    "orders_text_dates": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS STRING) AS o_orderdate,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'N/A' WHEN o_orderpriority = '2-HIGH' THEN 'null'
                    ELSE o_orderpriority END AS o_orderpriority,
               CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'false' END AS is_final,
               CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END AS open_custkey
        FROM {orders}""",
}
# The two dialects replace all matches by different means.
_SPARK_WORDS = {"global_flag": ""}
_CHECK_WORDS = {"global_flag": ", 'g'"}


_SCHEMAS: dict[str, StructType] = {}


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table; its schema is looked up once per path."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _fields(template: str) -> list[str]:
    return [f for _, f, _, _ in string.Formatter().parse(template) if f]


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A derived or a stored table."""
    if name not in TEMPLATES:
        return stored(spark, folder, name)
    template = TEMPLATES[name]
    used = {f: stored(spark, folder, f) for f in _fields(template) if f not in _SPARK_WORDS}
    words = {f: w for f, w in _SPARK_WORDS.items() if f in _fields(template)}
    text = template
    for f, w in words.items():
        text = text.replace("{" + f + "}", w)
    return spark.sql(text, **used)


def check_sql(name: str) -> str:
    """The same table as a parenthesised query of the checking engine."""
    if name not in TEMPLATES:
        return f"(SELECT * FROM {name})"
    words = {f: f for f in _fields(TEMPLATES[name])} | _CHECK_WORDS
    return "(" + TEMPLATES[name].format(**words) + ")"
