"""Key and relationship queries."""

from __future__ import annotations

from dataclasses import replace
from itertools import combinations

from pyspark.sql import functions as F

from assayer.config import DEFAULTS
from assayer.functions.relations import small_relation
from assayer.functions.columns import normalize_name
from assayer.operators import keys, relations
from assayer.operators.frequency import column_stats, missing_counts
from assayer.operators.keys import table_keys
from assayer.plans import relationships as plan
from assayer.registry.catalog import query
from assayer.registry.checks import per_column, with_input
from assayer.registry.inputs import check_sql, source
from assayer.registry.profiling import WIDE
from assayer.session import pinned

# Tables that are linked, and the prefix that keeps their names apart.
LINKED = {
    "customer": "c_",
    "documents": "",
    "events": "",
    "labels": "",
    "lineitem": "l_",
    "nation": "n_",
    "orders": "o_",
    "part": "p_",
    "region": "r_",
    "regulars": "c_",
    "supplier": "s_",
    "supplier_codes": "s_",
    "turns": "",
    "wealthy": "c_",
}
# Shared names, their columns and families, as the tables define them.
GROUPS = {
    "custkey": [("customer", "c_custkey", "n"), ("orders", "o_custkey", "n"), ("regulars", "c_custkey", "n"), ("wealthy", "c_custkey", "n")],
    "name": [("customer", "c_name", "t"), ("nation", "n_name", "t"), ("part", "p_name", "t"), ("region", "r_name", "t"), ("supplier", "s_name", "t")],
    "nationkey": [("customer", "c_nationkey", "n"), ("nation", "n_nationkey", "n"), ("supplier", "s_nationkey", "n"), ("supplier_codes", "s_nationkey", "n")],
    "acctbal": [("customer", "c_acctbal", "n"), ("supplier", "s_acctbal", "n")],
    "mktsegment": [("customer", "c_mktsegment", "t"), ("regulars", "c_mktsegment", "t"), ("wealthy", "c_mktsegment", "t")],
    "doc": [("documents", "doc_id", "n"), ("labels", "doc_id", "n")],
    "orderkey": [("lineitem", "l_orderkey", "n"), ("orders", "o_orderkey", "n")],
    "partkey": [("lineitem", "l_partkey", "n"), ("part", "p_partkey", "n")],
    "suppkey": [("lineitem", "l_suppkey", "n"), ("supplier", "s_suppkey", "n"), ("supplier_codes", "s_suppkey", "t")],
    "regionkey": [("nation", "n_regionkey", "n"), ("region", "r_regionkey", "n")],
}
_FAMILY = {"n": "numeric", "t": "text"}


def _tables(spark, folder):
    return {name: source(spark, folder, name) for name in LINKED}


def _name_map(tables):
    return {c: c.removeprefix(LINKED[name]) for name, df in tables.items() for c in df.columns}


def _is_key(dataset: str, column: str) -> str:
    return (
        f"(SELECT count(*) > 0 AND count(*) = count({column}) AND count(*) = count(DISTINCT {column}) FROM {check_sql(dataset)})"
    )


# The columns of the widest input that are no numbers.
_WIDE_FAMILY = {3: "text", 10: "text", 11: "datetime", 12: "text", 13: "text", 14: "text"}


@query(
    "f1_single_keys",
    " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, '{c}' AS \"column\" WHERE {_is_key(t, c)}"
        for t, columns in {
            "orders_wide": WIDE,
            "documents": ["doc_id", "text", "lang", "source", "n_chars"],
            "turns": ["conv_id", "turn"],
        }.items()
        for c in columns
    ),
)
def single_keys(spark, folder):
    chosen = {
        "orders_wide": source(spark, folder, "orders_wide"),
        "documents": source(spark, folder, "documents"),
        "turns": source(spark, folder, "turns"),
    }
    return relations.all_keys(chosen).select("dataset", "column")


_SCORED = list(enumerate(WIDE))


@query(
    "f2_key_candidates",
    with_input(
        "orders_wide",
        ", s AS ("
        + " UNION ALL ".join(
            f"SELECT {i} AS ordinal, '{c}' AS \"column\", count(DISTINCT {c}) / count(*) AS ratio FROM t" for i, c in _SCORED
        )
        + """), scored AS (SELECT ordinal, "column", round(ratio + CASE WHEN "column" LIKE '%id%' THEN 0.05 ELSE 0 END, 6)::DOUBLE
        AS score FROM s WHERE ratio >= 0.5)
        SELECT * FROM scored ORDER BY score DESC, ordinal LIMIT 6""",
    ),
)
def key_candidates(spark, folder):
    df = source(spark, folder, "orders_wide")
    found = keys.key_candidates(column_stats(df))
    return found.select("ordinal", "column", F.round("score", 6).alias("score"))


# The columns of the stored tables.
STORED = {
    name: columns.split()
    for name, columns in {
        "benchmark": "item_id text",
        "conversations": "conv_id turn role text",
        "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
        "documents": "doc_id text lang source n_chars",
        "embeddings": "vec_id embedding label",
        "events": "event_id ts user_id event_type value props",
        "labels": "doc_id quality toxic",
        "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag"
        " l_linestatus l_shipdate",
        "nation": "n_nationkey n_name n_regionkey",
        "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
        "pages": "page_id url html",
        "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
        "region": "r_regionkey r_name",
        "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    }.items()
}


def _pairs_sql(table: str) -> str:
    """Pairs of the six columns with the most values that are unique together, if no column is on its own."""
    columns = STORED[table]
    shares = " UNION ALL ".join(
        f"SELECT {i} AS ordinal, '{c}' AS c, count(DISTINCT {c}) / count(*) + {0.05 if 'id' in c else 0.0} AS score, "
        f"count(DISTINCT {c}) = count(*) AS alone FROM {table}"
        for i, c in enumerate(columns)
    )
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b FROM {table} HAVING count(*) = count(DISTINCT ({a}, {b}))"
        for a, b in combinations(columns, 2)
    )
    return f"""SELECT '{table}' AS dataset, x.c AS column_a, y.c AS column_b FROM ({pairs}) p
        JOIN (SELECT *, row_number() OVER (ORDER BY score DESC, ordinal) AS place FROM ({shares})) x ON x.c IN (p.a, p.b)
        JOIN (SELECT *, row_number() OVER (ORDER BY score DESC, ordinal) AS place FROM ({shares})) y ON y.c IN (p.a, p.b)
        WHERE x.place < y.place AND y.place <= 6 AND NOT (SELECT bool_or(alone) FROM ({shares}))"""


@query("f3_composite_keys", " UNION ALL ".join(_pairs_sql(t) for t in ("conversations", "lineitem")))
def composite_keys(spark, folder):
    rules = replace(DEFAULTS, composite_ratio=0.0)
    parts = []
    for name in ("conversations", "lineitem"):
        df = source(spark, folder, name)
        found = keys.composite_keys(df, pinned(column_stats(df)), rules)
        parts.append(found.select(F.lit(name).alias("dataset"), "column_a", "column_b"))
    return relations.union_all(parts)


@query(
    "f4_normalized_names",
    """SELECT dataset, "column", n_nonnull, coalesce(nullif(trim(CASE WHEN regexp_matches(joined, '^.+(_id|id)$')
        THEN regexp_extract(joined, '^(.+?)(_id|id)$', 1) ELSE joined END, '_'), ''), lower("column")) AS normalized_name
        FROM (SELECT *, trim(regexp_replace(lower("column"), '[^0-9a-z]+', '_', 'g'), '_') AS joined FROM ("""
    + " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, '{c}' AS \"column\", count({c}) AS n_nonnull FROM {t}" for t in STORED for c in STORED[t]
    )
    + "))",
)
def normalized_names(spark, folder):
    parts = []
    for name in STORED:
        df = source(spark, folder, name)
        named = small_relation(
            spark, {"column": "string", "normalized_name": "string"}, [(c, normalize_name(c)) for c in df.columns]
        )
        counts = missing_counts(df).select("column", (F.col("rows") - F.col("missing")).alias("n_nonnull"))
        parts.append(counts.join(F.broadcast(named), "column").withColumn("dataset", F.lit(name)))
    return relations.union_all(parts)


@query(
    "f5_dtype_families",
    per_column(
        "orders_wide",
        list(enumerate(WIDE)),
        lambda i, c: f"'{_WIDE_FAMILY.get(i, 'numeric')}' AS dtype_family, count({c}) AS n_nonnull",
    ),
)
def dtype_families(spark, folder):
    df = source(spark, folder, "orders_wide")
    named = small_relation(
        spark,
        {"column": "string", "dtype_family": "string"},
        [(f.name, relations.dtype_family(f.dataType)) for f in df.schema.fields],
    )
    stats = column_stats(df).select("ordinal", "column", "n_nonnull")
    return stats.join(F.broadcast(named), "column")


_MATCHES = " UNION ALL ".join(
    f"SELECT '{g}' AS normalized_name, '{t}' AS dataset, '{c}' AS \"column\", '{_FAMILY[k]}' AS dtype_family, "
    f"{_is_key(t, c)} AS is_key, {str(len({m[2] for m in members}) > 1).lower()} AS mixed_families"
    for g, members in GROUPS.items()
    for t, c, k in members
)


@query("f6_match_groups", f"SELECT normalized_name, count(DISTINCT dataset) AS datasets, count(*) FILTER (is_key) AS key_columns FROM ({_MATCHES}) GROUP BY normalized_name")
def match_groups(spark, folder):
    tables = _tables(spark, folder)
    found = relations.matching_columns(tables, _name_map(tables))
    return found.groupBy("normalized_name").agg(
        F.count_distinct("dataset").alias("datasets"), F.count_if("is_key").alias("key_columns")
    )


@query("f14_matching_columns", _MATCHES)
def matching_columns(spark, folder):
    tables = _tables(spark, folder)
    return relations.matching_columns(tables, _name_map(tables))


def _containment_sql(ct: str, cc: str, pt: str, pc: str) -> str:
    child, parent = check_sql(ct), check_sql(pt)
    shared = f"(SELECT count(DISTINCT {cc}) FROM {child} WHERE {cc} IN (SELECT {pc} FROM {parent} WHERE {pc} IS NOT NULL))"
    return shared, f"(SELECT count(DISTINCT {cc}) FROM {child})"


_SHARED, _CHILD = _containment_sql("orders_gaps", "o_custkey", "regulars", "c_custkey")


@query(
    "f7_containment",
    f"""SELECT 'o_custkey' AS child_column, 'c_custkey' AS parent_column, {_CHILD} AS child_values, {_SHARED} AS shared_values,
        round({_SHARED} / {_CHILD}, 6)::DOUBLE AS containment,
        CASE WHEN {_SHARED} / {_CHILD} >= 0.9 THEN 'Strong' WHEN {_SHARED} / {_CHILD} >= 0.6 THEN 'Moderate' ELSE 'Weak' END
        AS compatibility""",
)
def containment(spark, folder):
    found = relations.containment(
        source(spark, folder, "orders_gaps"), "o_custkey", source(spark, folder, "regulars"), "c_custkey"
    )
    return found.withColumn("containment", F.round("containment", 6))


def _link(group: str, child: tuple, parent: tuple, digits: int = 6) -> str:
    same = child[2] == parent[2]
    if same:
        shared, total = _containment_sql(child[0], child[1], parent[0], parent[1])
        share = f"coalesce({shared} / nullif({total}, 0), 0)"
    else:
        share = "0"
    return (
        f"SELECT '{group}' AS normalized_name, '{child[0]}' AS child_dataset, '{child[1]}' AS child_column, "
        f"'{parent[0]}' AS parent_dataset, '{parent[1]}' AS parent_column, round({share}, {digits})::DOUBLE AS containment, "
        f"{str(same).lower()} AS dtype_compatible WHERE {_is_key(parent[0], parent[1])}"
    )


_LINKS = (
    "SELECT *, CASE WHEN NOT dtype_compatible THEN 'Incompatible' WHEN containment >= 0.9 THEN 'Strong' "
    "WHEN containment >= 0.6 THEN 'Moderate' ELSE 'Weak' END AS compatibility FROM ("
    + " UNION ALL ".join(
        _link(g, child, parent) for g, m in GROUPS.items() for parent in m for child in m if child[0] != parent[0]
    )
    + ")"
)


def _links(spark, folder):
    tables = _tables(spark, folder)
    return tables, relations.foreign_keys(tables, name_map=_name_map(tables))


_LINK_COLUMNS = ["normalized_name", "child_dataset", "child_column", "parent_dataset", "parent_column", "containment"]


@query("f8_compatibility", f"SELECT compatibility, count(*) AS pairs FROM ({_LINKS}) GROUP BY compatibility")
def compatibility(spark, folder):
    return _links(spark, folder)[1].groupBy("compatibility").agg(F.count(F.lit(1)).alias("pairs"))


@query("f9_foreign_keys", _LINKS)
def foreign_keys(spark, folder):
    found = _links(spark, folder)[1].withColumn("containment", F.round("containment", 6))
    return found.select(*_LINK_COLUMNS, "dtype_compatible", "compatibility")


_GOOD = f"SELECT * FROM ({_LINKS}) WHERE compatibility IN ('Strong', 'Moderate')"


def _guidance_sql(names) -> str:
    """The best link of each pair of tables; of equal ones the first by shared name, parent and child."""
    numbered = " UNION ALL ".join(
        f"SELECT {seq} AS seq, * FROM ({_link(g, child, parent, 15)})"
        for seq, (g, child, parent) in enumerate(
            (g, child, parent) for g, m in GROUPS.items() for parent in m for child in m if child[0] != parent[0]
        )
        if child[0] in names and parent[0] in names
    )
    return f"""SELECT * EXCLUDE (seq, place, containment), round(containment, 6) AS containment,
        CASE WHEN containment >= 0.9 THEN 'Strong' ELSE 'Moderate' END AS compatibility FROM (
        SELECT *, row_number() OVER (PARTITION BY least(child_dataset, parent_dataset), greatest(child_dataset, parent_dataset)
            ORDER BY containment DESC, seq) AS place FROM ({numbered}) WHERE dtype_compatible AND containment >= 0.6)
        WHERE place = 1"""


@query("f10_merge_guidance", _guidance_sql(LINKED))
def merge_guidance(spark, folder):
    found = relations.merge_guidance(_links(spark, folder)[1]).withColumn("containment", F.round("containment", 6))
    return found.select(*_LINK_COLUMNS, "dtype_compatible", "compatibility")


@query(
    "f11_standalone",
    "SELECT dataset FROM (VALUES "
    + ", ".join(f"('{t}')" for t in LINKED)
    + f") AS v(dataset) WHERE dataset NOT IN (SELECT child_dataset FROM ({_GOOD}) UNION SELECT parent_dataset FROM ({_GOOD}))",
)
def standalone(spark, folder):
    tables, links = _links(spark, folder)
    return relations.standalone_tables(tables, pinned(links))


@query(
    "f12_contributions",
    f"""SELECT 'documents' AS dataset, count(*) AS "rows", 2 AS numeric_columns, 3 AS text_columns, 0 AS datetime_columns,
        '' AS likely_targets FROM documents
        UNION ALL SELECT 'embeddings', count(*), 2, 0, 0, 'label' FROM embeddings
        UNION ALL SELECT 'lineitem_gaps', count(*), 12, 2, 1, '' FROM {check_sql('lineitem_gaps')}
        UNION ALL SELECT 'orders', count(*), 3, 2, 1, '' FROM orders""",
)
def contributions(spark, folder):
    names = ("documents", "embeddings", "lineitem_gaps", "orders")
    found = relations.contributions({n: source(spark, folder, n) for n in names})
    return found.withColumn("likely_targets", F.array_join("likely_targets", ", "))


_OVERVIEW = {
    "labels": ("labels", 3, "numeric=3", "doc_id"),
    "lineitem": ("lineitem", 11, "datetime=1, numeric=8, text=2", ""),
    "supplier": ("supplier", 4, "numeric=3, text=1", "s_acctbal, s_name, s_suppkey"),
    "turns": ("turns", 2, "numeric=2", "conv_id + turn"),
}


def _overview_keys(name: str) -> str:
    singles = {"labels": ["doc_id", "quality", "toxic"], "lineitem": [], "supplier": ["s_acctbal", "s_name", "s_nationkey", "s_suppkey"]}
    if name == "turns":
        return (
            f"CASE WHEN (SELECT count(*) = count(DISTINCT (conv_id, turn)) FROM {check_sql('turns')}) "
            "THEN 'conv_id + turn' ELSE '' END"
        )
    flags = " UNION ALL ".join(f"SELECT '{c}' AS c WHERE {_is_key(name, c)}" for c in singles[name])
    return f"coalesce((SELECT string_agg(c, ', ' ORDER BY c) FROM ({flags})), '')" if flags else "''"


@query(
    "f13_overview",
    " UNION ALL ".join(
        f"SELECT '{n}' AS dataset, count(*) AS \"rows\", {w} AS \"columns\", '{mix}' AS type_mix, {_overview_keys(n)} AS keys "
        f"FROM {check_sql(t)}"
        for n, (t, w, mix, _) in _OVERVIEW.items()
    ),
)
def overview(spark, folder):
    tables = {n: source(spark, folder, n) for n in _OVERVIEW}
    rules = replace(DEFAULTS, composite_ratio=0.0)
    parts = [
        table_keys(df, rules if n == "turns" else DEFAULTS, pinned(column_stats(df))).select(
            F.lit(n).alias("dataset"), "columns", "kind"
        )
        for n, df in tables.items()
    ]
    found = plan.dataset_overview(tables, relations.union_all(parts))
    return found.withColumn("keys", F.array_join("keys", ", "))


@query(
    "f15_relationship_listing",
    f"SELECT child_dataset || '.' || child_column AS child, parent_dataset || '.' || parent_column AS parent, containment, compatibility FROM ({_LINKS})",
)
def relationship_listing(spark, folder):
    return _links(spark, folder)[1].select(
        F.concat_ws(".", "child_dataset", "child_column").alias("child"),
        F.concat_ws(".", "parent_dataset", "parent_column").alias("parent"),
        F.round("containment", 6).alias("containment"),
        "compatibility",
    )


_COUNTS = ", ".join(f"count(*) FILTER (compatibility = '{k}') AS {k.lower()}" for k in ("Strong", "Moderate", "Weak"))


@query("f16_summary", f"SELECT count(*) AS candidates, {_COUNTS} FROM ({_LINKS})")
def summary(spark, folder):
    return relations.relationship_summary(_links(spark, folder)[1])


_SMALL = ("customer", "nation", "orders", "regulars", "wealthy")
_SMALL_LINKS = " UNION ALL ".join(
    _link(g, child, parent)
    for g, m in GROUPS.items()
    for parent in m
    for child in m
    if child[0] != parent[0] and child[0] in _SMALL and parent[0] in _SMALL
)


_MIX = {
    "customer": "numeric=3, text=2",
    "nation": "numeric=2, text=1",
    "orders": "datetime=1, numeric=3, text=2",
    "regulars": "numeric=1, text=1",
    "wealthy": "numeric=1, text=1",
}
_SMALL_COLUMNS = {n: STORED.get(n, ["c_custkey", "c_mktsegment"]) for n in _SMALL}
_SMALL_GROUPS = {g: [m for m in members if m[0] in _SMALL] for g, members in GROUPS.items()}
_SMALL_KEYS = " UNION ALL ".join(
    f"SELECT '{n}' AS dataset, '{c}' AS c WHERE {_is_key(n, c)}" for n, columns in _SMALL_COLUMNS.items() for c in columns
)
_SMALL_GOOD = "SELECT * FROM links WHERE compatibility IN ('Strong', 'Moderate')"
_ENDS = "child_dataset || '.' || child_column || ' > ' || parent_dataset || '.' || parent_column"


def _mix_sql(name: str) -> str:
    counts = dict(part.split("=") for part in _MIX[name].split(", "))
    return " ".join(counts.get(k, "0") for k in ("numeric", "text", "datetime"))


_ANALYSIS = f"""WITH links AS (SELECT *, CASE WHEN NOT dtype_compatible THEN 'Incompatible' WHEN containment >= 0.9 THEN 'Strong'
        WHEN containment >= 0.6 THEN 'Moderate' ELSE 'Weak' END AS compatibility FROM ({_SMALL_LINKS})),
    single AS ({_SMALL_KEYS}),
    sizes AS ({" UNION ALL ".join(f"SELECT '{n}' AS dataset, count(*) AS n FROM {check_sql(n)}" for n in _SMALL)}),
    fixed AS ({" UNION ALL ".join(f"SELECT '{n}' AS dataset, '{_MIX[n]}' AS mix, '{_mix_sql(n)}' AS counts" for n in _SMALL)})
    SELECT 'overview' AS section, dataset, mix || ' | ' || coalesce((SELECT string_agg(c, ', ' ORDER BY c) FROM single s
        WHERE s.dataset = sizes.dataset), '') AS detail, n::DOUBLE AS value FROM sizes JOIN fixed USING (dataset)
    UNION ALL SELECT 'keys', dataset, 'single ' || c, NULL FROM single
    UNION ALL {" UNION ALL ".join(
        f"SELECT 'matching_columns', '{t}', '{g} {c} {_FAMILY[k]} ' || {_is_key(t, c)} || ' {str(len({x[2] for x in m}) > 1).lower()}', NULL"
        for g, m in _SMALL_GROUPS.items() if len(m) > 1 for t, c, k in m
    )}
    UNION ALL SELECT 'relationships', NULL, normalized_name || ' ' || {_ENDS} || ' ' || compatibility, containment FROM links
    UNION ALL SELECT 'merge_guidance', NULL, normalized_name || ' ' || {_ENDS} || ' ' || compatibility, containment
        FROM ({_guidance_sql(_SMALL)})
    UNION ALL SELECT 'standalone', dataset, '', NULL FROM sizes WHERE (SELECT count(*) FROM ({_SMALL_GOOD})) > 0
        AND dataset NOT IN (SELECT child_dataset FROM ({_SMALL_GOOD}) UNION SELECT parent_dataset FROM ({_SMALL_GOOD}))
    UNION ALL SELECT 'contributions', dataset, counts || ' | ', n FROM sizes JOIN fixed USING (dataset)
    UNION ALL SELECT 'summary', NULL, concat_ws(' ', {_COUNTS.replace(' AS strong', '').replace(' AS moderate', '').replace(' AS weak', '')},
        (SELECT count(*) FROM sizes), 1), count(*) FROM links
    UNION ALL SELECT 'failures', 'absent', 'not found', NULL"""


@query("f17_analysis", _ANALYSIS)
def analysis(spark, folder):
    """All nine sections as rows (section, dataset, detail, value)."""
    tables = {n: source(spark, folder, n) for n in _SMALL}
    names = {c: c.removeprefix(LINKED[n]) for n, df in tables.items() for c in df.columns}
    sections = plan.analyze(tables, {"absent": "not found"}, name_map=names)
    none = F.lit(None)
    link = F.concat_ws(
        " ",
        "normalized_name",
        F.concat_ws(".", "child_dataset", "child_column"),
        F.lit(">"),
        F.concat_ws(".", "parent_dataset", "parent_column"),
        "compatibility",
    )
    joined = F.concat_ws(" | ", "type_mix", F.array_join("keys", ", "))
    families = F.concat_ws(" ", *[f"{k}_columns" for k in ("numeric", "text", "datetime")])
    shown = {
        "overview": ("dataset", joined, "rows"),
        "keys": ("dataset", F.concat_ws(" ", "kind", F.array_join("columns", " + ")), none),
        "matching_columns": (
            "dataset",
            F.concat_ws(" ", "normalized_name", "column", "dtype_family", *[F.col(c).cast("string") for c in ("is_key", "mixed_families")]),
            none,
        ),
        "relationships": (none, link, F.round("containment", 6)),
        "merge_guidance": (none, link, F.round("containment", 6)),
        "standalone": ("dataset", F.lit(""), none),
        "contributions": ("dataset", F.concat_ws(" | ", families, F.array_join("likely_targets", ", ")), "rows"),
        "summary": (none, F.concat_ws(" ", "strong", "moderate", "weak", "datasets", "failed"), "candidates"),
        "failures": ("dataset", "error", none),
    }
    parts = []
    for section, (dataset, detail, value) in shown.items():
        as_column = [F.col(c) if isinstance(c, str) else c for c in (dataset, detail, value)]
        parts.append(
            sections[section].select(
                F.lit(section).alias("section"),
                as_column[0].cast("string").alias("dataset"),
                as_column[1].alias("detail"),
                as_column[2].cast("double").alias("value"),
            )
        )
    return relations.union_all(parts)
