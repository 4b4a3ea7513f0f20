"""Columns shared between tables, containment of their values, foreign keys."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from assayer.config import CONTRIBUTION_TARGET_WORDS, DEFAULTS, Thresholds
from assayer.functions.columns import compact, nan_to_null, normalize_name, ref, text_key
from assayer.functions.relations import melt, small_relation
from assayer.functions.types import FLOATING, INTEGRAL, columns_of, dtype_family
from assayer.operators.frequency import row_count, union_all
from assayer.operators.keys import all_single_keys, possible_key_rows

Tables = Mapping[str, DataFrame]

_MASK_BITS = 60


@dataclass(frozen=True)
class Entry:
    """One column of one table, under the name it is compared by."""

    normalized: str
    dataset: str
    column: str
    family: str
    dtype: T.DataType


def column_entries(tables: Tables, name_map: Mapping[str, str] | None = None) -> list[Entry]:
    """All columns in order of table name and position. ``name_map`` overrides names before comparing."""
    name_map = name_map or {}
    return [
        Entry(normalize_name(name_map.get(f.name, f.name)), dataset, f.name, dtype_family(f.dataType), f.dataType)
        for dataset in sorted(tables)
        for f in tables[dataset].schema.fields
    ]


def match_groups(entries: list[Entry]) -> dict[str, list[Entry]]:
    """Normalised names found in more than one table. Schemas only."""
    groups: dict[str, list[Entry]] = {}
    for e in entries:
        groups.setdefault(e.normalized, []).append(e)
    return {n: g for n, g in groups.items() if len({e.dataset for e in g}) > 1}


def all_keys(tables: Tables, groups: dict[str, list[Entry]] | None = None) -> DataFrame:
    """(dataset, ordinal, column) of single keys; only among matched columns if ``groups`` is given."""
    if groups is None:
        return all_single_keys(tables)
    matched: dict[str, list[str]] = {}
    for e in (e for g in groups.values() for e in g):
        matched.setdefault(e.dataset, []).append(e.column)
    return all_single_keys(tables, matched)


def matching_columns(
    tables: Tables, name_map: Mapping[str, str] | None = None, keys: DataFrame | None = None
) -> DataFrame:
    """(normalized_name, dataset, column, dtype_family, is_key, mixed_families) of every shared name.

    ``keys``: the (dataset, column) of all single keys, if they are known.
    """
    groups = match_groups(column_entries(tables, name_map))
    spark = next(iter(tables.values())).sparkSession
    schema = dict.fromkeys(("normalized_name", "dataset", "column", "dtype_family"), "string")
    listed = small_relation(
        spark,
        {**schema, "mixed_families": "boolean"},
        [
            (n, e.dataset, e.column, e.family, len({x.family for x in g}) > 1)
            for n, g in groups.items()
            for e in g
        ],
    )
    keys = all_keys(tables, groups) if keys is None else keys
    keys = keys.select("dataset", "column", F.lit(True).alias("is_key"))
    # keys are at most one row per column
    return listed.join(F.broadcast(keys), ["dataset", "column"], "left").na.fill(False, ["is_key"])


def classify(containment: Column, dtype_compatible: Column, rules: Thresholds = DEFAULTS) -> Column:
    return (
        F.when(~dtype_compatible, "Incompatible")
        .when(containment >= rules.strong_containment, "Strong")
        .when(containment >= rules.moderate_containment, "Moderate")
        .otherwise("Weak")
    )


def _common_class(family: str, members: list[Entry]) -> str:
    """One type in which values of a group can be compared: integer 1 meets 1.0."""
    if family == "numeric":
        if all(isinstance(e.dtype, INTEGRAL) for e in members):
            return "bigint"
        if not any(isinstance(e.dtype, FLOATING) for e in members):
            # whole numbers and decimals meet in a decimal that holds them all, if there is one
            sizes = [(e.dtype.precision, e.dtype.scale) if isinstance(e.dtype, T.DecimalType) else (20, 0) for e in members]
            scale = max(s for _, s in sizes)
            whole = max(p - s for p, s in sizes)
            return f"decimal({whole + scale},{scale})" if whole + scale <= 38 else "string"
        return "double"
    if family == "boolean":
        return "boolean"
    if family == "datetime":
        kinds = {e.dtype.simpleString() for e in members}
        return kinds.pop() if len(kinds) == 1 else "timestamp_ntz"
    return "string"


def _common_value(entry: Entry, cls: str) -> Column:
    if cls == "string" and entry.family == "numeric":
        # too wide for one decimal type: compared by their digits
        text = ref(entry.column).cast("string")
        digits = F.when(F.contains(text, F.lit(".")), F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)
        return F.when(digits == "-0", "0").otherwise(digits)
    if cls == "string":
        return compact(text_key(ref(entry.column), entry.dtype))
    return ref(entry.column).cast(cls)


def _overlaps(tables: Tables, pairs: list[tuple[int, tuple[Entry, Entry]]]) -> DataFrame:
    """(seq, child_values, parent_values, shared_values) of distinct values, for all pairs in one shuffle per value type.

    Each distinct value of a group is reduced to a bit mask of the columns
    that hold it, and masks are counted: no self-join, no pairs per value. A
    value that fills a third of a table is one row per map task in the
    shuffle. Pairs of different families are not compared: only the values of
    their parent are counted.
    """
    spark = next(iter(tables.values())).sparkSession
    groups: dict[tuple[str, str], list[Entry]] = {}
    for _, (child, parent) in pairs:
        members = groups.setdefault((parent.normalized, parent.family), [])
        compared = (child, parent) if child.family == parent.family else (parent,)
        members += [e for e in compared if e not in members]
    place = {(e.dataset, e.column): (g, b) for g, m in enumerate(groups.values()) for b, e in enumerate(m)}
    parts: dict[str, dict[str, dict[int, Column]]] = {}
    width = 1 + max((len(m) for m in groups.values()), default=0)
    for (_, family), members in groups.items():
        cls = _common_class(family, members)
        for e in members:
            g, b = place[(e.dataset, e.column)]
            parts.setdefault(cls, {}).setdefault(e.dataset, {})[g * width + b] = _common_value(e, cls)
    words = range(-(-width // _MASK_BITS))
    counted = []
    for of_tables in parts.values():
        values = union_all([melt(nan_to_null(tables[d]), v) for d, v in of_tables.items()])
        bit = F.col("ordinal") % width
        masks = [
            F.bit_or(
                F.when(
                    F.floor(bit / _MASK_BITS) == w,
                    F.expr(f"shiftleft(1L, ordinal % {width} % {_MASK_BITS})"),
                ).otherwise(F.lit(0).cast("bigint"))
            ).alias(f"m{w}")
            for w in words
        ]
        per_value = (
            values.where(F.col("value").isNotNull())
            .groupBy(F.floor(F.col("ordinal") / width).cast("int").alias("g"), "value")
            .agg(*masks)
        )
        counted.append(per_value.groupBy("g", *[f"m{w}" for w in words]).agg(F.count(F.lit(1)).alias("n")))
    schema = {"seq": "int", "g": "int", "child_bit": "int", "parent_bit": "int"}
    wanted = small_relation(
        spark,
        schema,
        [
            (s, g, place[(c.dataset, c.column)][1] if c.family == p.family else None, b)
            for s, (c, p) in pairs
            for g, b in [place[(p.dataset, p.column)]]
        ],
    )

    def holds(bit: str) -> Column:
        word = F.get(F.array(*[f"m{w}" for w in words]), F.floor(F.col(bit) / _MASK_BITS).cast("int"))
        return F.getbit(word, F.col(bit) % _MASK_BITS) == 1

    return (
        union_all(counted)
        .join(F.broadcast(wanted), "g")
        .groupBy("seq")
        .agg(
            F.sum(F.when(holds("child_bit"), F.col("n")).otherwise(0)).alias("child_values"),
            F.sum(F.when(holds("parent_bit"), F.col("n")).otherwise(0)).alias("parent_values"),
            F.sum(F.when(holds("child_bit") & holds("parent_bit"), F.col("n")).otherwise(0)).alias("shared_values"),
        )
    )


def containments(
    tables: Tables,
    pairs: list[tuple[Entry, Entry]],
    rules: Thresholds = DEFAULTS,
    unsure: Mapping[tuple[str, str], int] | None = None,
) -> DataFrame:
    """One row per (child, parent) pair with the share of distinct child values found in the parent.

    ``unsure``: parents without a gap, by (dataset, column), and the rows of their tables. The pairs of those that turn out
    to have fewer distinct values than rows are left out.
    """
    unsure = unsure or {}
    spark = next(iter(tables.values())).sparkSession
    strings = ("normalized_name", "child_dataset", "child_column", "parent_dataset", "parent_column")
    listed = small_relation(
        spark,
        {"seq": "int", **dict.fromkeys(strings, "string"), "dtype_compatible": "boolean", "parent_rows": "bigint"},
        [
            (s, c.normalized, c.dataset, c.column, p.dataset, p.column, c.family == p.family, unsure.get((p.dataset, p.column)))
            for s, (c, p) in enumerate(pairs)
        ],
    )
    compared = [
        (s, (c, p)) for s, (c, p) in enumerate(pairs) if c.family == p.family or (p.dataset, p.column) in unsure
    ]
    if not compared:
        counted = listed.withColumns({n: F.lit(0).cast("bigint") for n in ("child_values", "shared_values")})
    else:
        # one row per pair of columns
        overlaps = _overlaps(tables, compared)
        counted = listed.join(F.broadcast(overlaps), "seq", "left").na.fill(0, ["child_values", "parent_values", "shared_values"])
        counted = counted.where("parent_rows IS NULL OR parent_values = parent_rows").drop("parent_values")
    counted = counted.drop("parent_rows")
    share = F.coalesce(F.col("shared_values") / F.nullif(F.col("child_values"), F.lit(0)), F.lit(0.0))
    return counted.withColumn("containment", share).withColumn(
        "compatibility", classify(F.col("containment"), F.col("dtype_compatible"), rules)
    )


def containment(
    child: DataFrame, child_column: str, parent: DataFrame, parent_column: str, rules: Thresholds = DEFAULTS
) -> DataFrame:
    """The containment of one column in another, whatever their names."""

    def entry(dataset: str, df: DataFrame, column: str) -> Entry:
        dtype = df.schema[column].dataType
        return Entry("value", dataset, column, dtype_family(dtype), dtype)

    pair = (entry("child", child, child_column), entry("parent", parent, parent_column))
    return containments({"child": child, "parent": parent}, [pair], rules).select(
        "child_column", "parent_column", "child_values", "shared_values", "containment", "compatibility"
    )


def _possible_parents(
    tables: Tables, groups: dict[str, list[Entry]]
) -> tuple[set[tuple[str, str]], dict[tuple[str, str], int]]:
    """Matched columns that are keys, and those of which a scan cannot tell, with the rows of their tables.

    Where the values of a group meet in another type, which may make two of
    them equal, keys are counted in their own type beforehand.
    """
    matched: dict[str, list[str]] = {}
    counted: dict[str, list[str]] = {}
    for group in groups.values():
        for e in group:
            same = [m.dtype for m in group if m.family == e.family]
            own = len(set(map(str, same))) == 1 or all(isinstance(d, INTEGRAL) for d in same)
            (matched if own else counted).setdefault(e.dataset, []).append(e.column)
    found = possible_key_rows({d: tables[d] for d in matched}, matched)
    unsure = {(d, c): n for d, columns in found.items() for c, n in columns.items() if n > 0}
    if not counted:
        return set(), unsure
    exact = all_single_keys({d: tables[d] for d in counted}, counted)
    return {(row["dataset"], row["column"]) for row in exact.collect()}, unsure


def foreign_keys(
    tables: Tables,
    rules: Thresholds = DEFAULTS,
    name_map: Mapping[str, str] | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Every matched column of another table against every single key, best first.

    (seq, normalized_name, child_dataset, child_column, parent_dataset,
    parent_column, containment, dtype_compatible, compatibility, ...)

    ``keys``: the (dataset, column) of all single keys, if they are known.
    Else the shuffle that compares the values also tells which parents are
    keys: a column without a gap is one if it has as many values as rows.
    """
    groups = match_groups(column_entries(tables, name_map))
    unsure: dict[tuple[str, str], int] = {}
    if keys is None:
        is_key, unsure = _possible_parents(tables, groups)
    else:
        is_key = {(row["dataset"], row["column"]) for row in keys.collect()}
    pairs = [
        (child, parent)
        for members in groups.values()
        for parent in members
        if (parent.dataset, parent.column) in is_key or (parent.dataset, parent.column) in unsure
        for child in members
        if child.dataset != parent.dataset
    ]
    return containments(tables, pairs, rules, unsure).orderBy(F.desc("containment"), "seq")


def linked(relationships: DataFrame) -> DataFrame:
    return relationships.where(F.col("compatibility").isin("Strong", "Moderate"))


def merge_guidance(relationships: DataFrame) -> DataFrame:
    """The best link of each unordered pair of tables."""
    of_pair = Window.partitionBy(
        F.least("child_dataset", "parent_dataset"), F.greatest("child_dataset", "parent_dataset")
    ).orderBy(F.desc("containment"), "seq")
    return linked(relationships).withColumn("place", F.row_number().over(of_pair)).where("place = 1").drop("place")


def standalone_tables(tables: Tables, relationships: DataFrame) -> DataFrame:
    """(dataset) without a link to any other; none are reported if there is no link at all."""
    links = linked(relationships).select(F.explode(F.array("child_dataset", "parent_dataset")).alias("dataset"))
    names = small_relation(links.sparkSession, {"dataset": "string"}, [(n,) for n in sorted(tables)])
    # links are at most one row per pair of columns
    marked = names.join(F.broadcast(links.distinct().withColumn("link", F.lit(True))), "dataset", "left")
    gathered = marked.agg(
        F.array_sort(F.collect_list(F.when(F.col("link").isNull(), F.col("dataset")))).alias("alone"),
        F.count("link").alias("links"),
    )
    return gathered.where("links > 0").select(F.explode("alone").alias("dataset"))


def relationship_summary(relationships: DataFrame) -> DataFrame:
    """(candidates, strong, moderate, weak)."""
    return relationships.agg(
        F.count(F.lit(1)).alias("candidates"),
        *[F.count_if(F.col("compatibility") == k).alias(k.lower()) for k in ("Strong", "Moderate", "Weak")],
    )


def contributions(tables: Tables, counts: Mapping[str, int] | None = None) -> DataFrame:
    """(dataset, rows, numeric_columns, text_columns, datetime_columns, likely_targets). ``counts``: rows, if they are known."""
    parts = []
    for dataset in sorted(tables):
        df = tables[dataset]

        def of_family(family: str) -> int:
            return len(columns_of(df.schema, lambda dtype: dtype_family(dtype) == family))

        targets = [
            c
            for c in df.columns
            if c.lower().rpartition("_")[2] in CONTRIBUTION_TARGET_WORDS
        ]
        parts.append(
            row_count(df, (counts or {}).get(dataset)).select(
                F.lit(dataset).alias("dataset"),
                "rows",
                *[F.lit(of_family(k)).alias(f"{k}_columns") for k in ("numeric", "text", "datetime")],
                F.array(*[F.lit(c) for c in targets]).cast("array<string>").alias("likely_targets"),
            )
        )
    return union_all(parts)

