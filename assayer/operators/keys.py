"""Single-column and two-column keys."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.config import DEFAULTS, Thresholds
from assayer.functions.columns import group_key, key_class, nan_to_null, ref
from assayer.functions.relations import melt, small_relation
from assayer.functions.types import FLOATING
from assayer.operators.frequency import column_stats, tables_stats, union_all


def single_keys(stats: DataFrame) -> DataFrame:
    """(ordinal, column): nothing missing and every value once; none in an empty table."""
    is_key = (F.col("rows") > 0) & (F.col("missing") == 0) & (F.col("n_unique") == F.col("rows"))
    return stats.where(is_key).select("ordinal", "column")


def possible_key_rows(
    tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]] | None = None, least_share: float = 0.5
) -> dict[str, dict[str, int]]:
    """Columns that one scan without a shuffle of values cannot rule out as key, by table, and the rows of the table.

    A gap rules a column out, and so does a range of whole numbers smaller
    than the number of rows, or a sketch that sees fewer values than
    ``least_share`` of the rows (its error is a few percent). The driver sees
    a few numbers per column.
    """
    parts, names = [], []
    for dataset in sorted(tables):
        df = nan_to_null(tables[dataset])
        chosen = set(df.columns if columns is None else columns.get(dataset, []))
        values = {}
        for f in df.schema.fields:
            if f.name in chosen:
                ranged = key_class(f.dataType) == "bigint"
                key = group_key(ref(f.name), f.dataType)
                values[len(names)] = key if ranged else F.when(ref(f.name).isNotNull(), F.xxhash64(key))
                names.append((dataset, f.name, ranged))
        if values:
            parts.append(melt(df, values))
    if not parts:
        return {}
    # combined to one row per column in every task; all tables share the shuffle
    found = (
        union_all(parts)
        .groupBy("ordinal")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("value").alias("n"),
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
            F.approx_count_distinct("value", 0.02).alias("about"),
        )
    )
    kept: dict[str, dict[str, int]] = {}
    for row in sorted(found.collect(), key=lambda r: r["ordinal"]):
        dataset, column, ranged = names[row["ordinal"]]
        short = ranged and row["rows"] > 0 and row["hi"] - row["lo"] + 1 < row["rows"]
        if row["n"] == row["rows"] and not short and row["about"] >= least_share * row["rows"]:
            kept.setdefault(dataset, {})[column] = row["rows"]
    return kept


def possible_keys(
    tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]] | None = None
) -> dict[str, list[str]]:
    """The columns that a gap or their range does not rule out."""
    return {dataset: list(found) for dataset, found in possible_key_rows(tables, columns, 0.0).items()}


def all_single_keys(
    tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]] | None = None
) -> DataFrame:
    """(dataset, ordinal, column) of the single keys of many tables, in one exact count of what remains."""
    kept = possible_keys(tables, columns)
    stats = tables_stats(tables, kept)
    is_key = (F.col("rows") > 0) & (F.col("missing") == 0) & (F.col("n_unique") == F.col("rows"))
    return stats.where(is_key).select("dataset", "ordinal", "column")


def key_candidates(stats: DataFrame, rules: Thresholds = DEFAULTS) -> DataFrame:
    """(ordinal, column, score, rank): the columns worth trying in pairs, best first."""
    ratio = F.col("n_unique") / F.nullif(F.col("rows"), F.lit(0))
    bonus = F.when(F.contains(F.lower("column"), F.lit("id")), rules.composite_name_bonus).otherwise(0.0)
    scored = stats.where(ratio >= rules.composite_ratio).select("ordinal", "column", (ratio + bonus).alias("score"))
    # one row per column of the table, so the global order is small
    best = scored.groupBy().agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("k"), "ordinal", "column", "score"))).alias("all")
    )
    ranked = best.select(F.posexplode(F.slice("all", 1, rules.composite_columns)).alias("pos", "c"))
    return ranked.select("c.ordinal", "c.column", "c.score", (F.col("pos") + 1).alias("rank"))


def composite_keys(df: DataFrame, stats: DataFrame, rules: Thresholds = DEFAULTS) -> DataFrame:
    """(column_a, column_b): pairs that are unique together.

    Looked for only if no single column is a key. Candidates with a gap, and
    pairs whose distinct counts cannot make enough combinations, are left out
    before any row is read.
    """
    df = nan_to_null(df)
    spark = df.sparkSession
    nothing = small_relation(spark, {"column_a": "string", "column_b": "string"}, [])
    known = {row["ordinal"]: row for row in stats.collect()}
    rows = max((r["rows"] for r in known.values()), default=0)
    if rows == 0 or any(r["missing"] == 0 and r["n_unique"] == rows for r in known.values()):
        return nothing
    listed = [r["ordinal"] for r in key_candidates(stats, rules).orderBy("rank").collect()]
    usable = [i for i in listed if known[i]["missing"] == 0]
    pairs = [(i, j) for i, j in combinations(usable, 2) if known[i]["n_unique"] * known[j]["n_unique"] >= rows]
    if not pairs:
        return nothing

    def key(i: int):
        field = df.schema.fields[i]
        value = group_key(ref(field.name), field.dataType)
        # adding zero makes -0.0 the 0.0 it equals, which their hashes would not be
        return value + F.lit(0.0) if isinstance(field.dataType, FLOATING) else value

    hashes = {p: F.xxhash64(key(p[0]), key(p[1])) for p in pairs}
    # A sketch without a shuffle rules out pairs that are far from unique; its error is a few percent at most.
    sketch = df.agg(*[F.approx_count_distinct(hashes[p], 0.02).alias(f"p{k}") for k, p in enumerate(pairs)])
    seen = sketch.first()
    pairs = [p for k, p in enumerate(pairs) if seen[f"p{k}"] >= 0.8 * rows]
    if not pairs:
        return nothing

    # Different hashes are different pairs. Where a hash occurs again, its rows tell a repeated pair from a collision.
    counted = melt(df, {k: hashes[p] for k, p in enumerate(pairs)}).groupBy("ordinal", "value").agg(F.count(F.lit(1)).alias("n"))
    again = dict(map(tuple, counted.where("n > 1").groupBy("ordinal").agg(F.min("value")).collect()))
    unique = [k for k, p in enumerate(pairs) if k not in again or not _repeated(df, hashes[p], key(p[0]), key(p[1]), again[k])]
    return small_relation(
        spark, {"column_a": "string", "column_b": "string"}, [(df.columns[pairs[k][0]], df.columns[pairs[k][1]]) for k in unique]
    )


def _repeated(df: DataFrame, hashed: Column, a: Column, b: Column, example: int) -> bool:
    """Whether two rows hold one pair of values: the rows of a hash that occurs again tell it, or else, as these may only
    collide, all rows."""
    for rows in (df.where(hashed == example), df):
        counted = rows.select(hashed.alias("h"), a.alias("a"), b.alias("b")).groupBy("h", "a", "b").agg(F.count(F.lit(1)).alias("n"))
        if counted.where("n > 1").take(1):
            return True
    return False


def table_keys(df: DataFrame, rules: Thresholds = DEFAULTS, stats: DataFrame | None = None) -> DataFrame:
    """(columns array, kind): single keys, or two-column ones where there is none."""
    stats = column_stats(df) if stats is None else stats
    single = single_keys(stats).select(F.array("column").alias("columns"), F.lit("single").alias("kind"))
    pair = composite_keys(df, stats, rules).select(
        F.array("column_a", "column_b").alias("columns"), F.lit("composite").alias("kind")
    )
    return single.unionByName(pair)
