"""Column checks, roles, observations and advice.

Rows are read by ``column_stats`` and ``duplicate_columns`` only. Every rule
after that works on one row per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.config import DEFAULTS, TARGET_WORDS, Thresholds
from assayer.functions.columns import nan_to_null, ref, text_key
from assayer.functions.relations import small_relation
from assayer.functions.types import FLOATING, INTEGRAL, is_categorical, is_numeric, storage_label
from assayer.operators.correlation import strongest
from assayer.operators.frequency import column_stats, labelled

_LANE = 0xFFFFF


def _comparable(df: DataFrame, name: str, missing: int) -> tuple[str, Column]:
    """Type under which a column may equal another one, and its value in that type."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, INTEGRAL + FLOATING) and storage_label(dtype, missing > 0) == "float64":
        return "float64", ref(name).cast("double") + F.lit(0.0)
    if is_numeric(dtype) or is_categorical(dtype) or dtype.typeName().startswith(("date", "timestamp")):
        return dtype.simpleString(), ref(name)
    return dtype.simpleString(), text_key(ref(name), dtype)


def duplicate_columns(df: DataFrame) -> DataFrame:
    """(ordinal_a, ordinal_b, column, other_column): equal type and equal values in every row.

    One scan takes a fingerprint of each column. Only columns with equal
    fingerprints are compared row by row, in a second scan. The driver sees
    one number triple per column.
    """
    df = nan_to_null(df)
    schema = {"ordinal_a": "int", "ordinal_b": "int", "column": "string", "other_column": "string"}
    if not df.columns:
        return small_relation(df.sparkSession, schema, [])
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(ref(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    counts = counted.first()
    typed = [_comparable(df, c, counts["rows"] - counts[f"n{i}"]) for i, c in enumerate(df.columns)]
    kinds: dict[tuple, list[int]] = {}
    for i, (kind, _) in enumerate(typed):
        kinds.setdefault((kind, counts[f"n{i}"]), []).append(i)
    rivals = [i for members in kinds.values() if len(members) > 1 for i in members]
    groups: dict[tuple, list[int]] = {}
    if rivals:
        prints = []
        for i in rivals:
            digest = F.xxhash64(typed[i][1])
            prints += [
                F.coalesce(F.bit_xor(digest), F.lit(0)).alias(f"x{i}"),
                F.coalesce(F.sum(digest.bitwiseAND(F.lit(_LANE))), F.lit(0)).alias(f"s{i}"),
            ]
        found = df.agg(*prints).first()
        for i in rivals:
            key = (typed[i][0], counts[f"n{i}"], found[f"x{i}"], found[f"s{i}"])
            groups.setdefault(key, []).append(i)
    pairs = []
    waiting = [members for members in groups.values() if len(members) > 1]
    while waiting:
        # equality is transitive: comparing with the first member of a group is enough
        checks = [
            F.coalesce(F.bool_and(typed[m[0]][1].eqNullSafe(typed[j][1])), F.lit(True)).alias(f"{m[0]}_{j}")
            for m in waiting
            for j in m[1:]
        ]
        equal = df.agg(*checks).first()
        following = []
        for m in waiting:
            same = [m[0]] + [j for j in m[1:] if equal[f"{m[0]}_{j}"]]
            pairs += [(a, b) for k, a in enumerate(same) for b in same[k + 1 :]]
            rest = [j for j in m if j not in same]
            if len(rest) > 1:
                following.append(rest)
        waiting = following
    return small_relation(
        df.sparkSession, schema, [(a, b, df.columns[a], df.columns[b]) for a, b in sorted(pairs)]
    )


def column_facts(
    df: DataFrame, rules: Thresholds = DEFAULTS, duplicates: DataFrame | None = None
) -> DataFrame:
    """One row per column: base statistics and the outcome of every check."""
    df = nan_to_null(df)
    duplicates = duplicate_columns(df) if duplicates is None else duplicates
    copies = {row["ordinal_b"] for row in duplicates.collect()}
    names = small_relation(
        df.sparkSession,
        {
            "ordinal": "int",
            "is_numeric": "boolean",
            "is_categorical": "boolean",
            "names_id": "boolean",
            "names_target": "boolean",
            "is_copy": "boolean",
        },
        [
            (
                i,
                is_numeric(f.dataType),
                is_categorical(f.dataType),
                "id" in f.name.lower(),
                not set(TARGET_WORDS).isdisjoint(f.name.lower().split("_")),
                i in copies,
            )
            for i, f in enumerate(df.schema.fields)
        ],
    )
    ratio = F.col("n_unique") / F.nullif(F.col("rows"), F.lit(0))
    facts = (
        labelled(df, column_stats(df))
        .join(F.broadcast(names), "ordinal")
        .withColumn("unique_ratio", F.coalesce(ratio, F.lit(0.0)))
    )
    near_unique = (F.col("unique_ratio") >= rules.id_unique_ratio) & F.col("label").isin("int64", "str", "object")
    by_name = F.col("names_id") & (F.col("unique_ratio") > rules.id_name_ratio)
    many_values = (F.col("n_unique") >= rules.high_cardinality_min) & (
        F.col("unique_ratio") >= rules.high_cardinality_ratio
    )
    checked = facts.withColumns(
        {
            "is_constant": F.col("n_unique") <= 1,
            "is_empty": F.col("n_nonnull") == 0,
            "is_high_missing": F.col("missing_pct") > rules.high_missing_pct,
            "is_identifier": (F.col("rows") > 0) & (near_unique | by_name),
            "is_high_cardinality": (F.col("rows") > 0) & F.col("is_categorical") & many_values,
        }
    )
    dropped = F.col("is_constant") | F.col("is_empty") | F.col("is_high_missing") | F.col("is_copy")
    is_target = F.col("names_target") & ~F.col("is_identifier")
    return checked.withColumns(
        {
            "is_drop": dropped,
            "is_target": is_target,
            "is_feature": ~F.col("is_identifier") & ~dropped & ~is_target,
            "is_ignored": dropped | F.col("is_identifier"),
        }
    )


def _tags(facts: DataFrame, name: str, tags: dict[str, Column]) -> DataFrame:
    """One row per column and tag that applies."""
    chosen = [F.when(applies, F.lit(tag)) for tag, applies in tags.items()]
    return facts.withColumn(name, F.explode(F.array_compact(F.array(*chosen))))


def quality_findings(facts: DataFrame, duplicates: DataFrame) -> DataFrame:
    """(check, column, other_column) of all six checks."""
    single = _tags(
        facts,
        "check",
        {
            "constant": F.col("is_constant"),
            "empty": F.col("is_empty"),
            "high_missing": F.col("is_high_missing"),
            "identifier": F.col("is_identifier"),
            "high_cardinality": F.col("is_high_cardinality"),
        },
    ).select("check", "column", F.lit(None).cast("string").alias("other_column"))
    return single.unionByName(
        duplicates.select(F.lit("duplicate").alias("check"), "column", "other_column")
    )


def column_roles(facts: DataFrame) -> DataFrame:
    """(ordinal, column, bucket); a column may be in more than one bucket."""
    return _tags(
        facts,
        "bucket",
        {
            "features": F.col("is_feature"),
            "targets": F.col("is_target"),
            "identifiers": F.col("is_identifier"),
            "drop": F.col("is_drop"),
        },
    ).select("ordinal", "column", "bucket")


def role_lists(facts: DataFrame) -> DataFrame:
    """(bucket, columns): features and targets in column order, the others by name."""
    place = F.when(F.col("bucket").isin("features", "targets"), F.col("ordinal")).otherwise(F.lit(0))
    gathered = column_roles(facts).groupBy("bucket").agg(
        F.array_sort(F.collect_list(F.struct(place.alias("place"), "column"))).alias("found")
    )
    return gathered.select("bucket", F.col("found.column").alias("columns"))


def _names(applies: Column) -> Column:
    """Names of the columns of the table for which a flag holds, in column order."""
    listed = F.array_sort(F.collect_list(F.when(applies, F.struct("ordinal", "column"))))
    return listed["column"]


def _rule(place: int, rule: str, applies: Column, columns: Column, value: Column, text: Column) -> Column:
    return F.when(
        applies,
        F.struct(
            F.lit(place).alias("place"),
            F.lit(rule).alias("rule"),
            columns.alias("columns"),
            value.cast("double").alias("value"),
            text.alias("text"),
        ),
    )


def _list_rule(place: int, rule: str, names: str, advice: str) -> Column:
    text = F.concat(F.array_join(names, ", "), F.lit(f": {advice}"))
    return _rule(place, rule, F.size(names) > 0, F.col(names), F.size(names), text)


def observations(
    facts: DataFrame, duplicates: DataFrame, pairs: DataFrame, outliers: DataFrame, rules: Thresholds = DEFAULTS
) -> DataFrame:
    """(seq, rule, columns, value, text): what stands out in a table, in fixed order.

    Correlations that agree in nine decimals are equally strong; their pairs follow in the order of the columns.
    """
    summary = facts.agg(
        F.max(F.when(F.col("missing") > 0, F.struct("missing_pct", (-F.col("ordinal")).alias("o"), "column"))).alias("worst"),
        _names(F.col("is_high_missing")).alias("high_missing"),
        _names(F.col("is_constant")).alias("constant"),
        _names(F.col("is_empty")).alias("empty"),
        _names(F.col("is_target")).alias("targets"),
        F.array_sort(F.collect_list(F.when(F.col("is_identifier"), F.col("column")))).alias("identifiers"),
        _names(F.col("is_high_cardinality")).alias("many_values"),
        _names(F.col("is_feature")).alias("features"),
    )
    worst = F.col("worst")
    none = F.array().cast("array<string>")
    has_high = worst.isNotNull() & (F.size("high_missing") > 0)
    of_columns = [
        _rule(1, "no_missing", worst.isNull(), none, F.lit(0), F.lit("no column has a missing value")),
        _rule(
            1,
            "most_missing",
            worst.isNotNull(),
            F.array(worst["column"]),
            worst["missing_pct"],
            F.concat(worst["column"], F.lit(" misses most values: "), F.format_string("%.1f%%", worst["missing_pct"])),
        ),
        _rule(
            2,
            "high_missing",
            has_high,
            F.col("high_missing"),
            F.size("high_missing"),
            F.concat(F.array_join("high_missing", ", "), F.lit(f": more than {rules.high_missing_pct:.0f}% missing")),
        ),
        _list_rule(5, "constant", "constant", "one value only, no signal"),
        _list_rule(6, "empty", "empty", "no value at all"),
        _list_rule(8, "targets", "targets", "may be targets, keep them out of the features"),
        _list_rule(9, "identifiers", "identifiers", "identify rows, keep them out of the features"),
        _list_rule(10, "high_cardinality", "many_values", "too many values for one-hot encoding"),
        _list_rule(11, "features", "features", "usable as features"),
        _rule(11, "no_features", F.size("features") == 0, none, F.lit(0), F.lit("no column stands out as a feature")),
    ]
    about_columns = summary.select(F.inline(F.array_compact(F.array(*of_columns))))
    strong = strongest(pairs, rules)
    top = strong.agg(
        F.slice(
            F.array_sort(
                F.collect_list(F.struct((-F.round(F.abs("r"), 9)).alias("k"), "ordinal_a", "ordinal_b", "col_a", "col_b", "r"))
            ),
            1,
            rules.observed_pairs,
        ).alias("found")
    )
    named = F.transform("found", lambda p: F.concat(p["col_a"], F.lit(" & "), p["col_b"]))
    shown = F.transform(
        "found", lambda p: F.concat(p["col_a"], F.lit(" & "), p["col_b"], F.format_string(" (r=%.2f)", p["r"]))
    )
    about_pairs = top.select(
        F.inline(
            F.array_compact(
                F.array(
                    _rule(
                        3,
                        "high_correlation",
                        F.size("found") > 0,
                        named,
                        F.size("found"),
                        F.concat(F.array_join(shown, "; "), F.lit(": redundant, or one leaks the other")),
                    )
                )
            )
        )
    )
    most = F.max(F.struct("outliers", (-F.col("ordinal")).alias("o"), "column"))
    about_outliers = (
        outliers.where(F.col("outliers") > 0)
        .agg(most.alias("most"))
        .select(
            F.inline(
                F.array_compact(
                    F.array(
                        _rule(
                            4,
                            "most_outliers",
                            F.col("most").isNotNull(),
                            F.array(F.col("most.column")),
                            F.col("most.outliers"),
                            F.concat(
                                F.col("most.column"),
                                F.lit(" has most values outside the fence: "),
                                F.col("most.outliers").cast("string"),
                            ),
                        )
                    )
                )
            )
        )
    )
    equal = duplicates.agg(
        F.array_sort(F.collect_list(F.struct("ordinal_a", "ordinal_b", "column", "other_column"))).alias("found")
    ).withColumn("names", F.transform("found", lambda p: F.concat(p["other_column"], F.lit(" = "), p["column"])))
    about_copies = equal.select(
        F.inline(F.array_compact(F.array(_list_rule(7, "duplicate_columns", "names", "keep one of each"))))
    )
    collected = (
        about_columns.unionByName(about_pairs)
        .unionByName(about_outliers)
        .unionByName(about_copies)
        .agg(F.array_sort(F.collect_list(F.struct("place", "rule", "columns", "value", "text"))).alias("all"))
    )
    return collected.select(F.posexplode("all").alias("pos", "o")).select(
        (F.col("pos") + 1).alias("seq"), "o.rule", "o.columns", "o.value", "o.text"
    )


def recommendations(facts: DataFrame) -> DataFrame:
    """(section, action, ordinal, column); a section without advice has the action 'none'."""
    some_missing = (F.col("missing") > 0) & ~F.col("is_high_missing")
    kept = ~F.col("is_ignored")
    tags = {
        "cleaning/drop_empty": F.col("is_empty"),
        "cleaning/drop_constant": F.col("is_constant"),
        "cleaning/drop_duplicate": F.col("is_copy"),
        "cleaning/drop_high_missing": F.col("is_high_missing"),
        "cleaning/impute_median": F.col("is_numeric") & some_missing,
        "cleaning/impute_mode": F.col("is_categorical") & some_missing,
        "encoding/one_hot": F.col("is_categorical") & ~F.col("is_high_cardinality") & kept,
        "encoding/hash_or_target": F.col("is_high_cardinality") & kept,
        "scaling/scale": F.col("is_numeric") & kept,
        "ignore/ignore": F.col("is_ignored"),
        "keep/keep": F.col("is_feature"),
    }
    advised = _tags(facts, "tag", tags).select(
        F.split_part("tag", F.lit("/"), F.lit(1)).alias("section"),
        F.split_part("tag", F.lit("/"), F.lit(2)).alias("action"),
        "ordinal",
        "column",
    )
    sections = small_relation(
        facts.sparkSession, {"section": "string"}, [(s,) for s in ("cleaning", "encoding", "scaling", "ignore", "keep")]
    )
    # advice is a few rows per column of the table
    return sections.join(F.broadcast(advised), "section", "left").select(
        "section", F.coalesce("action", F.lit("none")).alias("action"), "ordinal", "column"
    )
