"""Left joins that keep every left row, and what there is to know about them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.config import LIMITS, Limits
from assayer.functions.columns import nan_to_null, ref
from assayer.operators.frequency import logical_size


def _folded(df: DataFrame) -> Callable[[str], str]:
    """Names as the session tells them apart: without case unless it is set to mind case."""
    minds = df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    return str if minds else str.lower


def rename_collisions(left: DataFrame, right: DataFrame, key: str, suffix: str) -> DataFrame:
    """Right columns that exist on the left get the suffix; the key keeps its name."""
    fold = _folded(left)
    taken = {fold(c) for c in left.columns}
    names = [c + suffix if fold(c) in taken and fold(c) != fold(key) else c for c in right.columns]
    added = [fold(c) for c in names if fold(c) != fold(key)]
    doubled = sorted(c for c, n in Counter(added).items() if n > 1 or c in taken)
    if doubled:
        raise ValueError(f"suffix {suffix!r} does not make the joined names unique: {doubled}")
    return right.toDF(*names)


def _place(df: DataFrame, key: str) -> int:
    fold = _folded(df)
    return [fold(c) for c in df.columns].index(fold(key))


def fits_broadcast(df: DataFrame, limits: Limits = LIMITS) -> bool:
    """Measured in one scan without a shuffle, not guessed."""
    return logical_size(df).first()["bytes"] <= limits.broadcast_bytes


def hot_keys(df: DataFrame, key: str, limits: Limits = LIMITS) -> list:
    """Key values, null among them, that hold more than ``hot_key_share`` of the rows.

    At most 1 / hot_key_share values can, so the list is short at any size.
    """
    counts = df.groupBy(ref(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    return [row["key"] for row in counts.where(F.col("n") > F.lit(total * limits.hot_key_share)).collect()]


def _is_one_of(value: Column, keys: list) -> Column:
    found = value.isin([k for k in keys if k is not None])
    found = F.coalesce(found, F.lit(False))
    return found | value.isNull() if None in keys else found


def _salt(left: DataFrame, key: str, salts: int) -> Column:
    """A salt from the content of a row, so that a task run again after a loss gives the same one.

    Rows of a table that is nothing but the key are all alike; they are told apart by their place in the task.
    """
    content = [ref(f.name) for f in left.schema.fields if f.name != key and "map<" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*(content or [F.monotonically_increasing_id()])), F.lit(salts)).cast("int")


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    suffix: str = "_right",
    null_safe: bool = False,
    limits: Limits = LIMITS,
    same_keys: DataFrame | None = None,
) -> DataFrame:
    """All left rows, enriched. With ``null_safe`` a missing key meets a missing key.

    The right side is measured first. Up to ``broadcast_bytes`` it is
    broadcast and the left side does not move. Beyond that both sides are
    shuffled by key, and the rows of keys that hold a large share of the left
    rows are spread over several join partitions; the few right rows of such a
    key are repeated once per salt. ``same_keys`` is a table with the same
    keys as often as the left one, if there is one that is cheaper to read.
    """
    left, right = nan_to_null(left), nan_to_null(right)
    renamed = rename_collisions(left, right, key, suffix)
    at, other = _place(left, key), _place(renamed, key)
    # own names for the join, which no column of either side can have
    names, added = left.columns, [c for i, c in enumerate(renamed.columns) if i != other]
    small = fits_broadcast(right, limits)
    keys = [] if small else hot_keys(left if same_keys is None else same_keys, key, limits)
    salt = _salt(left, names[at], limits.salts)
    probe = left.select(*[ref(c).alias(f"l{i}") for i, c in enumerate(names)], *([salt.alias("salt")] if keys else []))
    build = renamed.toDF(*[f"r{i}" for i in range(len(renamed.columns))])
    mine, theirs = F.col(f"l{at}"), F.col(f"r{other}")
    condition = mine.eqNullSafe(theirs) if null_safe else mine == theirs
    if keys:
        probe = probe.withColumn("salt", F.when(_is_one_of(mine, keys), F.col("salt")).otherwise(F.lit(0)))
        every = F.when(_is_one_of(theirs, keys), F.sequence(F.lit(0), F.lit(limits.salts - 1))).otherwise(F.array(F.lit(0)))
        build = build.withColumn("right_salt", F.explode(every))
        condition = condition & (F.col("salt") == F.col("right_salt"))
    joined = probe.join(F.broadcast(build) if small else build, condition, "left")
    found = [f"r{i}" for i in range(len(renamed.columns)) if i != other]
    return joined.select(
        *[F.col(f"l{i}").alias(c) for i, c in enumerate(names)], *[F.col(f).alias(c) for f, c in zip(found, added)]
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """(duplicate_keys): non-null occurrences beyond the first of each value; 0 without the column."""
    if key not in df.columns:
        return df.agg(F.lit(0).cast("bigint").alias("duplicate_keys"))
    counts = nan_to_null(df).groupBy(ref(key).alias("key")).agg(F.count(ref(key)).alias("n"))
    return counts.agg(F.coalesce(F.sum(F.greatest(F.col("n") - 1, F.lit(0))), F.lit(0)).alias("duplicate_keys"))


def _key_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, left_rows, right_rows): both tables reduced to counts per key before they meet."""

    def counts(df: DataFrame, own: str, other: str) -> DataFrame:
        per_key = nan_to_null(df).groupBy(ref(key).alias("key")).agg(F.count(F.lit(1)).alias(own))
        return per_key.withColumn(other, F.lit(0).cast("bigint")).select("key", "left_rows", "right_rows")

    both = counts(left, "left_rows", "right_rows").union(counts(right, "right_rows", "left_rows"))
    return both.groupBy("key").agg(F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows"))


def unmatched_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(unmatched, null_keys): left rows, not distinct values."""
    return _key_counts(left, right, key).agg(
        F.coalesce(
            F.sum(F.when(F.col("key").isNotNull() & (F.col("right_rows") == 0), F.col("left_rows"))), F.lit(0)
        ).alias("unmatched"),
        F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("left_rows"))), F.lit(0)).alias("null_keys"),
    )


def join_diagnostics(
    left: DataFrame, right: DataFrame, key: str, suffix: str, step_name: str, null_safe: bool = False
) -> DataFrame:
    """One row about a left join, from counts per key: the join itself is not run.

    A key with n left and m right rows gives n * max(m, 1) rows.
    """
    known = F.col("key").isNotNull()
    matches = F.col("right_rows") if null_safe else F.when(known, F.col("right_rows")).otherwise(0)
    total = _key_counts(left, right, key).agg(
        F.coalesce(F.sum("left_rows"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.col("left_rows") * F.greatest(matches, F.lit(1))), F.lit(0)).alias("rows_after"),
        F.coalesce(F.sum("right_rows"), F.lit(0)).alias("right_rows"),
        F.coalesce(
            F.sum(F.when(known, F.greatest(F.col("right_rows") - 1, F.lit(0)))), F.lit(0)
        ).alias("duplicate_right_keys"),
        F.coalesce(F.sum(F.when(known & (F.col("right_rows") == 0), F.col("left_rows"))), F.lit(0)).alias("unmatched"),
        F.coalesce(F.sum(F.when(~known, F.col("left_rows"))), F.lit(0)).alias("null_keys"),
    )
    renamed = rename_collisions(left, right, key, suffix)
    added = [c for i, c in enumerate(renamed.columns) if i != _place(renamed, key)]
    return total.select(
        F.lit(step_name).alias("step_name"),
        F.lit(key).alias("join_key"),
        "rows_before",
        "rows_after",
        "right_rows",
        "duplicate_right_keys",
        "unmatched",
        "null_keys",
        F.array(*[F.lit(c) for c in added]).cast("array<string>").alias("added_columns"),
        (F.col("duplicate_right_keys") > 0).alias("fan_out_risk"),
        (F.col("rows_after") != F.col("rows_before")).alias("row_count_changed"),
        F.lit(False).alias("skipped"),
        F.lit(None).cast("string").alias("skip_reason"),
    )


def skipped_step(left: DataFrame, key: str, step_name: str, reason: str) -> DataFrame:
    """The diagnostics row of a join that could not be made; the left table is unchanged."""
    none = F.lit(None).cast("bigint")
    rows = F.count(F.lit(1))
    return left.agg(rows.alias("rows_before")).select(
        F.lit(step_name).alias("step_name"),
        F.lit(key).alias("join_key"),
        "rows_before",
        F.col("rows_before").alias("rows_after"),
        none.alias("right_rows"),
        none.alias("duplicate_right_keys"),
        none.alias("unmatched"),
        none.alias("null_keys"),
        F.array().cast("array<string>").alias("added_columns"),
        F.lit(False).alias("fan_out_risk"),
        F.lit(False).alias("row_count_changed"),
        F.lit(True).alias("skipped"),
        F.lit(reason).alias("skip_reason"),
    )


def collapse(
    df: DataFrame, key: str, value: str, joined: str, counted: str, separator: str = "; "
) -> DataFrame:
    """One row per key: its distinct values in order, joined, and their number.

    Pairs are made distinct first, which spreads a hot key over its values;
    only what the result holds anyway comes together per key.
    """
    pairs = nan_to_null(df).select(ref(key), ref(value).cast("string").alias("__value")).dropna().distinct()
    return pairs.groupBy(ref(key)).agg(
        F.array_join(F.sort_array(F.collect_list("__value")), separator).alias(joined),
        F.count(F.lit(1)).alias(counted),
    )
