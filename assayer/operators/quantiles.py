"""Exact quantiles with linear interpolation, without one task holding a column.

Spark's own ``percentile`` ends in one task with every distinct value of the
column. Here a table of up to ``exact_rank_rows`` rows is ranked through its
counted distinct values. In a longer one a histogram, whose bins widen with
the distance from the minimum, tells a bracket around each quantile, and only
the rows strictly inside the bracket are ranked. Where a bin holds too many
rows, an approximate sketch proposes a smaller bracket and exact counts confirm
it. Brackets cost scans, not shuffles: a round divides the rows that are left
by some thousands.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assayer.config import LIMITS, Limits
from assayer.functions.columns import nan_to_null, numeric_columns, numeric_value
from assayer.functions.relations import melt, small_relation

QUARTILES = (0.25, 0.50, 0.75)

# Bins of the histogram for each doubling of the distance, and a distance (as power of 2) no double reaches.
_BINS, _FARTHEST = 1024, 1100.0


def _interpolate(lo: Column, hi: Column, weight: Column) -> Column:
    return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * weight)


def _ranked_whole(df: DataFrame, values: dict[int, Column], probs: tuple[float, ...]) -> DataFrame:
    """Quantiles of columns whose number of rows is known to be bounded."""
    counts = (
        melt(df, values).where(F.col("value").isNotNull()).groupBy("ordinal", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy("ordinal").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("ordinal").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = counts.withColumn("seen", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(whole))
    picks, results = [], []
    for j, p in enumerate(probs):
        place = F.lit(p) * (F.col("total") - 1)
        picks += [
            F.min(F.when(F.col("seen") > F.floor(place), F.col("value"))).alias(f"lo{j}"),
            F.min(F.when(F.col("seen") > F.ceil(place), F.col("value"))).alias(f"hi{j}"),
        ]
        place = F.lit(p) * (F.col("total") - 1)
        results.append(_interpolate(F.col(f"lo{j}"), F.col(f"hi{j}"), place - F.floor(place)))
    return (
        ranked.groupBy("ordinal")
        .agg(F.max("total").alias("total"), *picks)
        .select("ordinal", F.array(*results).alias("quantiles"))
    )


@dataclass
class _Bracket:
    """Where the ranks ``low`` and ``high`` (from 0) of one column lie.

    Without edges it is the whole column. With edges, ``below`` rows come
    before the lower one, ``at_lower`` rows equal it and ``interior`` rows lie
    strictly between both.
    """

    ordinal: int
    slot: int
    place: float
    interior: int
    edges: tuple[float, float] | None = None
    below: int = 0
    at_lower: int = 0
    spread: float = 1.0

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.place), math.ceil(self.place)

    def interior_value(self, value: Column) -> Column:
        if self.edges is None:
            return value
        return F.when((value > F.lit(self.edges[0])) & (value < F.lit(self.edges[1])), value)

    def settle(self, rank: int) -> tuple[float | None, int | None]:
        """The value at a rank if an edge has it, else its rank inside."""
        if self.edges is None:
            return None, rank
        inside = rank - self.below - self.at_lower
        if inside < 0:
            return self.edges[0], None
        return (None, inside) if inside < self.interior else (self.edges[1], None)

    @property
    def is_open(self) -> bool:
        """Some rank lies strictly inside."""
        return any(self.settle(rank)[0] is None for rank in self.ranks)


def _outline(df: DataFrame, values: dict[int, Column], brackets: list[_Bracket], lows: dict[int, float]) -> None:
    """First brackets, from the bin that holds the lower rank. They need no confirmation: the bins are counted exactly.

    A bin follows from the logarithm of the distance from the minimum (``lows``, finite), so bins are in the order of the
    values. The driver sees one bin per bracket.
    """
    places = [(k, b.ordinal, b.ranks[0]) for k, b in enumerate(brackets) if b.ordinal in lows]
    if not places:
        return
    low = F.get(F.array(*[F.lit(lows.get(i)).cast("double") for i in range(max(lows) + 1)]), F.col("ordinal"))
    bin_of = F.floor(F.least(F.log2(F.col("value") - low + 1.0), F.lit(_FARTHEST)) * _BINS)
    bins = (
        melt(df, {i: values[i] for i in lows})
        .where(F.col("value").isNotNull())
        .groupBy("ordinal", bin_of.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("first"), F.max("value").alias("last"))
    )
    in_order = Window.partitionBy("ordinal").orderBy("bin")
    ranked = bins.withColumns(
        {
            "seen": F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, 0)),
            "before": F.lag("last").over(in_order),
            "after": F.lead("first").over(in_order),
        }
    )
    wanted = small_relation(df.sparkSession, {"bracket": "int", "ordinal": "int", "rank": "bigint"}, places)
    holding = ranked.join(F.broadcast(wanted), "ordinal").where(
        (F.col("rank") < F.col("seen")) & (F.col("rank") >= F.col("seen") - F.col("n"))
    )
    for found in holding.collect():  # one row per quantile of a column
        b = brackets[found["bracket"]]
        after = math.inf if found["after"] is None else found["after"]
        b.below = found["seen"] - found["n"]
        if found["first"] == found["last"]:
            b.edges, b.at_lower, b.interior = (found["first"], after), found["n"], 0
        else:
            # the bin before counts as below, its last value included
            b.edges, b.interior = (-math.inf if found["before"] is None else found["before"], after), found["n"]


def _propose(df: DataFrame, values: dict[int, Column], pending: list[_Bracket], limits: Limits) -> list[tuple]:
    """Approximate edges for every bracket; one sketch serves all brackets of one range."""
    step = 3.0 / limits.sketch_accuracy
    ranges: dict[tuple, list[float]] = {}
    slots: list[list] = []
    for b in pending:
        start = b.below + b.at_lower
        wanted = (
            (b.ranks[0] - start) / b.interior - step * b.spread,
            (b.ranks[1] - start + 1) / b.interior + step * b.spread,
        )
        fractions = ranges.setdefault((b.ordinal, b.edges), [])
        found: list = []
        for side, p in enumerate(wanted):
            if b.edges is not None and not 0.0 < p < 1.0:
                # the rank may lie on the edge itself, which stays
                found.append(("edge", b.edges[side]))
            else:
                found.append(("sketch", (b.ordinal, b.edges), len(fractions)))
                fractions.append(min(1.0, max(0.0, p)))
        slots.append(found)
    sketched = {k: p for k, p in ranges.items() if p}
    if not sketched:
        return [tuple(s[1] for s in pair) for pair in slots]
    of_range = {(b.ordinal, b.edges): b for b in pending}
    row = df.agg(
        *[
            F.percentile_approx(of_range[k].interior_value(values[k[0]]), p, limits.sketch_accuracy).alias(f"s{i}")
            for i, (k, p) in enumerate(sketched.items())
        ]
    ).first()
    answers = dict(zip(sketched, row))
    return [tuple(s[1] if s[0] == "edge" else answers[s[1]][s[2]] for s in pair) for pair in slots]


def _narrow(df: DataFrame, values: dict[int, Column], brackets: list[_Bracket], limits: Limits) -> None:
    """Shrink every bracket until few rows lie strictly inside it. Proposals count only once confirmed."""
    for _ in range(30):
        pending = [b for b in brackets if b.is_open and b.interior > limits.exact_rank_rows]
        if not pending:
            return
        proposed = _propose(df, values, pending, limits)
        checks = []
        for i, (b, (lo, hi)) in enumerate(zip(pending, proposed)):
            v = values[b.ordinal]
            checks += [
                F.count_if(v < F.lit(lo)).alias(f"b{i}"),
                F.count_if(v == F.lit(lo)).alias(f"l{i}"),
                F.count_if((v > F.lit(lo)) & (v < F.lit(hi))).alias(f"t{i}"),
                F.count_if(v <= F.lit(hi)).alias(f"u{i}"),
            ]
        exact = df.agg(*checks).first()
        for i, (b, edges) in enumerate(zip(pending, proposed)):
            low, high = b.ranks
            if exact[f"b{i}"] <= low and exact[f"u{i}"] > high:
                b.edges, b.below, b.at_lower, b.interior = edges, exact[f"b{i}"], exact[f"l{i}"], exact[f"t{i}"]
            else:
                b.spread *= 4


def _read_off(df: DataFrame, values: dict[int, Column], brackets: list[_Bracket], slots: int) -> DataFrame:
    """Values at the ranks: from an edge, or by ranking the few rows strictly inside a bracket."""
    rows, open_brackets = [], []
    for k, b in enumerate(brackets):
        (lo_value, lo_rank), (hi_value, hi_rank) = map(b.settle, b.ranks)
        rows.append((k, b.ordinal, b.slot, b.place - b.ranks[0], lo_value, lo_rank, hi_value, hi_rank))
        if lo_value is None or hi_value is None:
            open_brackets.append(k)
    schema = {"bracket": "int", "ordinal": "int", "slot": "int", "weight": "double"}
    schema |= {"lo_value": "double", "lo_rank": "bigint", "hi_value": "double", "hi_rank": "bigint"}
    places = small_relation(df.sparkSession, schema, rows)
    if open_brackets:
        inside = {k: brackets[k].interior_value(values[brackets[k].ordinal]) for k in open_brackets}
        # only rows inside some bracket are melted
        held = df.where(reduce(lambda a, b: a | b, [v.isNotNull() for v in inside.values()]))
        counts = (
            melt(held, inside)
            .where(F.col("value").isNotNull())
            .groupBy(F.col("ordinal").alias("bracket"), "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        upto = Window.partitionBy("bracket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        ranked = (
            counts.withColumn("seen", F.sum("n").over(upto))
            .join(F.broadcast(places.select("bracket", "lo_rank", "hi_rank")), "bracket")
            .groupBy("bracket")
            .agg(
                F.min(F.when(F.col("seen") > F.col("lo_rank"), F.col("value"))).alias("lo_found"),
                F.min(F.when(F.col("seen") > F.col("hi_rank"), F.col("value"))).alias("hi_found"),
            )
        )
        # one row per quantile of a column
        settled = places.join(F.broadcast(ranked), "bracket", "left")
        lo, hi = F.coalesce("lo_value", "lo_found"), F.coalesce("hi_value", "hi_found")
    else:
        settled, lo, hi = places, F.col("lo_value"), F.col("hi_value")
    quantile = settled.withColumn("quantile", _interpolate(lo, hi, F.col("weight")))
    by_slot = [F.max(F.when(F.col("slot") == j, F.col("quantile"))) for j in range(slots)]
    return quantile.groupBy("ordinal").agg(F.array(*by_slot).alias("quantiles"))


def exact_quantiles(
    df: DataFrame,
    columns: list[str] | None = None,
    probs: tuple[float, ...] = QUARTILES,
    limits: Limits = LIMITS,
) -> DataFrame:
    """(ordinal, quantiles array): one row per column that has a value."""
    df = nan_to_null(df)
    chosen = set(numeric_columns(df) if columns is None else columns)
    values = {i: numeric_value(c) for i, c in enumerate(df.columns) if c in chosen}
    if not values:
        return _read_off(df, values, [], len(probs))
    found = []
    ordinals = list(values)
    # a task holds one sketch per column, so wide tables go in several passes over few columns each
    for start in range(0, len(ordinals), limits.sketched_columns):
        chunk = {i: values[i] for i in ordinals[start : start + limits.sketched_columns]}
        ends = [e for i, v in chunk.items() for e in (F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"))]
        known = df.agg(F.count(F.lit(1)).alias("rows"), *ends).first()
        if known["rows"] <= limits.exact_rank_rows:
            return _ranked_whole(df, values, probs)
        brackets = [
            _Bracket(i, j, p * (known[f"n{i}"] - 1), known[f"n{i}"])
            for i in chunk
            for j, p in enumerate(probs)
            if known[f"n{i}"]
        ]
        lows = {b.ordinal: known[f"lo{b.ordinal}"] for b in brackets}
        finite = {i: lo for i, lo in lows.items() if math.isfinite(lo) and math.isfinite(known[f"hi{i}"])}
        _outline(df, chunk, brackets, finite)
        _narrow(df, chunk, brackets, limits)
        found.append(_read_off(df, chunk, brackets, len(probs)))
    return reduce(DataFrame.unionByName, found)


def approximate_quantiles(
    df: DataFrame,
    columns: list[str] | None = None,
    probs: tuple[float, ...] = QUARTILES,
    limits: Limits = LIMITS,
) -> DataFrame:
    """(ordinal, quantiles array) from sketches: an opt-in where one pass must do."""
    df = nan_to_null(df)
    chosen = set(numeric_columns(df) if columns is None else columns)
    values = {i: numeric_value(c) for i, c in enumerate(df.columns) if c in chosen}
    return (
        melt(df, values)
        .where(F.col("value").isNotNull())
        .groupBy("ordinal")
        .agg(F.percentile_approx("value", list(probs), limits.sketch_accuracy).alias("quantiles"))
    )
