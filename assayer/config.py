"""Fixed thresholds and word lists that decide findings."""

from __future__ import annotations

from dataclasses import dataclass

# Results depend on them, so they are kept together here.
CONTRIBUTION_TARGET_WORDS = ("target", "label", "salary", "outcome", "y")
TARGET_WORDS = (
    "target",
    "label",
    "y",
    "outcome",
    "hired",
    "hire",
    "selected",
    "selection",
    "status",
    "result",
    "score",
    "offer",
)
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")


@dataclass(frozen=True)
class Thresholds:
    """Every number a rule compares with. Fixed values, as results depend on them; pass a changed copy to override."""

    high_missing_pct: float = 70.0
    high_correlation: float = 0.80
    id_unique_ratio: float = 0.95
    id_name_ratio: float = 0.50
    high_cardinality_min: int = 50
    high_cardinality_ratio: float = 0.50
    strong_containment: float = 0.90
    moderate_containment: float = 0.60
    composite_ratio: float = 0.50
    composite_name_bonus: float = 0.05
    composite_columns: int = 6
    composite_listed: int = 3
    profile_top: int = 10
    explore_top: int = 20
    observed_pairs: int = 5
    iqr_factor: float = 1.5


DEFAULTS = Thresholds()


@dataclass(frozen=True)
class Limits:
    """Size bounds that choose a physical plan. They never change a result."""

    broadcast_bytes: int = 64 << 20
    hot_key_share: float = 0.01
    salts: int = 64
    exact_rank_rows: int = 1 << 20
    sketch_accuracy: int = 10_000
    sketched_columns: int = 24
    pairwise_columns: int = 3


LIMITS = Limits()
