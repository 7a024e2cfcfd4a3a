"""Induction parameters and their defaults."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field, fields
from typing import Any

from premisa.functions.measures import check_measure

Measure = str | Callable

# The public defaults of every induction option.
NO_LIMIT = 2147483647
SUPPORT_LEVELS = (0.8, 0.5, 0.2, 0.1)


@dataclass(frozen=True)
class InductionParams:
    """Options shared by the three problem types.

    ``max_growing``, ``max_rule_count``: 0 means no limit.  ``minsupp_new`` below 1 is a fraction of
    the examples (of the positives, in classification) that are still uncovered.
    """

    minsupp_new: float = 0.05
    induction_measure: Measure = "Correlation"
    pruning_measure: Measure = "Correlation"
    voting_measure: Measure = "Correlation"
    max_growing: int = 0
    enable_pruning: bool = True
    ignore_missing: bool = False
    max_uncovered_fraction: float = 0.0
    select_best_candidate: bool = False
    complementary_conditions: bool = False
    control_apriori_precision: bool = True
    max_rule_count: int = 0
    approximate_induction: bool = False
    approximate_bins_count: int = 100
    mean_based_regression: bool = True

    def __post_init__(self):
        for name in ("minsupp_new", "max_growing", "max_rule_count"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")
        if not 0.0 <= self.max_uncovered_fraction <= 1.0:
            raise ValueError("max_uncovered_fraction must lie in [0, 1]")
        if self.approximate_bins_count < 2:
            raise ValueError("approximate_bins_count must be at least 2")
        for measure in (self.induction_measure, self.pruning_measure, self.voting_measure):
            if measure != "UserDefined":  # a stored model does not keep a user's function
                check_measure(measure)

    @property
    def bins(self) -> int | None:
        """Number of bins per numeric attribute, or None when every split is to be checked."""
        return self.approximate_bins_count if self.approximate_induction else None

    def min_new(self, uncovered: float) -> float:
        """Least number of uncovered examples a new rule must cover."""
        wanted = self.minsupp_new * uncovered if self.minsupp_new < 1.0 else self.minsupp_new
        return max(1.0, wanted)

    def as_dict(self) -> dict[str, Any]:
        """Plain values for storing; a user's function is stored as ``UserDefined``."""
        return {
            k: "UserDefined" if callable(v) else list(v) if isinstance(v, tuple) else v
            for k, v in asdict(self).items()
        }

    @classmethod
    def known(cls, values: dict[str, Any]) -> dict[str, Any]:
        names = {f.name for f in fields(cls)}
        unknown = sorted(set(values) - names)
        if unknown:
            raise TypeError(f"unknown induction parameters: {', '.join(unknown)}")
        return values


@dataclass(frozen=True)
class ExpertParams(InductionParams):
    """Options of user-guided induction."""

    extend_using_preferred: bool = False
    extend_using_automatic: bool = False
    induce_using_preferred: bool = False
    induce_using_automatic: bool = False
    consider_other_classes: bool = False
    preferred_conditions_per_rule: int = NO_LIMIT
    preferred_attributes_per_rule: int = NO_LIMIT


@dataclass(frozen=True)
class ContrastParams(InductionParams):
    """Options of contrast-set mining."""

    minsupp_all: tuple[float, ...] = field(default=SUPPORT_LEVELS)
    max_neg2pos: float = 0.5
    max_passes_count: int = 5
    penalty_strength: float = 0.5
    penalty_saturation: float = 0.2
