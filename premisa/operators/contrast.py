"""Contrast sets: rules that hold for much of one group and little of the others.

The group column takes the place of the class.  For each support level several covering passes run; each
pass starts with everything uncovered, and attributes used before are penalised so that passes differ.
The published description leaves the exact weighting open; ours is

    quality * (1 - s * u) * (1 - s + s * min(1, (p_new / P) / t))

with s the penalty strength, u the share of the group's earlier sets that use the attribute, and t the
saturation.  (A negative quality is divided by the factors instead.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premisa.functions import sqltext as q
from premisa.operators.classify import ClassSearch
from premisa.operators.covering import Covering, Listener, Premise
from premisa.plans.params import ContrastParams


def neg2pos(p: Column, n: Column, p_all: Column, n_all: Column) -> Column:
    """(n / N) / (p / P), written without nested division."""
    return n * p_all / F.nullif(p * n_all, F.lit(0.0))


def contrast_filters(rules: DataFrame, minsupp_all: float, max_neg2pos: float) -> DataFrame:
    """Keep sets with support p / P and negative-to-positive ratio within the limits."""
    p, n, p_all, n_all = (F.col(c) for c in ("p", "n", "p_all", "n_all"))
    return rules.where((p >= F.lit(minsupp_all) * p_all) & (neg2pos(p, n, p_all, n_all) <= F.lit(max_neg2pos)))


def penalised(cand: DataFrame, usage: dict[tuple[str, str], float], strength: float, saturation: float) -> DataFrame:
    """Scale the quality of candidates by attribute use and by the reward for new coverage."""
    used = "0D"
    if usage:
        used = f"coalesce({q.lookup({f'{a}@{t}': u for (a, t), u in usage.items()}, 'concat(attr, chr(64), target)')}, 0D)"
    reward = f"{1 - strength}D + {strength}D * least(1D, p_new / p_all / {saturation}D)"
    factor = f"(1D - {strength}D * {used}) * ({reward})"
    return cand.withColumn("quality", F.expr(f"if(quality >= 0, quality * {factor}, quality / greatest({factor}, 1e-9D))"))


def find_contrast_sets(
    search: ClassSearch, params: ContrastParams, listeners: Sequence[Listener] = ()
) -> list[tuple[str, Premise]]:
    """All contrast sets, (group, premise), in order of discovery."""
    found: list[tuple[str, Premise]] = []
    for level in params.minsupp_all:
        for _ in range(max(1, params.max_passes_count)):
            fresh = _one_pass(search, params, level, found, listeners)
            if not fresh:
                break
            found += fresh
    return found


def _one_pass(search, params, level, found, listeners) -> list[tuple[str, Premise]]:
    per_group: dict[str, list[Premise]] = {}
    for t, premise in found:
        per_group.setdefault(t, []).append(premise)
    usage = {
        (a, t): sum(any(c.attr == a for c in p) for p in premises) / len(premises)
        for t, premises in per_group.items()
        for a in {c.attr for p in premises for c in p}
    }

    def adjust(cand: DataFrame) -> DataFrame:
        return penalised(
            cand.where(f"p >= {level}D * p_all"), usage, params.penalty_strength, params.penalty_saturation
        )

    search.reset()
    search.adjust = adjust
    covering = Covering(search, params, listeners)
    covering.run(search.targets)
    seen = {(t, frozenset(c.key for c in p)) for t, p in found}
    fresh = []
    for t, premises in covering.rules.items():
        for premise in premises:
            p, n = search.found[t, premise]
            p_all, n_all = search.size[t], search.everything - search.size[t]
            good = p >= level * p_all and n * p_all <= params.max_neg2pos * p * n_all
            if good and (t, frozenset(c.key for c in premise)) not in seen:
                fresh.append((t, premise))
    return fresh
