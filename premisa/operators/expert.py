"""User-guided induction: initial rules, preferred and forbidden conditions."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premisa.functions import sqltext as q
from premisa.functions.measures import python_quality, quality
from premisa.functions.premise import holds, quoted
from premisa.operators.base import TrainingTable
from premisa.operators.candidates import (
    best_condition,
    complement_candidates,
    feature_kinds,
    nominal_candidates,
    numeric_candidates,
)
from premisa.operators.classify import ClassSearch
from premisa.operators.covering import Covering, Premise
from premisa.plans.params import ExpertParams
from premisa.plans.rules import FIXED, INDUCED, PREFERRED, Condition, add_condition, parse_rules


@dataclass
class Preferred:
    """A preferred conjunction (or attribute, written ``a = Any``) and how often it may still be used."""

    conditions: Premise
    left: float
    label: str | None = None

    @property
    def attribute(self) -> str | None:
        return self.conditions[0].attr if len(self.conditions) == 1 and self.conditions[0].op == "any" else None


@dataclass
class Knowledge:
    """What the user knows, parsed once on the driver."""

    rules: list[tuple[Premise, str | None]] = field(default_factory=list)
    preferred: list[Preferred] = field(default_factory=list)
    forbidden: list[tuple[Condition, str | None]] = field(default_factory=list)

    @classmethod
    def parse(cls, rules=None, preferred=None, forbidden=None) -> Knowledge:
        out = cls()
        for rule, _ in parse_rules(rules):
            # Conditions of initial rules are fixed unless the user marked them as merely preferred.
            premise = tuple(replace(c, origin=FIXED if c.origin == INDUCED else c.origin) for c in rule.conditions)
            out.rules.append((premise, rule.label))
        for rule, times in parse_rules(preferred, PREFERRED):
            out.preferred.append(Preferred(rule.conditions, times, rule.label))
        for rule, _ in parse_rules(forbidden):
            out.forbidden += [(c, rule.label) for c in rule.conditions]
        return out

    def conditions(self) -> Iterable[Condition]:
        """Every condition with thresholds, so that binned tables can cut exactly there."""
        for premise, _ in self.rules:
            yield from premise
        for item in self.preferred:
            yield from item.conditions
        for cond, _ in self.forbidden:
            yield cond

    def labels(self) -> set[str]:
        every = [label for _, label in self.rules] + [p.label for p in self.preferred]
        every += [label for _, label in self.forbidden]
        return {label for label in every if label is not None}


def _intersects(cond: Condition) -> str:
    """SQL: does a candidate row overlap a forbidden condition?"""
    same = f"attr = {q.text(cond.attr)}"
    if cond.op == "any":
        return f"({same})"
    if cond.op in ("eq", "ne"):
        return f"({same} and op = '{cond.op}' and value = {q.text(cond.value)})"
    below = "true" if cond.lo is None else f"cut > {q.number(cond.lo)}"
    above = "true" if cond.hi is None else f"cut {'<=' if cond.hi_closed else '<'} {q.number(cond.hi)}"
    return f"({same} and ((op = 'lt' and {below}) or (op = 'ge' and {above})))"


def forbidden_filter(
    forbidden: Sequence[tuple[Condition, str | None]], table: TrainingTable | None = None
) -> Callable[[DataFrame], DataFrame]:
    """A filter that drops candidates overlapping a forbidden condition (of that class, or of every class)."""
    tests = []
    for cond, label in forbidden:
        stored = table.coded(cond) if table is not None and cond.op == "interval" else cond
        test = _intersects(stored)
        tests.append(test if label is None else f"(target = {q.text(label)} and {test})")
    if not tests:
        return lambda cand: cand
    return lambda cand: cand.where(f"not ({' or '.join(tests)})")


def refine_condition(
    df: DataFrame,
    rest: Sequence[Condition],
    cond: Condition,
    label: str,
    target: str,
    measure="Correlation",
    complementary: bool = False,
) -> DataFrame:
    """The best condition on ``cond.attr`` for one class, given the other conditions of the rule.

    ``Any`` admits every form; an interval is refined to the best one of the same direction; a
    stated nominal value stands as it is.
    """
    totals = df.select(F.coalesce(quoted(label).cast("string") == F.lit(target), F.lit(False)).alias("y")).agg(
        F.count(F.when(F.col("y"), 1)).alias("p"), F.count(F.when(~F.col("y"), 1)).alias("n")
    ).first()
    rows = df.where(holds(rest, df.schema)) if rest else df
    numeric, nominal = feature_kinds(df, [cond.attr])
    if numeric:
        cand = numeric_candidates(rows, numeric, label, target)
        if cond.op == "interval":
            ops = [o for o, there in (("ge", cond.lo is not None), ("lt", cond.hi is not None)) if there]
            cand = cand.where(F.col("op").isin(*ops))
    else:
        cand = nominal_candidates(rows, nominal, label, target)
        if complementary:
            cand = cand.unionByName(complement_candidates(rows, nominal, label, target))
        if cond.op in ("eq", "ne"):
            cand = cand.where((F.col("op") == cond.op) & (F.col("value") == cond.value))
    return best_condition(cand, measure, totals["p"], totals["n"])


class ExpertInduction:
    """Runs the stages of user-guided induction on any of the three searches."""

    def __init__(self, covering: Covering, knowledge: Knowledge, params: ExpertParams):
        self.covering, self.search = covering, covering.search
        self.knowledge, self.params = knowledge, params
        self.forbid = forbidden_filter(knowledge.forbidden, self.search.table)

    def targets(self) -> list[str]:
        named = self.knowledge.labels()
        if not isinstance(self.search, ClassSearch):
            return list(self.search.targets)
        if self.params.consider_other_classes or not named:
            return list(self.search.targets)
        return [t for t in self.search.targets if t in named]

    def run(self) -> None:
        targets = self.targets()
        for t in targets:
            for premise, label in self.knowledge.rules:
                if label is None or label == t or not isinstance(self.search, ClassSearch):
                    self._initial(t, premise)
        if self.params.induce_using_preferred:
            for t in targets:
                self._from_preferred(t)
        if self.params.induce_using_automatic:
            self.covering.run(targets, allow=self.forbid)

    # --- stages ------------------------------------------------------------------------------

    def _initial(self, target: str, premise: Premise) -> None:
        premise = self.refined(target, premise)
        if self.params.extend_using_preferred:
            premise = self._prefer(target, premise)
        if self.params.extend_using_automatic:
            premise = self.covering.grow({target: premise}, self.forbid)[target]
            premise = self.covering.prune({target: premise})[target]
        self.covering.accept(target, premise)

    def _from_preferred(self, target: str) -> None:
        while not self.covering.full(target):
            before = [p.left for p in self.knowledge.preferred]
            premise = self._prefer(target, ())
            if not premise:
                return
            if self.params.induce_using_automatic:
                premise = self.covering.grow({target: premise}, self.forbid)[target]
            premise = self.covering.prune({target: premise})[target]
            need = self.params.min_new(self.search.uncovered[target])
            if self.search.new_coverage(target, premise) < need or premise in self.covering.rules.get(target, []):
                for item, left in zip(self.knowledge.preferred, before):
                    item.left = left
                return
            self.covering.accept(target, premise)

    def _prefer(self, target: str, premise: Premise) -> Premise:
        """Add preferred conditions and attributes, the best first, while they add something."""
        conditions, attributes = 0, 0
        while True:
            items = [p for p in self.knowledge.preferred if p.left > 0 and p.label in (None, target)]
            if not isinstance(self.search, ClassSearch):
                items = [p for p in self.knowledge.preferred if p.left > 0]
            fixed = [p for p in items if p.attribute is None and conditions < self.params.preferred_conditions_per_rule]
            free = {p.attribute: p for p in items if p.attribute and attributes < self.params.preferred_attributes_per_rule}
            options = []
            trials = []
            for item in fixed:
                grown = premise
                for c in item.conditions:
                    grown = add_condition(grown, c)
                if grown != premise:
                    trials.append((item, grown))
            for (item, grown), (value, new, changes) in zip(trials, self._values(target, premise, [g for _, g in trials])):
                if value is not None and changes and new >= self.params.min_new(self.search.uncovered[target]):
                    options.append((value, 1, item, grown))
            if free:
                names = ", ".join(q.text(a) for a in free)
                steps = self.search.best({target: premise}, lambda c: self.forbid(c).where(f"attr in ({names})"))
                if target in steps:
                    step = steps[target]
                    cond = replace(step.condition, origin=PREFERRED)
                    options.append((step.quality, 0, free[cond.attr], add_condition(premise, cond)))
            if not options:
                return premise
            _, is_condition, item, premise = max(options, key=lambda o: (o[0], o[1]))
            item.left -= 1
            conditions += is_condition
            attributes += 1 - is_condition

    def _values(self, target: str, premise: Premise, grown: list[Premise]) -> list[tuple[float | None, float, bool]]:
        """(quality, newly covered, does it exclude anything) of given premises."""
        if not grown:
            return []
        if isinstance(self.search, ClassSearch):
            self.search._remember(target, [premise, *grown])
            counts = [self.search.counts(target, p) for p in [premise, *grown]]
            size, rest = self.search.size[target], self.search.everything - self.search.size[target]
            values = python_quality(
                self.params.induction_measure, self.search.table.df.sparkSession, [(p, n, size, rest) for p, n, _ in counts]
            )
            now = sum(counts[0][:2])
            return [(v, new, p + n < now) for v, (p, n, new) in zip(values[1:], counts[1:])]
        now = self.search.covered(premise)
        values = self.search.variant_qualities(grown)
        return [(v, self.search.new_coverage(target, p), self.search.covered(p) < now) for v, p in zip(values, grown)]

    # --- refinement --------------------------------------------------------------------------

    def refined(self, target: str, premise: Premise) -> Premise:
        """Replace every '@=' condition by the best of its kind, left to right."""
        out: Premise = tuple(c for c in premise if not c.refine)
        for cond in (c for c in premise if c.refine):
            for new in self._refine(target, out, cond):
                out = add_condition(out, new)
        order = {c.attr: i for i, c in enumerate(premise)}
        return tuple(sorted(out, key=lambda c: order[c.attr]))

    def _refine(self, target: str, rest: Premise, cond: Condition) -> list[Condition]:
        if cond.op in ("eq", "ne"):
            return [replace(cond, refine=False)]
        wanted = [None]
        if cond.op == "interval":
            wanted = [o for o, there in (("ge", cond.lo is not None), ("lt", cond.hi is not None)) if there]
        found = []
        with self._unfiltered():
            for op in wanted:
                only = f"attr = {q.text(cond.attr)}" + (f" and op = '{op}'" if op else "")
                start = rest
                for c in found:
                    start = add_condition(start, c)
                steps = self.search.best({target: start}, lambda c, only=only: c.where(only))
                if target in steps:
                    found.append(replace(steps[target].condition, origin=cond.origin))
        return found

    @contextmanager
    def _unfiltered(self):
        """Refinement looks for the best condition as such: no support or precision filter."""
        old = self.search.params
        self.search.params = replace(old, minsupp_new=1.0, control_apriori_precision=False)
        try:
            yield
        finally:
            self.search.params = old


def extend_using_preferred(
    df: DataFrame, rest: Sequence[Condition], preferred: Mapping[str, Sequence[Condition]], label: str, target: str,
    measure="Correlation",
) -> DataFrame:
    """Quality of a rule extended by each preferred conjunction: (name, p, n, p_all, n_all, quality), one scan."""
    pos = F.coalesce(quoted(label).cast("string") == F.lit(target), F.lit(False))
    aggs = [F.sum(pos.cast("double")).alias("p_all"), F.sum((~pos).cast("double")).alias("n_all")]
    rows = []
    for i, (name, conds) in enumerate(preferred.items()):
        hit = holds([*rest, *conds], df.schema)
        aggs += [F.sum((hit & pos).cast("double")).alias(f"p{i}"), F.sum((hit & ~pos).cast("double")).alias(f"n{i}")]
        rows.append(F.struct(F.lit(name).alias("name"), F.col(f"p{i}").alias("p"), F.col(f"n{i}").alias("n"),
                             F.col("p_all"), F.col("n_all")))
    table = df.agg(*aggs).select(F.inline(F.array(*rows)))
    return table.withColumn("quality", quality(measure, *[F.col(c) for c in ("p", "n", "p_all", "n_all")]))
