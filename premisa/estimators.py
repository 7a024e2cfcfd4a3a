"""Models: fit on a DataFrame, hold a rule set, apply it to DataFrames.

Every ``fit`` takes the table and the names of its role columns; predictions come back as the input table with added
columns.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premisa.functions.premise import quoted
from premisa.operators import evaluate
from premisa.operators.classify import ClassSearch
from premisa.operators.contrast import find_contrast_sets
from premisa.operators.counts import exact_medians, regression_consequent
from premisa.operators.covering import Covering, Listener
from premisa.operators.expert import ExpertInduction, Knowledge
from premisa.operators.matching import coverage_matrix
from premisa.operators.predict import predict_class, predict_proba, predict_survival, predict_value
from premisa.operators.regress import RegressionSearch
from premisa.operators.statistics import (
    regression_pvalue,
    rule_stats,
    ruleset_stats,
    significance,
    significance_fdr,
    significance_fwer,
    voting_weight,
)
from premisa.operators.survival import rule_curves
from premisa.operators.survive import SurvivalSearch
from premisa.plans.params import ContrastParams, ExpertParams, InductionParams
from premisa.plans.rules import FIXED, PREFERRED, Rule, RuleSet
from premisa.roles import NotFittedError, Roles, example_set, normalise_missing, validate_roles
from premisa.session import written
from premisa.sources.store import load_curves, load_ruleset, save_ruleset


class RuleModel:
    """What all models share: parameters, listeners, persistence, coverage."""

    problem = "classification"
    params_type: type[InductionParams] = InductionParams

    def __init__(self, **params):
        self.params = self.params_type(**self.params_type.known(params))
        self.model: RuleSet | None = None
        self.curves: DataFrame | None = None
        self.listeners: list[Listener] = []

    def add_event_listener(self, listener: Listener) -> None:
        self.listeners.append(listener)

    def set_params(self, **params) -> RuleModel:
        """Replace some parameters; unknown names and values are errors, and a fitted model stays as it is."""
        self.params = replace(self.params, **self.params_type.known(params))
        return self

    def get_params(self) -> dict:
        return self.params.as_dict()

    def _fitted(self) -> RuleSet:
        if self.model is None:
            raise NotFittedError("call fit first")
        return self.model

    def _rows(self, df: DataFrame) -> DataFrame:
        """Rows to score, with NaN and '?' as missing."""
        attrs = [a for a in self._fitted().attributes() if a in df.columns]
        return normalise_missing(df, attrs)

    def get_coverage_matrix(self, df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
        return coverage_matrix(self._rows(df), self._fitted(), key)

    def statistics(self, spark) -> DataFrame:
        model = self._fitted()
        return ruleset_stats(model.rules_table(spark), model.conditions_table(spark))

    def summary(self, spark) -> dict:
        """All rule set statistics: sizes, means, timings and significance with both corrections."""
        model = self._fitted()
        out = {k: getattr(model, k) for k in ("time_total_s", "time_growing_s", "time_pruning_s")}
        out.update(self.statistics(spark).first().asDict())
        rules = model.rules_table(spark).where("pvalue is not null")
        for table in (significance(rules), significance_fdr(rules), significance_fwer(rules)):
            out.update(table.first().asDict())
        return out

    def save(self, spark, path: str) -> None:
        save_ruleset(spark, self._fitted(), path, self.curves)

    @classmethod
    def load(cls, spark, path: str) -> RuleModel:
        out = cls.__new__(cls)
        out.model = load_ruleset(spark, path)
        values = {k: v for k, v in out.model.params.items() if v != "UserDefined"}
        if "minsupp_all" in values:
            values["minsupp_all"] = tuple(values["minsupp_all"])
        out.params, out.listeners, out.curves = cls.params_type(**values), [], None
        if cls.problem == "survival":
            out.curves = load_curves(spark, path)
        return out

    # --- fitting -----------------------------------------------------------------------------

    def _learn(self, search, knowledge: Knowledge | None) -> list[Rule]:
        covering = Covering(search, self.params, self.listeners)
        if knowledge is not None:
            ExpertInduction(covering, knowledge, self.params).run()
        else:
            covering.run(search.targets)
        self._clock = covering.clock
        return search.describe_all([(t, p) for t in search.targets for p in covering.rules.get(t, [])])

    def _finish(self, rules: list[Rule], began: float, **facts) -> None:
        rules = [replace(r, origin=_origin(r)) for r in rules]
        clock = getattr(self, "_clock", None)
        self.model = RuleSet(
            rules, problem=self.problem, params=self.params.as_dict(), time_total_s=time.monotonic() - began,
            time_growing_s=clock.growing if clock else 0.0, time_pruning_s=clock.pruning if clock else 0.0, **facts,
        )


def _origin(rule: Rule) -> str:
    kinds = {c.origin for c in rule.conditions}
    return FIXED if FIXED in kinds else PREFERRED if PREFERRED in kinds else rule.origin


def _weighted(spark, rules: list[Rule], measure, with_pvalue: bool) -> list[Rule]:
    """Rules with voting weight and, for classes, Fisher p-value: one job over the rule table."""
    if not rules:
        return []
    table = spark.createDataFrame(
        [(i, float(r.p), float(r.n), float(r.p_all), float(r.n_all)) for i, r in enumerate(rules)],
        "i int, p double, n double, p_all double, n_all double",
    )
    table = rule_stats(table, measure) if with_pvalue else voting_weight(table, measure).withColumn(
        "pvalue", F.lit(None).cast("double")
    )
    found = {r["i"]: r for r in table.collect()}
    return [replace(r, weight=found[i]["weight"], pvalue=found[i]["pvalue"]) for i, r in enumerate(rules)]


# --- classification ------------------------------------------------------------------------------


class RuleClassifier(RuleModel):
    """Learns rules for every class of a label column."""

    def fit(
        self, df: DataFrame, label: str, features=None, weight: str | None = None, classes: Sequence[str] | None = None
    ) -> RuleClassifier:
        """``classes`` fixes the class order; by default classes are ordered by name."""
        return self._fit(df, label, features, weight, classes, None)

    def _fit(self, df, label, features, weight, classes, knowledge):
        began = time.monotonic()
        roles = validate_roles(df, self.problem, label, weight=weight, features=features)
        data = example_set(df, label, weight=weight, features=roles.features)
        search = ClassSearch(
            data, roles.features, label, self.params, weight, list(knowledge.conditions()) if knowledge else (), classes
        )
        try:
            rules = self._learn(search, knowledge)
            total = search.everything
            priors = {c: search.size[c] / total for c in search.targets}
        finally:
            search.close()
        rules = _weighted(df.sparkSession, rules, self.params.voting_measure, True)
        self._finish(
            rules, began, target=label, classes=list(priors), priors=priors,
            default_label=max(priors, key=priors.get) if priors else None,
            numeric_label=isinstance(df.schema[label].dataType, T.NumericType),
        )
        return self

    def predict(self, df: DataFrame, return_metrics: bool = False):
        """Adds ``prediction``; optionally also a one-row table of voting metrics."""
        out = predict_class(self._rows(df), self._fitted())
        return (out, evaluate.prediction_metrics(self._rows(df), self._fitted())) if return_metrics else out

    def predict_proba(self, df: DataFrame, return_metrics: bool = False):
        """Adds ``probabilities``, a map from class to probability."""
        out = predict_proba(self._rows(df), self._fitted())
        return (out, evaluate.prediction_metrics(self._rows(df), self._fitted())) if return_metrics else out

    def score(self, df: DataFrame, label: str) -> float:
        return evaluate.accuracy(self.predict(df), label).first()[0]


class ExpertRuleClassifier(RuleClassifier):
    params_type = ExpertParams

    def fit(
        self, df: DataFrame, label: str, features=None, weight: str | None = None, classes=None, expert_rules=None,
        expert_preferred_conditions=None, expert_forbidden_conditions=None,
    ) -> ExpertRuleClassifier:
        knowledge = Knowledge.parse(expert_rules, expert_preferred_conditions, expert_forbidden_conditions)
        return self._fit(df, label, features, weight, classes, knowledge)


class ContrastSetRuleClassifier(RuleClassifier):
    """Contrast sets of a group column; the label takes no part in premises."""

    params_type = ContrastParams

    def fit(
        self, df: DataFrame, label: str, contrast: str, features=None, weight: str | None = None, classes=None
    ) -> ContrastSetRuleClassifier:
        began = time.monotonic()
        roles = validate_roles(df, self.problem, label, contrast=contrast, weight=weight, features=features)
        self._contrast(df, roles, contrast, weight, classes, began)
        return self

    def _contrast(self, df, roles: Roles, contrast, weight, classes, began):
        data = example_set(df, contrast, weight=weight, features=roles.features)
        search = ClassSearch(data, roles.features, contrast, self.params, weight, targets=classes)
        try:
            sets = find_contrast_sets(search, self.params, self.listeners)
            rules = search.describe_all(sets)
            priors = {c: search.size[c] / search.everything for c in search.targets}
        finally:
            search.close()
        rules = _weighted(df.sparkSession, rules, self.params.voting_measure, True)
        self._finish(
            rules, began, target=contrast, classes=list(priors), priors=priors,
            default_label=max(priors, key=priors.get) if priors else None,
        )


# --- regression ----------------------------------------------------------------------------------


class RuleRegressor(RuleModel):
    """Learns rules for a numeric label."""

    problem = "regression"

    def fit(self, df: DataFrame, label: str, features=None, weight: str | None = None) -> RuleRegressor:
        return self._fit(df, label, features, weight, None)

    def _fit(self, df, label, features, weight, knowledge):
        began = time.monotonic()
        roles = validate_roles(df, self.problem, label, weight=weight, features=features)
        data = example_set(df, label, weight=weight, features=roles.features).withColumn(
            label, quoted(label).cast("double")
        )
        search = RegressionSearch(
            data, roles.features, label, self.params, weight, list(knowledge.conditions()) if knowledge else ()
        )
        try:
            rules = self._learn(search, knowledge)
            default = search.center
            if not self.params.mean_based_regression:
                whole = search.table.df.select(F.lit(0).alias("k"), "__y")
                default += exact_medians(whole, "k", "__y").first()["median"]
        finally:
            search.close()
        rules = _weighted(df.sparkSession, rules, self.params.voting_measure, False)
        if rules:
            tails = {r["rule_id"]: r["pvalue"] for r in regression_pvalue(data, rules, label, search.center).collect()}
            rules = [replace(r, pvalue=tails.get(i)) for i, r in enumerate(rules, 1)]
        self._finish(rules, began, target=label, default_value=default)
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        return predict_value(self._rows(df), self._fitted())

    def score(self, df: DataFrame, label: str) -> float:
        return evaluate.r2(self.predict(df), label).first()[0]


class ExpertRuleRegressor(RuleRegressor):
    params_type = ExpertParams

    def fit(
        self, df: DataFrame, label: str, features=None, weight: str | None = None, expert_rules=None,
        expert_preferred_conditions=None, expert_forbidden_conditions=None,
    ) -> ExpertRuleRegressor:
        knowledge = Knowledge.parse(expert_rules, expert_preferred_conditions, expert_forbidden_conditions)
        return self._fit(df, label, features, weight, knowledge)


class ContrastSetRuleRegressor(ContrastSetRuleClassifier):
    """Contrast sets with the mean and deviation of a numeric label per set."""

    problem = "regression"

    def fit(self, df: DataFrame, label: str, contrast: str, features=None, weight=None, classes=None):
        began = time.monotonic()
        roles = validate_roles(df, "regression", label, contrast=contrast, weight=weight, features=features)
        self._contrast(df, roles, contrast, weight, classes, began)
        found = {}
        if self.model.rules:
            rows = normalise_missing(df, self.model.attributes())
            found = {r["rule_id"]: r for r in regression_consequent(rows, self.model, label).collect()}
        self.model.rules = [
            replace(r, value=found[i]["value"], std=found[i]["spread"]) if i in found else r
            for i, r in enumerate(self.model.rules, 1)
        ]
        self.model.default_value = df.agg(F.avg(quoted(label).cast("double"))).first()[0]
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction``: the weighted mean of the covering sets' values; the training mean if none covers."""
        return predict_value(self._rows(df), self._fitted())

    def score(self, df: DataFrame, label: str) -> float:
        """R squared."""
        return evaluate.r2(self.predict(df), label).first()[0]


# --- survival ------------------------------------------------------------------------------------


class SurvivalRules(RuleModel):
    """Learns rules whose covered examples survive differently from the others."""

    problem = "survival"

    def fit(self, df: DataFrame, label: str, survival_time: str, features=None) -> SurvivalRules:
        return self._fit(df, label, survival_time, features, None)

    def _fit(self, df, label, survival_time, features, knowledge):
        began = time.monotonic()
        roles = validate_roles(df, self.problem, label, survival_time=survival_time, features=features)
        data = example_set(df, label, survival_time=survival_time, features=roles.features)
        search = SurvivalSearch(
            data, roles.features, label, survival_time, self.params, list(knowledge.conditions()) if knowledge else ()
        )
        try:
            rules = self._learn(search, knowledge)
            self._finish(rules, began, target=label)
            # Curves go to the shared folder: predictions read them instead of the training table.
            self.curves = written(rule_curves(search.plain, self.model, survival_time, label, search.time_bounds), "curves")
        finally:
            search.close()
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction``: the survival curve as array<struct<time, prob>>."""
        return predict_survival(self._rows(df), self._fitted(), self.curves)

    def score(self, df: DataFrame, label: str, survival_time: str) -> float:
        """Integrated Brier score (smaller is better)."""
        out = evaluate.integrated_brier_score(self._rows(df), self._fitted(), self.curves, survival_time, label)
        return out.first()[0]


class ExpertSurvivalRules(SurvivalRules):
    params_type = ExpertParams

    def fit(
        self, df: DataFrame, label: str, survival_time: str, features=None, expert_rules=None,
        expert_preferred_conditions=None, expert_forbidden_conditions=None,
    ) -> ExpertSurvivalRules:
        knowledge = Knowledge.parse(expert_rules, expert_preferred_conditions, expert_forbidden_conditions)
        return self._fit(df, label, survival_time, features, knowledge)


class ContrastSetSurvivalRules(ContrastSetRuleClassifier):
    """Contrast sets with a Kaplan-Meier curve per set (``curves``)."""

    problem = "survival"

    def fit(self, df: DataFrame, label: str, survival_time: str, contrast: str, features=None, classes=None):
        began = time.monotonic()
        roles = validate_roles(
            df, "survival", label, survival_time=survival_time, contrast=contrast, features=features
        )
        # Facts, the training table and the curves read the rows: what derives them runs once.
        df = df.select(*[quoted(c) for c in roles.columns]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._contrast(df, roles, contrast, None, classes, began)
            data = example_set(df, label, survival_time=survival_time, features=roles.features)
            self.curves = written(rule_curves(data, self.model, survival_time, label), "curves")
        finally:
            df.unpersist()
        return self

    def predict(self, df: DataFrame, facts=None) -> DataFrame:
        """Adds ``prediction``: the mean curve of the covering sets as array<struct<time, prob>>; ``facts`` as in `predict_survival`."""
        return predict_survival(self._rows(df), self._fitted(), self.curves, facts=facts)

    def score(self, df: DataFrame, label: str, survival_time: str) -> float:
        """Integrated Brier score (smaller is better)."""
        out = evaluate.integrated_brier_score(self._rows(df), self._fitted(), self.curves, survival_time, label)
        return out.first()[0]


__all__ = [
    "ContrastSetRuleClassifier",
    "ContrastSetRuleRegressor",
    "ContrastSetSurvivalRules",
    "ExpertRuleClassifier",
    "ExpertRuleRegressor",
    "ExpertSurvivalRules",
    "RuleClassifier",
    "RuleRegressor",
    "SurvivalRules",
]
