"""Which rules cover which examples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premisa.functions.premise import holds, premise, quoted
from premisa.plans.rules import Rule, RuleSet

# Premises per generated expression: beyond this a stage's code would outgrow the JVM method limit.
RULES_PER_EXPRESSION = 200


def _rules(ruleset: RuleSet | Sequence[Rule]) -> list[Rule]:
    return list(ruleset.rules if isinstance(ruleset, RuleSet) else ruleset)


def matching_ids(df: DataFrame, ruleset, parts: int = RULES_PER_EXPRESSION) -> Column:
    """Sorted ids (from 1) of the covering rules of a row; no shuffle, works on streams."""
    rules = _rules(ruleset)
    if not rules:
        return F.array().cast("array<int>")
    arrays = []
    for start in range(0, len(rules), parts):
        hits = [
            F.when(premise(r.conditions, df.schema), F.lit(i + 1))
            for i, r in list(enumerate(rules))[start : start + parts]
        ]
        arrays.append(F.array_compact(F.array(*hits)))
    return arrays[0] if len(arrays) == 1 else F.concat(*arrays)


def every_rule(found: DataFrame, ruleset, zero: Sequence[str]) -> DataFrame:
    """One row per rule: a rule that covers nothing gets 0 in the columns ``zero`` and null in the others."""
    ids = [(i,) for i in range(1, len(_rules(ruleset)) + 1)]
    # One row per rule on both sides: model sized.
    out = found.sparkSession.createDataFrame(ids, "rule_id int").join(found, "rule_id", "left")
    return out.select(*[F.coalesce(F.col(c), F.lit(0).cast(t)).alias(c) if c in zero else F.col(c) for c, t in out.dtypes])


def rule_match(df: DataFrame, ruleset, key: Sequence[str]) -> DataFrame:
    """(key, rule_id) for every rule that covers an example; labels are not looked at."""
    return df.select(*[quoted(k) for k in key], F.explode(matching_ids(df, ruleset)).alias("rule_id"))


def any_rule(df: DataFrame, ruleset) -> Column:
    rules = _rules(ruleset)
    if not rules:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [holds(r.conditions, df.schema) for r in rules])


def covered(df: DataFrame, ruleset) -> DataFrame:
    """Examples at least one rule covers."""
    return df.where(any_rule(df, ruleset))


def uncovered(df: DataFrame, ruleset) -> DataFrame:
    """Examples no rule covers."""
    return df.where(~any_rule(df, ruleset))


def first_covering_id(df: DataFrame, ruleset) -> Column:
    rules = _rules(ruleset)
    if not rules:
        return F.lit(None).cast("int")
    return F.coalesce(*[F.when(premise(r.conditions, df.schema), F.lit(i)) for i, r in enumerate(rules, 1)])


def first_covering_rule(df: DataFrame, ruleset, key: Sequence[str] = ()) -> DataFrame:
    """The first rule (in rule order) to cover each example, null when none does."""
    keep = [quoted(k) for k in key] if key else ["*"]
    return df.select(*keep, first_covering_id(df, ruleset).alias("first_rule"))


def coverage_matrix(df: DataFrame, ruleset, key: Sequence[str] = (), as_array: bool = False) -> DataFrame:
    """0/1 per example and rule: columns r1..rn, or one array column for large rule sets."""
    cells = [holds(r.conditions, df.schema).cast("tinyint") for r in _rules(ruleset)]
    keep = [quoted(k) for k in key]
    if as_array:
        return df.select(*keep, F.array(*cells).alias("coverage"))
    return df.select(*keep, *[c.alias(f"r{i}") for i, c in enumerate(cells, 1)])


def induction_trace(df: DataFrame, ruleset) -> DataFrame:
    """Per rule: examples it covers first, total, and uncovered count after it.

    One aggregate by first covering rule; the windows are over one row per rule.
    """
    newly = df.groupBy(first_covering_id(df, ruleset).alias("rule_id")).agg(F.count(F.lit(1)).alias("n_new"))
    ids = df.sparkSession.range(1, len(_rules(ruleset)) + 1).select(F.col("id").cast("int").alias("id"))
    every = Window.partitionBy(F.lit(0))
    upto = every.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    return (
        newly.join(ids, F.col("rule_id") == F.col("id"), "full")
        .select("id", F.coalesce("n_new", F.lit(0)).alias("n_new"))
        .select("id", "n_new", F.sum("n_new").over(every).alias("total_examples"))
        .where("id is not null")
        .select(
            F.col("id").alias("rule_id"),
            F.col("n_new").alias("newly_covered"),
            "total_examples",
            (F.col("total_examples") - F.sum("n_new").over(upto)).alias("uncovered_examples"),
        )
    )
