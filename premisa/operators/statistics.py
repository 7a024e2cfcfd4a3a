"""Statistics of rules and rule sets.  All inputs are rule tables: one row per rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from premisa.functions.measures import quality
from premisa.functions.premise import quoted
from premisa.functions.tails import chi2_lower, chi2_upper_1df, fisher_log10
from premisa.operators.matching import _rules, every_rule, matching_ids
from premisa.operators.survival import log_rank

ALPHA = 0.05
_COUNTS = ("p", "n", "p_all", "n_all")


def voting_weight(counts: DataFrame, measure="Correlation") -> DataFrame:
    """Rule weight: the voting measure on the rule's counts."""
    return counts.withColumn("weight", quality(measure, *[F.col(c) for c in _COUNTS]))


def rule_pvalue(counts: DataFrame) -> DataFrame:
    """Classification: one-sided Fisher exact test on p, n, P, N."""
    log10 = fisher_log10(*[F.col(c) for c in _COUNTS])
    return counts.withColumn("log10_pvalue", log10).withColumn("pvalue", F.pow(F.lit(10.0), F.col("log10_pvalue")))


def rule_stats(counts: DataFrame, measure="Correlation") -> DataFrame:
    """p, n, P, N, weight and p-value per rule."""
    return rule_pvalue(voting_weight(counts, measure))


def regression_pvalue(df: DataFrame, ruleset, label: str, center: float | None = None) -> DataFrame:
    """Variance test: is the label's variance among covered examples smaller than among the others?

    chi2 = n var(covered) / var(uncovered) with n - 1 degrees of freedom, lower tail. Squares are summed about ``center``,
    a value in the midst of the labels; their mean if none is given, which takes one more scan.
    """
    rules, y = _rules(ruleset), quoted(label).cast("double")
    rows = df.where(y.isNotNull())
    if center is None:
        center = rows.agg(F.coalesce(F.avg(y), F.lit(0.0))).first()[0]
    # Rows of the same rules are added up first, then once for each of their rules, and for rule 0, the whole table.
    cells = rows.select(matching_ids(df, rules).alias("ids"), (y - F.lit(center)).alias("y"))
    cells = cells.groupBy("ids").agg(F.count(F.lit(1)).cast("double").alias("c"), F.sum("y").alias("s"), F.sum(F.col("y") ** 2).alias("q"))
    cells = cells.select(F.explode(F.concat(F.array(F.lit(0)), "ids")).alias("rule_id"), "c", "s", "q")
    sums = cells.groupBy("rule_id").agg(*[F.sum(x).alias(x) for x in "csq"])
    # One row per rule remains: the window that hands them the whole table's sums is over that small result.
    every = Window.partitionBy(F.lit(0))
    whole = [F.max(F.when(F.col("rule_id") == 0, F.col(x))).over(every).alias(f"t{x}") for x in "csq"]
    per_rule = every_rule(sums.select("*", *whole).where("rule_id > 0"), rules, ["c", "s", "q"])
    of = lambda c, s, q: F.try_divide(q, c) - F.pow(F.try_divide(s, c), F.lit(2.0))
    v = of(F.col("c"), F.col("s"), F.col("q"))
    u = of(F.col("tc") - F.col("c"), F.col("ts") - F.col("s"), F.col("tq") - F.col("q"))
    stats = per_rule.select("rule_id", F.col("c").alias("covered"), (F.col("c") * v / F.nullif(u, F.lit(0.0))).alias("chi2"))
    return stats.withColumn("pvalue", chi2_lower(F.col("chi2"), F.col("covered") - 1))


def survival_pvalue(df: DataFrame, ruleset, time: str, status: str) -> DataFrame:
    """Log-rank test of covered against uncovered examples, one degree of freedom."""
    return log_rank(df, ruleset, time, status).withColumn("pvalue", chi2_upper_1df(F.col("chi2")))


def ruleset_stats(rules: DataFrame, conditions: DataFrame) -> DataFrame:
    """Rule count, mean conditions (all and induced), coverage, precision and quality, in one row."""
    per_rule = conditions.groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("conditions"),
        F.sum(F.when(F.col("origin") == "induced", 1).otherwise(0)).alias("induced"),
    )
    both = rules.join(per_rule, "rule_id", "left").fillna(0, ["conditions", "induced"])
    return both.agg(
        F.count(F.lit(1)).alias("rules_count"),
        F.avg("conditions").alias("conditions_per_rule"),
        F.avg("induced").alias("induced_conditions_per_rule"),
        F.avg((F.col("p") + F.col("n")) / (F.col("p_all") + F.col("n_all"))).alias("avg_rule_coverage"),
        F.avg(F.col("p") / F.nullif(F.col("p") + F.col("n"), F.lit(0.0))).alias("avg_rule_precision"),
        F.avg("weight").alias("avg_rule_quality"),
    )


def _fraction(column: str, alpha: float, name: str) -> list:
    return [
        F.avg(column).alias(f"{name}_mean"),
        F.avg(F.when(F.col(column) <= alpha, 1.0).otherwise(0.0)).alias(f"{name}_fraction"),
    ]


def significance(rules: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Mean p-value and fraction of rules with p <= alpha."""
    return rules.agg(*_fraction("pvalue", alpha, "p"))


def adjusted_fdr(rules: DataFrame) -> DataFrame:
    """Benjamini-Hochberg: running minimum, from the largest p down, of m p / rank."""
    # The windows below have one row per rule, so a single partition is right.
    every = Window.partitionBy(F.lit(0))
    order = every.orderBy("pvalue", "rule_id")
    ranked = rules.select(
        "rule_id", "pvalue", F.row_number().over(order).alias("rank"), F.count(F.lit(1)).over(every).alias("m")
    )
    down = every.orderBy(F.desc("rank")).rowsBetween(Window.unboundedPreceding, 0)
    return ranked.select(
        "rule_id",
        "pvalue",
        F.least(F.lit(1.0), F.min(F.col("m") * F.col("pvalue") / F.col("rank")).over(down)).alias("adjusted"),
    )


def adjusted_fwer(rules: DataFrame) -> DataFrame:
    """Holm: running maximum, from the smallest p up, of (m - rank + 1) p."""
    every = Window.partitionBy(F.lit(0))
    order = every.orderBy("pvalue", "rule_id")
    ranked = rules.select(
        "rule_id", "pvalue", F.row_number().over(order).alias("rank"), F.count(F.lit(1)).over(every).alias("m")
    )
    up = every.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    step = (F.col("m") - F.col("rank") + 1) * F.col("pvalue")
    return ranked.select("rule_id", "pvalue", F.least(F.lit(1.0), F.max(step).over(up)).alias("adjusted"))


def significance_fdr(rules: DataFrame, alpha: float = ALPHA) -> DataFrame:
    return adjusted_fdr(rules).agg(*_fraction("adjusted", alpha, "fdr"))


def significance_fwer(rules: DataFrame, alpha: float = ALPHA) -> DataFrame:
    return adjusted_fwer(rules).agg(*_fraction("adjusted", alpha, "fwer"))
