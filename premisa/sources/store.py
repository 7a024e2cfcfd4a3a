"""Models on disk: rules, conditions and parameters as Parquet, curves beside them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premisa.plans.rules import Condition, Rule, RuleSet


def _facts(ruleset: RuleSet) -> dict:
    names = ("problem", "target", "params", "classes", "numeric_label", "default_label", "default_value", "priors",
             "time_total_s", "time_growing_s", "time_pruning_s", "voting")
    return {n: getattr(ruleset, n) for n in names}


def params_table(spark: SparkSession, ruleset: RuleSet) -> DataFrame:
    """One row: problem, parameters as JSON, timings and the voting flag."""
    row = (ruleset.problem, ruleset.target, json.dumps(ruleset.params, default=str), ruleset.time_total_s,
           ruleset.time_growing_s, ruleset.time_pruning_s, ruleset.voting, json.dumps(_facts(ruleset), default=str))
    return spark.createDataFrame(
        [row],
        "problem string, target string, params string, time_total_s double, time_growing_s double, "
        "time_pruning_s double, is_voting boolean, facts string",
    )


def save_ruleset(spark: SparkSession, ruleset: RuleSet, path: str, curves: DataFrame | None = None) -> None:
    """Rule tables hold a row per rule or condition: one file each is right."""
    ruleset.rules_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/rules")
    ruleset.conditions_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/conditions")
    params_table(spark, ruleset).coalesce(1).write.mode("overwrite").parquet(f"{path}/params")
    if curves is not None:
        curves.write.mode("overwrite").parquet(f"{path}/curves")


def ruleset_from_tables(rules: DataFrame, conditions: DataFrame, facts: dict | None = None) -> RuleSet:
    """Rule tables (model sized) back to driver objects."""
    premises: dict[int, list[Condition]] = {}
    for r in conditions.orderBy("rule_id", "pos").collect():
        premises.setdefault(r["rule_id"], []).append(
            Condition(r["attr"], r["op"], r["num_lo"], bool(r["lo_closed"]), r["num_hi"], bool(r["hi_closed"]),
                      r["nom_value"], r["origin"])
        )
    out = [
        Rule(tuple(premises.get(r["rule_id"], ())), r["target"], r["problem"], r["consequent_label"],
             r["consequent_value"], r["consequent_std"], r["p"], r["n"], r["p_all"], r["n_all"], r["weight"], r["pvalue"],
             r["origin"])
        for r in rules.orderBy("rule_id").collect()
    ]
    return RuleSet(out, **(facts or {}))


def load_ruleset(spark: SparkSession, path: str) -> RuleSet:
    facts = json.loads(spark.read.parquet(f"{path}/params").first()["facts"])
    return ruleset_from_tables(spark.read.parquet(f"{path}/rules"), spark.read.parquet(f"{path}/conditions"), facts)


def load_curves(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/curves")


def _number(c):
    """Integers bare, everything else with two decimals."""
    return F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(F.format_string("%.2f", c))


def ruleset_text(rules: DataFrame, conditions: DataFrame) -> DataFrame:
    """(rule_id, text): rule strings assembled from the rule tables."""
    lo = F.when(F.col("num_lo").isNull(), F.lit("(-inf")).otherwise(
        F.concat(F.when(F.col("lo_closed"), F.lit("<")).otherwise(F.lit("(")), _number(F.col("num_lo")))
    )
    hi = F.when(F.col("num_hi").isNull(), F.lit("inf)")).otherwise(
        F.concat(_number(F.col("num_hi")), F.when(F.col("hi_closed"), F.lit(">")).otherwise(F.lit(")")))
    )
    body = (
        F.when(F.col("op") == "any", F.lit("Any"))
        .when(F.col("op") == "eq", F.concat(F.lit("{"), F.col("nom_value"), F.lit("}")))
        .when(F.col("op") == "ne", F.concat(F.lit("!{"), F.col("nom_value"), F.lit("}")))
        .otherwise(F.concat(lo, F.lit(", "), hi))
    )
    one = F.concat(F.col("attr"), F.lit(" = "), body)
    one = (
        F.when(F.col("origin") == "expert_fixed", F.concat(F.lit("[["), one, F.lit("]]")))
        .when(F.col("origin") == "expert_preferred", F.concat(F.lit("["), one, F.lit("]")))
        .otherwise(one)
    )
    parts = conditions.select("rule_id", "pos", one.alias("c")).groupBy("rule_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "c")))["c"].alias("cs")
    )
    value, spread = F.col("consequent_value"), F.coalesce("consequent_std", F.lit(0.0))
    then = (
        F.when(F.col("problem") == "survival", F.lit(""))
        .when(
            F.col("problem") == "regression",
            F.concat(
                F.col("target"), F.lit(" = {"), F.format_string("%.2f", value), F.lit("} ["),
                F.format_string("%.2f", value - spread), F.lit(","), F.format_string("%.2f", value + spread), F.lit("]"),
            ),
        )
        .otherwise(F.concat(F.col("target"), F.lit(" = {"), F.col("consequent_label"), F.lit("}")))
    )
    return rules.join(parts, "rule_id", "left").select(
        "rule_id", F.concat(F.lit("IF "), F.array_join("cs", " AND "), F.lit(" THEN "), then).alias("text")
    )
