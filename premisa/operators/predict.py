"""Applying a rule set: class votes, numbers and survival curves.

Classes and numbers are one projection without shuffle, so they also run on streams.  Survival
curves are computed once per *signature*, the set of rules that cover an example.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premisa.functions.premise import holds, quoted
from premisa.operators.candidates import bucketize, value_buckets
from premisa.operators.matching import matching_ids
from premisa.operators.running import running_sums
from premisa.operators.survival import BROADCAST_TIMES, curve_jumps
from premisa.plans.rules import RuleSet
from premisa.session import written

NO_RULE = ""
# Different (signature, time) asked for, up to which their probabilities are broadcast to the rows.
BROADCAST_ASKED = 2_000_000


def _total(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms) if terms else F.lit(0.0)


def class_votes(df: DataFrame, ruleset: RuleSet) -> dict[str, tuple[Column, Column]]:
    """Per class: (is any of its rules covering, sum of their weights)."""
    out = {}
    for c in ruleset.classes:
        hits = [(holds(r.conditions, df.schema), r.weight) for r in ruleset if r.label == c]
        if hits:
            covered = reduce(lambda a, b: a | b, [h for h, _ in hits])
            out[c] = (covered, _total([F.when(h, F.lit(float(w or 0.0))).otherwise(F.lit(0.0)) for h, w in hits]))
        else:
            out[c] = (F.lit(False), F.lit(0.0))
    return out


def predicted_class(df: DataFrame, ruleset: RuleSet) -> Column:
    """Class with the largest vote (the earlier class on ties); the default class if no rule covers."""
    options = []
    for i, (c, (covered, vote)) in enumerate(class_votes(df, ruleset).items()):
        options.append(F.when(covered, F.struct(vote.alias("v"), F.lit(-i).alias("i"), F.lit(c).alias("c"))))
    if not options:
        return F.lit(ruleset.default_label)
    best = options[0] if len(options) == 1 else F.greatest(*options)
    out = F.coalesce(best["c"], F.lit(ruleset.default_label))
    return out.cast("double") if ruleset.numeric_label else out


def predict_class(df: DataFrame, ruleset: RuleSet, output: str = "prediction") -> DataFrame:
    return df.withColumn(output, predicted_class(df, ruleset))


def class_probabilities(df: DataFrame, ruleset: RuleSet) -> dict[str, Column]:
    """Votes scaled to sum 1 (negative votes count 0); class priors where there is no vote."""
    votes = {c: F.greatest(v, F.lit(0.0)) for c, (_, v) in class_votes(df, ruleset).items()}
    total = _total(list(votes.values()))
    return {
        c: F.when(total > 0, v / total).otherwise(F.lit(float(ruleset.priors.get(c, 0.0)))) for c, v in votes.items()
    }


def predict_proba(df: DataFrame, ruleset: RuleSet, output: str = "probabilities") -> DataFrame:
    """A map from class to probability."""
    probs = class_probabilities(df, ruleset)
    pairs = [x for c, p in probs.items() for x in (F.lit(c), p)]
    return df.withColumn(output, F.create_map(*pairs))


def predicted_value(df: DataFrame, ruleset: RuleSet) -> Column:
    """Weighted mean of the covering rules' values; the training value if no rule covers."""
    rules = [r for r in ruleset if r.value is not None]
    hits = [(holds(r.conditions, df.schema), float(r.weight or 0.0), r.value) for r in rules]
    zero = F.lit(0.0)
    top = _total([F.when(h, F.lit(w * v)).otherwise(zero) for h, w, v in hits])
    weight = _total([F.when(h, F.lit(w)).otherwise(zero) for h, w, _ in hits])
    return F.when(weight > 0, top / F.nullif(weight, zero)).otherwise(F.lit(ruleset.default_value))


def predict_value(df: DataFrame, ruleset: RuleSet, output: str = "prediction") -> DataFrame:
    return df.withColumn(output, predicted_value(df, ruleset))


def signature(df: DataFrame, ruleset) -> Column:
    """The covering rules of a row as text, for instance ``1,3``; empty if none covers."""
    return F.array_join(matching_ids(df, ruleset).cast("array<string>"), ",")


def signature_jumps(signatures: DataFrame, curves: DataFrame) -> DataFrame:
    """(signature, time, jump): the changes of the mean of the covering rules' curves; rule 0 stands in when none covers.

    Curves are added as jumps, so nothing is expanded to a grid of signatures and times.
    """
    parts = signatures.select("signature").distinct()
    ids = F.when(F.col("signature") == F.lit(NO_RULE), F.array(F.lit("0"))).otherwise(F.split("signature", ","))
    parts = parts.select("signature", F.size(ids).alias("k"), F.explode(ids.cast("array<int>")).alias("rule_id"))
    jumps = parts.join(curve_jumps(curves, ["rule_id"]), "rule_id")
    return jumps.groupBy("signature", "time").agg(F.sum(F.col("jump") / F.col("k")).alias("jump"))


def signature_curves(signatures: DataFrame, curves: DataFrame) -> DataFrame:
    """(signature, time, prob): the curve of every signature at its own times."""
    run = running_sums(signature_jumps(signatures, curves), ["signature"], "time", ["jump"])
    return run.select("signature", "time", (F.lit(1.0) + F.col("cum_jump")).alias("prob"))


def survival_probability_at(df: DataFrame, ruleset, curves: DataFrame, at: Column, output: str = "probability") -> DataFrame:
    """Every row with the probability of surviving ``at``, a time of its own: null for a null time, 1 before the first event.

    Rows carry no curve. The distinct (signature, time) that are asked for stand among the curves' jumps as steps of height 0,
    and one running sum gives the last value at or before each; in two levels where there are many times, so a signature
    that most rows share is not one task's.
    """
    rows = df.withColumns({"__signature": signature(df, ruleset), "__at": at.cast("double")})
    asked = rows.where("__at is not null").select(F.col("__signature").alias("signature"), F.col("__at").alias("time")).distinct()
    asked = written(asked, "asked")
    steps = signature_jumps(asked, curves).unionByName(asked.withColumn("jump", F.lit(0.0)))
    steps = written(steps.groupBy("signature", "time").agg(F.sum("jump").alias("jump")), "steps")
    bounds = value_buckets(steps, ["time"])["time"]
    run = running_sums(
        bucketize(steps, {"__b": bounds}, {"__b": "time"}), ["signature"], "time", ["jump"], bucket="__b" if bounds else None)
    found = run.join(asked, ["signature", "time"], "left_semi").select(
        F.col("signature").alias("__signature"), F.col("time").alias("__at"), (F.lit(1.0) + F.col("cum_jump")).alias(output))
    # One row for each different question; where they are few the rows stay where they are.
    if asked.count() <= BROADCAST_ASKED:
        found = F.broadcast(found)
    return rows.join(found, ["__signature", "__at"], "left").select(*[quoted(c) for c in df.columns], output)


def predict_survival(
    df: DataFrame, ruleset, curves: DataFrame, output: str = "prediction", facts: Mapping[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """Every row with its curve as array<struct<time, prob>>, and with ``facts``, expressions of the curve by name.

    Facts are computed once a curve, not once a row that has it. The join is by signature: curves of few points in all are
    broadcast; beyond, AQE joins them and splits a hot signature.
    """
    rows = df.withColumn("signature", signature(df, ruleset))
    points = signature_curves(rows, curves).groupBy("signature").agg(
        F.sort_array(F.collect_list(F.struct("time", "prob"))).alias(output)
    )
    points = written(points.withColumns({name: of(F.col(output)) for name, of in (facts or {}).items()}), "points")
    if (points.agg(F.sum(F.size(output))).first()[0] or 0) <= BROADCAST_TIMES:
        points = F.broadcast(points)
    return rows.join(points, "signature", "left").drop("signature")


def covering_classes(df: DataFrame, ruleset: RuleSet) -> Column:
    """Number of different classes the covering rules point to."""
    hits = [
        reduce(lambda a, b: a | b, [holds(r.conditions, df.schema) for r in ruleset if r.label == c]).cast("int")
        for c in dict.fromkeys(r.label for r in ruleset)
    ]
    return reduce(lambda a, b: a + b, hits) if hits else F.lit(0)


def covering_rules(df: DataFrame, ruleset) -> Column:
    """Number of covering rules."""
    return F.size(matching_ids(df, ruleset))


