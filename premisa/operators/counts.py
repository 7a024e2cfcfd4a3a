"""Counts and conclusions of given rules, all rules in one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premisa.functions.premise import premise, quoted
from premisa.operators.candidates import bucketize, value_buckets
from premisa.operators.matching import _rules, every_rule, matching_ids
from premisa.operators.running import running_sums
from premisa.roles import label_text

# Rules counted by one wide aggregate; larger sets go through the match table.
WIDE_RULES = 64


def _weight(weight: str | None) -> Column:
    return quoted(weight).cast("double") if weight else F.lit(1.0)


def contingency(df: DataFrame, ruleset, label: str, weight: str | None = None) -> DataFrame:
    """p, n, P, N of every rule: (rule_id, label, p, n, p_all, n_all)."""
    rules = _rules(ruleset)
    y, w = label_text(df, label), _weight(weight)
    if len(rules) > WIDE_RULES:
        return _contingency_long(df, rules, y, w)
    labels = list(dict.fromkeys(r.label for r in rules))
    zero = F.lit(0.0)
    aggs = [F.coalesce(F.sum(w), zero).alias("t")]
    aggs += [F.coalesce(F.sum(F.when(y == F.lit(v), w)), zero).alias(f"l{j}") for j, v in enumerate(labels)]
    for i, r in enumerate(rules):
        hit = premise(r.conditions, df.schema)
        aggs.append(F.coalesce(F.sum(F.when(hit, w)), zero).alias(f"c{i}"))
        aggs.append(F.coalesce(F.sum(F.when(hit & (y == F.lit(r.label)), w)), zero).alias(f"p{i}"))
    rows = [
        F.struct(
            F.lit(i + 1).alias("rule_id"),
            F.lit(r.label).alias("label"),
            F.col(f"p{i}").alias("p"),
            (F.col(f"c{i}") - F.col(f"p{i}")).alias("n"),
            F.col(f"l{labels.index(r.label)}").alias("p_all"),
            (F.col("t") - F.col(f"l{labels.index(r.label)}")).alias("n_all"),
        )
        for i, r in enumerate(rules)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def _contingency_long(df, rules, y, w):
    """The same through the match table: one scan, one aggregate by (rule, label), combined on the map side."""
    spark = df.sparkSession
    heads = spark.createDataFrame([(i, r.label) for i, r in enumerate(rules, 1)], "rule_id int, label string")
    # The whole table rides along as rule 0; a zero row per rule keeps rules that cover nothing.
    ids = F.concat(F.array(F.lit(0)), matching_ids(df, rules))
    cells = df.select(F.explode(ids).alias("rule_id"), y.alias("y"), w.alias("w"))
    cells = cells.groupBy("rule_id", "y").agg(F.sum("w").alias("w"))
    cells = cells.unionByName(
        heads.select("rule_id", F.lit(None).cast("string").alias("y"), F.lit(0.0).alias("w"))
    )
    # From here on there are rules x classes rows; the class totals reach every rule by a window.
    every = Window.partitionBy(F.lit(0))
    whole = F.when(F.col("rule_id") == 0, F.struct("y", "w"))
    cells = cells.withColumn("totals", F.collect_list(whole).over(every)).where("rule_id > 0")
    own = F.expr("aggregate(filter(totals, x -> x.y = label), 0D, (s, x) -> s + x.w)")
    total = F.expr("aggregate(totals, 0D, (s, x) -> s + x.w)")
    per_rule = (
        cells.join(F.broadcast(heads), "rule_id")
        .select("rule_id", "label", "y", "w", own.alias("p_all"), total.alias("t"))
        .groupBy("rule_id", "label")
        .agg(
            F.sum(F.when(F.col("y") == F.col("label"), F.col("w")).otherwise(0.0)).alias("p"),
            F.sum("w").alias("c"),
            F.max("p_all").alias("p_all"),
            F.max("t").alias("t"),
        )
    )
    return per_rule.select(
        "rule_id", "label", "p", (F.col("c") - F.col("p")).alias("n"), "p_all", (F.col("t") - F.col("p_all")).alias("n_all")
    )


def weighted_contingency(df: DataFrame, ruleset, label: str, weight: str) -> DataFrame:
    return contingency(df, ruleset, label, weight)


def class_prior(df: DataFrame, label: str, weight: str | None = None) -> DataFrame:
    """P, prior and whether the class is the majority, per class."""
    per_class = df.groupBy(label_text(df, label).alias("class_label")).agg(F.sum(_weight(weight)).alias("p_all"))
    every = Window.partitionBy(F.lit(0))  # one row per class
    rank = F.row_number().over(every.orderBy(F.desc("p_all"), "class_label"))
    return per_class.select(
        "class_label",
        "p_all",
        (F.col("p_all") / F.sum("p_all").over(every)).alias("prior"),
        (rank == 1).cast("int").alias("is_default"),
    )


def _rule_values(df, rules, y: Column, extra=()) -> DataFrame:
    return df.select(F.explode(matching_ids(df, rules)).alias("rule_id"), y.cast("double").alias("y"), *extra).where(
        "y is not null"
    )


def regression_consequent(df: DataFrame, ruleset, label: str, mean_based: bool = True) -> DataFrame:
    """(rule_id, covered, value, spread): mean and population deviation, or median and deviation about it.

    A rule that covers nothing has covered 0 and no value.
    """
    rules = _rules(ruleset)
    hits = _rule_values(df, rules, quoted(label))
    if mean_based:
        found = hits.groupBy("rule_id").agg(
            F.count(F.lit(1)).alias("covered"), F.avg("y").alias("value"), F.stddev_pop("y").alias("spread")
        )
        return every_rule(found, rules, ["covered"])
    medians = exact_medians(hits, "rule_id", "y")
    # One row per rule: model sized, so broadcasting it is safe at any data size.
    found = (
        hits.join(F.broadcast(medians), "rule_id")
        .groupBy("rule_id")
        .agg(
            F.count(F.lit(1)).alias("covered"),
            F.first("median").alias("value"),
            F.sqrt(F.avg((F.col("y") - F.col("median")) ** 2)).alias("spread"),
        )
    )
    return every_rule(found, rules, ["covered"])


def exact_medians(df: DataFrame, key: str, value: str) -> DataFrame:
    """Exact median per key without holding a group: counts per distinct value, then ranks."""
    bounds = value_buckets(df, [value])
    cells = bucketize(df, {"__b": bounds[value]}, {"__b": value})
    cells = cells.groupBy(key, "__b", value).agg(F.count(F.lit(1)).cast("double").alias("m"))
    bucket = "__b" if bounds[value] else None
    ranked = running_sums(cells, [key], value, ["m"], bucket=bucket)
    sizes = cells.groupBy(key).agg(F.sum("m").alias("size"))
    both = ranked.join(F.broadcast(sizes), key)
    lower, upper = F.floor((F.col("size") - 1) / 2), F.ceil((F.col("size") - 1) / 2)
    start = F.col("cum_m") - F.col("m")

    def at(rank):
        return F.max(F.when((start <= rank) & (rank < F.col("cum_m")), F.col(value)))

    return both.groupBy(key).agg(((at(lower) + at(upper)) / 2).alias("median"))


def regression_contingency(
    df: DataFrame, ruleset, label: str, mean_based: bool = True, consequents: DataFrame | None = None
) -> DataFrame:
    """p, n, P, N per rule, where positives are the examples within value ± spread of that rule.

    The conclusions come from a first pass; the second is one scan whose matches are counted by rule, so it grows
    linearly with the rules.
    """
    rules = _rules(ruleset)
    if consequents is None:
        consequents = regression_consequent(df, rules, label, mean_based)
    y = quoted(label).cast("double")
    spark = df.sparkSession
    heads = every_rule(consequents.select("rule_id", "value", "spread"), rules, [])
    # Rules are model sized, like the two tables below that have one row or cell per rule.
    ends = {r["rule_id"]: (r["value"], r["spread"]) for r in heads.collect()}
    near = [F.abs(y - F.lit(v)) <= F.lit(s) if v is not None else F.lit(False) for v, s in (ends[i] for i in sorted(ends))]
    near_ids = F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(near, 1)])) if near else F.array().cast("array<int>")
    cells = df.where(y.isNotNull()).select(matching_ids(df, rules).alias("hit"), near_ids.alias("near"))
    tagged = F.concat(
        F.array(F.struct(F.lit(0).alias("rule_id"), F.lit("t").alias("k"))),
        F.transform("hit", lambda i: F.struct(i.alias("rule_id"), F.lit("c").alias("k"))),
        F.transform("near", lambda i: F.struct(i.alias("rule_id"), F.lit("a").alias("k"))),
        F.transform(F.array_intersect("hit", "near"), lambda i: F.struct(i.alias("rule_id"), F.lit("p").alias("k"))),
    )
    counts = cells.select(F.inline(tagged)).groupBy("rule_id", "k").agg(F.count(F.lit(1)).cast("double").alias("m"))
    of = lambda k: F.coalesce(F.max(F.when(F.col("k") == k, F.col("m"))), F.lit(0.0)).alias(k)
    total = counts.where("rule_id = 0").agg(F.coalesce(F.max("m"), F.lit(0.0)).alias("t"))
    per_rule = every_rule(counts.where("rule_id > 0").groupBy("rule_id").agg(of("c"), of("a"), of("p")), rules, ["c", "a", "p"])
    rows = spark.createDataFrame([(i, *ends[i]) for i in sorted(ends)], "rule_id int, value double, spread double")
    return (
        rows.join(per_rule, "rule_id")
        .join(F.broadcast(total), F.lit(True))  # one row
        .select("rule_id", "value", "spread", "p", (F.col("c") - F.col("p")).alias("n"), F.col("a").alias("p_all"),
                (F.col("t") - F.col("a")).alias("n_all"))
    )


def missing_policy(df: DataFrame, cond, label: str, target: str) -> DataFrame:
    """Counts of one condition under both treatments of a missing value.

    ``strict``: a missing value does not satisfy the condition.  ``ignore``: rows without a value are left out
    of P and N too.
    """
    pos = F.coalesce(label_text(df, label) == F.lit(target), F.lit(False))
    hit = F.coalesce(premise([cond], df.schema), F.lit(False))
    there = quoted(cond.attr).isNotNull()
    aggs = {"p": hit & pos, "n": hit & ~pos, "a": pos, "b": ~pos, "ia": pos & there, "ib": ~pos & there}
    t = df.agg(*[F.count(F.when(c, 1)).alias(name) for name, c in aggs.items()])
    rows = [
        F.struct(F.lit(policy).alias("policy"), F.col("p"), F.col("n"), F.col(a).alias("p_all"), F.col(b).alias("n_all"))
        for policy, a, b in (("strict", "a", "b"), ("ignore", "ia", "ib"))
    ]
    return t.select(F.inline(F.array(*rows)))
