"""Scores of predictions; each is one aggregate over the scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premisa.functions.premise import quoted
from premisa.operators.candidates import bucketize, value_buckets
from premisa.operators.predict import covering_classes, covering_rules, predicted_class, signature, signature_jumps
from premisa.operators.running import running_sums
from premisa.operators.survival import curve_from_counts, event_flag
from premisa.ordering import positioned
from premisa.plans.rules import RuleSet
from premisa.roles import class_text, label_text
from premisa.session import written


def accuracy(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    same = F.col("y") == F.col("f")
    pairs = df.select(label_text(df, label).alias("y"), class_text(df, label, quoted(prediction)).alias("f"))
    return pairs.agg(F.avg(same.cast("double")).alias("accuracy"))


def prediction_metrics(df: DataFrame, ruleset: RuleSet, label: str | None = None) -> DataFrame:
    """Mean number of covering rules, and conflicts: rows whose covering rules name different classes.

    With a label also the conflicts that were resolved wrongly.
    """
    cols = [covering_rules(df, ruleset).alias("k"), (covering_classes(df, ruleset) > 1).alias("conflict")]
    if label is not None:
        wrong = label_text(df, label) != class_text(df, label, predicted_class(df, ruleset))
        cols.append(wrong.alias("wrong"))
    aggs = [
        F.avg("k").alias("rules_per_example"),
        F.count(F.when(F.col("conflict"), 1)).alias("voting_conflicts"),
    ]
    if label is not None:
        aggs.append(F.count(F.when(F.col("conflict") & F.col("wrong"), 1)).alias("negative_voting_conflicts"))
    return df.select(*cols).agg(*aggs)


def confusion_matrix(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    predicted = class_text(df, label, quoted(prediction)).alias("predicted")
    return df.groupBy(label_text(df, label).alias("actual"), predicted).agg(F.count(F.lit(1)).alias("n"))


def binary_metrics(df: DataFrame, label: str, positive: str, prediction: str = "prediction", proba: str | None = None):
    """Scores of a two-way decision (``positive`` against the rest); log loss if a probability is given."""
    y = label_text(df, label) == F.lit(str(positive))
    f = class_text(df, label, quoted(prediction)) == F.lit(str(positive))
    cols = [F.coalesce(y, F.lit(False)).alias("y"), F.coalesce(f, F.lit(False)).alias("f")]
    aggs = [
        F.sum((F.col("y") & F.col("f")).cast("double")).alias("tp"),
        F.sum((F.col("y") & ~F.col("f")).cast("double")).alias("fn"),
        F.sum((~F.col("y") & F.col("f")).cast("double")).alias("fp"),
        F.sum((~F.col("y") & ~F.col("f")).cast("double")).alias("tn"),
    ]
    if proba is not None:
        tiny = 2.220446049250313e-16
        cols.append(F.least(F.greatest(quoted(proba), F.lit(tiny)), F.lit(1.0 - tiny)).alias("s"))
        loss = F.when(F.col("y"), -F.log("s")).otherwise(-F.log(F.lit(1.0) - F.col("s")))
        aggs.append(F.avg(loss).alias("log_loss"))
    t = df.select(*cols).agg(*aggs)
    tp, fn, fp, tn = (F.col(c) for c in ("tp", "fn", "fp", "tn"))
    total = tp + fn + fp + tn

    def div(a, b):
        return a / F.nullif(b, F.lit(0.0))

    tpr, tnr, ppv, npv = div(tp, tp + fn), div(tn, tn + fp), div(tp, tp + fp), div(tn, tn + fn)
    chance = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (total * total)
    metrics = {
        "sensitivity": tpr,
        "specificity": tnr,
        "ppv": ppv,
        "npv": npv,
        "psep": ppv + npv - 1,
        "fall_out": div(fp, fp + tn),
        "youden": tpr + tnr - 1,
        "lift": div(ppv, (tp + fn) / total),
        "f_measure": div(2 * tp, 2 * tp + fp + fn),
        "fowlkes_mallows": F.sqrt(ppv * tpr),
        "geometric_mean": F.sqrt(tpr * tnr),
        "kappa": div((tp + tn) / total - chance, F.lit(1.0) - chance),
        "balanced_accuracy": (tpr + tnr) / 2,
        "mean_absolute_error": (fp + fn) / total,
        "accuracy": (tp + tn) / total,
    }
    if proba is not None:
        metrics["log_loss"] = F.col("log_loss")
    return t.select(*[m.alias(name) for name, m in metrics.items()])


def _pairs(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.select(quoted(label).cast("double").alias("y"), quoted(prediction).cast("double").alias("f")).where(
        "y is not null and f is not null"
    )


def r2(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """1 - residual / total sum of squares; the total comes from the population variance, in one pass."""
    t = _pairs(df, label, prediction).agg(
        F.avg((F.col("y") - F.col("f")) ** 2).alias("mse"), F.var_pop("y").alias("var")
    )
    return t.select((F.lit(1.0) - F.col("mse") / F.nullif(F.col("var"), F.lit(0.0))).alias("r2"))


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Absolute, relative (plain, lenient, strict), normalised, squared and root errors, correlations."""
    y, f = F.col("y"), F.col("f")
    gap = F.abs(y - f)
    zero = F.lit(0.0)
    pairs = _pairs(df, label, prediction)
    mean = pairs.agg(F.avg("y")).first()[0]  # one number, needed by the normalised error
    t = pairs.agg(
        F.avg(gap).alias("absolute_error"),
        F.avg(gap / F.nullif(F.abs(y), zero)).alias("relative_error"),
        F.avg(gap / F.nullif(F.greatest(F.abs(y), F.abs(f)), zero)).alias("relative_error_lenient"),
        F.avg(gap / F.nullif(F.least(F.abs(y), F.abs(f)), zero)).alias("relative_error_strict"),
        (F.avg(gap) / F.nullif(F.avg(F.abs(y - F.lit(mean))), zero)).alias("normalized_absolute_error"),
        F.avg((y - f) ** 2).alias("squared_error"),
        F.sqrt(F.avg((y - f) ** 2)).alias("root_mean_squared_error"),
        F.sqrt(F.avg((y - f) ** 2) / F.nullif(F.var_pop(y), zero)).alias("root_relative_squared_error"),
        F.corr(y, f).alias("correlation"),
        (F.corr(y, f) ** 2).alias("squared_correlation"),
        (F.lit(1.0) - F.var_pop(y - f) / F.nullif(F.var_pop(y), zero)).alias("explained_variance"),
    )
    return t


def brier_curve(df: DataFrame, ruleset, curves: DataFrame, time: str, status: str) -> DataFrame:
    """(time, brier): censoring-weighted squared error of the predicted curves at every time of ``df``.

    Per signature both parts of the score, events so far and those still at risk, are step functions that change
    only at the signature's own times.  Their changes are added over signatures by time, then accumulated.
    """
    rows = df.select(
        signature(df, ruleset).alias("signature"),
        quoted(time).cast("double").alias("time"),
        event_flag(df, status).alias("event"),
    ).where("time is not null")
    counts = rows.groupBy("signature", "time").agg(F.sum("event").alias("d"), F.count(F.lit(1)).cast("double").alias("m"))
    # The only scan of the examples.  Everything below works on this table of signatures and times.
    counts = written(counts, "brier")
    bounds = value_buckets(counts, ["time"])["time"]
    # Left limits weight the events, values at t those still at risk.
    gone = counts.groupBy("time").agg(F.sum(F.col("m") - F.col("d")).alias("events"), F.sum("m").alias("leaving"))
    censoring = curve_from_counts(gone, bounds).select(
        "time", F.col("prob").alias("g"), F.col("prob_left").alias("g_left"), (F.col("events") + F.col("censored")).alias("k")
    )
    cells = counts.join(censoring, "time").select(
        "signature", "time", "m", (F.col("d") / F.nullif(F.col("g_left"), F.lit(0.0))).alias("a"), F.lit(0.0).alias("jump")
    )
    sizes = counts.groupBy("signature").agg(F.sum("m").alias("size"))
    steps = signature_jumps(counts, curves).select("signature", "time", F.lit(0.0).alias("m"), F.lit(0.0).alias("a"), "jump")
    both = cells.unionByName(steps).groupBy("signature", "time").agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("m", "a", "jump")]
    )
    both = bucketize(both, {"__b": bounds}, {"__b": "time"})
    run = running_sums(both, ["signature"], "time", ["m", "a", "jump"], bucket="__b" if bounds else None).join(sizes, "signature")
    # Each part at a time less its value just before, which the same running sums give without their own term.
    prob, before = F.lit(1.0) + F.col("cum_jump"), F.lit(1.0) + F.col("cum_jump") - F.col("jump")
    left = F.col("size") - F.col("cum_m")
    deltas = run.select(
        "time",
        (prob * prob * F.col("cum_a") - before * before * (F.col("cum_a") - F.col("a"))).alias("u"),
        ((1 - prob) * (1 - prob) * left - (1 - before) * (1 - before) * (left + F.col("m"))).alias("v"),
    )
    by_time = deltas.groupBy("time").agg(F.sum("u").alias("u"), F.sum("v").alias("v"))
    by_time = bucketize(by_time, {"__b": bounds}, {"__b": "time"})
    total = running_sums(by_time, [], "time", ["u", "v"], bucket="__b" if bounds else None)
    n = censoring.agg(F.sum("k")).first()[0]  # one number
    at_risk_part = F.when(F.col("g") > 0, F.col("cum_v") / F.col("g")).otherwise(F.lit(0.0))
    return total.join(censoring, "time").select("time", ((F.col("cum_u") + at_risk_part) / F.lit(n)).alias("brier"))


def integrated_brier_score(df: DataFrame, ruleset, curves: DataFrame, time: str, status: str) -> DataFrame:
    """Area under the Brier curve from 0 to the last time, divided by the last time.

    Distinct times are placed in order by ranges; a time meets the next one in a join of their places.
    """
    curve = brier_curve(df, ruleset, curves, time, status)
    placed = positioned(curve, [F.col("time")], "place", "brier")
    after = placed.select((F.col("place") - 1).alias("place"), F.col("time").alias("until"))
    steps = placed.join(after, "place", "left")
    return steps.agg((F.sum(F.col("brier") * (F.col("until") - F.col("time"))) / F.max("time")).alias("ibs"))
