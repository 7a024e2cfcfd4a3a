"""Kaplan-Meier curves and the log-rank statistic as aggregates over distinct times.

Log-rank of covered against uncovered examples needs, at every event time t, the number at risk
overall (n) and among the covered (n1) and the events overall (d).  With the cumulated tables

    H(t) = sum d/n        G(t) = sum c/n        K(t) = sum c/n^2,   c = d (n - d) / (n - 1)

over event times up to t, the expected events are the sum of H(T_i) over covered examples, the linear
part of the variance the sum of G(T_i), and the quadratic part the sum over covered times of
K(t) (n1^2 - (n1 - m)^2), m being the covered examples that leave at t.  H, G, K depend on the
training table alone, so one join by time serves every rule and every candidate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premisa.functions.premise import quoted
from premisa.operators.candidates import COARSE, bucketize, column_facts, fitting_bounds, value_buckets
from premisa.operators.matching import _rules, every_rule, matching_ids
from premisa.operators.running import running_sums

# Distinct times up to which the risk table (32 bytes per time) is broadcast; beyond, AQE joins it.
BROADCAST_TIMES = 500_000


def event_flag(df: DataFrame, status: str) -> Column:
    """Event indicator from a numeric, boolean or text status: 1 / 1.0 / true an event, 0 / 0.0 / false or null none.

    Any other status is an error.
    """
    s = F.lower(quoted(status).cast("string"))
    unknown = F.raise_error(F.concat(F.lit("unknown survival status: "), s)).cast("double")
    none = s.isNull() | s.isin("0", "0.0", "false")
    return F.when(s.isin("1", "1.0", "true"), F.lit(1.0)).when(none, F.lit(0.0)).otherwise(unknown)


def _time_cells(rows: DataFrame, by: Sequence[str], bounds, weight: str | None = None) -> DataFrame:
    """rows(by, time, event) to one row per distinct time with its counts."""
    rows = bucketize(rows, {"__b": bounds}, {"__b": "time"})
    w = F.col(weight) if weight else F.lit(1.0)
    return rows.groupBy(*by, "__b", "time").agg(F.sum(F.col("event") * w).alias("events"), F.sum(w).alias("leaving"))


def curve_from_counts(counts: DataFrame, bounds) -> DataFrame:
    """A curve from (time, events, leaving) rows, one per distinct time."""
    return _curve(bucketize(counts, {"__b": bounds}, {"__b": "time"}), [], bool(bounds))


def _curve(cells: DataFrame, by: Sequence[str], two_level: bool) -> DataFrame:
    bucket = "__b" if two_level else None
    risk = running_sums(cells, by, "time", ["leaving"], descending=True, bucket=bucket)
    risk = risk.withColumnRenamed("cum_leaving", "at_risk")
    # A curve is a running product of 1 - d/r; in logs it is a running sum, zeros counted apart.
    factor = F.lit(1.0) - F.col("events") / F.col("at_risk")
    risk = risk.withColumn("__f", F.when(factor > 0, F.log(factor)).otherwise(F.lit(0.0))).withColumn(
        "__z", F.when(factor > 0, F.lit(0.0)).otherwise(F.lit(1.0))
    )
    run = running_sums(risk, by, "time", ["__f", "__z"], bucket=bucket)
    return run.select(
        *by,
        "time",
        "events",
        (F.col("leaving") - F.col("events")).alias("censored"),
        "at_risk",
        F.when(F.col("cum___z") > 0, F.lit(0.0)).otherwise(F.exp("cum___f")).alias("prob"),
        # The value just before this time, from the same running sums.
        F.when(F.col("cum___z") > F.col("__z"), F.lit(0.0)).otherwise(F.exp(F.col("cum___f") - F.col("__f"))).alias(
            "prob_left"
        ),
    )


def kaplan_meier(df: DataFrame, time: str, status: str, by: Sequence[str] = (), bounds=None) -> DataFrame:
    """One point per distinct time: events, censored, at_risk, prob and prob_left (just before), per group.

    ``bounds`` splits the time axis for two-level sums; by default it is split where that is needed.
    """
    rows = df.select(*[quoted(b) for b in by], quoted(time).cast("double").alias("time"), event_flag(df, status).alias("event"))
    rows = rows.where("time is not null")
    if bounds is None:
        bounds = value_buckets(rows, ["time"])["time"]
    return _curve(_time_cells(rows, list(by), bounds), list(by), bool(bounds))


def rule_curves(df: DataFrame, ruleset, time: str, status: str, bounds=None) -> DataFrame:
    """Kaplan-Meier curve of the examples each rule covers, by rule_id; rule 0 is the whole table."""
    rows = df.select(
        matching_ids(df, ruleset).alias("ids"), quoted(time).cast("double").alias("time"), event_flag(df, status).alias("event")
    ).where("time is not null")
    # Rows of the same rules and time are added up first, then once for each of their rules.
    sums = rows.groupBy("ids", "time").agg(F.sum("event").alias("events"), F.count(F.lit(1)).cast("double").alias("leaving"))
    sums = sums.select(F.explode(F.concat(F.array(F.lit(0)), "ids")).alias("rule_id"), "time", "events", "leaving")
    if bounds is None:
        plain = df.select(quoted(time).cast("double").alias("time"))
        bounds = value_buckets(plain, ["time"])["time"]
    cells = bucketize(sums, {"__b": bounds}, {"__b": "time"}).groupBy("rule_id", "__b", "time").agg(
        F.sum("events").alias("events"), F.sum("leaving").alias("leaving"))
    return _curve(cells, ["rule_id"], bool(bounds))


def km_at(curve: DataFrame, t: float, by: Sequence[str] = ()) -> DataFrame:
    """Step-function lookup: the last point at or before t, probability 1 before the first time.

    events and censored are 0 between the curve's own times; at_risk counts those not yet gone at t.
    """
    upto = F.col("time") <= F.lit(float(t))
    after = F.when(F.col("time") >= F.lit(float(t)), F.struct("time", "at_risk"))
    return curve.groupBy(*by).agg(
        F.lit(float(t)).alias("t"),
        F.coalesce(F.max_by("prob", F.when(upto, F.col("time"))), F.lit(1.0)).alias("prob"),
        F.coalesce(F.sum(F.when(F.col("time") == F.lit(float(t)), F.col("events"))), F.lit(0.0)).alias("events"),
        F.coalesce(F.min(after)["at_risk"], F.lit(0.0)).alias("at_risk"),
    )


def risk_table(df: DataFrame, time: str, status: str, bounds=None, weight: str | None = None) -> DataFrame:
    """Per distinct time of the whole table: the cumulated H, G, K of the module text.

    With ``weight`` a row stands for that many equal ones.
    """
    rows = df.select(
        quoted(time).cast("double").alias("time"), event_flag(df, status).alias("event"),
        (quoted(weight) if weight else F.lit(1.0)).alias("weight"),
    ).where("time is not null")
    if bounds is None:
        bounds = value_buckets(rows, ["time"])["time"]
    cells = _time_cells(rows, [], bounds, "weight")
    bucket = "__b" if bounds else None
    risk = running_sums(cells, [], "time", ["leaving"], descending=True, bucket=bucket)
    steps = _hazards(F.col("events"), F.col("cum_leaving"))
    parts = risk.select("__b", "time", *[e.alias(x) for x, e in steps.items()])
    run = running_sums(parts, [], "time", ["h", "g", "k"], bucket=bucket)
    return run.select("time", F.col("cum_h").alias("H"), F.col("cum_g").alias("G"), F.col("cum_k").alias("K"))


def with_risk(df: DataFrame, time: str, status: str, weight: str | None = None) -> DataFrame:
    """Attach __event, __time, __H, __G, __K.  The risk table is aggregated to distinct times before the join."""
    _, distinct, coarse = column_facts(df, [time], {time: COARSE})
    bounds = fitting_bounds(df, distinct, coarse)[time]
    risk = risk_table(df, time, status, bounds, weight).select(
        F.col("time").alias("__time"), *[F.col(x).alias(f"__{x}") for x in "HGK"]
    )
    if distinct[time] <= BROADCAST_TIMES:
        risk = F.broadcast(risk)
    rows = df.withColumns({"__time": quoted(time).cast("double"), "__event": event_flag(df, status)})
    return rows.where("__time is not null").join(risk, "__time")


def log_rank_from_sums(o: Column, e: Column, v: Column, q: Column) -> Column:
    """(O - E)^2 / V; null when the variance vanishes."""
    variance = v - q
    return (o - e) * (o - e) / F.when(variance > 1e-12, variance)


def log_rank(df: DataFrame, ruleset, time: str, status: str) -> DataFrame:
    """Covered against uncovered, per rule: (rule_id, observed, expected, variance, chi2).

    One scan: the whole table rides along as rule 0, and its cumulated tables reach the other rules' cells by a
    window over equal times.  All windows run on (rule, time) aggregates.
    """
    bounds = value_buckets(df.select(quoted(time).cast("double").alias("time")), ["time"])["time"]
    ids = F.concat(F.array(F.lit(0)), matching_ids(df, ruleset))
    rows = df.select(
        F.explode(ids).alias("rule_id"), quoted(time).cast("double").alias("time"), event_flag(df, status).alias("event")
    ).where("time is not null")
    bucket = "__b" if bounds else None
    cells = running_sums(
        _time_cells(rows, ["rule_id"], bounds), ["rule_id"], "time", ["leaving"], descending=True, bucket=bucket
    )
    parts = cells.select("*", *[e.alias(x) for x, e in _hazards(F.col("events"), F.col("cum_leaving")).items()])
    run = running_sums(parts, ["rule_id"], "time", ["h", "g", "k"], bucket=bucket)
    same = Window.partitionBy("time")
    whole = [F.max(F.when(F.col("rule_id") == 0, F.col(f"cum_{x}"))).over(same).alias(x.upper()) for x in "hgk"]
    run = run.select("rule_id", "time", "events", "leaving", "cum_leaving", *whole).where("rule_id > 0")
    m, n1 = F.col("leaving"), F.col("cum_leaving")
    sums = run.groupBy("rule_id").agg(
        F.sum("events").alias("observed"),
        F.sum(m * F.col("H")).alias("expected"),
        F.sum(m * F.col("G")).alias("v"),
        F.sum(F.col("K") * (n1 * n1 - (n1 - m) * (n1 - m))).alias("q"),
    )
    return every_rule(_log_rank_row(sums), ruleset, ["observed", "expected", "variance"])


def _hazards(d: Column, n: Column) -> dict[str, Column]:
    """The increments of H, G, K at one time with d events among n at risk."""
    c = F.when(n > 1, d * (n - d) / (n - 1)).otherwise(F.lit(0.0))
    return {"h": d / n, "g": c / n, "k": c / (n * n)}


def _log_rank_row(sums: DataFrame) -> DataFrame:
    o, e, v, q = (F.col(x) for x in ("observed", "expected", "v", "q"))
    return sums.select("rule_id", o, e, (v - q).alias("variance"), log_rank_from_sums(o, e, v, q).alias("chi2"))


def log_rank_on(base: DataFrame, ruleset, bounds=None) -> DataFrame:
    """The same on a table that already carries the risk columns and the rows' weight __w; ``bounds`` are cuts of K."""
    hits = base.select(F.explode(matching_ids(base, _rules(ruleset))).alias("rule_id"), "__event", "__H", "__G", "__K", "__w")
    # Times with equal K cannot be told apart by the statistic, so K itself is the order.
    if bounds is None:
        bounds = value_buckets(base.select("__K"), ["__K"])["__K"]
    hits = bucketize(hits, {"__b": bounds}, {"__b": "__K"})
    cells = hits.groupBy("rule_id", "__b", "__K").agg(
        *[F.sum(F.col("__w") * F.col(c)).alias(x) for x, c in {"o": "__event", "e": "__H", "v": "__G"}.items()],
        F.sum("__w").alias("m"),
    )
    run = running_sums(cells, ["rule_id"], "__K", ["m"], descending=True, bucket="__b" if bounds else None)
    rest = F.col("cum_m") - F.col("m")
    per_rule = run.groupBy("rule_id").agg(
        F.sum("o").alias("observed"),
        F.sum("e").alias("expected"),
        F.sum("v").alias("v"),
        F.sum(F.col("__K") * (F.col("cum_m") * F.col("cum_m") - rest * rest)).alias("q"),
    )
    return _log_rank_row(per_rule)


def curve_jumps(curves: DataFrame, by: Sequence[str]) -> DataFrame:
    """Changes of probability: (by, time, jump); a curve is 1 plus the sum of its jumps up to t."""
    return curves.select(*by, "time", (F.col("prob") - F.col("prob_left")).alias("jump"))
