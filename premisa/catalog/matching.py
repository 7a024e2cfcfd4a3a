"""Rules against examples: matching, counts, conclusions, curves and tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from premisa.catalog.registry import query
from premisa.catalog.tasks import (
    C_CLS, CLS, H_CLS, H_SURV, KEY, PREMISES_SQL, R_CLS, SURV, cls, counts, r6, rules_cls, rules_reg,
    rules_surv, surv,
)
from premisa.operators.counts import (
    class_prior, contingency, regression_consequent, regression_contingency, weighted_contingency,
)
from premisa.operators.matching import (
    coverage_matrix, covered, first_covering_rule, induction_trace, rule_match, uncovered,
)
from premisa.operators.rule_index import indexed_match
from premisa.operators.statistics import regression_pvalue, survival_pvalue
from premisa.operators.survival import kaplan_meier, km_at, log_rank, rule_curves
from premisa.plans.rules import Rule, RuleSet, at_least, equals, interval, less, not_equals

_K = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice"
_ANY = " or ".join(f"({p})" for p in PREMISES_SQL)
_FIRST = "case " + " ".join(f"when {p} then {i}" for i, p in enumerate(PREMISES_SQL, 1)) + " end"


@query("rule_match", f"with {CLS}, {H_CLS} select {_K}, rule_id from h")
def _match(spark, sf):
    return rule_match(cls(spark, sf), rules_cls(), KEY)


# The number of made rules, and the width of their price intervals.
MANY, WIDTH = 5000, 500


def many_rules() -> RuleSet:
    """Rules of three or four conditions each, spread over the prices."""
    out = []
    for i in range(MANY):
        low = 1000 + i * 7919 % 90000
        flag = [(equals("l_returnflag", "R"),), (not_equals("l_returnflag", "A"),), ()][i % 3]
        out.append(Rule((interval("l_extendedprice", low, low + WIDTH), at_least("l_quantity", 1 + i % 40), less("l_discount", (2 + i % 9) / 100), *flag)))
    return RuleSet(out, problem="classification", target="y")


@query(
    "rule_match_many",
    f"""with {CLS}, r as (
          select i + 1 as rule_id, 1000 + i * 7919 % 90000 as low, 1 + i % 40 as q, (2 + i % 9)::double / 100 as d, i % 3 as f from range({MANY}) g(i))
        select rule_id::int as rule_id, count(*) as covered, sum(l_orderkey)::bigint as orders from t join r on l_extendedprice >= low and l_extendedprice < low + {WIDTH}
          and l_quantity >= q and l_discount < d and (f = 2 or f = 0 and l_returnflag = 'R' or f = 1 and l_returnflag <> 'A') group by rule_id""",
)
def _match_many(spark, sf):
    """Thousands of rules by the bitmap index, in one scan; the matches of each are counted."""
    found = indexed_match(cls(spark, sf), many_rules(), KEY)
    return found.groupBy("rule_id").agg(F.count(F.lit(1)).alias("covered"), F.sum("l_orderkey").alias("orders"))


@query("covered", f"with {CLS} select {_K}, y from t where {_ANY}")
def _covered(spark, sf):
    return covered(cls(spark, sf), rules_cls()).select(*KEY, "y")


@query("uncovered", f"with {CLS} select {_K}, y from t where not ({_ANY})")
def _uncovered(spark, sf):
    return uncovered(cls(spark, sf), rules_cls()).select(*KEY, "y")


@query("first_covering_rule", f"with {CLS} select {_K}, {_FIRST} as first_rule from t")
def _first(spark, sf):
    return first_covering_rule(cls(spark, sf), rules_cls(), KEY)


@query(
    "coverage_matrix",
    f"with {CLS} select {_K}, " + ", ".join(f"({p})::int::tinyint as r{i}" for i, p in enumerate(PREMISES_SQL, 1)) + " from t",
)
def _matrix(spark, sf):
    return coverage_matrix(cls(spark, sf), rules_cls(), KEY)


_COUNTS = "p::bigint as p, n::bigint as n, p_all::bigint as p_all, n_all::bigint as n_all"


@query("contingency", f"with {CLS}, {R_CLS}, {H_CLS}, {C_CLS} select rule_id, label, {_COUNTS} from c")
def _contingency(spark, sf):
    return contingency(cls(spark, sf), rules_cls(), "y").select("rule_id", "label", *counts("p", "n", "p_all", "n_all"))


@query(
    "weighted_contingency",
    f"""with {CLS}, {R_CLS}, {H_CLS}
        select r.rule_id, r.label, sum(case when h.y = r.label then l_quantity else 0 end)::bigint as p,
               sum(case when h.y <> r.label then l_quantity else 0 end)::bigint as n,
               (select sum(l_quantity) from t where t.y = r.label)::bigint as p_all,
               (select sum(l_quantity) from t where t.y <> r.label)::bigint as n_all
        from r join h on h.rule_id = r.rule_id group by r.rule_id, r.label""",
)
def _weighted(spark, sf):
    out = weighted_contingency(cls(spark, sf), rules_cls(), "y", "l_quantity")
    return out.select("rule_id", "label", *counts("p", "n", "p_all", "n_all"))


@query(
    "class_prior",
    f"""with {CLS}, g as (select y as class_label, count(*) as p_all from t group by y)
        select class_label, p_all, round(p_all / sum(p_all) over (), 6) as prior,
               (row_number() over (order by p_all desc, class_label) = 1)::int as is_default from g""",
)
def _prior(spark, sf):
    return class_prior(cls(spark, sf), "y").select("class_label", *counts("p_all"), r6("prior"), "is_default")


@query(
    "regression_consequent",
    f"""with {CLS}, {H_CLS} select rule_id, count(*) as covered, round(avg(rev), 4) as value,
        round(stddev_pop(rev), 4) as spread from h group by rule_id""",
)
def _consequent(spark, sf):
    out = regression_consequent(cls(spark, sf), rules_reg(), "rev")
    return out.select("rule_id", "covered", F.round("value", 4).alias("value"), F.round("spread", 4).alias("spread"))


_MEDIANS = "m as (select rule_id, median(rev) as med from h group by rule_id)"


@query(
    "regression_consequent_median",
    f"""with {CLS}, {H_CLS}, {_MEDIANS}
        select rule_id, count(*) as covered, round(max(med), 4) as value,
               round(sqrt(avg((rev - med) * (rev - med))), 4) as spread
        from h join m using (rule_id) group by rule_id""",
)
def _consequent_median(spark, sf):
    out = regression_consequent(cls(spark, sf), rules_reg(), "rev", mean_based=False)
    return out.select("rule_id", "covered", F.round("value", 4).alias("value"), F.round("spread", 4).alias("spread"))


_REG_COUNTS = f"""{H_CLS}, q as (select rule_id, avg(rev) as value, stddev_pop(rev) as spread, count(*) as k from h group by rule_id)"""


@query(
    "regression_contingency",
    f"""with {CLS}, {_REG_COUNTS},
        a as (select rule_id, count(*) as p from h join q using (rule_id) where abs(rev - value) <= spread group by rule_id),
        b as (select rule_id, count(*) as p_all from q, t where abs(rev - value) <= spread group by rule_id)
        select rule_id, p, k - p as n, p_all, (select count(*) from t) - p_all as n_all
        from q join a using (rule_id) join b using (rule_id)""",
)
def _reg_contingency(spark, sf):
    out = regression_contingency(cls(spark, sf), rules_reg(), "rev")
    return out.select("rule_id", *counts("p", "n", "p_all", "n_all"))


# --- survival ----------------------------------------------------------------------------------


def km_sql(source: str, by: str = "") -> str:
    """CTE `km`: Kaplan-Meier points of a source with time and status."""
    part = f"partition by {by}" if by else ""
    pre = f"{by}, " if by else ""
    return f"""kg as (select {pre}time, sum(status)::double as events, (count(*) - sum(status))::double as censored,
        count(*)::double as m from {source} group by {pre}time),
      kr as (select *, sum(m) over ({part} order by time desc) as at_risk from kg),
      km as (select {pre}time, events, censored, at_risk,
        product(1 - events / at_risk) over ({part} order by time) as prob from kr)"""


@query(
    "kaplan_meier",
    f"""with {SURV}, {km_sql('t')} select time, events::bigint as events, censored::bigint as censored,
        at_risk::bigint as at_risk, round(prob, 6) as prob from km""",
)
def _km(spark, sf):
    out = kaplan_meier(surv(spark, sf), "time", "status")
    return out.select("time", *counts("events", "censored", "at_risk"), r6("prob"))


_H0 = H_SURV.replace("h as (", "h as (select 0 as rule_id, t.* from t union all ", 1)


@query(
    "rule_curves",
    f"""with {SURV}, {_H0}, {km_sql('h', 'rule_id')}
        select rule_id, time, events::bigint as events, censored::bigint as censored, at_risk::bigint as at_risk,
               round(prob, 6) as prob from km""",
)
def _curves(spark, sf):
    out = rule_curves(surv(spark, sf), rules_surv(), "time", "status")
    return out.select("rule_id", "time", *counts("events", "censored", "at_risk"), r6("prob"))


@query(
    "km_at",
    f"""with {SURV}, {_H0}, {km_sql('h', 'rule_id')}
        select rule_id, 365.0::double as t, round(coalesce(max_by(prob, time) filter (time <= 365), 1.0), 6) as prob,
               coalesce(sum(events) filter (time = 365), 0)::bigint as events,
               coalesce(max(at_risk) filter (time >= 365), 0)::bigint as at_risk
        from km group by rule_id""",
)
def _km_at(spark, sf):
    out = km_at(rule_curves(surv(spark, sf), rules_surv(), "time", "status"), 365, ["rule_id"])
    return out.select("rule_id", "t", r6("prob"), *counts("events", "at_risk"))


# The textbook form: at every event time, observed and expected events and the hypergeometric variance.
LOG_RANK = f"""{H_SURV},
  dt as (select time, sum(status)::double as d, count(*)::double as m from t group by time),
  n as (select time, d, sum(m) over (order by time desc) as n from dt),
  d1 as (select rule_id, time, sum(status)::double as d1, count(*)::double as m1 from h group by rule_id, time),
  g as (select r.rule_id, n.time, n.d, n.n, coalesce(d1.d1, 0) as d1, coalesce(d1.m1, 0) as m1
        from (select distinct rule_id from h) r cross join n left join d1 on d1.rule_id = r.rule_id and d1.time = n.time),
  s as (select *, sum(m1) over (partition by rule_id order by time desc) as n1 from g),
  lr as (select rule_id, sum(d1) as observed, sum(d * n1 / n) as expected,
         sum(case when n > 1 then d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) else 0 end) as variance
         from s group by rule_id)"""


@query(
    "log_rank",
    f"""with {SURV}, {LOG_RANK} select rule_id, observed::bigint as observed, round(expected, 6) as expected,
        round(variance, 6) as variance, round((observed - expected) ** 2 / variance, 6) as chi2 from lr""",
)
def _log_rank(spark, sf):
    out = log_rank(surv(spark, sf), rules_surv(), "time", "status")
    return out.select("rule_id", *counts("observed"), r6("expected"), r6("variance"), r6("chi2"))


@query(
    "survival_pvalue",
    f"""with {SURV}, {LOG_RANK} select rule_id, round((observed - expected) ** 2 / variance, 6) as chi2,
        (observed - expected) ** 2 / variance >= 3.841458820694124 as significant,
        round(1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 400 + cast(6 * half as bigint)),
            lambda n: exp(2 * n * ln(2) + (2 * n + 1) * ln(half) / 2 + lgamma(n + 1) - lgamma(2 * n + 2) - half))), 6) as pvalue
        from (select *, (observed - expected) ** 2 / variance / 2 as half from lr)""",
)
def _survival_pvalue(spark, sf):
    """The tail as SQL is the series of the error function."""
    out = survival_pvalue(surv(spark, sf), rules_surv(), "time", "status")
    return out.select("rule_id", r6("chi2"), (F.col("pvalue") <= 0.05).alias("significant"), r6("pvalue"))


def _variance_sql() -> str:
    parts = [
        f"select {i} as rule_id, count(*) filter ({p}) as covered, var_pop(rev) filter ({p}) as v, "
        f"var_pop(rev) filter (not ({p})) as u from t"
        for i, p in enumerate(PREMISES_SQL, 1)
    ]
    return " union all ".join(parts)


@query(
    "regression_pvalue",
    f"""with {CLS}, g as ({_variance_sql()}), x as (select *, covered * v / u / 2 as half, (covered - 1) / 2 as a from g)
        select rule_id, covered, round(2 * half, 4) as chi2,
        round(list_sum(list_transform(range(0, 1000 + cast(20 * sqrt(half) + greatest(half - a, 0) as bigint)),
            lambda n: exp((a + n) * ln(half) - half - lgamma(a + n + 1)))), 5) as pvalue from x""",
)
def _regression_pvalue(spark, sf):
    """The tail as SQL is the series of the incomplete gamma function."""
    out = regression_pvalue(cls(spark, sf), rules_reg(), "rev")
    return out.select("rule_id", *counts("covered"), F.round("chi2", 4).alias("chi2"), F.round("pvalue", 5).alias("pvalue"))


@query(
    "induction_trace",
    f"""with {CLS}, f as (select {_FIRST} as rule_id from t),
        r as (select unnest(range(1, 6))::int as rule_id),
        g as (select r.rule_id, count(f.rule_id) as newly_covered from r left join f using (rule_id) group by r.rule_id)
        select rule_id, newly_covered, (select count(*) from t) as total_examples,
               ((select count(*) from t) - sum(newly_covered) over (order by rule_id))::bigint as uncovered_examples from g""",
)
def _trace(spark, sf):
    return induction_trace(cls(spark, sf), rules_cls())


