"""Scans, roles, missing values, profiles and elementary conditions."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from premisa.catalog.registry import query
from premisa.catalog.tasks import (
    C_CLS, CLS, FEATURES, H_CLS, KEY, MISS, NOMINAL, NUMERIC, R_CLS, cls, miss, rules_cls, table,
)
from premisa.functions.premise import condition, premise
from premisa.operators.counts import contingency, missing_policy
from premisa.operators.predict import predict_class
from premisa.operators.statistics import rule_stats
from premisa.plans.rules import RuleSet, at_least, equals, interval, less, not_equals
from premisa.roles import dataset_profile, example_set, explode_features, label_domain, normalise_missing, validate_roles
from premisa.session import scratch_path
from premisa.sources.arff import arff_scan
from premisa.sources.store import load_ruleset, ruleset_text, save_ruleset


@query(
    "arff_scan",
    f"""with {MISS} select case l_orderkey % 3 when 0 then '@data' when 1 then 'a, note' else '%, b' end as note,
        l_orderkey::double as l_orderkey, l_quantity, l_extendedprice, l_discount,
        l_returnflag as "return flag", y from t""",
)
def _arff(spark, sf):
    """Line items written out as ARFF files, each with a header, comments between its rows and quoted cells, then scanned;
    some notes begin with an at sign, as lines of a header do."""
    path = scratch_path(spark, "arff")
    header = ["% a comment", "@relation items", "", "@ATTRIBUTE note string", "@attribute l_orderkey integer", "@attribute l_quantity numeric",
              "@attribute l_extendedprice real", "@attribute l_discount NUMERIC", "@attribute 'return flag' {A,N,R}",
              "@attribute y {low, mid, high}", "@data"]
    note = F.when(F.col("l_orderkey") % 3 == 0, "@data").when(F.col("l_orderkey") % 3 == 1, "'a, note'").otherwise('"%, b"')
    rows = miss(spark, sf).select(
        (F.col("l_orderkey") % 2).alias("part"),
        F.concat_ws(", ", note, *[F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in (
            "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "y")]).alias("value"))
    rows = rows.withColumn("value", F.when(F.col("part") == 0, F.concat(F.col("value"), F.lit("\n  % 1, 2, a comment\n"))).otherwise(F.col("value")))
    head = "\n".join([*header[:-1], "% more", header[-1], "% and more"])
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of its task, which writes one file
    for part in (0, 1):
        body = rows.where(F.col("part") == part)
        body = body.select(F.when(first, F.concat(F.lit(head + "\n"), "value")).otherwise(F.col("value")).alias("value"))
        # A file of its own with nothing but a header stands in where a part has no rows.
        spark.createDataFrame([(head,)], "value string").unionByName(body).write.text(f"{path}/{part}")
    return arff_scan(spark, f"{path}/*")


@query(
    "example_set",
    f"""with {MISS} select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
        l_tax, l_returnflag, l_linestatus, y from t""",
)
def _example_set(spark, sf):
    return example_set(miss(spark, sf), "y", features=FEATURES, key=KEY[:4])


@query(
    "explode_features",
    "select vec_id, label, " + ", ".join(f"round(embedding[{i}]::double, 6) as att{i}" for i in range(1, 65)) + " from embeddings",
)
def _explode(spark, sf):
    wide = explode_features(table(spark, sf, "embeddings"), "embedding", 64, keep=["vec_id", "label"])
    return wide.select("vec_id", "label", *[F.round(f"att{i}", 6).alias(f"att{i}") for i in range(1, 65)])


@query(
    "normalise_missing",
    f"""with {CLS} select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
        nullif(l_tax, 0.0) as l_tax, nullif(l_returnflag, 'A') as l_returnflag from t""",
)
def _missing(spark, sf):
    df = cls(spark, sf).select(
        *KEY,
        F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_returnflag") == "A", "?").otherwise(F.col("l_returnflag")).alias("l_returnflag"),
    )
    return normalise_missing(df)


@query(
    "attribute_types",
    """select 'o_custkey' as attr, 'numeric' as kind, count(o_custkey) as n_values from orders
       union all select 'o_orderkey', 'numeric', count(o_orderkey) from orders
       union all select 'o_orderpriority', 'nominal', count(o_orderpriority) from orders
       union all select 'o_orderstatus', 'nominal', count(o_orderstatus) from orders
       union all select 'o_totalprice', 'numeric', count(o_totalprice) from orders
       union all select 'open', 'nominal', count(o_orderstatus = 'O') from orders""",
)
def _types(spark, sf):
    df = table(spark, sf, "orders").withColumn("open", F.col("o_orderstatus") == "O").drop("o_orderdate")
    return dataset_profile(df).select("attr", "kind", (F.col("n_rows") - F.col("n_missing")).alias("n_values"))


@query(
    "label_domain",
    """with g as (select o_orderpriority as class_label, min(o_orderkey) as first_key, count(*) as n_rows
                  from orders group by o_orderpriority)
       select class_label, n_rows, row_number() over (order by first_key, class_label)::int as class_rank from g""",
)
def _labels(spark, sf):
    return label_domain(table(spark, sf, "orders"), "o_orderpriority", F.col("o_orderkey"))


@query(
    "validate_roles",
    f"""with {CLS}, f as (select unnest({FEATURES!r}) as attr)
        select attr, case when attr like '%flag' or attr like '%status' then 'nominal' else 'numeric' end as kind,
               (select count(*) from t) as n_rows from f""".replace('"', "'"),
)
def _roles(spark, sf):
    """Roles are checked on the schema; the accepted features are profiled."""
    df = cls(spark, sf)
    roles = validate_roles(df, "classification", "y", contrast="l_linestatus", features=FEATURES[:5])
    return dataset_profile(df, [*roles.features, roles.contrast]).select("attr", "kind", "n_rows")


def _profile_sql(column: str, kind: str) -> str:
    stats = [f"avg({column})", f"stddev_samp({column})", f"min({column})", f"max({column})"]
    if kind == "nominal":
        stats = ["null::double"] * 4
    values = ", ".join(f"round({s}, 6) as {n}" for s, n in zip(stats, ("mean_value", "std_value", "min_value", "max_value")))
    return f"select '{column}' as attr, '{kind}' as kind, count(*) as n_rows, count(*) - count({column}) as n_missing, {values} from t"


@query(
    "dataset_profile",
    f"with {MISS} " + " union all ".join(
        [_profile_sql(c, "numeric") for c in NUMERIC] + [_profile_sql(c, "nominal") for c in NOMINAL]
    ),
)
def _profile(spark, sf):
    out = dataset_profile(miss(spark, sf), FEATURES)
    stats = [F.round(c, 6).alias(c) for c in ("mean_value", "std_value", "min_value", "max_value")]
    return out.select("attr", "kind", "n_rows", "n_missing", *stats)


def weighted_rules(spark, sf) -> RuleSet:
    """The fixed rule set with counts, weights and p-values from the table."""
    rules = rules_cls()
    found = {r["rule_id"]: r for r in rule_stats(contingency(cls(spark, sf), rules, "y")).collect()}
    names = ("p", "n", "p_all", "n_all", "weight", "pvalue")
    rules.rules = [replace(r, **{n: found[i][n] for n in names}) for i, r in enumerate(rules.rules, 1)]
    total = found[1]["p_all"] + found[1]["n_all"]
    rules.priors = {found[i]["label"]: found[i]["p_all"] / total for i in found}
    rules.default_label = max(sorted(rules.priors), key=rules.priors.get)
    return rules


_CORR = "(p * n_all - p_all * n) / nullif(sqrt(p_all * n_all * (p + n) * (p_all + n_all - p - n)), 0)"
VOTES = f"""w as (select *, {_CORR} as weight from c),
  k as (select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice from t),
  hw as (select h.*, w.weight, w.label from h join w on h.rule_id = w.rule_id),
  votes as (select t.l_orderkey, t.l_partkey, t.l_suppkey, t.l_linenumber, t.l_extendedprice, t.y, t.rev,
      sum(case when label = 'high' then weight end) as v_high, sum(case when label = 'low' then weight end) as v_low,
      sum(case when label = 'mid' then weight end) as v_mid, count(rule_id) as k_rules
    from t left join hw using (l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice)
    group by all),
  prior as (select y as class_label, count(*)::double / (select count(*) from t) as prior from t group by y),
  dflt as (select class_label from prior order by prior desc, class_label limit 1),
  pred as (select *, case when k_rules = 0 then (select class_label from dflt)
      when v_high is not null and v_high >= coalesce(v_low, -1e9) and v_high >= coalesce(v_mid, -1e9) then 'high'
      when v_low is not null and v_low >= coalesce(v_mid, -1e9) then 'low' else 'mid' end as prediction from votes)"""


@query(
    "ruleset_round_trip",
    f"""with {CLS}, {R_CLS}, {H_CLS}, {C_CLS}, {VOTES}
        select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, prediction from pred""",
)
def _round_trip(spark, sf):
    """Saved, loaded, saved and loaded again: predictions stay the same."""
    rules = weighted_rules(spark, sf)
    for _ in range(2):
        path = scratch_path(spark, "model")
        save_ruleset(spark, rules, path)
        rules = load_ruleset(spark, path)
    return predict_class(cls(spark, sf), rules).select(*KEY, "prediction")


@query(
    "ruleset_text",
    f"""with {CLS}, {R_CLS}, {H_CLS}, {C_CLS},
        x as (select * from (values
          (1, 'IF l_extendedprice = <70000, inf) AND l_discount = (-inf, 0.06) THEN y = {{high}}'),
          (2, 'IF l_extendedprice = <62000, inf) THEN y = {{high}}'),
          (3, 'IF l_extendedprice = (-inf, 27000) THEN y = {{low}}'),
          (4, 'IF l_extendedprice = <25000, 60000) AND l_returnflag = !{{A}} THEN y = {{mid}}'),
          (5, 'IF l_quantity = <45, inf) AND l_returnflag = {{R}} THEN y = {{high}}')) v(rule_id, text))
        select c.rule_id, x.text || ' (p=' || p::bigint || ', n=' || n::bigint || ')' as text from c join x using (rule_id)""",
)
def _text(spark, sf):
    rules = weighted_rules(spark, sf)
    text = ruleset_text(rules.rules_table(spark), rules.conditions_table(spark))
    counted = contingency(cls(spark, sf), rules, "y").select("rule_id", "p", "n")
    return text.join(counted, "rule_id").select(
        "rule_id", F.format_string("%s (p=%d, n=%d)", "text", F.col("p").cast("long"), F.col("n").cast("long")).alias("text")
    )


_CONDITIONS = {
    "cond_less": (less("l_extendedprice", 27000), "l_extendedprice < 27000"),
    "cond_at_least": (at_least("l_quantity", 45), "l_quantity >= 45"),
    "cond_interval": (
        interval("l_extendedprice", 25000, 60000, lo_closed=False, hi_closed=True),
        "l_extendedprice > 25000 and l_extendedprice <= 60000",
    ),
    "cond_equals": (equals("l_returnflag", "R"), "l_returnflag = 'R'"),
    "cond_not_equals": (not_equals("l_returnflag", "A"), "l_returnflag <> 'A'"),
}


def _condition_query(cond, where):
    sql = f"with {MISS} select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, y from t where {where}"

    def run(spark, sf):
        df = miss(spark, sf)
        return df.where(condition(cond, df.schema)).select(*KEY, "y")

    return sql, run


for _name, (_cond, _where) in _CONDITIONS.items():
    _sql, _run = _condition_query(_cond, _where)
    query(_name, _sql)(_run)


@query(
    "premise",
    f"""with {MISS} select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, y from t
        where l_discount >= 0.02 and l_discount < 0.055 and l_returnflag <> 'A' and l_quantity >= 10""",
)
def _premise(spark, sf):
    df = miss(spark, sf)
    conds = [interval("l_discount", 0.02, 0.055), not_equals("l_returnflag", "A"), at_least("l_quantity", 10)]
    return df.where(premise(conds, df.schema)).select(*KEY, "y")


@query(
    "missing_policy",
    f"""with {MISS}, g as (select
          count(case when l_discount < 0.05 and y = 'high' then 1 end) as p,
          count(case when l_discount < 0.05 and y <> 'high' then 1 end) as n,
          count(case when y = 'high' then 1 end) as a, count(case when y <> 'high' then 1 end) as b,
          count(case when y = 'high' and l_discount is not null then 1 end) as ia,
          count(case when y <> 'high' and l_discount is not null then 1 end) as ib from t)
        select 'strict' as policy, p, n, a as p_all, b as n_all from g
        union all select 'ignore', p, n, ia, ib from g""",
)
def _policy(spark, sf):
    return missing_policy(miss(spark, sf), less("l_discount", 0.05), "y", "high")
