"""Learning tasks over the driver's tables, each as a DataFrame and as the equivalent SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from premisa.plans.rules import Rule, RuleSet, at_least, equals, interval, less, not_equals

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
NUMERIC, NOMINAL = FEATURES[:4], FEATURES[4:]
CLASSES = ["high", "low", "mid"]
SURVIVAL_FEATURES = ["l_quantity", "l_extendedprice", "l_returnflag", "o_orderpriority"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in three revenue classes; ``rev`` is the regression label."""
    df = table(spark, sf_dir, "lineitem")
    rev = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    y = F.when(rev >= 60000, "high").when(rev >= 25000, "mid").otherwise("low")
    return df.withColumns({"rev": rev, "y": y})


CLS = """t as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus, l_extendedprice * (1 - l_discount) as rev,
         case when l_extendedprice * (1 - l_discount) >= 60000 then 'high'
              when l_extendedprice * (1 - l_discount) >= 25000 then 'mid' else 'low' end as y
  from lineitem)"""


def miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a zero discount read as missing."""
    return cls(spark, sf_dir).withColumn("l_discount", F.nullif("l_discount", F.lit(0.0)))


MISS = CLS.replace("l_quantity, l_extendedprice, l_discount, l_tax,", "l_quantity, l_extendedprice, nullif(l_discount, 0.0) as l_discount, l_tax,")


def surv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days from order to shipping, an event where the line status is F."""
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    df = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return df.select(
        *KEY, "l_quantity", "l_returnflag", "o_orderpriority",
        F.datediff("l_shipdate", "o_orderdate").alias("time"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("status"),
    ).where("time > 0")


SURV = """t as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_quantity, l_returnflag, o_orderpriority,
         date_diff('day', o_orderdate::date, l_shipdate::date)::double as time,
         case when l_linestatus = 'F' then 1 else 0 end as status
  from lineitem join orders on l_orderkey = o_orderkey
  where date_diff('day', o_orderdate::date, l_shipdate::date) > 0)"""


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with simple text features."""
    d, q = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.join(q, "doc_id").select(
        "doc_id", "n_chars", "lang", "source", F.size(F.split(F.trim("text"), r"\s+")).alias("n_words"),
        F.col("quality").cast("string").alias("quality"),
    )


# --- fixed rule sets ---------------------------------------------------------------------------

_PREMISES = [
    ("l_extendedprice >= 70000 and l_discount < 0.055", (at_least("l_extendedprice", 70000), less("l_discount", 0.055))),
    ("l_extendedprice >= 62000", (at_least("l_extendedprice", 62000),)),
    ("l_extendedprice < 27000", (less("l_extendedprice", 27000),)),
    (
        "l_extendedprice >= 25000 and l_extendedprice < 60000 and l_returnflag <> 'A'",
        (interval("l_extendedprice", 25000, 60000), not_equals("l_returnflag", "A")),
    ),
    ("l_quantity >= 45 and l_returnflag = 'R'", (at_least("l_quantity", 45), equals("l_returnflag", "R"))),
]
_LABELS = ["high", "high", "low", "mid", "high"]


def rules_cls() -> RuleSet:
    rules = [Rule(c, target="y", label=v) for (_, c), v in zip(_PREMISES, _LABELS)]
    return RuleSet(rules, target="y", classes=list(CLASSES))


def rules_reg() -> RuleSet:
    rules = [Rule(c, target="rev", problem="regression") for _, c in _PREMISES]
    return RuleSet(rules, problem="regression", target="rev")


_SURVIVAL = [
    ("l_quantity < 25", (less("l_quantity", 25),)),
    ("l_returnflag = 'R'", (equals("l_returnflag", "R"),)),
    (
        "o_orderpriority <> '5-LOW' and l_extendedprice >= 50000",
        (not_equals("o_orderpriority", "5-LOW"), at_least("l_extendedprice", 50000)),
    ),
]


def rules_surv() -> RuleSet:
    rules = [Rule(c, target="status", problem="survival", weight=1.0) for _, c in _SURVIVAL]
    return RuleSet(rules, problem="survival", target="status")


# The rules as SQL: `r` lists them, `h` holds one row per covering rule and example.
R_CLS = "r as (select * from (values " + ", ".join(
    f"({i}, '{v}')" for i, v in enumerate(_LABELS, 1)
) + ") v(rule_id, label))"


def hits(premises, source: str = "t") -> str:
    return "h as (" + " union all ".join(
        f"select {i} as rule_id, {source}.* from {source} where {p}" for i, (p, _) in enumerate(premises, 1)
    ) + ")"


H_CLS, H_SURV = hits(_PREMISES), hits(_SURVIVAL)
PREMISES_SQL = [p for p, _ in _PREMISES]
SURVIVAL_SQL = [p for p, _ in _SURVIVAL]

C_CLS = """c as (
  select r.rule_id, r.label, coalesce(sum(case when h.y = r.label then 1 else 0 end), 0)::double as p,
         coalesce(sum(case when h.y <> r.label then 1 else 0 end), 0)::double as n,
         (select count(*) from t where t.y = r.label)::double as p_all,
         (select count(*) from t where t.y <> r.label)::double as n_all
  from r left join h on h.rule_id = r.rule_id group by r.rule_id, r.label)"""

CORRELATION = "(p * n_all - p_all * n) / nullif(sqrt(p_all * n_all * (p + n) * (p_all + n_all - p - n)), 0)"


def big(name: str) -> Column:
    return F.col(name).cast("long").alias(name)


def r6(name: str) -> Column:
    return F.round(F.col(name), 6).alias(name)


def counts(*names: str) -> list[Column]:
    return [big(n) for n in names]
