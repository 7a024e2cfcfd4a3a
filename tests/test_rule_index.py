"""The bitmap index against premises as expressions; survival lookups against whole curves."""

import math
import random

import pytest
from pyspark.sql import functions as F

from premisa.operators import rule_index
from premisa.operators.matching import rule_match
from premisa.operators.predict import predict_survival, survival_probability_at
from premisa.operators.survival import rule_curves
from premisa.plans.rules import Condition, Rule, RuleSet, at_least, equals, not_equals


def rules_of(rng, n):
    near = [1.0, math.nextafter(1.0, 2.0), math.nextafter(math.nextafter(1.0, 2.0), 2.0), 0.0, -0.0, 5.0, 9.5]
    out = []
    for _ in range(n):
        made = []
        for attr in rng.sample(["a", "b"], rng.randint(0, 2)):
            for _ in range(rng.choice([1, 1, 2])):
                lo, hi = sorted(rng.choice([*near, rng.random() * 10]) for _ in range(2))
                made.append(Condition(attr, "interval", rng.choice([lo, lo, None]), rng.random() < 0.5, hi, rng.random() < 0.5))
        if rng.random() < 0.6:
            made.append(rng.choice([equals, not_equals])("color", rng.choice(["red", "green", "none such"])))
        if rng.random() < 0.3:
            made.append(equals("flag", rng.choice(["True", "False"])))
        out.append(Rule(tuple(made)))
    return RuleSet(out, problem="classification", target="y")


@pytest.mark.parametrize("n, cells", [(1, 2048), (64, 5), (130, 2048)])
def test_index_equals_premises(spark, small, monkeypatch, n, cells):
    monkeypatch.setattr(rule_index, "CELLS_AT_ONCE", cells)
    rules = rules_of(random.Random(n), n)
    odd = spark.createDataFrame(
        [(1000, 1.0, math.nextafter(1.0, 2.0), "red", True), (1001, float("nan"), None, None, None), (1002, -0.0, math.inf, "blue", False)],
        "id long, a double, b double, color string, flag boolean")
    df = small.select("id", "a", "b", "color", "flag").unionByName(odd)
    got = sorted(map(tuple, rule_index.indexed_match(df, rules, ["id"]).collect()))
    assert got == sorted(map(tuple, rule_match(df, rules, ["id"]).collect())) and got


def test_index_joins_large_tables_and_keeps_columns(spark, small, monkeypatch):
    monkeypatch.setattr(rule_index, "BROADCAST_BYTES", 0)
    rules = RuleSet([Rule((at_least("a", 5),)), Rule(()), Rule((equals("color", "red"), at_least("b", 0.5)))], problem="classification", target="y")
    found = rule_index.covering_bits(small, rules)
    assert found.columns == [*small.columns, "rules"] and found.count() == small.count()
    for r in found.collect():
        want = [(r["a"] or 0) >= 5, True, r["color"] == "red" and not math.isnan(r["b"]) and r["b"] >= 0.5]
        assert r["rules"] == [sum(1 << k for k, w in enumerate(want) if w)]
    assert rule_index.covering_bits(small, RuleSet([Rule(())], problem="classification", target="y")).select("rules").distinct().collect()[0][0] == [1]


def test_survival_lookup_equals_the_curve(spark, small):
    df = small.withColumn("at", F.when(F.col("id") % 5 > 0, F.col("days") * (F.col("id") % 7) / 3))
    rules = RuleSet([Rule((at_least("a", 5),)), Rule((equals("color", "red"),))], problem="survival", target="died")
    curves = rule_curves(df, rules, "days", "died")
    got = {r["id"]: r["probability"] for r in survival_probability_at(df, rules, curves, F.col("at")).collect()}
    whole = predict_survival(df, rules, curves).collect()
    assert len(got) == len(whole)
    for r in whole:
        if r["at"] is None:
            assert got[r["id"]] is None
        else:
            want = [x["prob"] for x in r["prediction"] if x["time"] <= r["at"]]
            assert abs(got[r["id"]] - (want[-1] if want else 1.0)) < 1e-9
