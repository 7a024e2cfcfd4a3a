"""Label types and data shapes that the line item table does not have."""

import pytest
from pyspark.sql import functions as F

import premisa.catalog.data as catalog_data
import premisa.operators.predict as predict
from premisa import ContrastSetRuleRegressor, ContrastSetSurvivalRules, RuleClassifier
from premisa.functions.measures import user_measure
from premisa.operators.counts import regression_consequent, regression_contingency
from premisa.operators.evaluate import binary_metrics, confusion_matrix
from premisa.operators.predict import predict_survival, survival_probability_at
from premisa.operators.selection import class_ranks
from premisa.operators.survival import event_flag, log_rank, rule_curves
from premisa.plans.rules import Rule, RuleSet, at_least, less
from premisa.sources.arff import arff_scan


@pytest.fixture
def settings(spark):
    """Sets Spark settings until the end of the test."""
    before = {}

    def change(values):
        for k, v in values.items():
            before.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield change
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_arff_rows_and_quotes(spark, tmp_path):
    path = tmp_path / "a.arff"
    path.write_text(
        "% a comment\n@relation r\n@attribute s {'x,1', \"y z\", w}\n@attribute n numeric\n@attribute 't t' string\n@data\n"
        "'x,1',1,a\n  %odd,2,'b, c'\n@odd,3,\"q,z\"\n\"y z\",4,'it, too'\nw,?,?\n"
    )
    df = arff_scan(spark, str(path))
    assert [tuple(r) for r in df.collect()] == [
        ("x,1", 1.0, "a"), ("@odd", 3.0, "q,z"), ("y z", 4.0, "it, too"), ("w", None, None)]
    assert df.schema["s"].metadata["domain"] == ["x,1", "y z", "w"]


def test_unknown_status_is_refused(spark):
    df = spark.createDataFrame([("1",), ("0",), (None,), ("true",)], "s string")
    assert [r[0] for r in df.select(event_flag(df, "s")).collect()] == [1.0, 0.0, 0.0, 1.0]
    bad = spark.createDataFrame([("dead",)], "s string")
    with pytest.raises(Exception, match="unknown survival status"):
        bad.select(event_flag(bad, "s")).collect()


def test_approximate_search_sees_rare_values(spark):
    df = spark.range(20_000).selectExpr("id", "pmod(id * 7919, 1000) / 10 as noise", "if(id % 200 = 0, 1.0, 0.0) as r",
                                        "if(id % 200 = 0, 'yes', 'no') as y")
    model = RuleClassifier(approximate_induction=True, approximate_bins_count=20, max_rule_count=1).fit(df, label="y", features=["noise", "r"])
    yes = [r for r in model.model if r.label == "yes"]
    assert yes and yes[0].n == 0 and yes[0].p == 100 and yes[0].conditions[0].attr == "r"


def test_labels_of_every_type(spark):
    base = spark.range(400).selectExpr("cast(id as double) as x", "id >= 150 as b", "cast(id >= 150 as int) as i")
    for label, positive in (("b", "True"), ("i", "1")):
        model = RuleClassifier().fit(base, label=label, features=["x"])
        assert model.score(base, label) == 1.0
        predicted = model.predict(base)
        assert binary_metrics(predicted, label, positive).first()["sensitivity"] == 1.0
        assert all(r["actual"] == r["predicted"] for r in confusion_matrix(predicted, label).collect())


def test_rules_that_cover_nothing_stay(spark):
    df = spark.range(20).selectExpr("cast(id as double) as x", "cast(id as double) as y", "cast(id % 2 as int) as s")
    rules = RuleSet([Rule((at_least("x", 100),)), Rule((less("x", 5),))], problem="regression", target="y")
    found = {r["rule_id"]: r for r in regression_consequent(df, rules, "y").collect()}
    assert found[1]["covered"] == 0 and found[1]["value"] is None and found[2]["covered"] == 5
    assert {r["rule_id"]: r["p"] for r in regression_contingency(df, rules, "y").collect()} == {1: 0.0, 2: 3.0}
    nothing = RuleSet(rules.rules[:1], problem="regression", target="y")
    assert [(r["p"], r["n"], r["p_all"], r["n_all"]) for r in regression_contingency(df, nothing, "y").collect()] == [(0.0, 0.0, 0.0, 20.0)]
    ranks = {r["rule_id"]: r for r in log_rank(df, rules, "y", "s").collect()}
    assert ranks[1]["observed"] == 0 and ranks[1]["chi2"] is None and ranks[2]["chi2"] is not None


def test_user_measures(spark):
    df = spark.createDataFrame([(3.0, 0.0, 5.0, 5.0), (2.0, 1.0, 5.0, 5.0)], "p double, n double, a double, b double")
    args = [F.col(c) for c in "pnab"]
    value = lambda f: [r[0] for r in df.select(user_measure(f)(*args)).collect()]
    assert value(lambda p, n, P, N: p / n) == [None, 2.0]
    assert value(lambda p, n, P, N: p / n if p > 2.5 else p + n) == [None, 3.0]
    assert value(lambda p, n, P, N: F.sqrt(p - n) * 0 + p) == [3.0, 2.0]
    with pytest.raises(KeyError):
        user_measure(lambda p, n, P, N: {}["missing"])(*args)


def test_contrast_models_predict_and_score(spark, small):
    df = small.where("a is not null and color is not null")
    values = ContrastSetRuleRegressor(max_growing=1, approximate_induction=True).fit(df, "value", "flag", features=["a", "b"])
    assert values.predict(df).schema["prediction"].dataType.typeName() == "double"
    assert isinstance(values.score(df, "value"), float)
    curves = ContrastSetSurvivalRules(max_growing=1, approximate_induction=True).fit(df, "died", "days", "flag", features=["a", "b"])
    assert curves.predict(df).schema["prediction"].dataType.typeName() == "array"
    assert 0 <= curves.score(df, "died", "days") <= 1


def test_ranks_do_not_gather_a_class(spark, settings):
    settings({"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.files.openCostInBytes": "0"})
    df = spark.range(0, 20_000, 1, 8).selectExpr("id", "if(id < 19000, 'a', if(id < 19900, null, 'b')) as y")
    ranked = class_ranks(df, ["y"], ["id"]).persist()
    sizes = {r["y"]: (r["n"], r["last"], r["size"]) for r in ranked.groupBy("y").agg(
        F.countDistinct("__rank").alias("n"), F.max("__rank").alias("last"), F.max("__size").alias("size")).collect()}
    assert sizes == {"a": (19_000, 18_999, 19_000), None: (900, 899, 900), "b": (100, 99, 100)}
    largest = ranked.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0]
    ranked.unpersist()
    assert largest <= 12_000


def test_arff_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    items = spark.range(0, 400, 1, 8).selectExpr(
        "id as l_orderkey", "double(id) as l_quantity", "1000.0D + id as l_extendedprice", "nullif(id % 3, 0) / 100 as l_discount",
        "'A' as l_returnflag", "'low' as y")
    seen = []
    monkeypatch.setattr(catalog_data, "miss", lambda spark, sf: items)
    monkeypatch.setattr(catalog_data, "arff_scan", lambda spark, path: seen.append(path) or arff_scan(spark, path))
    df = catalog_data._arff(spark, "")
    assert sorted(r["l_orderkey"] for r in df.collect()) == [float(i) for i in range(400)]
    assert df.where("l_discount is null").count() == 134 and df.where("note is null").count() == 0
    files = spark.read.text(seen[0]).groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.when(F.col("value").startswith("@relation"), 1)).alias("heads"), F.count(F.lit(1)).alias("lines"))
    files = files.collect()
    assert len(files) >= 16 and all(r["heads"] == 1 for r in files) and max(r["lines"] for r in files) < 200
    monkeypatch.setattr(catalog_data, "miss", lambda spark, sf: items.where("false"))
    assert catalog_data._arff(spark, "").count() == 0


def test_facts_of_a_curve_are_computed_once_a_curve(spark, settings, small):
    """With few points the rows are not shuffled, and each gets the same curve and facts as from a computation of its own."""
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    df = small.select("id", "a", "days", "died")
    rules = RuleSet([Rule((at_least("a", 4.0),), weight=1.0), Rule((less("a", 7.0),), weight=1.0)], problem="survival", target="died")
    mean = lambda curve: F.aggregate(curve, F.lit(0.0), lambda s, x: s + x["prob"]) / F.size(curve)
    found = predict_survival(df, rules, rule_curves(df, rules, "days", "died"), facts={"mean": mean})
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
    got = found.select("id", "mean", mean(F.col("prediction")).alias("own")).collect()
    assert len(got) == 240 and all(r["mean"] == r["own"] is not None for r in got)


def test_few_questions_leave_the_rows_in_place(spark, settings, small, monkeypatch):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    df = small.select("id", "a", "days", "died")
    rules = RuleSet([Rule((at_least("a", 4.0),), weight=1.0)], problem="survival", target="died")
    curves = rule_curves(df, rules, "days", "died")
    ask = lambda: survival_probability_at(df, rules, curves, F.col("days") * F.nullif(F.col("id") % 3, F.lit(0)))
    few = ask()
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(predict, "BROADCAST_ASKED", 0)
    many = ask()
    pairs = lambda t: sorted((r["id"], r["probability"]) for r in t.collect())
    assert [i for i, _ in pairs(few)] == [i for i, _ in pairs(many)] and all(
        p == q or abs(p - q) < 1e-12 for (_, p), (_, q) in zip(pairs(few), pairs(many), strict=True))
    assert all((p is None) == (i % 3 == 0) for i, p in pairs(few))
