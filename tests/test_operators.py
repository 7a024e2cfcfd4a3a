"""Operators on small tables: ARFF, tails, long rule sets, curves, streams."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import premisa.operators.counts as counts
import premisa.operators.matching as matching
from premisa import arff_scan
from premisa.functions.measures import MEASURES, quality
from premisa.functions.tails import chi2_lower, chi2_upper_1df, fisher_log10
from premisa.operators.evaluate import integrated_brier_score, prediction_metrics
from premisa.operators.predict import predict_class
from premisa.operators.statistics import adjusted_fdr, adjusted_fwer
from premisa.operators.survival import kaplan_meier, log_rank, rule_curves
from premisa.plans.rules import Rule, RuleSet, at_least, equals, less
from premisa.streaming.drift import rule_drift


def test_arff(spark, tmp_path):
    path = tmp_path / "x.arff"
    path.write_bytes(
        b"% caf\xe9\n@RELATION x\n\n@attribute 'a b' NUMERIC\n@attribute c {one, 'two words', '3'}\n@attribute d real\n"
        b"@attribute s string\n@DATA\n1.5, one, ?, x\n% note\n?, 'two words', -2e3, 'y, z'\n\n 3,?,4,?\n"
    )
    df = arff_scan(spark, str(path), "latin1")
    assert df.dtypes == [("a b", "double"), ("c", "string"), ("d", "double"), ("s", "string")]
    assert df.schema["c"].metadata["domain"] == ["one", "two words", "3"]
    assert [tuple(r) for r in df.collect()] == [
        (1.5, "one", None, "x"), (None, "two words", -2000.0, "y, z"), (3.0, None, 4.0, None)
    ]
    (tmp_path / "bad.arff").write_text("@relation x\n@attribute a numeric\n")
    with pytest.raises(ValueError):
        arff_scan(spark, str(tmp_path / "bad.arff"))


def test_tails(spark):
    rows = [(3.0, 1.0, 4.0, 4.0), (4.0, 0.0, 4.0, 4.0), (0.0, 4.0, 4.0, 4.0), (600.0, 400.0, 5000.0, 5000.0)]
    df = spark.createDataFrame(rows, "p double, n double, p_all double, n_all double")
    got = [10 ** r[0] for r in df.select(fisher_log10(F.col("p"), F.col("n"), F.col("p_all"), F.col("n_all"))).collect()]
    exact = [sum(math.comb(int(P), k) * math.comb(int(N), int(p + n) - k) for k in range(int(p), int(min(p + n, P)) + 1))
             / math.comb(int(P + N), int(p + n)) for p, n, P, N in rows]
    assert got == pytest.approx(exact, rel=1e-9)
    quantiles = [(0.1025866, 2.0, 0.05), (3.841459, 1.0, 0.95), (18.307038, 10.0, 0.95), (3.940299, 10.0, 0.05), (1e6, 1e6, 0.50019)]
    df = spark.createDataFrame([q[:2] for q in quantiles], "x double, k double")
    got = [r[0] for r in df.select(chi2_lower(F.col("x"), F.col("k"))).collect()]
    assert got == pytest.approx([q[2] for q in quantiles], abs=2e-5)
    got = spark.sql("select 3.841458820694124D as x").select(chi2_upper_1df(F.col("x"))).first()[0]
    assert got == pytest.approx(0.05, abs=1e-12)


def test_measures_on_a_perfect_and_a_useless_rule(spark):
    df = spark.createDataFrame([(10.0, 0.0, 10.0, 30.0), (5.0, 15.0, 10.0, 30.0)], "p double, n double, a double, b double")
    out = df.select(*[quality(m, F.col("p"), F.col("n"), F.col("a"), F.col("b")).alias(m) for m in MEASURES]).collect()
    perfect, useless = out
    assert len(MEASURES) == 39
    for m in ("Correlation", "C1", "C2", "Coverage", "FBayesianConfirmation", "Precision", "Kappa", "Q2", "GeoRSS", "YAILS", "Ripper"):
        assert perfect[m] == pytest.approx(1.0), m
    for m in ("Correlation", "CN2Significnce", "InformationGain", "JMeasure", "Novelty", "RSS", "RuleInterest", "SBayesian", "Klosgen",
              "WeightedRelativeAccuracy", "PawlakDependencyFactor", "OneWaySupport", "TwoWaySupport", "CFoil"):
        assert useless[m] == pytest.approx(0.0, abs=1e-12), m
    with pytest.raises(ValueError):
        quality("Nothing", *[F.col(c) for c in ("p", "n", "a", "b")])


def test_adjustments(spark):
    values = [0.01, 0.04, 0.03, 0.005, 0.5]
    df = spark.createDataFrame(list(enumerate(values, 1)), "rule_id int, pvalue double")
    fdr = {r["rule_id"]: r["adjusted"] for r in adjusted_fdr(df).collect()}
    fwer = {r["rule_id"]: r["adjusted"] for r in adjusted_fwer(df).collect()}
    assert [fdr[i] for i in range(1, 6)] == pytest.approx([0.025, 0.05, 0.05, 0.025, 0.5])
    assert [fwer[i] for i in range(1, 6)] == pytest.approx([0.04, 0.09, 0.09, 0.025, 0.5])


def test_long_rule_sets_are_split(small, monkeypatch):
    rules = RuleSet([Rule((at_least("a", i / 10), less("b", 1 - i / 400)), label="yes" if i % 2 else "no") for i in range(150)])
    monkeypatch.setattr(counts, "WIDE_RULES", 1000)
    one = sorted(tuple(r) for r in counts.contingency(small, rules, "y").collect())
    monkeypatch.setattr(counts, "WIDE_RULES", 1)
    monkeypatch.setattr(matching, "RULES_PER_EXPRESSION", 40)
    assert sorted(tuple(r) for r in counts.contingency(small, rules, "y").collect()) == one


def test_missing_values_never_match(spark, small):
    rules = [Rule((at_least("b", -1),)), Rule((less("b", 100),)), Rule(())]
    pdf = small.toPandas()
    n = int(pdf["b"].notna().sum())
    got = {r["rule_id"]: r["count"] for r in matching.rule_match(small, rules, ["id"]).groupBy("rule_id").count().collect()}
    assert got == {1: n, 2: n, 3: 240}


@pytest.mark.parametrize("bounds", [None, [15.0, 30.0, 31.0, 80.0]])
def test_kaplan_meier_by_hand(small, bounds):
    pdf = small.toPandas()
    got = {r["time"]: r for r in kaplan_meier(small, "days", "died", bounds=bounds).collect()}
    prob = 1.0
    assert sorted(got) == sorted(pdf["days"].unique())
    for t in sorted(got):
        d, n = int(((pdf.days == t) & (pdf.died == 1)).sum()), int((pdf.days >= t).sum())
        prob *= 1 - d / n
        assert got[t]["events"] == d and got[t]["at_risk"] == n and got[t]["prob"] == pytest.approx(prob, abs=1e-12)
    if bounds:
        rule = [Rule((less("a", 5),))]
        split = {(r["rule_id"], r["time"]): r["prob"] for r in rule_curves(small, rule, "days", "died", bounds).collect()}
        plain = {(r["rule_id"], r["time"]): r["prob"] for r in rule_curves(small, rule, "days", "died").collect()}
        assert split == pytest.approx(plain)


def test_all_times_equal(spark):
    df = spark.createDataFrame([(1.0, 1, 5.0), (2.0, 1, 5.0)], "a double, died int, t double")
    row = log_rank(df, [Rule((less("a", 1.5),))], "t", "died").first()
    assert row["observed"] == 1 and row["chi2"] is None


def test_brier_score_by_hand(small):
    pdf = small.toPandas()
    rules = [Rule((at_least("a", 5),), problem="survival"), Rule((equals("color", "red"),), problem="survival")]
    curves = rule_curves(small, rules, "days", "died")
    got = integrated_brier_score(small, rules, curves, "days", "died").first()[0]
    table = curves.toPandas()

    def at(rule, t):
        c = table[(table.rule_id == rule) & (table.time <= t)].sort_values("time")
        return c.prob.iloc[-1] if len(c) else 1.0

    time, died = pdf.days.to_numpy(), pdf.died.to_numpy()
    times = np.unique(time)
    g, left, prob = {}, {}, 1.0
    for t in times:
        left[t] = prob
        prob *= 1 - ((time == t) & (died == 0)).sum() / (time >= t).sum()
        g[t] = prob
    covering = [[i for i, h in ((1, a is not None and a >= 5), (2, c == "red")) if h] or [0] for a, c in zip(pdf.a, pdf.color)]
    total = 0.0
    for t, after in zip(times, times[1:]):
        score = 0.0
        for x, e, rule_ids in zip(time, died, covering):
            s = np.mean([at(r, t) for r in rule_ids])
            if x <= t and e == 1:
                score += s * s / left[x]
            elif x > t:
                score += (1 - s) ** 2 / g[t]
        total += score / len(time) * (after - t)
    assert got == pytest.approx(total / times[-1], abs=1e-9)


def test_splits_keep_every_row(small, monkeypatch):
    """Shares hold per class, folds are even, rows without a class are kept, many ranking buckets included."""
    import premisa.operators.selection as selection

    df = small.withColumn("c", F.when(F.col("id") % 3 != 0, F.col("y")))
    for order in (None, F.col("id") % 50):
        folds = selection.stratified_kfold(df, 4, "c", ["id"], seed=5, order=order).groupBy("c", "fold").count().collect()
        assert sum(r["count"] for r in folds) == 240 and {r["c"] for r in folds} == {"yes", "no", None}
        for c in ("yes", "no", None):
            sizes = [r["count"] for r in folds if r["c"] == c]
            assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1
        split = selection.train_test_split(df, 0.25, ["id"], stratify="c", seed=5, order=order).groupBy("c").agg(
            F.sum("is_test").alias("t"), F.count("*").alias("n")
        )
        assert all(r["t"] == r["n"] // 4 for r in split.collect())
    first = selection.stratified_kfold(df, 4, "c", ["id"], seed=5)
    again = selection.stratified_kfold(df.repartition(2), 4, "c", ["id"], seed=5)
    assert first.select("id", "fold").exceptAll(again.select("id", "fold")).count() == 0


def test_conflicts(spark):
    df = spark.createDataFrame([(1, 5.0, "x"), (2, 1.0, "y"), (3, 9.0, "y")], "id int, a double, y string")
    rules = RuleSet(
        [Rule((at_least("a", 4),), label="x", weight=0.9), Rule((less("a", 6),), label="y", weight=0.5), Rule((less("a", 6),), label="y", weight=0.1)],
        classes=["x", "y"], default_label="x",
    )
    row = prediction_metrics(df, rules, "y").first()
    assert (row["rules_per_example"], row["voting_conflicts"], row["negative_voting_conflicts"]) == (2.0, 1, 0)
    got = {r["id"]: r["prediction"] for r in predict_class(df, rules).collect()}
    assert got == {1: "x", 2: "y", 3: "x"}


def test_stream_equals_batch(spark, sf, tmp_path):
    from premisa.catalog.scoring import _events, event_rules

    source = spark.read.parquet(f"{sf}/events.parquet")
    for i in range(4):  # files in the order of event time
        part = source.where(f"event_id >= {i * 250} and event_id < {(i + 1) * 250 if i < 3 else 10**9}")
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    rules = event_rules()

    def run(df, name, mode):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option(
            "checkpointLocation", str(tmp_path / name)
        ).start()
        q.processAllAvailable()
        q.stop()
        return sorted(map(tuple, spark.table(name).collect()))

    plain = rule_drift(_events(source), rules, "big", "ts")
    assert run(rule_drift(_events(stream), rules, "big", "ts"), "drift", "complete") == sorted(map(tuple, plain.collect()))
    matched = matching.rule_match(_events(source), rules, ["event_id"])
    assert run(matching.rule_match(_events(stream), rules, ["event_id"]), "matched", "append") == sorted(map(tuple, matched.collect()))
    closed = run(rule_drift(_events(stream), rules, "big", "ts", watermark="1 day"), "closed", "append")
    assert set(closed) <= set(map(tuple, plain.collect())) and closed
