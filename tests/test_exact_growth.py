"""Exact growth where times or values are few or many, against brute force."""

import random

import numpy as np
import pytest
from test_learning import log_rank

import premisa.operators.regress as regress
import premisa.operators.single as single
import premisa.operators.survive as survive
from premisa import ContrastSetSurvivalRules, RuleClassifier, RuleRegressor, SurvivalRules
from premisa.catalog import QUERIES
from premisa.operators.regress import RegressionSearch
from premisa.operators.statistics import regression_pvalue
from premisa.operators.survive import SurvivalSearch
from premisa.plans.params import InductionParams
from premisa.plans.rules import Rule, at_least, equals, less
from premisa.roles import example_set


def _lives(n=300, seed=11):
    """A continuous value, one with a heavy value, a name; some are missing."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a = None if i % 19 == 0 else rng.random() * 10
        b = rng.choice([1.0, 1.0, 1.0, 2.0, float(rng.randint(3, 40))])
        s = rng.choice(["u", "v", None])
        out.append((a, b, s, float(rng.randint(1, 25) if (a or 0) > 6 else rng.randint(5, 40)), int(rng.random() < 0.6)))
    return out


SCHEMA = "a double, b double, s string, days double, died int"


def _options(rows, at):
    """(op, attr, cut or value) to covered rows, of the candidates of one attribute."""
    values = [r[at] for r in rows]
    if at == 2:
        for v in sorted({v for v in values if v is not None}):
            yield ("eq", v), np.array([x == v for x in values])
            yield ("ne", v), np.array([x is not None and x != v for x in values])
        return
    known = sorted({v for v in values if v is not None})
    for low, high in zip(known, known[1:]):
        cut = (low + high) / 2
        yield ("lt", cut), np.array([v is not None and v < cut for v in values])
        yield ("ge", cut), np.array([v is not None and v >= cut for v in values])


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("premise", [(), (less("b", 30.0),)])
def test_every_survival_candidate(spark, monkeypatch, few, premise):
    """Few times are counted, in stretches of values and without sums over dominated points; many are not."""
    monkeypatch.setattr(survive, "ROWS_PER_GROUP", 16)
    if few:
        monkeypatch.setattr(survive, "dominated_sums", None)
    else:
        monkeypatch.setattr(survive, "FEW_TIMES", 0)
    rows = _lives()
    names = ["a", "b", "s"]
    data = example_set(spark.createDataFrame(rows, SCHEMA), "died", survival_time="days", features=names)
    search = SurvivalSearch(data, names, "died", "days", InductionParams(complementary_conditions=True))
    found = {
        (r["attr"], r["op"], r["value"] if r["cut"] is None else r["cut"]): r["quality"]
        for r in search.exact(premise, search.first_pass(premise)).collect()
    }
    search.close()
    start = np.array([not premise or r[1] < 30 for r in rows])
    time, event = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
    held = [r for r, s in zip(rows, start) if s]
    kept = np.flatnonzero(start)
    asked = 0
    for at, name in enumerate(names):
        for (op, value), hit in _options(held, at):
            whole = np.zeros(len(rows), bool)
            whole[kept[hit]] = True
            want, asked = log_rank(time, event, whole), asked + 1
            got = found[name, op, value]
            assert (want is None) == (got is None) and (want is None or got == pytest.approx(want, abs=1e-6)), (name, op, value)
    assert len(found) == asked


def test_approximate_survival_merges_equal_rows(spark):
    """A search on few cells, times and events holds one weighted row for equal ones, and finds what the single rows give."""
    rows = [(float(i % 3), float(i % 2), "uv"[i % 5 == 0], float(1 + i % 4), int(i % 7 < 3)) for i in range(2_000)]
    data = example_set(spark.createDataFrame(rows, SCHEMA), "died", survival_time="days", features=["a", "b", "s"])
    search = SurvivalSearch(data, ["a", "b", "s"], "died", "days", InductionParams(approximate_induction=True, approximate_bins_count=4))
    assert search.table.df.count() <= 3 * 2 * 2 * 4 * 2 and search.everything == 2_000
    time, event = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
    for r in search.second_pass((), search.first_pass(()).collect()).collect():
        at = {"a": 0, "b": 1, "s": 2}[r["attr"]]
        cut = search.table.real_cut(r["attr"], r["cut"])
        hit = np.array([x[at] == r["value"] if r["op"] == "eq" else (x[at] < cut) == (r["op"] == "lt") for x in rows])
        assert r["c"] == hit.sum() and r["quality"] == pytest.approx(log_rank(time, event, hit), abs=1e-6)
    premise = (less("a", 2.0),)
    hit = np.array([x[0] < 2 for x in rows])
    assert search.variant_qualities([premise]) == [pytest.approx(log_rank(time, event, hit), abs=1e-6)]
    search.close()


def _counted(spark, df, seen):
    """The table, and every row that is derived for it counted."""

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.coalesce(1).mapInArrow(count, df.schema)


def test_survival_fit_reads_its_rows_once(spark):
    """What derives the rows is run once in a fit, the curves included."""
    seen = spark.sparkContext.accumulator(0)
    df = _counted(spark, spark.createDataFrame(_lives(), SCHEMA), seen)
    model = SurvivalRules(max_growing=1, max_rule_count=1, approximate_induction=True, approximate_bins_count=4)
    model.fit(df, "died", "days", features=["a", "b", "s"])
    assert model.curves.where("rule_id = 0").count() > 0 and seen.value == 300


def test_contrast_fit_with_times_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame(_lives(), SCHEMA).selectExpr("*", "if(b > 2, 'x', 'y') as g")
    model = ContrastSetSurvivalRules(approximate_induction=True, approximate_bins_count=4, minsupp_all=(0.2,), max_growing=1)
    model.fit(_counted(spark, rows, seen), "died", "days", "g", features=["a", "b", "s"])
    assert model.model.rules and model.curves.where("rule_id = 0").count() > 0 and seen.value == 300


def _labelled(n=2_000):
    rng = random.Random(5)
    return [(rng.choice([None, 0.0, 1.0, 2.0, 3.0]), rng.choice(["u", "v", None]), rng.gauss(5 * (i % 3), 2.0)) for i in range(n)]


@pytest.mark.parametrize("ignore_missing", [False, True])
def test_approximate_regression_by_sums_of_cells(spark, monkeypatch, ignore_missing):
    """First passes read one row per combination of cells, also once accepted rules are written out; counts are those of the rows."""
    monkeypatch.setattr(single, "RULES_PER_WRITE", 1)
    rows = _labelled()
    data = spark.createDataFrame(rows, "a double, s string, y double")
    params = InductionParams(approximate_induction=True, approximate_bins_count=4, ignore_missing=ignore_missing)
    search = RegressionSearch(data, ["a", "s"], "y", params)
    assert search.moments.count() <= 5 * 3
    y = np.array([r[2] for r in rows])
    assert search.accept("", (less("a", 1.0),)) == sum(r[0] == 0 for r in rows)
    for premise, start in (((), np.ones(len(rows), bool)), ((less("a", 3.0),), np.array([r[0] is not None and r[0] < 3 for r in rows]))):
        found = search.second_pass(premise, search.first_pass(premise).collect()).collect()
        assert len({r["attr"] for r in found}) == 2
        for r in found:
            of = [x["as".index(r["attr"])] for x in rows]
            cut = search.table.real_cut(r["attr"], r["cut"])
            hit = start & np.array([v is not None and (v == r["value"] if r["op"] == "eq" else (v < cut) == (r["op"] == "lt")) for v in of])
            near = np.abs(y - y[hit].mean()) <= y[hit].std()
            there = np.array([v is not None for v in of]) | (not ignore_missing)
            assert (r["c"], r["p"]) == (hit.sum(), (hit & near).sum())
            assert (r["p_all"], r["n_all"]) == ((near & there).sum(), (~near & there).sum())
            assert r["p_new"] == sum(h and not (x[0] is not None and x[0] < 1) for h, x in zip(hit, rows))
    search.close()


def test_regression_pvalue_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame(_labelled(), "a double, s string, y double")
    rules = [Rule((less("a", 2.0),)), Rule((equals("s", "u"), at_least("a", 1.0))), Rule((equals("s", "none"),))]
    got = regression_pvalue(_counted(spark, rows, seen), rules, "y", 5.0).collect()
    assert seen.value == 2_000
    want = regression_pvalue(rows, rules, "y").collect()
    assert [r["covered"] for r in got] == [r["covered"] for r in want] and got[2]["pvalue"] is None
    assert [r["pvalue"] for r in got[:2]] == [pytest.approx(r["pvalue"], rel=1e-9) for r in want[:2]]


def _skewed(n=900):
    """A continuous value, one with a heavy value, a name; labels that follow the first, some missing, some far out."""
    rng, out = random.Random(8), []
    for i in range(n):
        a = None if i % 23 == 0 else rng.random() * 10
        b = rng.choice([1.0, 1.0, 2.0, rng.random() * 40])
        y = 3 * (a or 5.0) + rng.gauss(0, 1) + (500.0 if i % 300 == 7 else 0)
        out.append((a, b, rng.choice(["u", "v", f"w{i % 40}", None]), y, rng.choice([1.0, 2.0])))
    return out


@pytest.mark.parametrize("way, per_group, per_pass, copies", [
    ("whole", 1 << 19, 256, 8), ("grid", 0, 10_000, 8), ("stretches", 100, 10, 10_000), ("dominance", 100, 0, -1)])
@pytest.mark.parametrize("ignore_missing", [False, True])
def test_every_regression_candidate(spark, monkeypatch, way, per_group, per_pass, copies, ignore_missing):
    """A whole attribute in one group, a grid, stretches of cuts, or dominated points: the same counts for every candidate."""
    monkeypatch.setattr(regress, "ROWS_PER_GROUP", per_group)
    monkeypatch.setattr(single, "CANDIDATES_PER_PASS", per_pass)
    monkeypatch.setattr(regress, "MOST_COPIES", copies)
    used = {"stretches": {"stretches", "grid", "dominance"}, "dominance": {"stretches", "dominance"}}.get(way, {way})
    for name, of in (("_by_stretches", "stretches"), ("second_pass", "grid"), ("_by_dominance", "dominance")):
        if of not in used:
            monkeypatch.setattr(RegressionSearch, name, None)
    rows, names = _skewed(), ["a", "b", "s"]
    data = spark.createDataFrame(rows, "a double, b double, s string, y double, w double").repartition(3)
    params = InductionParams(complementary_conditions=True, ignore_missing=ignore_missing)
    search = RegressionSearch(data, names, "y", params, weight="w")
    y, w = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
    for premise, start in (((), np.ones(len(rows), bool)), ((less("b", 30.0),), np.array([r[1] < 30 for r in rows]))):
        found = search.exact(premise, search.first_pass(premise)).collect()
        got = {(r["attr"], r["op"], r["value"] if r["cut"] is None else r["cut"]): r for r in found}
        kept, asked = np.flatnonzero(start), 0
        for at, name in enumerate(names):
            there = np.array([r[at] is not None for r in rows]) | (not ignore_missing)
            for (op, value), hit in _options([rows[i] for i in kept], at):
                inside = np.zeros(len(rows), bool)
                inside[kept[hit]] = True
                mean = np.average(y[inside], weights=w[inside])
                near = np.abs(y - mean) <= np.sqrt(np.average((y[inside] - mean) ** 2, weights=w[inside])) + 1e-9 * (inside.sum() == 1)
                r, asked = got[name, op, value], asked + 1
                if inside.sum() > 2:  # one or two labels lie on the ends of their interval
                    want = (w[inside & near].sum(), w[near & there].sum(), w[~near & there].sum())
                    assert (r["p"], r["p_all"], r["n_all"]) == want, (name, op, value)
                assert r["c"] == w[inside].sum() and r["n"] == r["c"] - r["p"]
        assert len(found) == asked
    search.close()


def test_stretches_send_few_rows(spark, monkeypatch):
    """Rows between the cuts of a stretch go to it alone; of the others those with labels where its intervals differ."""
    monkeypatch.setattr(regress, "ROWS_PER_GROUP", 1_000)
    monkeypatch.setattr(RegressionSearch, "_by_dominance", None)
    sizes = spark.sparkContext.accumulator(0)
    real = regress._count_functions

    def counting():
        counted = real()

        def tell(rows, asked):
            sizes.add(len(rows))
            return counted(rows, asked)

        return tell

    monkeypatch.setattr(regress, "_count_functions", counting)
    data = spark.range(20_000).selectExpr("pmod(id * 7919, 20011) / 7D as a", "pmod(id * 104729, 20011) / 3D as y")
    search = RegressionSearch(data, ["a"], "y", InductionParams())
    assert search.exact((), search.first_pass(())).count() == 2 * 19_999
    search.close()
    assert 20_000 * 0.9 < sizes.value < 6 * 20_000


@pytest.mark.parametrize("premise", [(), (less("b", 30.0),)])
def test_small_survival_tables_take_an_attribute_in_one_group(spark, monkeypatch, premise):
    """The same statistics as by stretches of values."""
    data = example_set(spark.createDataFrame(_lives(), SCHEMA), "died", survival_time="days", features=["a", "b", "s"])
    search = SurvivalSearch(data, ["a", "b", "s"], "died", "days", InductionParams(complementary_conditions=True))
    found = []
    for most in (1 << 17, 16):
        monkeypatch.setattr(survive, "ROWS_PER_GROUP", most)
        got = search.exact(premise, search.first_pass(premise)).collect()
        found.append({(r["attr"], r["op"], r["cut"], r["value"]): (r["c"], r["p_new"], r["quality"]) for r in got})
    search.close()
    one, parts = found
    assert one.keys() == parts.keys() and len(one) > 500
    assert all(one[k] == (*parts[k][:2], pytest.approx(parts[k][2], abs=1e-6) if parts[k][2] is not None else None) for k in one)


@pytest.mark.parametrize("name", ["cross_validate", "learn_regression", "learn_survival", "regression_score"])
def test_queries_learn_without_limits(spark, sf, monkeypatch, name):
    """No bound on conditions, rules or cuts in queries that fit a whole model."""

    class Seen(Exception):
        pass

    def fit(self, *args, **kwargs):
        assert self.params == InductionParams()
        raise Seen

    for model in (RuleClassifier, RuleRegressor, SurvivalRules):
        monkeypatch.setattr(model, "fit", fit)
    with pytest.raises(Seen):
        QUERIES[name](spark, sf)
