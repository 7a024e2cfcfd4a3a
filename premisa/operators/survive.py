"""Search for survival rules: a candidate's quality is its log-rank statistic.

Observed events, expected events and the linear part of the variance are plain prefix sums (see
`operators.survival`).  The quadratic part needs the covered examples at risk over time; it is
taken from (attribute, slot, K) cells, cut into stretches of K so that no task holds a whole time axis.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premisa.functions.premise import quoted
from premisa.functions.tails import chi2_upper_1df
from premisa.operators.base import TrainingTable
from premisa.operators.candidates import (
    bucketize,
    column_facts,
    quantile_cuts,
    split_candidates,
    value_buckets,
    value_sums,
)
from premisa.operators.covering import Premise
from premisa.operators.dominance import dominated_sums
from premisa.operators.running import running_sums
from premisa.operators.single import SingleSearch, Slots
from premisa.operators.survival import event_flag, log_rank_from_sums, log_rank_on, with_risk
from premisa.plans.params import InductionParams
from premisa.plans.rules import Condition, Rule

# Distinct event times handled by one task of the second pass.
TIMES_PER_STRETCH = 10_000

# Distinct values of K up to which exact search counts per time.
FEW_TIMES = 4_096
# Rows of an attribute that one group of exact search is to hold, and the most groups there are.
ROWS_PER_GROUP = 1 << 17
MAX_GROUPS = 1_024
NO_CELL = "struct<k:string, x:double, nom:string, is_numeric:boolean, y:double>"

_FIRST_PASS = ("op", "cut", "value", "c", "o", "e", "v", "p_new")


def _pair_functions(ks: list[float]):
    """The work inside one group. Nested, so that workers get the code itself and need no installed package."""
    times = np.array(ks, dtype=float)

    def with_counts(counts: np.ndarray, times: np.ndarray) -> np.ndarray:
        """For each time the sum of the earlier of the two over counted examples."""
        upto = np.cumsum(counts * times)
        return upto + times * (counts.sum() - np.cumsum(counts))

    def heads_of(frame: pd.DataFrame) -> pd.DataFrame:
        """Per stretch: the counts per time before it, those of the whole attribute, and the last value before it."""
        parts = np.sort(frame["part"].unique())
        grid = np.zeros((len(parts), len(times)))
        at = np.searchsorted(parts, frame["part"].to_numpy())
        np.add.at(grid, (at, frame["j"].to_numpy()), frame["m"].to_numpy())
        last = frame.groupby("part")["last"].max().sort_index().to_numpy()
        upto = grid.cumsum(axis=0)
        return pd.DataFrame({"k": frame["k"].iloc[0], "part": parts, "prev": np.concatenate([[np.nan], last[:-1]]),
                             "before": list(upto - grid), "every": [upto[-1]] * len(parts)}).astype({"k": object})

    def earlier(j: np.ndarray, m: np.ndarray, times: np.ndarray) -> np.ndarray:
        """For each row the sum of the earlier time over all rows before it, by halving the range of times."""
        n = len(j)
        rank, weights = j, np.stack([m, m * times[j]], axis=1)
        low, high, less = np.zeros(n, dtype=np.int64), np.arange(n), np.zeros((n, 2))
        for bit in reversed(range(max(1, (len(times) - 1).bit_length()))):
            small = (rank >> bit) & 1 == 0
            zeros = np.concatenate([[0], np.cumsum(small)])
            upto = np.concatenate([np.zeros((1, 2)), np.cumsum(np.where(small[:, None], weights, 0.0), axis=0)])
            take = (j >> bit) & 1 == 1
            less += np.where(take[:, None], upto[high] - upto[low], 0.0)
            low0, high0 = zeros[low], zeros[high]
            low, high = np.where(take, zeros[-1] + low - low0, low0), np.where(take, zeros[-1] + high - high0, high0)
            order = np.argsort(~small, kind="stable")
            rank, weights = rank[order], weights[order]
        return less[:, 1] + times[j] * (np.cumsum(m) - m - less[:, 0])

    def cuts_of(rows: pd.DataFrame, head: pd.DataFrame) -> pd.DataFrame:
        """The pairs below the cut in front of each value."""
        rows = rows.sort_values("x", kind="stable")
        x, j, m = rows["x"].to_numpy(), rows["j"].to_numpy(), rows["m"].to_numpy()
        before, every = np.asarray(head["before"].iloc[0]), np.asarray(head["every"].iloc[0])
        known, all_pairs = with_counts(before, times), with_counts(every, times)
        own = np.cumsum(2 * m * (known[j] + earlier(j, m, times)) + m * m * times[j])
        own_full = np.cumsum(m * all_pairs[j])
        first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
        shift = lambda total, start: start + np.where(first > 0, total[first - 1], 0.0)
        prev = np.concatenate([head["prev"].to_numpy(dtype=float)[:1], x[first[1:] - 1]])
        out = pd.DataFrame({"k": rows["k"].iloc[0], "cut": (prev + x[first]) / 2, "own": shift(own, (before * known).sum()),
                            "own_full": shift(own_full, (before * all_pairs).sum()), "whole": (every * all_pairs).sum()})
        return out[~np.isnan(prev)].astype({"k": object})  # nothing lies below the first value

    def whole_of(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """A whole attribute in one group: its candidates with the sum over all pairs of the examples they cover."""
        if not len(asked):
            return asked.drop(columns="k").assign(q=0.0).astype({c: object for c in ("attr", "op", "value")})
        rows = rows.sort_values("x", kind="stable")
        x, m = rows["x"].to_numpy(), rows["__w"].to_numpy(dtype=float)
        times, j = np.unique(rows["y"].to_numpy(), return_inverse=True)
        every = np.bincount(j, m, len(times))
        all_pairs = with_counts(every, times)
        whole = (every * all_pairs).sum()
        op = asked["op"].to_numpy(dtype=object)
        own, own_full = np.zeros(len(asked)), np.zeros(len(asked))
        cuts, named = np.isin(op, ["lt", "ge"]), np.isin(op, ["eq", "ne"])
        if cuts.any():
            first = np.searchsorted(x, asked["cut"].to_numpy()[cuts], "left")
            upto = lambda v: np.concatenate([[0.0], np.cumsum(v)])[first]
            own[cuts] = upto(2 * m * earlier(j, m, times) + m * m * times[j])
            own_full[cuts] = upto(m * all_pairs[j])
        if named.any():
            found = {}
            for value, at in rows.reset_index(drop=True).groupby("nom").indices.items():
                some, its = np.unique(j[at], return_inverse=True)
                counts = np.bincount(its, m[at], len(some))
                found[value] = ((counts * with_counts(counts, times[some])).sum(), (m[at] * all_pairs[j[at]]).sum())
            pairs = np.array([found[v] for v in asked["value"].to_numpy(dtype=object)[named]])
            own[named], own_full[named] = pairs[:, 0], pairs[:, 1]
        q = np.where(np.isin(op, ["lt", "eq"]), own, whole + own - 2 * own_full)
        return asked.drop(columns="k").assign(q=q).astype({c: object for c in ("attr", "op", "value")})

    return heads_of, cuts_of, whole_of


class SurvivalSearch(SingleSearch):
    def __init__(
        self,
        df: DataFrame,
        features: Sequence[str],
        status: str,
        time: str,
        params: InductionParams,
        thresholds: Sequence[Condition] = (),
    ):
        self.label = status
        # The cleaned rows are read again and again until ``close``: for facts, for the training table, for the rules' curves.
        self.plain = df.select(*[quoted(c) for c in features], quoted(time), quoted(status)).persist(
            StorageLevel.MEMORY_AND_DISK
        )
        rows = self.plain.withColumns({"__time": quoted(time).cast("double"), "__event": event_flag(df, status)})
        extra = {"__time": F.col("__time"), "__event": F.col("__event"), "__w": F.lit(1.0)}
        # Cells, times and events are few: equal rows become one weighted row before anything is attached to them.
        table = TrainingTable(rows.where("__time is not null"), features, params.bins, extra, thresholds, merge="__w")
        self.time_bounds = value_buckets(table.df, ["__time"])["__time"]
        table.replace(with_risk(table.df, "__time", "__event", "__w").drop("__time"))
        super().__init__(table, params)
        _, times, _ = column_facts(self.table.df, ["__K"], {})
        self.times = times["__K"]
        self.stretches = quantile_cuts(self.table.df, {"__K": 1 + self.times // TIMES_PER_STRETCH})["__K"]

    def close(self) -> None:
        super().close()
        self.plain.unpersist()

    def first_pass(self, premise: Premise) -> DataFrame:
        sums = {"c": "__w", "o": "__w * __event", "e": "__w * __H", "v": "__w * __G", "p_new": f"if({self._open()}, __w, 0D)"}
        cells = value_sums(
            self.table.df.where(self.table.holds(premise)), self.table.numeric, self.table.nominal, sums,
            self.table.bounds, self.table.nominal_buckets,
        )
        cand = split_candidates(
            self.table.gather(cells), list(sums), (), self.params.complementary_conditions, self.table.two_level,
            integral=self.table.approximate,
        )
        return cand.selectExpr("*", "c as p")

    def exact(self, premise: Premise, cand: DataFrame) -> DataFrame:
        """The quadratic part of every candidate's variance, then its statistic, in a fixed number of jobs.

        It is the sum of K(the earlier time) over all pairs of covered examples. Adding examples by growing value, each
        new one pairs with those before it; ``full`` pairs each example with all: the other side of a cut, or of a nominal
        value, is whole + own part - 2 full. With few times the pairs of a cut come from counts per time and stretch of
        values (`_cut_pairs`), with many from two sums over dominated points in the (value, K) plane. A small table takes
        an attribute in one group.
        """
        inside = self.table.holds(premise)
        small = self.table.rows <= ROWS_PER_GROUP
        if not small:
            cand = cand.persist(StorageLevel.MEMORY_AND_DISK)
        numeric = set(self.table.numeric)
        made = [
            F.when(quoted(a).isNotNull(), F.struct(
                F.lit(a).alias("k"), (quoted(a).cast("double") if a in numeric else F.lit(0.0)).alias("x"),
                (F.lit(None).cast("string") if a in numeric else quoted(a).cast("string")).alias("nom"),
                F.lit(a in numeric).alias("is_numeric"), F.col("__K").cast("double").alias("y")))
            for a in self.table.features
        ]
        if small:
            asked = cand.select(F.col("attr").alias("k"), "attr", *_FIRST_PASS)
            rows = self.table.df.where(inside).select("__w", F.inline(F.array_compact(F.array(*made))))
            schema = "attr string, op string, cut double, value string, c double, o double, e double, v double, p_new double, q double"
            return self._judged(rows.groupBy("k").cogroup(asked.groupBy("k")).applyInPandas(_pair_functions([])[2], schema))
        few = self.times <= FEW_TIMES
        if few:  # numeric attributes take their own way
            made = [m for a, m in zip(self.table.features, made) if a not in numeric] or [F.lit(None).cast(NO_CELL)]
        long = self.table.df.where(inside).select("__w", F.inline(F.array_compact(F.array(*made))))
        cells = long.groupBy("k", "x", "nom", "is_numeric", "y").agg(F.sum("__w").alias("m"))
        cells = cells.withColumn("my", F.col("m") * F.col("y")).persist(StorageLevel.MEMORY_AND_DISK)
        bucket = "__b" if self.stretches else None
        strips = lambda df: bucketize(df, {"__b": self.stretches}, {"__b": "y"})
        # every example with all of its attribute
        line = strips(cells.groupBy("k", "y").agg(F.sum("m").alias("m"), F.sum("my").alias("my")))
        run = running_sums(line, ["k"], "y", ["m", "my"], bucket=bucket)
        sizes = cells.groupBy("k").agg(F.sum("m").alias("size"))
        pairs = run.join(sizes, "k").select(
            "k", "y", (F.col("cum_my") - F.col("my") + F.col("y") * (F.col("size") - F.col("cum_m") + F.col("m"))).alias("with_all"))
        full = cells.join(pairs, ["k", "y"]).groupBy("k", "x", "nom").agg(F.sum(F.col("m") * F.col("with_all")).alias("full"))
        full = full.persist(StorageLevel.MEMORY_AND_DISK)
        whole = full.groupBy("k").agg(F.sum("full").alias("whole"))
        under = self._cut_pairs(inside) if few else self._cut_pairs_by_dominance(cells, full, whole, cand)
        # nominal: pairs within a value
        named = strips(cells.where("not is_numeric").select("k", "nom", "y", "m", "my"))
        run = running_sums(named, ["k", "nom"], "y", ["my"], bucket=bucket)
        within = run.groupBy("k", "nom").agg(F.sum(F.expr("m * (2 * cum_my - my)")).alias("own"))
        within = within.join(full.where("nom is not null").select("k", "nom", F.col("full").alias("own_full")), ["k", "nom"])
        cand = cand.withColumn("k", F.col("attr"))
        left = cand.where("cut is not null").join(under, ["k", "cut"])
        right = cand.where("value is not null").join(within.withColumnRenamed("nom", "value").join(whole, "k"), ["k", "value"])
        both = left.unionByName(right)
        both = both.withColumn("q", F.expr("if(op in ('lt', 'eq'), own, whole + own - 2 * own_full)"))
        return self._judged(both)

    @staticmethod
    def _judged(scored: DataFrame) -> DataFrame:
        """Candidates with their statistic."""
        # Rounded: complementary conditions tie exactly, whatever the order of summation.
        chi2 = F.round(log_rank_from_sums(F.col("o"), F.col("e"), F.col("v"), F.col("q")), 9)
        return scored.select(F.lit("").alias("target"), "attr", "op", "cut", "value", "c", "p_new", F.col("c").alias("p"), chi2.alias("quality"))

    def _cut_pairs(self, inside: Column) -> DataFrame:
        """(k, cut, own, own_full, whole) for every cut between neighbouring values, where times are few.

        Each attribute is cut into stretches of values with about ``ROWS_PER_GROUP`` rows; a value with more rows has no more
        cells than there are times. Counts by (stretch, time) give what precedes a stretch; within, rows are added one by one.
        """
        df, names = self.table.df.where(inside), self.table.numeric
        none = "k string, cut double, own double, own_full double, whole double"
        if not names:
            return df.sparkSession.createDataFrame([], none)
        ks = sorted(r[0] for r in self.table.df.select("__K").distinct().collect())  # at most about FEW_TIMES
        parts = min(MAX_GROUPS, 1 + int(self.table.rows) // ROWS_PER_GROUP)
        cuts = quantile_cuts(self.table.df, dict.fromkeys(names, parts))
        coded = {f"__part_{i}": a for i, a in enumerate(names)}
        df = bucketize(df, {**{c: cuts[a] for c, a in coded.items()}, "__j": ks[1:]}, {**coded, "__j": "__K"})
        made = [
            F.when(quoted(a).isNotNull(), F.struct(
                F.lit(a).alias("k"), F.col(c).alias("part"), quoted(a).cast("double").alias("x"), F.col("__j").alias("j")))
            for c, a in coded.items()
        ]
        long = df.select("__w", F.inline(F.array_compact(F.array(*made))))
        cells = long.groupBy("k", "part", "x", "j").agg(F.sum("__w").alias("m")).persist(StorageLevel.MEMORY_AND_DISK)
        counts = cells.groupBy("k", "part", "j").agg(F.sum("m").alias("m"), F.max("x").alias("last"))
        heads_of, cuts_of, _ = _pair_functions(ks)
        # One group per attribute: at most MAX_GROUPS x FEW_TIMES counts.
        heads = counts.groupBy("k").applyInPandas(heads_of, "k string, part int, prev double, before array<double>, every array<double>")
        return cells.groupBy("k", "part").cogroup(heads.groupBy("k", "part")).applyInPandas(cuts_of, none)

    def _cut_pairs_by_dominance(self, cells: DataFrame, full: DataFrame, whole: DataFrame, cand: DataFrame) -> DataFrame:
        """The same for any number of times: pairs with smaller values, and within a value."""
        points = cells.where("is_numeric").select("k", "x", "y", "m", "my")
        ask = lambda x, y, x_in, which: F.struct(x.alias("qx"), y.alias("qy"), F.lit(x_in).alias("x_in"), F.lit(which).alias("which"))
        x, y, top = F.col("x"), F.col("y"), F.lit(math.inf)
        asked = F.array(ask(x, y, False, 0), ask(x, y, True, 1), ask(x, top, False, 2))
        queries = points.select("k", F.col("x").alias("at"), F.col("y").alias("own_y"), F.explode(asked).alias("q"))
        queries = queries.select("k", "at", "own_y", F.col("q.qx").alias("x"), F.col("q.qy").alias("y"), F.col("q.x_in").alias("x_in"),
                                 F.lit(False).alias("y_in"), F.col("q.which").alias("which"))
        sums = dominated_sums(points, queries, ["m", "my"], "at double, own_y double, which int")
        pick = lambda name, i: F.coalesce(F.sum(F.when(F.col("which") == i, F.col(name))), F.lit(0.0))
        before = sums.groupBy("k", F.col("at").alias("x"), F.col("own_y").alias("y")).agg(
            pick("my", 0).alias("my0"), pick("m", 0).alias("m0"), pick("my", 1).alias("my1"), pick("m", 2).alias("smaller"))
        added = points.join(before, ["k", "x", "y"]).groupBy("k", "x").agg(
            F.sum(F.expr("2 * m * (my0 + y * (smaller - m0)) + 2 * m * (my1 - my0) + m * m * y")).alias("added"))
        steps = added.join(full.where("nom is null").select("k", "x", "full"), ["k", "x"]).select("k", "x", F.lit(0.0).alias("y"), "added", "full")
        cuts = cand.where("cut is not null").select(F.col("attr").alias("k"), F.col("cut").alias("x")).distinct()
        cuts = cuts.select("k", "x", F.col("x").alias("at"), top.alias("y"), F.lit(False).alias("x_in"), F.lit(False).alias("y_in"))
        under = dominated_sums(steps, cuts, ["added", "full"], "at double")
        return under.withColumnsRenamed({"added": "own", "full": "own_full", "at": "cut"}).join(whole, "k")

    def second_pass(self, premise: Premise, rows) -> DataFrame:
        slots = Slots(self.table, rows)
        df, slot = slots.assign(self.table.df.where(self.table.holds(premise)))
        df = bucketize(df, {"stretch": self.stretches}, {"stretch": "__K"})
        cells = [F.struct(F.lit(a).alias("attr"), slot[a].cast("int").alias("slot")) for a in slots.by_attr]
        cells = df.select("stretch", F.col("__K").alias("k"), "__w", F.inline(F.array(*cells))).where("slot is not null")
        cells = cells.groupBy("attr", "stretch", "k", "slot").agg(F.sum("__w").alias("m"))
        if self.stretches:
            # Those still at risk after a stretch enter it as one extra row per slot.
            cells = cells.unionByName(self._after(cells))
        plans = {
            a: (slots.slot_count(a),
                [(i0, i1, inv, tuple(r[c] for c in _FIRST_PASS)) for r, i0, i1, inv in slots.spans(a)])
            for a in slots.by_attr
        }

        columns = ["attr", *_FIRST_PASS, "q"]

        def squares(pdf: pd.DataFrame) -> pd.DataFrame:
            attr = pdf["attr"].iloc[0]
            n_slots, entries = plans[attr]
            later = np.zeros(n_slots)
            rest = pdf[pdf["k"].isna()]
            np.add.at(later, rest["slot"].to_numpy(), rest["m"].to_numpy())
            here = pdf[pdf["k"].notna()]
            ks, at = np.unique(here["k"].to_numpy(), return_inverse=True)
            leaving = np.zeros((len(ks), n_slots))
            np.add.at(leaving, (at, here["slot"].to_numpy()), here["m"].to_numpy())
            at_risk = leaving[::-1].cumsum(axis=0)[::-1] + later
            out = []
            edge = np.concatenate([np.zeros((len(ks), 1)), at_risk.cumsum(axis=1)], axis=1)
            gone = np.concatenate([np.zeros((len(ks), 1)), leaving.cumsum(axis=1)], axis=1)
            for i0, i1, inv, first in entries:
                n1, m = edge[:, i1] - edge[:, i0], gone[:, i1] - gone[:, i0]
                if inv:
                    n1, m = edge[:, -1] - n1, gone[:, -1] - m
                out.append((attr, *first, float((ks * (n1**2 - (n1 - m) ** 2)).sum())))
            return pd.DataFrame(out, columns=columns)

        # One group per (attribute, stretch): at most TIMES_PER_STRETCH x slots cells.
        parts = cells.groupBy("attr", "stretch").applyInPandas(
            squares,
            "attr string, op string, cut double, value string, c double, o double, e double, v double, p_new double, q double",
        )
        whole = parts.groupBy("attr", *_FIRST_PASS).agg(F.sum("q").alias("q"))
        # Rounded: complementary conditions tie exactly, whatever the order of summation.
        chi2 = F.round(log_rank_from_sums(F.col("o"), F.col("e"), F.col("v"), F.col("q")), 9)
        return whole.select(
            F.lit("").alias("target"), "attr", "op", "cut", "value", "c", "p_new", F.col("c").alias("p"),
            chi2.alias("quality"),
        )

    @staticmethod
    def _after(cells: DataFrame) -> DataFrame:
        """Per (attr, stretch, slot): the examples of later stretches, also where a slot has none of its own.

        A running total from stretch s on holds for every stretch from the slot's previous one up to s - 1.
        """
        ends = cells.groupBy("attr", "slot", "stretch").agg(F.sum("m").alias("m"))
        w = Window.partitionBy("attr", "slot").orderBy("stretch")
        later = F.sum("m").over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        ends = ends.select(
            "attr", "slot", "stretch", later.alias("m"), F.coalesce(F.lag("stretch").over(w), F.lit(0)).alias("start")
        ).where("stretch > start")
        return ends.select(
            "attr", F.explode(F.sequence("start", F.col("stretch") - 1)).alias("stretch"),
            F.lit(None).cast("double").alias("k"), "slot", "m",
        )

    def log_ranks(self, premises: Sequence[Premise]) -> DataFrame:
        coded = [Rule(tuple(self.table.coded(c) for c in p)) for p in premises]
        return log_rank_on(self.table.df, coded, self.stretches)

    def variant_qualities(self, premises: Sequence[Premise]):
        found = {r["rule_id"]: r["chi2"] for r in self.log_ranks(premises).collect()}
        return [found.get(i + 1) for i in range(len(premises))]

    def describe(self, target: str, premise: Premise) -> Rule:
        c = self.covered(premise)
        return Rule(premise, target=self.label, problem="survival", p=c, n=0.0, p_all=self.everything, n_all=0.0, weight=1.0)

    def describe_all(self, pairs) -> list[Rule]:
        """Rules with their log-rank p-values, all from one job."""
        rules = [self.describe(t, p) for t, p in pairs]
        if not rules:
            return []
        tails = self.log_ranks([p for _, p in pairs]).select("rule_id", chi2_upper_1df(F.col("chi2")).alias("pvalue"))
        found = {r["rule_id"]: r["pvalue"] for r in tails.collect()}
        return [replace(r, pvalue=found.get(i)) for i, r in enumerate(rules, 1)]
