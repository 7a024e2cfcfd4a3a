"""Search for regression rules.

A rule predicts the mean of the labels it covers; its positives are all examples within one population
deviation of that mean, so P and N differ per candidate.  First pass: moments of every candidate by prefix
sums.  Then, with the intervals known, p and P are sums over rectangles of the (value, label) plane. Where candidates are
few, labels are coded by the intervals' end points and the cells of a small grid added up. Exact search of many cuts takes
stretches of neighbouring cuts: their intervals nearly agree, so a stretch needs the rows between its cuts, those whose
labels lie where the intervals differ, and of all others a few sums (`_by_stretches`).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premisa.functions.measures import python_quality, quality
from premisa.functions.premise import quoted
from premisa.operators.base import MERGE_SHARE, TrainingTable
from premisa.operators.candidates import bucketize, quantile_cuts, split_candidates, value_sums
from premisa.operators.counts import exact_medians
from premisa.operators.covering import Premise
from premisa.operators.dominance import dominated_sums, rank_function
from premisa.operators import single
from premisa.operators.single import SingleSearch, Slots
from premisa.plans.params import InductionParams
from premisa.plans.rules import Condition, Rule
from premisa.session import written

OUTSIDE = -1
# Rows up to which exact search takes an attribute in one group; beyond, a stretch of cuts has a quarter of them between its cuts.
ROWS_PER_GROUP = 1 << 19
MAX_STRETCHES = 512
# Rows sent to stretches for their labels, as a multiple of the table's, up to which cuts are taken by stretches.
MOST_COPIES = 8
ASKED = ("attr", "op", "cut", "value", "c", "p_new", "lo", "hi")
COUNTED = "attr string, op string, cut double, value string, c double, p_new double, p double, p_all double, total double"


def _count_functions():
    """The work inside one group. Nested, so that workers get the code itself and need no installed package."""
    prefix_rank_sums = rank_function()

    def counted(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """Candidates with p and P from weighted points (x, y) or (nom, y); ``got`` is the weight inside the premise."""
        if not len(asked):
            return pd.DataFrame(columns=["attr", "op", "cut", "value", "c", "p_new", "p", "p_all", "total"])
        rows = rows.sort_values("y", kind="stable")
        y, got = rows["y"].to_numpy(), rows["got"].to_numpy(dtype=float)
        upto = lambda w: np.concatenate([[0.0], np.cumsum(w)])
        every, inside = upto(rows["all"].to_numpy(dtype=float)), upto(got)
        low = np.searchsorted(y, asked["lo"].to_numpy(), "left")
        high = np.maximum(low, np.searchsorted(y, asked["hi"].to_numpy(), "right"))
        p = inside[high] - inside[low]
        op = asked["op"].to_numpy(dtype=object)
        cuts, named = np.isin(op, ["lt", "ge"]), np.isin(op, ["eq", "ne"])
        own = np.zeros(len(asked))
        held = np.flatnonzero(got != 0)
        if cuts.any():
            order = np.argsort(rows["x"].to_numpy()[held], kind="stable")
            first = np.searchsorted(rows["x"].to_numpy()[held][order], asked["cut"].to_numpy()[cuts], "left")
            weights = got[held][order][:, None]
            to = lambda end: prefix_rank_sums(order, weights, first, np.searchsorted(held, end[cuts], "left"))[:, 0]
            own[cuts] = to(high) - to(low)
        if named.any():
            values, ids = np.unique(asked["value"].to_numpy(dtype=object)[named].astype(str), return_inverse=True)
            nom = rows["nom"].to_numpy(dtype=object)[held]
            at = {v: i for i, v in enumerate(values)}
            code = np.array([at.get(v, len(values)) for v in nom], dtype=np.int64)
            place = code * (len(y) + 1) + held
            order = np.argsort(place, kind="stable")
            place, sums = place[order], upto(got[held][order])
            to = lambda end: sums[np.searchsorted(place, ids * (len(y) + 1) + end[named], "left")]
            own[named] = to(high) - to(low)
        p = np.where(np.isin(op, ["lt", "eq"]), own, p - own)
        out = asked[["attr", "op", "cut", "value", "c", "p_new"]].reset_index(drop=True)
        out = out.assign(p=p, p_all=every[high] - every[low], total=every[-1])
        return out.astype({c: object for c in ("attr", "op", "value")})

    return counted


class _Stretches:
    """What is known of one attribute's stretches: the ends of their cuts and the ranges their intervals' ends take.

    Cells of values lie between the first and last cuts of stretches, cells of labels between the ends of all ranges. Labels from
    the least to the greatest lower end of a stretch, and above the least to the greatest upper end, are ``wide`` for it.
    """

    def __init__(self, rows):
        self.ids = sorted({r["s"] for r in rows})
        first, last, ranges = {}, {}, []
        for r in rows:
            s = r["s"]
            first[s], last[s] = min(first.get(s, math.inf), r["x0"]), max(last.get(s, -math.inf), r["x1"])
            above = lambda v: math.nextafter(v, math.inf)
            ranges += [(s, r["lo0"], r["lo1"]), (s, above(r["hi0"]), above(r["hi1"]))]
        self.xs = sorted({*first.values(), *last.values()})
        self.ys = sorted({v for _, a, b in ranges for v in (a, b)})
        at_x, at_y = ({v: i for i, v in enumerate(vs)} for vs in (self.xs, self.ys))
        # value cells up to the first number are below all cuts of the stretch, those above the second beyond all of them
        self.span = {s: (at_x[first[s]], at_x[last[s]]) for s in self.ids}
        wide = {(s, j) for s, a, b in ranges for j in range(at_y[a] + 1, at_y[b] + 1)}
        self.wide = sorted(wide)

    @staticmethod
    def usable(rows) -> bool:
        return all(math.isfinite(r[c]) for r in rows for c in ("x0", "x1", "lo0", "lo1", "hi0", "hi1"))

    def summed(self):
        """One group per attribute: sums of the cells that are not wide for a stretch, as points beside its cuts."""
        ids, span, starts = self.ids, self.span, [-math.inf, *self.ys]
        shape = (len(self.xs) + 3, len(self.ys) + 2)  # one value cell more for rows outside, and one of each that is not a number
        wide: dict[int, list[int]] = {s: [] for s in ids}
        for s, j in self.wide:
            wide[s].append(j)

        def points(frame: pd.DataFrame) -> pd.DataFrame:
            at = (frame["xi"].to_numpy() + 1, frame["yi"].to_numpy())
            upto = []
            for name in ("got", "all"):
                grid = np.zeros(shape)
                np.add.at(grid, at, frame[name].to_numpy(dtype=float))
                upto.append(grid.cumsum(axis=0))
            got, every = upto
            out = []
            for s in ids:
                i0, i1 = span[s]
                keep = np.ones(shape[1], bool)
                keep[wide[s]] = False
                begins = np.flatnonzero(keep & ~np.concatenate([[False], keep[:-1]]))
                if not len(begins):
                    continue
                # rows of cells up to i0 come before the stretch, those from i1 + 1 on after it
                sums = [got[i0 + 1], got[-1] - got[i1 + 1], every[-1] - (every[i1 + 1] - every[i0 + 1])]
                before, after, both = (np.add.reduceat(np.where(keep, v, 0.0), begins) for v in sums)
                for b, g0, g1, a in zip(begins, before, after, both):
                    out += [(s, -math.inf, starts[min(b, len(starts) - 1)], g0, a), (s, math.inf, starts[min(b, len(starts) - 1)], g1, 0.0)]
            return pd.DataFrame(out, columns=["s", "x", "y", "got", "all"])

        return points



class RegressionSearch(SingleSearch):
    def __init__(
        self,
        df: DataFrame,
        features: Sequence[str],
        label: str,
        params: InductionParams,
        weight: str | None = None,
        thresholds: Sequence[Condition] = (),
    ):
        self.label = label
        rows = df.where(quoted(label).cast("double").isNotNull())
        # Sums of squares are taken about the mean, which keeps them accurate for large labels.
        w = quoted(weight) if weight else F.lit(1.0)
        y = quoted(label).cast("double")
        self.center = rows.agg(F.coalesce(F.try_divide(F.sum(w * y), F.sum(w).cast("double")), F.lit(0.0))).first()[0]
        extra = {"__y": quoted(label).cast("double") - F.lit(self.center), "__w": w}
        self.moments: DataFrame | None = None
        self.held: list[DataFrame] = []
        super().__init__(TrainingTable(rows, features, params.bins, extra, thresholds), params)
        if self.table.approximate:
            # Conditions tell coded rows apart by their cells alone: sums per combination of cells serve every first pass.
            keys = [quoted(a) for a in features]
            kinds = self.table.df.agg(F.approx_count_distinct(F.xxhash64(*keys))).first()[0]
            if kinds <= MERGE_SHARE * self.table.rows:
                sums = {"__w": "__w", "__s1": "__w * __y", "__s2": "__w * __y * __y"}
                sums = self.table.df.groupBy(*keys).agg(*[F.sum(F.expr(e)).alias(n) for n, e in sums.items()])
                self.moments = sums.persist(StorageLevel.MEMORY_AND_DISK)

    @property
    def weights(self) -> DataFrame:
        return self.table.df if self.moments is None else self.moments

    def _sums(self) -> dict[str, str]:
        """Weight and label sums of a row of `weights`."""
        if self.moments is None:
            return {"c": "__w", "s1": "__w * __y", "s2": "__w * __y * __y"}
        return {"c": "__w", "s1": "__s1", "s2": "__s2"}

    def store_open(self) -> None:
        super().store_open()
        if self.moments is not None:
            fresh = written(self.moments.withColumn("__open", F.expr(self._open())), "moments")
            self.moments.unpersist()
            self.moments = fresh.persist(StorageLevel.MEMORY_AND_DISK)

    def close(self) -> None:
        super().close()
        self._release()
        if self.moments is not None:
            self.moments.unpersist()

    def first_pass(self, premise: Premise) -> DataFrame:
        sums = {**self._sums(), "p_new": f"if({self._open()}, __w, 0D)"}
        cells = value_sums(
            self.weights.where(self.table.holds(premise)), self.table.numeric, self.table.nominal, sums,
            self.table.bounds, self.table.nominal_buckets,
        )
        cand = split_candidates(
            self.table.gather(cells), list(sums), (), self.params.complementary_conditions, self.table.two_level,
            integral=self.table.approximate,
        )
        spread = "sqrt(greatest(s2 / c - (s1 / c) * (s1 / c), 0D))"
        return cand.selectExpr("*", f"s1 / c - {spread} as lo", f"s1 / c + {spread} as hi", "c as p")

    def exact(self, premise: Premise, cand: DataFrame) -> DataFrame:
        """p and P of every candidate: a group for each attribute of a small table, else as the attribute's candidates ask for."""
        inside = self.table.holds(premise)
        self._release()
        if self.table.rows <= ROWS_PER_GROUP:
            rows = self._long(inside, self.table.features)
            return self._judged(rows.groupBy("k").cogroup(cand.select(F.col("attr").alias("k"), *ASKED).groupBy("k")).applyInPandas(_count_functions(), COUNTED))
        cand = self._hold(cand)
        sizes = {r["attr"]: r["n"] for r in cand.groupBy("attr").agg(F.count(F.lit(1)).alias("n")).collect()}
        few = [a for a, n in sizes.items() if n <= 2 * single.CANDIDATES_PER_PASS]
        parts, rest = [], [a for a in sizes if a not in few and a not in self.table.numeric]
        for a in sizes:
            if a not in few and a not in rest:
                found = self._by_stretches(inside, cand.where(F.col("attr") == a), a)
                rest, parts = ([*rest, a], parts) if found is None else (rest, [*parts, self._judged(found)])
        if few:
            parts.append(self.second_pass(premise, cand.where(F.col("attr").isin(few)).collect()))
        if rest:
            parts.append(self._judged(self._by_dominance(inside, cand.where(F.col("attr").isin(rest)), rest)))
        if not parts:
            return self._judged(cand.selectExpr("attr", "op", "cut", "value", "c", "p_new", "p", "c as p_all", "c as total"))
        return reduce(lambda x, y: x.unionByName(y), parts)

    def _hold(self, df: DataFrame) -> DataFrame:
        """Stored until the next step."""
        self.held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def _release(self) -> None:
        while self.held:
            self.held.pop().unpersist()

    def _judged(self, scored: DataFrame) -> DataFrame:
        """Counts of candidates with their quality."""
        scored = scored.select("attr", "op", "cut", "value", "c", "p_new", "p", "p_all", (F.col("total") - F.col("p_all")).alias("n_all"),
                               (F.col("c") - F.col("p")).alias("n"))
        args = [F.col(x) for x in ("p", "n", "p_all", "n_all")]
        return scored.withColumn("quality", quality(self.params.induction_measure, *args)).withColumn("target", F.lit(""))

    def _long(self, inside: Column, attrs: Sequence[str]) -> DataFrame:
        """A row for each example and attribute: k, x or nom, y, the weight inside the premise, the weight."""

        def cell(a: str) -> Column:
            numeric = a in self.table.numeric
            there = quoted(a).isNotNull()
            x = F.coalesce(quoted(a).cast("double"), F.lit(-math.inf)) if numeric else F.lit(0.0)
            nom = F.lit(None).cast("string") if numeric else quoted(a).cast("string")
            got = F.when(inside & there, F.col("__w").cast("double")).otherwise(F.lit(0.0))
            made = F.struct(F.lit(a).alias("k"), x.alias("x"), nom.alias("nom"), F.col("__y").alias("y"),
                            got.alias("got"), F.col("__w").cast("double").alias("all"))
            return F.when(there, made) if self.params.ignore_missing else made

        return self.table.df.select(F.inline(F.array_compact(F.array(*[cell(a) for a in attrs]))))

    def _by_stretches(self, inside: Column, cand: DataFrame, attr: str) -> DataFrame | None:
        """p and P of the many cuts of one attribute, in groups of neighbouring cuts; None where labels do not allow it.

        Values are cut into stretches of about equal rows. From cut to cut the interval of a candidate moves little, so
        the intervals of a stretch differ in a few narrow ranges of labels. Its group gets the rows between its own first and last
        cuts, those of all other values with labels in these ranges, and the rest as sums. A value with many rows
        lies between two stretches. Labels whose ranges stay wide (far outliers at every cut) go by dominated points.
        """
        stretches = min(MAX_STRETCHES, 2 + 4 * int(self.table.rows) // ROWS_PER_GROUP)
        x, w = quoted(attr).cast("double"), F.col("__w").cast("double")
        values = self.table.df.where(inside & x.isNotNull()).select(x.alias("x"))
        edges = quantile_cuts(values, {"x": stretches})["x"]
        cand = bucketize(cand, {"s": edges}, {"s": "cut"})
        ends = cand.groupBy("s", "op").agg(F.min("cut").alias("x0"), F.max("cut").alias("x1"), F.min("lo").alias("lo0"),
                                           F.max("lo").alias("lo1"), F.min("hi").alias("hi0"), F.max("hi").alias("hi1")).collect()
        if not _Stretches.usable(ends):
            return None
        known = _Stretches(ends)
        rows = self.table.df.select(x.alias("x"), F.col("__y").alias("y"), F.when(inside & x.isNotNull(), w).otherwise(F.lit(0.0)).alias("got"), w.alias("all"))
        if self.params.ignore_missing:
            rows = rows.where("x is not null")
        rows = bucketize(rows, {"xi": known.xs, "yi": known.ys}, {"xi": "x", "yi": "y"})
        rows = rows.withColumn("xi", F.when(F.col("got") != 0, F.col("xi")).otherwise(F.lit(OUTSIDE)))
        grid = self._hold(rows.groupBy("xi", "yi").agg(F.sum("got").alias("got"), F.sum("all").alias("all"), F.count(F.lit(1)).alias("n")))
        sizes = {r["yi"]: r["n"] for r in grid.groupBy("yi").agg(F.sum("n").alias("n")).collect()}
        if sum(sizes.get(j, 0) for _, j in known.wide) > MOST_COPIES * self.table.rows:
            return None
        spark = cand.sparkSession
        wide = [(s, j, *known.span[s]) for s, j in known.wide]
        wide = F.broadcast(spark.createDataFrame(wide, "s int, yi int, i0 int, i1 int"))  # ranges of labels by stretch, a few for each
        own = F.broadcast(spark.createDataFrame([(s, i1) for s, (i0, i1) in known.span.items() if i1 > i0], "s int, xi int"))
        between = rows.join(own, "xi").select("s", "x", "y", "got", "all")
        aside = rows.join(wide, "yi").where("xi <= i0 or xi > i1").select(
            "s", F.expr("if(xi <= i0, double('-inf'), double('inf'))").alias("x"), "y", "got", "all")
        rest = grid.groupBy().applyInPandas(known.summed(), "s int, x double, y double, got double, all double")
        points = between.unionByName(aside).unionByName(rest)
        return points.groupBy("s").cogroup(cand.select("s", *ASKED).groupBy("s")).applyInPandas(_count_functions(), COUNTED)

    def _by_dominance(self, inside: Column, cand: DataFrame, attrs: Sequence[str]) -> DataFrame:
        """p and P of candidates from sums over dominated points in the (value, label) plane, whatever values and labels are.

        Below a cut and at most hi, less below the cut and under lo; the other side is the attribute's total less that.
        Nominal candidates meet the rows of their value in a join.
        """
        everywhere = F.lit(math.inf)

        long = self._long(inside, attrs)
        points = long.groupBy("k", "x", "y").agg(F.sum("got").alias("got"), F.sum("all").alias("all")).persist(StorageLevel.MEMORY_AND_DISK)
        ask = lambda x, y, closed, which: F.struct(
            x.alias("x"), F.col(y).alias("y"), F.lit(False).alias("x_in"), F.lit(closed).alias("y_in"), F.lit(which).alias("which"))
        asked = F.array(ask(everywhere, "lo", False, 0), ask(everywhere, "hi", True, 1),
                        ask(F.col("cut"), "lo", False, 2), ask(F.col("cut"), "hi", True, 3))
        key = {"cut": F.coalesce("cut", F.lit(0.0)), "value": F.coalesce("value", F.lit(""))}
        queries = cand.select(F.col("attr").alias("k"), "op", key["cut"].alias("at"), key["value"].alias("of"), F.explode(asked).alias("q"))
        queries = queries.select("k", "op", "at", "of", "q.*").where("x is not null")
        sums = dominated_sums(points, queries, ["got", "all"], "op string, at double, of string, which int")
        pick = lambda name, i: F.coalesce(F.sum(F.when(F.col("which") == i, F.col(name))), F.lit(0.0))
        found = sums.groupBy("k", "op", "at", "of").agg(
            (pick("got", 1) - pick("got", 0)).alias("band"), (pick("got", 3) - pick("got", 2)).alias("below"),
            (pick("all", 1) - pick("all", 0)).alias("p_all"))
        totals = points.groupBy("k").agg(F.sum("all").alias("total"))
        near = cand.where("value is not null").select(F.col("attr").alias("k"), "op", F.col("value").alias("nom"), "lo", "hi")
        own = long.where("nom is not null and got > 0").groupBy("k", "nom", "y").agg(F.sum("got").alias("got")).join(near, ["k", "nom"])
        own = own.groupBy("k", "op", F.col("nom").alias("of")).agg(
            F.sum(F.when(F.col("y").between(F.col("lo"), F.col("hi")), F.col("got")).otherwise(0.0)).alias("own"))
        scored = (
            cand.withColumns({"k": F.col("attr"), "at": key["cut"], "of": key["value"]})
            .join(found, ["k", "op", "at", "of"]).join(totals, "k").join(own, ["k", "op", "of"], "left")
            .withColumn("own", F.coalesce("own", F.lit(0.0)))
            .withColumn("p", F.expr("case op when 'lt' then below when 'ge' then band - below when 'eq' then own else band - own end"))
        )
        return scored.select("attr", "op", "cut", "value", "c", "p_new", "p", "p_all", "total")

    def second_pass(self, premise: Premise, rows) -> DataFrame:
        slots = Slots(self.table, rows)
        # End points per attribute; hi is inclusive, so its code boundary is the next double.
        ends = {
            a: sorted({x for r in cands for x in (r["lo"], math.nextafter(r["hi"], math.inf))})
            for a, cands in slots.by_attr.items()
        }
        df, slot = slots.assign(self.table.df)
        # One search among the ends of all attributes; an attribute's own code is looked up.
        every = sorted({x for own in ends.values() for x in own})
        df = bucketize(df, {"__end": every}, {"__end": "__y"})
        inside = self.table.holds(premise)
        # A cell is one number: attribute, slot and code. Attribute i has the numbers from bases[i] on.
        names, widths = list(slots.by_attr), [len(ends[a]) + 1 for a in slots.by_attr]
        bases = np.concatenate([[0], np.cumsum([(slots.slot_count(a) + 1) * c for a, c in zip(names, widths)])]).tolist()

        def place(a):
            at = F.when(inside, F.coalesce(slot[a], F.lit(OUTSIDE))).otherwise(F.lit(OUTSIDE))
            # Ignoring missing values means that such rows take no part for this attribute.
            return F.when(slot[a].isNotNull(), at) if self.params.ignore_missing else at

        def cell(a, base, width):
            codes = np.searchsorted(ends[a], [-math.inf, *every], "right")
            code = F.get(F.lit([int(c) for c in [*codes, codes[-1]]]), F.col("__end"))  # the last one: not a number
            return (F.lit(base) + (place(a) - F.lit(OUTSIDE)) * F.lit(width) + code).cast("long")

        cells = F.array(*[cell(*x) for x in zip(names, bases, widths)])
        grid = df.select("__w", F.explode(cells).alias("cell")).where("cell is not null").groupBy("cell").agg(F.sum("__w").alias("w"))
        which = F.greatest(F.lit(0), *[F.when(F.col("cell") >= b, F.lit(i)) for i, b in enumerate(bases[:-1])])
        of = lambda values: F.get(F.lit(values), F.col("i"))
        grid = grid.withColumn("i", which).withColumn("at", F.col("cell") - of(bases[:-1]))
        grid = grid.select(of(names).alias("attr"), ((F.col("at") / of(widths)).cast("int") + F.lit(OUTSIDE)).alias("slot"),
                           (F.col("at") % of(widths)).cast("int").alias("code"), "w")
        plans = {
            a: (
                slots.slot_count(a),
                len(ends[a]) + 1,
                [
                    (i0, i1, inv, ends[a].index(r["lo"]) + 1, ends[a].index(math.nextafter(r["hi"], math.inf)) + 1, r)
                    for r, i0, i1, inv in slots.spans(a)
                ],
            )
            for a in slots.by_attr
        }
        plans = {
            a: (s, c, [(*e[:5], e[5]["op"], e[5]["cut"], e[5]["value"], e[5]["c"], e[5]["p_new"]) for e in entries])
            for a, (s, c, entries) in plans.items()
        }

        def rectangles(pdf: pd.DataFrame) -> pd.DataFrame:
            attr = pdf["attr"].iloc[0]
            n_slots, n_codes, entries = plans[attr]
            grid = np.zeros((n_slots + 1, n_codes))  # the last row: outside the premise, or missing
            np.add.at(grid, (pdf["slot"].to_numpy(), pdf["code"].to_numpy()), pdf["w"].to_numpy())
            across = np.concatenate([np.zeros((n_slots + 1, 1)), grid.cumsum(axis=1)], axis=1)
            down = np.concatenate([np.zeros((1, n_codes + 1)), across[:-1].cumsum(axis=0)])
            out = []
            for i0, i1, inv, c0, c1, op, cut, value, c, new in entries:
                band = down[:, c1] - down[:, c0]
                p = band[i1] - band[i0]
                p = band[-1] - p if inv else p
                p_all = across[:, c1].sum() - across[:, c0].sum()
                out.append((attr, op, cut, value, c, new, p, p_all, grid.sum() - p_all))
            return pd.DataFrame(out, columns=["attr", "op", "cut", "value", "c", "p_new", "p", "p_all", "n_all"])

        # One group per attribute, bounded by slots x codes of this pass.
        scored = grid.groupBy("attr").applyInPandas(
            rectangles,
            "attr string, op string, cut double, value string, c double, p_new double, p double, p_all double, n_all double",
        )
        scored = scored.withColumn("n", F.col("c") - F.col("p"))
        args = [F.col(x) for x in ("p", "n", "p_all", "n_all")]
        return scored.withColumn("quality", quality(self.params.induction_measure, *args)).withColumn(
            "target", F.lit("")
        )

    def evaluate(self, premises: Sequence[Premise], medians: bool = False) -> list[dict]:
        """Conclusion and counts of given premises: two scans for all of them."""
        if not premises:
            return []
        df, w, y = self.table.df, F.col("__w"), F.col("__y")
        hits = [self.table.holds(p) for p in premises]
        sums = [F.expr(e) for e in self._sums().values()]
        aggs = [F.sum(F.when(h, e)).alias(f"{n}{i}") for i, h in enumerate(hits) for n, e in zip("csq", sums)]
        row = self.weights.agg(*aggs).first()
        found: dict[int, tuple[float, float]] = {}
        for i in range(len(premises)):
            if row[f"c{i}"]:
                mean = row[f"s{i}"] / row[f"c{i}"]
                found[i] = (mean, math.sqrt(max(0.0, row[f"q{i}"] / row[f"c{i}"] - mean * mean)))
        if medians and found:
            found = self._about_medians(hits, found)
        if not found:
            return [{"value": None, "std": None, "p": 0.0, "n": 0.0, "p_all": 0.0, "n_all": self.everything}
                    for _ in premises]
        aggs = []
        for i, (value, spread) in found.items():
            near = y.between(F.lit(value - spread), F.lit(value + spread))
            aggs += [F.sum(F.when(hits[i] & near, w).otherwise(0.0)).alias(f"p{i}"),
                     F.sum(F.when(near, w).otherwise(0.0)).alias(f"a{i}")]
        counts = df.agg(*aggs).first()
        out = []
        for i in range(len(premises)):
            if i not in found:
                out.append({"value": None, "std": None, "p": 0.0, "n": 0.0, "p_all": 0.0, "n_all": self.everything})
                continue
            value, spread = found[i]
            p, p_all = counts[f"p{i}"], counts[f"a{i}"]
            out.append({"value": value + self.center, "std": spread, "p": p, "n": row[f"c{i}"] - p,
                        "p_all": p_all, "n_all": self.everything - p_all})
        return out

    def _about_medians(self, hits, found):
        ids = F.array_compact(F.array(*[F.when(h, F.lit(i)) for i, h in enumerate(hits)]))
        rows = self.table.df.select(F.explode(ids).alias("rule_id"), F.col("__y").alias("y"))
        medians = {r["rule_id"]: r["median"] for r in exact_medians(rows, "rule_id", "y").collect()}
        out = {}
        for i, (mean, spread) in found.items():
            # E[(y - m)^2] = var + (mean - m)^2
            out[i] = (medians[i], math.sqrt(spread**2 + (mean - medians[i]) ** 2))
        return out

    def variant_qualities(self, premises: Sequence[Premise]):
        counts = self.evaluate(premises)
        rows = [(c["p"], c["n"], c["p_all"], c["n_all"]) for c in counts]
        return python_quality(self.params.pruning_measure, self.table.df.sparkSession, rows)

    def describe(self, target: str, premise: Premise) -> Rule:
        return self.describe_all([(target, premise)])[0]

    def describe_all(self, pairs) -> list[Rule]:
        """Conclusions and counts of all rules from two scans."""
        premises = [p for _, p in pairs]
        counts = self.evaluate(premises, medians=not self.params.mean_based_regression)
        return [Rule(p, target=self.label, problem="regression", **c) for p, c in zip(premises, counts)]
