"""Search for classification rules (and contrast sets): every class against the rest, in one job."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premisa.functions import sqltext as q
from premisa.functions.measures import python_quality, quality
from premisa.functions.premise import quoted
from premisa.operators.base import MERGE_SHARE, TrainingTable
from premisa.operators.candidates import best_by_quality, split_candidates, value_sums
from premisa.operators.covering import Premise, Step, climb
from premisa.plans.params import InductionParams
from premisa.plans.rules import Condition, Rule, add_condition, at_least, equals, less, not_equals

# Classes whose counts share one job; more classes run in several jobs.
CLASSES_PER_JOB = 16
# Sets of failing conditions, per class, that one aggregate for pruning may return.
PATTERNS = 4096
# Conditions in one long of such a set.
WORD = 62
# Accepted rules after which the uncovered flag is written out.
RULES_PER_WRITE = 20


def candidate_condition(row, table: TrainingTable) -> Condition:
    """The condition a candidate row stands for."""
    if row["op"] == "lt":
        return less(row["attr"], table.real_cut(row["attr"], row["cut"]))
    if row["op"] == "ge":
        return at_least(row["attr"], table.real_cut(row["attr"], row["cut"]))
    return (equals if row["op"] == "eq" else not_equals)(row["attr"], row["value"])


def _depth(conditions: int) -> int:
    """The most conditions that may fail, at least one, so that the sets of failing ones stay within ``PATTERNS``."""
    depth, sets = 0, 1
    while depth < conditions and (sets := sets + math.comb(conditions, depth + 1)) <= PATTERNS:
        depth += 1
    return max(1, depth)


class ClassSearch:
    must_improve = False

    def __init__(
        self,
        df: DataFrame,
        features: Sequence[str],
        label: str,
        params: InductionParams,
        weight: str | None = None,
        thresholds: Sequence[Condition] = (),
        targets: Sequence[str] | None = None,
    ):
        self.params, self.label = params, label
        w = quoted(weight) if weight else F.lit(1.0)
        self.table = TrainingTable(df, features, params.bins, {"__y": quoted(label), "__w": w}, thresholds)
        aggs = [F.sum("__w").alias("s")]
        if self.table.approximate:
            aggs.append(F.approx_count_distinct(F.xxhash64(*[quoted(a) for a in features])).alias("k"))
        found = self.table.df.groupBy("__y").agg(*aggs).collect()
        if self.table.approximate and sum(r["k"] for r in found) <= MERGE_SHARE * self.table.rows:
            self.table.merge([*features, "__y"], "__w")
        sizes = {r["__y"]: r["s"] for r in found if r["__y"] is not None}
        self.everything = sum(sizes.values())
        self.targets = list(targets) if targets else sorted(sizes)
        self.size = {t: sizes.get(t, 0.0) for t in self.targets}
        self.missing = self._missing() if params.ignore_missing else {}
        self.adjust: Callable[[DataFrame], DataFrame] | None = None
        self.found: dict[tuple[str, Premise], tuple[float, float]] = {}
        self.reset()

    def reset(self) -> None:
        """Everything uncovered again."""
        self.uncovered = dict(self.size)
        self.pending: dict[str, list[Premise]] = {}
        self.flagged = False  # whether the stored table carries the uncovered flag
        self._known: dict[tuple[str, Premise], tuple[float, float, float]] = {}

    def _missing(self) -> dict[tuple[str, str], float]:
        """Weight of rows with a missing value per attribute, in total and per class."""
        names = self.table.features
        aggs = [F.sum(F.when(quoted(a).isNull(), F.col("__w")).otherwise(0.0)).alias(f"m{i}") for i, a in enumerate(names)]
        out: dict[tuple[str, str], float] = {}
        for row in self.table.df.where("__y is not null").groupBy("__y").agg(*aggs).collect():
            for i, a in enumerate(names):
                out[a, row["__y"]] = row[f"m{i}"]
        return out

    def total(self) -> float:
        return sum(self.size.values())

    def remaining(self) -> float:
        return sum(self.uncovered.values())

    # --- state -------------------------------------------------------------------------------

    def _open(self) -> str:
        """Rows of a class that no accepted rule of that class covers yet."""
        taken = [
            f"(__y = {q.text(t)} and ({' or '.join(self.table.holds_sql(p) for p in premises)}))"
            for t, premises in self.pending.items()
            if premises
        ]
        flag = "__open" if self.flagged else "true"
        return f"{flag} and not ({' or '.join(taken)})" if taken else flag

    def _flush(self) -> None:
        if sum(len(p) for p in self.pending.values()) >= RULES_PER_WRITE:
            self.table.replace_columns({"__open": F.expr(self._open())})
            self.flagged, self.pending = True, {}

    def accept(self, target: str, premise: Premise) -> float:
        p, n, new = self.counts(target, premise)
        self.uncovered[target] -= new
        self.found[target, premise] = (p, n)
        self.pending.setdefault(target, []).append(premise)
        self._known = {k: v for k, v in self._known.items() if k[0] != target}
        self._flush()
        return new

    def counts(self, target: str, premise: Premise) -> tuple[float, float, float]:
        """(p, n, newly covered positives) of a premise."""
        if (target, premise) not in self._known:
            self._remember(target, [premise])
        return self._known[target, premise]

    def _remember(self, target: str, premises: Sequence[Premise]) -> None:
        marks = self._marks(target)
        aggs = [
            F.expr(f"coalesce(sum(if({self.table.holds_sql(p)} and {m}, __w, 0D)), 0D) as {x}{i}")
            for i, p in enumerate(premises)
            for x, m in marks.items()
        ]
        row = self.table.df.where("__y is not null").agg(*aggs).first()
        for i, p in enumerate(premises):
            self._known[target, p] = (row[f"p{i}"], row[f"n{i}"], row[f"f{i}"])

    def _marks(self, target: str) -> dict[str, str]:
        """Row conditions for p, n and newly covered positives."""
        pos = f"__y = {q.text(target)}"
        return {"p": f"{pos}", "n": f"not ({pos})", "f": f"{pos} and {self._open()}"}

    def new_coverage(self, target: str, premise: Premise) -> float:
        return self.counts(target, premise)[2]

    # --- growing -----------------------------------------------------------------------------

    def candidates(self, premises: Mapping[str, Premise]) -> DataFrame:
        """(target, attr, op, cut, value, p, c, p_new) of every target's refinements: one scan."""
        sums, parts = {}, []
        inside = {t: self.table.holds_sql(p) for t, p in premises.items()}
        for i, t in enumerate(premises):
            marks = self._marks(t)
            sums[f"c{i}"] = f"if({inside[t]}, __w, 0D)"
            sums[f"p{i}"] = f"if({inside[t]} and {marks['p']}, __w, 0D)"
            sums[f"f{i}"] = f"if({inside[t]} and {marks['f']}, __w, 0D)"
            parts.append(f"if(c{i} > 0, struct({q.text(t)} as target, p{i} as p, c{i} as c, f{i} as p_new), null)")
        rows = self.table.df.where(f"__y is not null and ({' or '.join(inside.values())})")
        cells = value_sums(
            rows, self.table.numeric, self.table.nominal, sums, self.table.bounds, self.table.nominal_buckets
        )
        cells = self.table.gather(cells).selectExpr("attr", "bucket", "num", "nom", f"inline(array_compact(array({', '.join(parts)})))")
        return split_candidates(
            cells, ["p", "c", "p_new"], ["target"], self.params.complementary_conditions,
            self.table.two_level, integral=self.table.approximate,
        )

    def scored(self, premises: Mapping[str, Premise]) -> DataFrame:
        """Candidates with n, P, N and quality, after the support, precision and progress filters."""
        p_all = q.lookup(self.size, "target")
        n_all = f"{q.number(self.everything)} - {p_all}"
        if self.missing:
            at = "concat_ws('\u0001', attr, target)"
            own = {f"{a}\u0001{t}": self.missing.get((a, t), 0.0) for a in self.table.features for t in self.targets}
            total: dict[str, float] = {}
            for (a, _), m in self.missing.items():
                total[a] = total.get(a, 0.0) + m
            gone = q.lookup(own, at)
            p_all, n_all = f"{p_all} - {gone}", f"{n_all} - ({q.lookup(total, 'attr')} - {gone})"
        now = {t: self.counts(t, p)[1] if p else self.everything - self.size[t] for t, p in premises.items()}
        need = {t: self.params.min_new(self.uncovered[t]) for t in premises}
        cand = self.candidates(premises).where(
            f"p_new >= {q.lookup(need, 'target')} and c - p < {q.lookup(now, 'target')}"  # leaves out a negative
        )
        cand = cand.selectExpr("*", "c - p as n", f"{p_all} as p_all", f"{n_all} as n_all")
        if self.params.control_apriori_precision:
            cand = cand.where("p * (p_all + n_all) > p_all * c")
        measure = self.params.induction_measure
        cand = cand.withColumn("quality", quality(measure, *[F.col(x) for x in ("p", "n", "p_all", "n_all")]))
        return self.adjust(cand) if self.adjust else cand

    def best(self, premises: Mapping[str, Premise], allow=None) -> dict[str, Step]:
        out: dict[str, Step] = {}
        names = list(premises)
        for start in range(0, len(names), CLASSES_PER_JOB):
            part = {t: premises[t] for t in names[start : start + CLASSES_PER_JOB]}
            cand = self.scored(part)
            if allow is not None:
                cand = allow(cand)
            # One row per class comes back.
            for row in best_by_quality(cand, ["target"]).collect():
                step = Step(candidate_condition(row, self.table), row["quality"], row["c"], row["n"], row["p_new"])
                out[row["target"]] = step
                grown = add_condition(part[row["target"]], step.condition)
                self._known[row["target"], grown] = (row["p"], row["n"], row["p_new"])
        return out

    # --- pruning -----------------------------------------------------------------------------

    def prune(self, premises: Mapping[str, Premise]) -> dict[str, Premise]:
        """Hill climbing. A premise without the conditions D covers the rows that fail no condition outside D. So one
        aggregate by the set of failing conditions, over the rows that fail at most d, answers the next d removals; d is all
        conditions of a short premise and less for a long one, such that at most ``PATTERNS`` sets come back."""
        return climb(premises, self._removal_qualities(premises))

    def _patterns(self, premises: Mapping[str, Premise], depth: Mapping[str, int]) -> dict[str, dict[int, tuple[float, float, float]]]:
        """Sums per set of at most ``depth`` failing conditions (a bit each, in the premise's order)."""
        words = [f"f{k}" for k in range(-(-max(len(p) for p in premises.values()) // WORD))]
        parts = []
        for t, premise in premises.items():
            bits = [f"if({self.table.holds_sql([c])}, 0L, {1 << j % WORD}L)" for j, c in enumerate(premise)]
            sets = [f"{' + '.join(bits[k * WORD : (k + 1) * WORD] or ['0L'])} as {w}" for k, w in enumerate(words)]
            sums = ", ".join(f"if({m}, __w, 0D) as {x}" for x, m in self._marks(t).items())
            parts.append(f"struct({q.text(t)} as target, {depth[t]} as depth, {', '.join(sets)}, {sums})")
        rows = self.table.df.where("__y is not null").selectExpr(f"inline(array({', '.join(parts)}))")
        rows = rows.where(f"{' + '.join(f'bit_count({w})' for w in words)} <= depth")
        table: dict[str, dict[int, tuple[float, float, float]]] = {t: {} for t in premises}
        for r in rows.groupBy("target", *words).agg(*[F.sum(x).alias(x) for x in "pnf"]).collect():
            failing = sum(r[w] << k * WORD for k, w in enumerate(words))
            table[r["target"]][failing] = (r["p"], r["n"], r["f"])
        return table

    def _removal_qualities(self, premises: Mapping[str, Premise]) -> Callable:
        held: dict[str, tuple[tuple[int, ...], int, dict]] = {}  # positions the sets are of, their depth, their sums

        def qualities(asks):
            stale: dict[str, set[int]] = {}
            for t, kept in asks:
                if t not in held or len(held[t][0]) - len(kept) > held[t][1]:
                    stale.setdefault(t, set())
            for t, kept in asks:
                if t in stale:
                    stale[t] |= set(kept)
            if stale:
                whole = {t: tuple(sorted(x)) for t, x in stale.items()}
                depth = {t: _depth(len(x)) for t, x in whole.items()}
                found = self._patterns({t: tuple(premises[t][i] for i in x) for t, x in whole.items()}, depth)
                held.update({t: (x, depth[t], found[t]) for t, x in whole.items()})
            rows = []
            for t, kept in asks:
                whole, _, table = held[t]
                dropped = sum(1 << j for j, i in enumerate(whole) if i not in kept)
                sums = [v for failing, v in table.items() if failing & ~dropped == 0]
                p, n, f = (sum(s[j] for s in sums) for j in range(3))
                self._known[t, tuple(premises[t][i] for i in kept)] = (p, n, f)
                rows.append((p, n, self.size[t], self.everything - self.size[t]))
            return python_quality(self.params.pruning_measure, self.table.df.sparkSession, rows)

        return qualities

    # --- results -----------------------------------------------------------------------------

    def describe(self, target: str, premise: Premise, **kw) -> Rule:
        p, n = self.found.get((target, premise)) or self.counts(target, premise)[:2]
        size = self.size[target]
        return Rule(premise, target=self.label, label=target, p=p, n=n, p_all=size, n_all=self.everything - size, **kw)

    def describe_all(self, pairs: Sequence[tuple[str, Premise]]) -> list[Rule]:
        return [self.describe(t, p) for t, p in pairs]

    def close(self) -> None:
        self.table.close()
