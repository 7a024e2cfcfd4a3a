"""Shared bookkeeping of searches with one target: the whole table is to be covered."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premisa.functions.premise import quoted
from premisa.operators.base import TrainingTable
from premisa.operators.candidates import best_by_quality, bucketize
from premisa.operators.classify import RULES_PER_WRITE, candidate_condition
from premisa.operators.covering import Premise, Step, climb
from premisa.plans.params import InductionParams
from premisa.plans.rules import Rule, add_condition

TARGET = ""
# Candidates per attribute whose second-pass statistics share one job.
CANDIDATES_PER_PASS = 256


class SingleSearch:
    """Subclasses supply `first_pass`, `second_pass`, `variant_qualities` and `describe`."""

    must_improve = True

    def __init__(self, table: TrainingTable, params: InductionParams):
        self.table, self.params = table, params
        self.everything = float(table.df.agg(F.expr("coalesce(sum(__w), 0D)")).first()[0])
        self.targets = [TARGET]
        self.size = {TARGET: self.everything}
        self.adjust: Callable[[DataFrame], DataFrame] | None = None
        self.reset()

    def reset(self) -> None:
        self.uncovered = {TARGET: self.everything}
        self.pending: list[Premise] = []
        self.flagged = False  # whether the stored table carries the uncovered flag
        self._new: dict[Premise, float] = {}
        self._covered: dict[Premise, float] = {(): self.everything}

    def total(self) -> float:
        return self.everything

    def remaining(self) -> float:
        return self.uncovered[TARGET]

    def _open(self) -> str:
        flag = "__open" if self.flagged else "true"
        if not self.pending:
            return flag
        return f"{flag} and not ({' or '.join(self.table.holds_sql(p) for p in self.pending)})"

    def new_coverage(self, target: str, premise: Premise) -> float:
        if premise not in self._new:
            self._measure(premise)
        return self._new[premise]

    def covered(self, premise: Premise) -> float:
        if premise not in self._covered:
            self._measure(premise)
        return self._covered[premise]

    def _measure(self, premise: Premise) -> None:
        """Covered and newly covered weight of a premise the search has not met yet."""
        hit = self.table.holds_sql(premise)
        row = self.weights.agg(
            F.expr(f"coalesce(sum(if({hit}, __w, 0D)), 0D) as c"),
            F.expr(f"coalesce(sum(if({hit} and {self._open()}, __w, 0D)), 0D) as f"),
        ).first()
        self._covered[premise], self._new[premise] = row["c"], row["f"]

    def accept(self, target: str, premise: Premise) -> float:
        new = self.new_coverage(target, premise)
        self.uncovered[TARGET] -= new
        self.pending.append(premise)
        self._new = {}
        if len(self.pending) >= RULES_PER_WRITE:
            self.store_open()
            self.flagged, self.pending = True, []
        return new

    def store_open(self) -> None:
        """Write the uncovered flag out."""
        self.table.replace_columns({"__open": F.expr(self._open())})

    @property
    def weights(self) -> DataFrame:
        """The stored columns with the weight __w: the training table, or a smaller one with the same sums."""
        return self.table.df

    # --- growing -----------------------------------------------------------------------------

    def best(self, premises: Mapping[str, Premise], allow=None) -> dict[str, Step]:
        premise = premises[TARGET]
        now = self.covered(premise)
        cand = self.first_pass(premise).withColumn("target", F.lit(TARGET))
        cand = cand.where(
            (F.col("p_new") >= F.lit(self.params.min_new(self.uncovered[TARGET]))) & (F.col("c") < F.lit(now))
        )
        if allow is not None:
            cand = allow(cand)
        winner = None
        for scored in self._scored(premise, cand):
            if self.adjust:
                scored = self.adjust(scored)
            found = best_by_quality(scored).collect()
            if found and (winner is None or self._rank(found[0]) < self._rank(winner)):
                winner = found[0]
        if winner is None:
            return {}
        n = winner["n"] if "n" in winner.asDict() else 1.0
        grown = add_condition(premise, candidate_condition(winner, self.table))
        self._covered[grown], self._new[grown] = winner["c"], winner["p_new"]
        return {TARGET: Step(candidate_condition(winner, self.table), winner["quality"], winner["c"], n, winner["p_new"])}

    def _scored(self, premise: Premise, cand: DataFrame) -> Iterator[DataFrame]:
        """Candidates with their qualities. Exact search scores all of them at once, in a fixed number of jobs."""
        if not self.table.approximate and (scored := self.exact(premise, cand)) is not None:
            yield scored
            return
        for share in self._passes(cand):
            rows = share.collect()
            if rows:
                yield self.second_pass(premise, rows)

    def exact(self, premise: Premise, cand: DataFrame) -> DataFrame | None:
        """All candidates scored without shares; None where a search has no such way."""
        return None

    def _passes(self, cand: DataFrame) -> Iterator[DataFrame]:
        """Shares of the candidates small enough for one second pass; together they are all of them."""
        if self.table.candidates_per_attribute <= 2 * CANDIDATES_PER_PASS:
            yield cand
            return
        cand = cand.persist()
        per_attr = cand.groupBy("attr").count().agg(F.max("count")).first()[0] or 0
        passes = -(-per_attr // CANDIDATES_PER_PASS)
        for i in range(passes):
            yield cand.where(F.pmod(F.hash("attr", "op", "cut", "value"), F.lit(passes)) == F.lit(i))
        cand.unpersist()

    @staticmethod
    def _rank(row):
        return (-row["quality"], -row["p"], row["attr"], row["op"], row["cut"] or 0.0, row["value"] or "")

    # --- pruning -----------------------------------------------------------------------------

    def prune(self, premises: Mapping[str, Premise]) -> dict[str, Premise]:
        def qualities(asks):
            return self.variant_qualities([tuple(premises[t][i] for i in kept) for t, kept in asks])

        return climb(premises, qualities)

    def describe_all(self, pairs) -> list[Rule]:
        return [self.describe(t, p) for t, p in pairs]

    def close(self) -> None:
        self.table.close()


class Slots:
    """Cells of the candidates of one pass: slot numbers per attribute, and who covers which slots.

    A numeric attribute is cut at the pass's own cuts (slot k is ``[cut_k-1, cut_k)``), a nominal one
    has a slot per listed value and one more for all others.  Sizes are bounded by CANDIDATES_PER_PASS.
    """

    def __init__(self, table: TrainingTable, rows):
        self.table = table
        self.by_attr: dict[str, list] = {}
        for r in rows:
            self.by_attr.setdefault(r["attr"], []).append(r)
        self.keys: dict[str, list] = {}
        for a, cands in self.by_attr.items():
            if a in table.numeric:
                self.keys[a] = sorted({r["cut"] for r in cands})
            else:
                self.keys[a] = sorted({r["value"] for r in cands})

    def assign(self, df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
        """Slot column per attribute: null for missing values."""
        numeric = [a for a in self.by_attr if a in self.table.numeric]
        slots = {}
        if self.table.approximate:  # values are numbers of cells: their slots are looked up
            for a in numeric:
                at = np.searchsorted(self.keys[a], np.arange(len(self.table.cuts[a]) + 2), "right")
                slots[a] = F.get(F.lit(at.tolist()), quoted(a))
            numeric = []
        names = {f"__slot_{i}": a for i, a in enumerate(numeric)}
        df = bucketize(df, {s: self.keys[a] for s, a in names.items()}, names)
        slots.update({a: F.col(f"`{s}`") for s, a in names.items()})
        for a in self.by_attr:
            if a not in slots:
                slots[a] = self._named(a)
        return df, slots

    def _named(self, attr: str) -> Column:
        at = F.create_map(*[x for i, v in enumerate(self.keys[attr]) for x in (F.lit(v), F.lit(i))])
        c = quoted(attr)
        return F.when(c.isNotNull(), F.coalesce(F.element_at(at, c), F.lit(len(self.keys[attr]))))

    def slot_count(self, attr: str) -> int:
        return len(self.keys[attr]) + 1

    def spans(self, attr: str):
        """(candidate row, first slot, end slot, inverted) with the covered slots as a half-open range."""
        where = {k: i for i, k in enumerate(self.keys[attr])}
        for r in self.by_attr[attr]:
            if r["op"] == "lt":
                yield r, 0, where[r["cut"]] + 1, False
            elif r["op"] == "ge":
                yield r, where[r["cut"]] + 1, self.slot_count(attr), False
            else:
                yield r, where[r["value"]], where[r["value"]] + 1, r["op"] == "ne"


