"""The training table every search step scans: features and roles only, persisted once per fit."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premisa.functions import sqltext as q
from premisa.functions.premise import quoted
from premisa.operators.candidates import (
    COARSE,
    MAX_BUCKETS,
    VALUES_PER_BUCKET,
    bucketize,
    column_facts,
    feature_kinds,
    fitting_bounds,
)
from premisa.plans.rules import Condition
from premisa.session import written

# Up to this many rows the table is spread over all cores.
SMALL_ROWS = 10_000_000
# Equal coded rows are merged when that leaves at most this share of the rows.
MERGE_SHARE = 0.25
# Aggregated cells (attribute, value) up to which one task finishes the candidate search.
FEW_CELLS = 20_000


class TrainingTable:
    """Cleaned features plus ``extra`` columns.

    With ``bins`` every numeric feature is replaced by the index of its quantile cell, and conditions are
    translated to indices, so a search step reads small integers.  Thresholds users wrote are added
    to the cuts, hence their conditions stay exact.  Equal rows then become one with their summed weight,
    the column ``merge``, if that leaves few; ``df`` is read for it again and should be stored.
    """

    def __init__(
        self,
        df: DataFrame,
        features: Sequence[str],
        bins: int | None,
        extra: Mapping[str, Column],
        thresholds: Iterable[Condition] = (),
        merge: str | None = None,
    ):
        self.features = list(features)
        self.numeric, self.nominal = feature_kinds(df, self.features)
        self.approximate = bins is not None
        self.cuts: dict[str, list[float]] = {}
        self.bounds: dict[str, list[float]] = {}
        self.nominal_buckets = 1
        plain = df.select(*[quoted(a) for a in self.features], *[e.alias(n) for n, e in extra.items()])
        if self.approximate:
            self.rows, self.distinct, cuts = column_facts(plain, self.features, {a: bins for a in self.numeric})
            for cond in thresholds:
                if cond.op == "interval" and cond.attr in cuts:
                    cuts[cond.attr] = sorted({*cuts[cond.attr], *_half_open(cond)})
            self.cuts = cuts
            codes = {a: f"__code_{i}" for i, a in enumerate(self.numeric)}
            plain = bucketize(plain, {c: cuts[a] for a, c in codes.items()}, {c: a for a, c in codes.items()})
            plain = plain.select(*[F.col(codes[a]).alias(a) if a in codes else quoted(a) for a in self.features], *extra)
            if merge:
                keys = [quoted(c) for c in plain.columns if c != merge]
                kinds = plain.agg(F.approx_count_distinct(F.xxhash64(*keys))).first()[0]
                if kinds <= MERGE_SHARE * self.rows:
                    plain = plain.groupBy(*keys).agg(F.sum(merge).alias(merge))
        else:
            # Coarse quantiles ride along; only columns with very many distinct values need finer ones.
            self.rows, self.distinct, coarse = column_facts(plain, self.features, dict.fromkeys(self.numeric, COARSE))
            self.bounds = fitting_bounds(plain, {a: self.distinct[a] for a in self.numeric}, coarse)
        largest = max([self.distinct[a] for a in self.nominal], default=0)
        self.nominal_buckets = min(MAX_BUCKETS, 1 + largest // VALUES_PER_BUCKET)
        if self.rows <= SMALL_ROWS:
            # Small inputs come in fewer splits than there are cores.
            plain = plain.repartition(df.sparkSession.sparkContext.defaultParallelism)
        self.df = plain.persist(StorageLevel.MEMORY_AND_DISK)

    def _cells(self) -> list[int]:
        cells = [len(self.cuts[a]) + 1 if self.approximate else self.distinct[a] for a in self.numeric]
        return [*cells, *[self.distinct[a] for a in self.nominal]]

    @property
    def cells(self) -> int:
        """Estimated distinct (attribute, value) pairs."""
        return sum(self._cells())

    @property
    def candidates_per_attribute(self) -> int:
        """Estimated candidates per attribute in one growth step."""
        return 2 * max(self._cells(), default=0)

    @property
    def two_level(self) -> bool:
        return any(self.bounds.values()) or self.nominal_buckets > 1

    def merge(self, keys: list[str], weight: str) -> None:
        """Merge equal rows into one with their summed weight."""
        self.replace(self.df.groupBy(*[quoted(k) for k in keys]).agg(F.sum(weight).alias(weight)))

    def replace(self, df: DataFrame) -> None:
        """Hold a table made from the present one in its place."""
        before = self.df
        self.df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self.df.count()  # filled before its source is released
        before.unpersist()

    def coded(self, cond: Condition) -> Condition:
        """The condition on the stored columns."""
        if not self.approximate or cond.op != "interval":
            return cond
        cuts = self.cuts[cond.attr]
        lo = None if cond.lo is None else cuts.index(_lower(cond)) + 1
        hi = None if cond.hi is None else cuts.index(_upper(cond)) + 1
        return replace(cond, lo=lo, lo_closed=True, hi=hi, hi_closed=False)

    def holds_sql(self, conditions: Sequence[Condition]) -> str:
        return q.holds([self.coded(c) for c in conditions if c.op != "any"])

    def holds(self, conditions: Sequence[Condition]) -> Column:
        return F.expr(self.holds_sql(conditions))

    def real_cut(self, attr: str, cut: float | None) -> float | None:
        """Cut value of a candidate whose ``cut`` is a cell index."""
        if cut is None or not self.approximate:
            return cut
        return self.cuts[attr][int(cut) - 1]

    def gather(self, cells: DataFrame) -> DataFrame:
        """Few aggregated cells go to one task, which then sorts them without further shuffles.

        Their number is bounded by attributes x cells, whatever the row count.
        """
        return cells.repartition(1) if self.cells <= FEW_CELLS else cells

    def replace_columns(self, columns: Mapping[str, Column]) -> None:
        """Write the table out with new columns, so the plan does not grow with the rule set."""
        fresh = written(self.df.withColumns(dict(columns)), "training")
        self.df.unpersist()
        self.df = fresh.persist(StorageLevel.MEMORY_AND_DISK)

    def close(self) -> None:
        self.df.unpersist()


def _lower(cond: Condition) -> float:
    return cond.lo if cond.lo_closed else math.nextafter(cond.lo, math.inf)


def _upper(cond: Condition) -> float:
    return math.nextafter(cond.hi, math.inf) if cond.hi_closed else cond.hi


def _half_open(cond: Condition) -> list[float]:
    out = []
    if cond.lo is not None:
        out.append(_lower(cond))
    if cond.hi is not None:
        out.append(_upper(cond))
    return out
