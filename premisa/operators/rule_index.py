"""A bitmap index over many rules: which rules cover a row, at a cost that does not grow with the premises' expressions.

The conditions on one attribute cut its values into cells: the cut points and the gaps between them, each value that a
condition names, one cell for all other values, one for missing values. A cell holds a bit set of the rules whose conditions
on the attribute it meets (a rule without one is met by every cell). The rules that cover a row are the intersection of the bit
sets of its cells. The index is a table per attribute, one row for a cell, made from the rules in vectorised blocks; rows find
their numeric cells by a binary search and meet the tables in joins: one scan, and a plan of one join for each attribute used.

A cell takes rules / 8 bytes. Tables of up to BROADCAST_BYTES are broadcast, larger ones are joined as Spark sees fit.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premisa.functions.premise import nominal, quoted
from premisa.operators.candidates import bucketize
from premisa.operators.matching import _rules
from premisa.plans.rules import Condition, Rule, RuleSet

BROADCAST_BYTES = 64 << 20
#: Cells whose bit sets are made at once.
CELLS_AT_ONCE = 2048


def _packed(holds: np.ndarray) -> list[list[int]]:
    """Rows of booleans (a column for each rule) to lists of 64-bit words, the first rule in the lowest bit."""
    width = -(-holds.shape[1] // 64) * 64
    wide = np.zeros((len(holds), width), dtype=bool)
    wide[:, : holds.shape[1]] = holds
    return np.packbits(wide, axis=1, bitorder="little").view("<i8").tolist()


def _conditions(rules: Sequence[Rule]) -> dict[str, list[tuple[int, Condition]]]:
    out: dict[str, list[tuple[int, Condition]]] = {}
    for i, rule in enumerate(rules):
        for c in rule.conditions:
            if c.op != "any":
                out.setdefault(c.attr, []).append((i, c))
    return out


def _numeric_cells(conditions: list[tuple[int, Condition]], rules: int) -> tuple[list[float], list[tuple[int, list[int]]]]:
    """Cuts, and (cell, bits): cell j lies between cut j - 1 and cut j, -1 is the missing value (and NaN).

    Each end of an interval is a cut, and so is the next double: an end is a cell of its own, the gap behind it another, and all
    cells are half-open, as Bucketizer wants them.
    """
    finite = lambda e: e is not None and math.isfinite(e)
    ends = sorted({float(e) + 0.0 for _, c in conditions for e in (c.lo, c.hi) if finite(e)})
    place = {e: 2 * j + 1 for j, e in enumerate(ends)}
    cuts = sorted({x for e in ends for x in (e, math.nextafter(e, math.inf))})
    # the place of each cell: odd for an end, even for a gap (which is empty between neighbouring doubles)
    places, at = [0], 0
    for x in cuts:
        at = place.get(x, at + 1)
        places.append(at)
    # a condition is met from one place to another
    top = 2 * len(ends)
    first = np.array([place[float(c.lo)] + (not c.lo_closed) if finite(c.lo) else 0 for _, c in conditions])
    last = np.array([place[float(c.hi)] - (not c.hi_closed) if finite(c.hi) else top for _, c in conditions])
    of = np.array([i for i, _ in conditions])
    free = np.ones(rules, dtype=bool)
    free[of] = False
    cells = [(-1, _packed(free[None, :])[0])]
    for a in range(0, len(places), CELLS_AT_ONCE):
        here = np.array(places[a : a + CELLS_AT_ONCE])
        met = np.ones((len(here), rules), dtype=bool)
        for k in range(len(of)):  # several conditions of a rule on one attribute: all of them
            met[:, of[k]] &= (here >= first[k]) & (here <= last[k])
        cells += list(zip(range(a, a + len(here)), _packed(met), strict=True))
    return cuts, cells


def _nominal_cells(conditions: list[tuple[int, Condition]], rules: int) -> list[tuple[str | None, bool, list[int]]]:
    """(value, whether it stands for all other values, bits); a null value that stands for no others is the missing one."""
    named = sorted({c.value for _, c in conditions})
    met = {v: np.ones(rules, dtype=bool) for v in named}
    other, free = np.ones(rules, dtype=bool), np.ones(rules, dtype=bool)
    for i, c in conditions:
        free[i] = False
        for v in named:
            met[v][i] &= (v == c.value) == (c.op == "eq")
        other[i] &= c.op == "ne"
    return [*((v, False, _packed(met[v][None, :])[0]) for v in named), (None, True, _packed(other[None, :])[0]), (None, False, _packed(free[None, :])[0])]


def covering_bits(df: DataFrame, ruleset: RuleSet | Sequence[Rule], output: str = "rules") -> DataFrame:
    """``df`` with the bit set of the covering rules, an array of longs; rule 1 is the lowest bit of the first."""
    rules = _rules(ruleset)
    words = -(-len(rules) // 64)
    spark, sets = df.sparkSession, []
    every = [-1] * (len(rules) // 64) + ([(1 << len(rules) % 64) - 1] if len(rules) % 64 else [])
    rows = df
    for k, (attr, conditions) in enumerate(sorted(_conditions(rules).items())):
        numeric = all(c.op == "interval" for _, c in conditions)
        if not numeric and any(c.op == "interval" for _, c in conditions):
            raise ValueError(f"conditions of both kinds on {attr}")
        bits = f"__bits_{k}"
        if numeric:
            cuts, cells = _numeric_cells(conditions, len(rules))
            value = quoted(attr).cast("double")
            # a negative zero is a zero
            rows = rows.withColumn(f"__value_{k}", F.when(value == 0, F.lit(0.0)).when(~F.isnan(value), value))
            rows = bucketize(rows, {f"__cell_of_{k}": cuts}, {f"__cell_of_{k}": f"__value_{k}"})
            rows = rows.withColumn(f"__cell_of_{k}", F.coalesce(F.col(f"__cell_of_{k}"), F.lit(-1))).drop(f"__value_{k}")
            index = spark.createDataFrame(cells, f"__id_{k} int, {bits} array<long>")
            same = F.col(f"__cell_of_{k}") == F.col(f"__id_{k}")
        else:
            cells = _nominal_cells(conditions, len(rules))
            named = [v for v, _, _ in cells if v is not None]
            value = nominal(attr, df.schema).cast("string")
            cell = F.when(value.isNull(), F.lit("null")).when(value.isin(named), F.concat(F.lit("="), value)).otherwise(F.lit("other"))
            rows = rows.withColumn(f"__cell_of_{k}", cell)
            table = [("other" if rest else "null" if v is None else f"={v}", b) for v, rest, b in cells]
            index = spark.createDataFrame(table, f"__id_{k} string, {bits} array<long>")
            same = F.col(f"__cell_of_{k}") == F.col(f"__id_{k}")
        if len(cells) * (8 * words + 32) <= BROADCAST_BYTES:
            index = F.broadcast(index)
        rows = rows.join(index, same).drop(f"__cell_of_{k}", f"__id_{k}")
        sets.append(bits)
    both = F.array(*[F.lit(w).cast("long") for w in every]) if not sets else F.col(sets[0])
    for bits in sets[1:]:
        both = F.zip_with(both, F.col(bits), lambda a, b: a.bitwiseAND(b))
    return rows.withColumn(output, both).drop(*sets)


def bit_ids(bits: Column) -> Column:
    """The sorted ids (from 1) of the bits that are set."""
    held = F.filter(F.transform(bits, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"] != 0)
    places = lambda x: F.transform(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(x["w"], b) == 1), lambda b: x["i"] * 64 + b + 1)
    return F.flatten(F.transform(held, places))


def indexed_match(df: DataFrame, ruleset: RuleSet | Sequence[Rule], key: Sequence[str]) -> DataFrame:
    """(key, rule_id) for every rule that covers an example, as ``rule_match``, for any number of rules."""
    used = {c.attr for r in _rules(ruleset) for c in r.conditions}
    rows = df.select(*[quoted(c) for c in dict.fromkeys([*key, *[c for c in df.columns if c in used]])])
    found = covering_bits(rows, ruleset, "__rules")
    return found.select(*[quoted(k) for k in key], F.explode(bit_ids(F.col("__rules"))).alias("rule_id"))
