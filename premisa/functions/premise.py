"""Conditions as Column expressions (no UDF, so they reach scans and generated code)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premisa.plans.rules import Condition


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def nominal(name: str, schema: T.StructType | None = None) -> Column:
    """A nominal column as text; booleans read ``True`` / ``False``."""
    c = quoted(name)
    if schema is not None and isinstance(schema[name].dataType, T.BooleanType):
        return F.initcap(c.cast("string"))
    return c


def condition(cond: Condition, schema: T.StructType | None = None) -> Column:
    """Null (never true) for a missing value, also for NaN."""
    if cond.op == "any":
        return F.lit(True)
    if cond.op == "eq":
        return nominal(cond.attr, schema) == F.lit(cond.value)
    if cond.op == "ne":
        return nominal(cond.attr, schema) != F.lit(cond.value)
    c, parts = quoted(cond.attr), []
    if cond.lo is not None:
        parts.append(c >= F.lit(cond.lo) if cond.lo_closed else c > F.lit(cond.lo))
    if cond.hi is not None:
        parts.append(c <= F.lit(cond.hi) if cond.hi_closed else c < F.lit(cond.hi))
    elif schema is not None and isinstance(schema[cond.attr].dataType, (T.DoubleType, T.FloatType)):
        # NaN sorts above every number, so an interval without upper end would admit it.
        parts.append(~F.isnan(c))
    if cond.lo is None and cond.hi is None:
        parts.append(c.isNotNull())
    return reduce(lambda a, b: a & b, parts)


def premise(conditions: Sequence[Condition], schema: T.StructType | None = None) -> Column:
    """Conjunction; an empty premise covers everything.  May be null, use in where/when."""
    if not conditions:
        return F.lit(True)
    return reduce(lambda a, b: a & b, [condition(c, schema) for c in conditions])


def holds(conditions: Sequence[Condition], schema: T.StructType | None = None) -> Column:
    """Like `premise`, but false instead of null."""
    return F.coalesce(premise(conditions, schema), F.lit(False))
