"""SQL text for expressions the search builds again and again (one parse instead of many small calls)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from premisa.plans.rules import Condition


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float) -> str:
    return f"{float(value)!r}D"


def condition(cond: Condition) -> str:
    """A condition on a cleaned table: features are doubles without NaN, or strings."""
    if cond.op == "any":
        return "true"
    if cond.op in ("eq", "ne"):
        return f"{name(cond.attr)} {'=' if cond.op == 'eq' else '!='} {text(cond.value)}"
    parts = []
    if cond.lo is not None:
        parts.append(f"{name(cond.attr)} {'>=' if cond.lo_closed else '>'} {number(cond.lo)}")
    if cond.hi is not None:
        parts.append(f"{name(cond.attr)} {'<=' if cond.hi_closed else '<'} {number(cond.hi)}")
    return " and ".join(parts) if parts else f"{name(cond.attr)} is not null"


def holds(conditions: Sequence[Condition]) -> str:
    """Conjunction as a boolean that is never null."""
    if not conditions:
        return "true"
    return "coalesce(" + " and ".join(f"({condition(c)})" for c in conditions) + ", false)"


def lookup(values: Mapping[str, float], key: str) -> str:
    """A small driver-side table as an expression."""
    pairs = ", ".join(f"{text(k)}, {number(v)}" for k, v in values.items())
    return f"element_at(map({pairs}), {key})"
