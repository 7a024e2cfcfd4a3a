"""Rules, conditions and rule sets, as small driver objects and as tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

INDUCED, FIXED, PREFERRED = "induced", "expert_fixed", "expert_preferred"

RULES_SCHEMA = T.StructType(
    [
        T.StructField("rule_id", T.IntegerType(), False),
        T.StructField("target", T.StringType()),
        T.StructField("problem", T.StringType()),
        T.StructField("consequent_label", T.StringType()),
        T.StructField("consequent_value", T.DoubleType()),
        T.StructField("consequent_std", T.DoubleType()),
        T.StructField("p", T.DoubleType()),
        T.StructField("n", T.DoubleType()),
        T.StructField("p_all", T.DoubleType()),
        T.StructField("n_all", T.DoubleType()),
        T.StructField("weight", T.DoubleType()),
        T.StructField("pvalue", T.DoubleType()),
        T.StructField("origin", T.StringType()),
    ]
)

CONDITIONS_SCHEMA = T.StructType(
    [
        T.StructField("rule_id", T.IntegerType(), False),
        T.StructField("pos", T.IntegerType(), False),
        T.StructField("attr", T.StringType(), False),
        T.StructField("op", T.StringType(), False),
        T.StructField("num_lo", T.DoubleType()),
        T.StructField("lo_closed", T.BooleanType()),
        T.StructField("num_hi", T.DoubleType()),
        T.StructField("hi_closed", T.BooleanType()),
        T.StructField("nom_value", T.StringType()),
        T.StructField("origin", T.StringType()),
    ]
)


def number_text(x: float) -> str:
    """Integers bare, everything else with two decimals."""
    return str(int(x)) if float(x).is_integer() else f"{x:.2f}"


@dataclass(frozen=True)
class Condition:
    """One elementary condition on one column."""

    attr: str
    op: str  # interval | eq | ne | any
    lo: float | None = None
    lo_closed: bool = True
    hi: float | None = None
    hi_closed: bool = False
    value: str | None = None
    origin: str = INDUCED
    refine: bool = False  # written with '@=': to be refined against data

    @property
    def key(self):
        return (self.attr, self.op, self.lo, self.lo_closed, self.hi, self.hi_closed, self.value)

    def merged(self, other: Condition) -> Condition:
        """Intersection of two intervals on the same attribute."""
        lo, lo_closed = self.lo, self.lo_closed
        if other.lo is not None and (lo is None or (other.lo, not other.lo_closed) > (lo, not lo_closed)):
            lo, lo_closed = other.lo, other.lo_closed
        hi, hi_closed = self.hi, self.hi_closed
        if other.hi is not None and (hi is None or (other.hi, other.hi_closed) < (hi, hi_closed)):
            hi, hi_closed = other.hi, other.hi_closed
        return replace(self, lo=lo, lo_closed=lo_closed, hi=hi, hi_closed=hi_closed)

    def text(self) -> str:
        if self.op == "any":
            body = f"{self.attr} = Any"
        elif self.op in ("eq", "ne"):
            body = f"{self.attr} = {'!' if self.op == 'ne' else ''}{{{self.value}}}"
        else:
            lo = "(-inf" if self.lo is None else f"{'<' if self.lo_closed else '('}{number_text(self.lo)}"
            hi = "inf)" if self.hi is None else f"{number_text(self.hi)}{'>' if self.hi_closed else ')'}"
            body = f"{self.attr} = {lo}, {hi}"
        if self.origin == FIXED:
            return f"[[{body}]]"
        return f"[{body}]" if self.origin == PREFERRED else body


def less(attr, b, **kw) -> Condition:
    return Condition(attr, "interval", hi=float(b), **kw)


def at_least(attr, a, **kw) -> Condition:
    return Condition(attr, "interval", lo=float(a), **kw)


def interval(attr, a, b, lo_closed=True, hi_closed=False, **kw) -> Condition:
    return Condition(
        attr,
        "interval",
        lo=None if a is None else float(a),
        lo_closed=lo_closed,
        hi=None if b is None else float(b),
        hi_closed=hi_closed,
        **kw,
    )


def equals(attr, v, **kw) -> Condition:
    return Condition(attr, "eq", value=str(v), **kw)


def not_equals(attr, v, **kw) -> Condition:
    return Condition(attr, "ne", value=str(v), **kw)


def any_value(attr, **kw) -> Condition:
    return Condition(attr, "any", **kw)


def add_condition(premise: Sequence[Condition], new: Condition) -> tuple[Condition, ...]:
    """Append a condition; a second induced interval on an attribute narrows the first one."""
    out = list(premise)
    if new.op == "interval":
        for i, c in enumerate(out):
            if c.attr == new.attr and c.op == "interval" and c.origin == new.origin:
                out[i] = c.merged(new)
                return tuple(out)
    out.append(new)
    return tuple(out)


@dataclass(frozen=True)
class Rule:
    """IF conditions THEN conclusion, with the counts found on the training table."""

    conditions: tuple[Condition, ...]
    target: str = ""
    problem: str = "classification"
    label: str | None = None
    value: float | None = None
    std: float | None = None
    p: float | None = None
    n: float | None = None
    p_all: float | None = None
    n_all: float | None = None
    weight: float | None = None
    pvalue: float | None = None
    origin: str = INDUCED

    def text(self) -> str:
        premise = " AND ".join(c.text() for c in self.conditions)
        if self.problem == "survival":
            return f"IF {premise} THEN "
        if self.problem == "regression":
            if self.value is None:
                return f"IF {premise} THEN "
            spread = self.std or 0.0
            return (
                f"IF {premise} THEN {self.target} = {{{self.value:.2f}}} "
                f"[{self.value - spread:.2f},{self.value + spread:.2f}]"
            )
        return f"IF {premise} THEN {self.target} = {{{self.label}}}"

    __str__ = text

    @property
    def precision(self) -> float:
        return self.p / (self.p + self.n)

    @property
    def coverage(self) -> float:
        return (self.p + self.n) / (self.p_all + self.n_all)


@dataclass
class RuleSet:
    """An ordered list of rules; what a fitted model consists of."""

    rules: list[Rule]
    problem: str = "classification"
    target: str = ""
    params: dict = field(default_factory=dict)
    classes: list[str] = field(default_factory=list)
    numeric_label: bool = False
    default_label: str | None = None
    default_value: float | None = None
    priors: dict[str, float] = field(default_factory=dict)
    time_total_s: float = 0.0
    time_growing_s: float = 0.0
    time_pruning_s: float = 0.0
    voting: bool = True

    def __len__(self):
        return len(self.rules)

    def __iter__(self):
        return iter(self.rules)

    def texts(self) -> list[str]:
        return [r.text() for r in self.rules]

    def attributes(self) -> list[str]:
        return list(dict.fromkeys(c.attr for r in self.rules for c in r.conditions))

    def condition_rows(self) -> list[tuple]:
        return [
            (i, pos, c.attr, c.op, c.lo, c.lo_closed, c.hi, c.hi_closed, c.value, c.origin)
            for i, r in enumerate(self.rules, 1)
            for pos, c in enumerate(r.conditions)
        ]

    def rule_rows(self) -> list[tuple]:
        return [
            (i, r.target or self.target, r.problem, r.label, r.value, r.std, r.p, r.n, r.p_all, r.n_all,
             r.weight, r.pvalue, r.origin)
            for i, r in enumerate(self.rules, 1)
        ]

    def rules_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rule_rows(), RULES_SCHEMA)

    def conditions_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.condition_rows(), CONDITIONS_SCHEMA)


# --- rule text ---------------------------------------------------------------------------------

_RULE = re.compile(r"^\s*(?:(?P<times>inf|\d+)\s*:)?\s*IF\s*(?P<premise>.*?)\s*THEN\s*(?P<then>.*)$", re.S | re.I)
_CONDITION = re.compile(r"^(?P<attr>.+?)\s*(?P<op>@=|<=|>=|=|<|>)\s*(?P<body>.+)$", re.S)
_INTERVAL = re.compile(r"^(?P<l>[<(\[])\s*(?P<lo>[^,]+?)\s*,\s*(?P<hi>[^,]+?)\s*(?P<r>[>)\]])$")


def parse_condition(text: str, origin: str | None = None) -> Condition:
    """One condition as users write it: ``a = <1, 5)``, ``a = {v}``, ``[[a = Any]]``, ``a < 3``."""
    s = text.strip()
    found = INDUCED
    if s.startswith("[[") and s.endswith("]]"):
        s, found = s[2:-2].strip(), FIXED
    elif s.startswith("[") and s.endswith("]"):
        s, found = s[1:-1].strip(), PREFERRED
    m = _CONDITION.match(s)
    if not m:
        raise ValueError(f"not a condition: {text!r}")
    attr, op, body = m["attr"].strip(), m["op"], m["body"].strip()
    kw = {"origin": origin or found, "refine": op == "@="}
    if op in ("<", "<="):
        return interval(attr, None, float(body), hi_closed=op == "<=", **kw)
    if op in (">", ">="):
        return interval(attr, float(body), None, lo_closed=op == ">=", **kw)
    if body.lower() == "any":
        return any_value(attr, **kw)
    m = _INTERVAL.match(body)
    if m:
        lo, hi = (None if "inf" in m[g].lower() else float(m[g]) for g in ("lo", "hi"))
        return interval(attr, lo, hi, lo_closed=m["l"] in "<[", hi_closed=m["r"] in ">]", **kw)
    m = re.match(r"^(!?)\s*\{(.*)\}$", body, re.S)
    if not m:
        raise ValueError(f"not a condition: {text!r}")
    return (not_equals if m[1] else equals)(attr, m[2].strip(), **kw)


def parse_rule(text: str, origin: str | None = None) -> tuple[Rule, float]:
    """A rule and its multiplicity (``3: IF ...``; 1 when not written, ``inf`` allowed)."""
    m = _RULE.match(text)
    if not m:
        raise ValueError(f"not a rule: {text!r}")
    parts = [s for s in re.split(r"\s+AND\s+", m["premise"], flags=re.I) if s.strip()]
    conditions = tuple(parse_condition(s, origin) for s in parts)
    times = float(m["times"]) if m["times"] else 1.0
    then = re.match(r"^(?P<attr>.+?)\s*=\s*\{(?P<value>.*?)\}", m["then"].strip(), re.S)
    label = then["value"].strip() if then else None
    if label is not None and label.lower() == "nan":
        label = None
    return Rule(conditions, target=then["attr"].strip() if then else "", label=label), times


def parse_rules(items: Iterable[str | tuple[str, str]], origin: str | None = None) -> list[tuple[Rule, float]]:
    """User lists hold plain rule texts or (name, text) pairs."""
    return [parse_rule(i if isinstance(i, str) else i[1], origin) for i in items or []]
