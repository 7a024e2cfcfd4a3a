"""Rule quality measures as Column functions of p, n, P, N.

p, n: covered positives and negatives; P, N: all positives and negatives.  A division by zero gives
null, and a null quality never wins a search.  Formulas follow the published surveys of rule
learning heuristics; constants the papers leave open are stated below.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parameters of the parametrised measures.
M_ESTIMATE_M = 2.0
F_BETA = 0.5
G_MEASURE_G = 2.0
KLOSGEN_OMEGA = 0.4323


def _div(a, b) -> Column:
    return a / F.nullif(b, F.lit(0.0))


def _xlog(x: Column, arg: Column) -> Column:
    """x * ln(arg), taken as 0 where x or the argument vanishes."""
    return F.when((x <= 0) | (arg <= 0), F.lit(0.0)).otherwise(x * F.log(arg))


def _xlog2(x: Column, arg: Column) -> Column:
    return F.when((x <= 0) | (arg <= 0), F.lit(0.0)).otherwise(x * F.log2(arg))


def _entropy(a: Column, b: Column) -> Column:
    """Binary entropy of the counts a, b; 0 for an empty group."""
    t = F.nullif(a + b, F.lit(0.0))
    return F.coalesce(-_xlog2(a / t, a / t) - _xlog2(b / t, b / t), F.lit(0.0))


def _conditional_entropy(p, n, P, N):
    c, T = p + n, P + N
    return (c / T) * _entropy(p, n) + ((T - c) / T) * _entropy(P - p, N - n)


def _precision(p, n):
    return _div(p, p + n)


def _kappa(p, n, P, N):
    c, T = p + n, P + N
    return _div(T * _div(p, c) - P, (T / 2) * _div(c + P, c) - P)


def _coleman(p, n, P, N):
    return _div(N * p - P * n, N * (p + n))


def _yails(p, n, P, N):
    w = F.lit(0.5) + F.lit(0.25) * _precision(p, n)
    return w * _precision(p, n) + (F.lit(1.0) - w) * _div(p, P)


# The names of the built-in measures.
MEASURES: dict[str, Callable[[Column, Column, Column, Column], Column]] = {
    "Accuracy": lambda p, n, P, N: p - n,
    "BinaryEntropy": lambda p, n, P, N: -_conditional_entropy(p, n, P, N),
    "C1": lambda p, n, P, N: _coleman(p, n, P, N) * (F.lit(2.0) + _kappa(p, n, P, N)) / 3,
    "C2": lambda p, n, P, N: _coleman(p, n, P, N) * (F.lit(1.0) + _div(p, P)) / 2,
    "CFoil": lambda p, n, P, N: _xlog2(p, _precision(p, n)) - _xlog2(p, _div(P, P + N)),
    "CN2Significnce": lambda p, n, P, N: 2
    * (_xlog(p, _div(p * (P + N), (p + n) * P)) + _xlog(n, _div(n * (P + N), (p + n) * N))),
    "Correlation": lambda p, n, P, N: _div(
        p * N - P * n, F.sqrt(P * N * (p + n) * (P + N - p - n))
    ),
    "Coverage": lambda p, n, P, N: _div(p, P),
    "FBayesianConfirmation": lambda p, n, P, N: _div(p * N - n * P, p * N + n * P),
    "FMeasure": lambda p, n, P, N: _div(
        F.lit(F_BETA**2 + 1) * _precision(p, n) * _div(p, P),
        F.lit(F_BETA**2) * _precision(p, n) + _div(p, P),
    ),
    "FullCoverage": lambda p, n, P, N: _div(p + n, P + N),
    "GeoRSS": lambda p, n, P, N: F.sqrt(_div(p, P) * (F.lit(1.0) - _div(n, N))),
    "GMeasure": lambda p, n, P, N: p / (p + n + F.lit(G_MEASURE_G)),
    "InformationGain": lambda p, n, P, N: _entropy(P, N) - _conditional_entropy(p, n, P, N),
    "JMeasure": lambda p, n, P, N: _div(
        _xlog(p, _div(p * (P + N), (p + n) * P)) + _xlog(n, _div(n * (P + N), (p + n) * N)), P + N
    ),
    "Kappa": _kappa,
    "Klosgen": lambda p, n, P, N: F.pow(_div(p + n, P + N), F.lit(KLOSGEN_OMEGA))
    * (_precision(p, n) - _div(P, P + N)),
    "Laplace": lambda p, n, P, N: (p + 1) / (p + n + 2),
    "Lift": lambda p, n, P, N: _div(_precision(p, n), _div(P, P + N)),
    "LogicalSufficiency": lambda p, n, P, N: _div(p * N, n * P),
    "MEstimate": lambda p, n, P, N: (p + F.lit(M_ESTIMATE_M) * _div(P, P + N))
    / (p + n + F.lit(M_ESTIMATE_M)),
    "MutualSupport": lambda p, n, P, N: _div(p, n + P),
    "Novelty": lambda p, n, P, N: _div(p, P + N) - _div(P * (p + n), (P + N) * (P + N)),
    "OddsRatio": lambda p, n, P, N: _div(p * (N - n), n * (P - p)),
    "OneWaySupport": lambda p, n, P, N: _xlog2(
        _precision(p, n), _div(_precision(p, n), _div(P, P + N))
    ),
    "PawlakDependencyFactor": lambda p, n, P, N: _div(
        p * (P + N) - P * (p + n), p * (P + N) + P * (p + n)
    ),
    "Precision": lambda p, n, P, N: _precision(p, n),
    "Q2": lambda p, n, P, N: (_div(p, P) - _div(n, N)) * (F.lit(1.0) - _div(n, N)),
    "RelativeRisk": lambda p, n, P, N: _precision(p, n) * _div(P + N - p - n, P - p),
    "Ripper": lambda p, n, P, N: _div(p - n, p + n),
    "RSS": lambda p, n, P, N: _div(p, P) - _div(n, N),
    "RuleInterest": lambda p, n, P, N: _div(p * (P + N) - (p + n) * P, P + N),
    "SBayesian": lambda p, n, P, N: _precision(p, n) - _div(P - p, P + N - p - n),
    "Sensitivity": lambda p, n, P, N: _div(p, P),
    "Specificity": lambda p, n, P, N: _div(N - n, N),
    "TwoWaySupport": lambda p, n, P, N: _div(p, P + N)
    * _xlog2(F.lit(1.0), _div(_precision(p, n), _div(P, P + N))),
    "WeightedLaplace": lambda p, n, P, N: _div((p + 1) * (P + N), (p + n + 2) * P),
    "WeightedRelativeAccuracy": lambda p, n, P, N: _div(p + n, P + N)
    * (_precision(p, n) - _div(P, P + N)),
    "YAILS": _yails,
}

# The fortieth name; its value is a statistic over times, see operators.survival.log_rank.
LOG_RANK = "LogRank"


def check_measure(measure) -> None:
    """A built-in name that works on counts, or a function; anything else is an error."""
    if callable(measure) or measure in MEASURES:
        return
    if measure == LOG_RANK:
        raise ValueError("LogRank is what survival models use by themselves; it has no value for p, n, P, N")
    raise ValueError(f"unknown measure {measure!r}")


def quality(measure, p: Column, n: Column, P: Column, N: Column) -> Column:
    """Quality as a double column, for a built-in name or a user's function."""
    if callable(measure):
        return user_measure(measure)(p, n, P, N)
    check_measure(measure)
    p, n, P, N = (c.cast("double") for c in (p, n, P, N))
    return MEASURES[measure](p, n, P, N).cast("double")


class _Number:
    """A Column under arithmetic, in which a division by zero gives null. Anything else is a TypeError."""

    def __init__(self, column: Column):
        self.column = column

    @staticmethod
    def of(x) -> Column:
        if isinstance(x, _Number):
            return x.column
        if isinstance(x, (int, float)):
            return F.lit(float(x))
        raise TypeError(f"not a number: {x!r}")

    def __bool__(self):
        raise TypeError("a column has no truth value")

    def __add__(self, x): return _Number(self.column + _Number.of(x))  # noqa: E704
    def __radd__(self, x): return _Number(_Number.of(x) + self.column)  # noqa: E704
    def __sub__(self, x): return _Number(self.column - _Number.of(x))  # noqa: E704
    def __rsub__(self, x): return _Number(_Number.of(x) - self.column)  # noqa: E704
    def __mul__(self, x): return _Number(self.column * _Number.of(x))  # noqa: E704
    def __rmul__(self, x): return _Number(_Number.of(x) * self.column)  # noqa: E704
    def __truediv__(self, x): return _Number(F.try_divide(self.column, _Number.of(x)))  # noqa: E704
    def __rtruediv__(self, x): return _Number(F.try_divide(_Number.of(x), self.column))  # noqa: E704
    def __pow__(self, x): return _Number(F.pow(self.column, _Number.of(x)))  # noqa: E704
    def __neg__(self): return _Number(-self.column)  # noqa: E704
    def __abs__(self): return _Number(F.abs(self.column))  # noqa: E704


def user_measure(fn: Callable) -> Callable[[Column, Column, Column, Column], Column]:
    """Any ``f(p, n, P, N)`` as a measure; a division by zero gives null.

    Plain arithmetic is inlined into the plan, and so is a function of Columns.  One that needs numbers (say, it
    branches on them) runs as a pandas UDF over aggregated candidate rows.  Other errors of the function are raised.
    """

    def apply(p, n, P, N):
        args = [c.cast("double") for c in (p, n, P, N)]
        for given in ([_Number(a) for a in args], args):
            try:
                out = fn(*given)
            except (TypeError, ValueError):  # it asks for something else than these
                continue
            if isinstance(out, _Number):
                return out.column.cast("double")
            if isinstance(out, Column):
                return out.cast("double")
            if isinstance(out, (int, float)):
                return F.lit(float(out))

        def one(*t):
            try:
                return float(fn(*t))
            except ZeroDivisionError:
                return None

        def rowwise(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
            return pd.Series([one(*t) for t in zip(a, b, c, d)], index=a.index, dtype="float64")

        return F.pandas_udf(rowwise, T.DoubleType())(*args)

    return apply


def python_quality(measure, spark, rows: list[tuple[float, float, float, float]]) -> list[float | None]:
    """Qualities of a few count tuples held by the driver, through the same Column formulas."""
    if not rows:
        return []
    table = spark.createDataFrame(
        [(i, *map(float, r)) for i, r in enumerate(rows)], "i long, p double, n double, p_all double, n_all double"
    )
    scored = table.select("i", quality(measure, *(F.col(c) for c in ("p", "n", "p_all", "n_all"))).alias("q"))
    out = {r["i"]: r["q"] for r in scored.collect()}
    return [out[i] for i in range(len(rows))]
