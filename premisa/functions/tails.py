"""Tail probabilities that Spark has no built-in for; only ever applied to rule-sized tables."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fisher_udf():
    """Nested, so that workers get the code itself and need no installed package."""
    block = 65536

    def _log_choose(a: float, b: float) -> float:
        return math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)

    def _log_hypergeometric_tail(p: float, n: float, p_all: float, n_all: float) -> float:
        """ln P(X >= p) when p + n of p_all + n_all examples are drawn, p_all of them positive.

        Terms follow by their ratios from the first one; the sum stops once they no longer count.
        """
        c = p + n
        if p <= max(0.0, c - n_all):
            return 0.0
        last, total = min(c, p_all), p_all + n_all
        term = _log_choose(p_all, p) + _log_choose(n_all, n) - _log_choose(total, c)
        parts, k = [term], p
        while k < last:
            steps = np.arange(k, min(last, k + block), dtype="float64")
            ratio = (p_all - steps) * (c - steps) / ((steps + 1) * (n_all - c + steps + 1))
            with np.errstate(divide="ignore"):
                logs = term + np.cumsum(np.log(ratio))
            parts.append(float(np.logaddexp.reduce(logs)))
            term, k = float(logs[-1]), float(steps[-1] + 1)
            if ratio[-1] < 1 and term < max(parts) - 60:
                break
        return min(0.0, float(np.logaddexp.reduce(parts)))

    def tails(p: pd.Series, n: pd.Series, p_all: pd.Series, n_all: pd.Series) -> pd.Series:
        rows = zip(p.round(), n.round(), p_all.round(), n_all.round())
        return pd.Series([_log_hypergeometric_tail(*r) / math.log(10.0) for r in rows], dtype="float64")

    return F.pandas_udf(tails, T.DoubleType())


def fisher_log10(p: Column, n: Column, p_all: Column, n_all: Column) -> Column:
    """log10 of the one-sided Fisher exact p-value."""
    return _fisher_udf()(*[c.cast("double") for c in (p, n, p_all, n_all)])


def _chi2_lower_udf():
    def _lower_gamma(a: float, x: float) -> float:
        """Regularised lower incomplete gamma function."""
        if x <= 0:
            return 0.0
        if a > 1e5:  # the cube-root normal approximation is exact to many digits here
            z = ((x / a) ** (1 / 3) - (1 - 1 / (9 * a))) * 3 * math.sqrt(a)
            return 0.5 * math.erfc(-z / math.sqrt(2))
        front = math.exp(a * math.log(x) - x - math.lgamma(a))
        if x < a + 1:
            term = total = 1 / a
            k = a
            while term > total * 1e-16:
                k += 1
                term *= x / k
                total += term
            return min(1.0, front * total)
        b, c, d = x + 1 - a, 1e300, 1 / (x + 1 - a)
        h = d
        for i in range(1, 100_000):
            an = -i * (i - a)
            b += 2
            d = an * d + b
            d = 1 / (d if abs(d) > 1e-300 else 1e-300)
            c = b + an / c
            c = c if abs(c) > 1e-300 else 1e-300
            h *= d * c
            if abs(d * c - 1) < 1e-15:
                break
        return max(0.0, 1 - front * h)

    def tails(x: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series(
            [None if pd.isna(a) or pd.isna(k) or k <= 0 else _lower_gamma(k / 2, a / 2) for a, k in zip(x, df)],
            dtype="float64",
        )

    return F.pandas_udf(tails, T.DoubleType())


def chi2_lower(x: Column, df: Column) -> Column:
    """P(chi-squared with df degrees of freedom <= x)."""
    return _chi2_lower_udf()(x.cast("double"), df.cast("double"))


def chi2_upper_1df(x: Column) -> Column:
    """P(chi-squared with one degree of freedom >= x)."""

    def tails(v: pd.Series) -> pd.Series:
        return v.map(lambda t: None if pd.isna(t) else math.erfc(math.sqrt(max(t, 0.0) / 2))).astype("float64")

    return F.pandas_udf(tails, T.DoubleType())(x.cast("double"))
