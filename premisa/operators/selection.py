"""Splits, cross validation and parameter search."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premisa.functions.premise import quoted
from premisa.ordering import positioned
from premisa.session import written

# Strata up to which their sizes (a value and two numbers each) are broadcast; beyond, AQE joins them.
BROADCAST_STRATA = 100_000


def _hash_order(key: Sequence[str], seed: int) -> Column:
    """A reproducible pseudo-random position in [0, 1) per row key."""
    return F.pmod(F.xxhash64(*[quoted(k) for k in key], F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def class_ranks(
    df: DataFrame, strata: Sequence[str], key: Sequence[str], seed: int = 0, order: Column | None = None
) -> DataFrame:
    """Add __rank (0-based within the stratum) and __size, by a hash of the key or by an order of the user's.

    One range shuffle by (stratum, order, key) places all rows; where a stratum begins and how many rows it has are one row
    per stratum. These are broadcast, so that no task gets all rows of a stratum. Ties of the order are told apart by the
    key, so a value that many rows share is spread as well.
    """
    by = order if order is not None else _hash_order(key, seed)
    rows = df.withColumn("__order", by)
    place = [*[quoted(c).asc_nulls_first() for c in strata], F.col("__order"), *[quoted(k) for k in key]]
    rows = positioned(rows, place, "__rank", "ranks").drop("__order")
    names = [f"__s_{i}" for i in range(len(strata))]
    sizes = rows.groupBy(*[quoted(c).alias(n) for c, n in zip(strata, names, strict=True)]).agg(
        F.min("__rank").alias("__offset"), F.count(F.lit(1)).alias("__size"))
    # Null-safe keys: rows without a stratum value are ranked among themselves, not lost.
    same = [quoted(c).eqNullSafe(F.col(n)) for c, n in zip(strata, names, strict=True)]
    if strata:
        sizes = written(sizes, "strata")
        if sizes.count() <= BROADCAST_STRATA:
            sizes = F.broadcast(sizes)
        rows = rows.join(sizes, reduce(lambda a, b: a & b, same))
    else:
        rows = rows.withColumns({"__offset": F.lit(0), "__size": F.lit(sizes.first()["__size"])})
    return rows.withColumn("__rank", F.col("__rank") - F.col("__offset")).drop("__offset", *names)


def train_test_split(
    df: DataFrame,
    test_fraction: float,
    key: Sequence[str],
    stratify: str | None = None,
    seed: int = 0,
    order: Column | None = None,
) -> DataFrame:
    """Add ``is_test``: the first fraction of every stratum in a reproducible order."""
    strata = [stratify] if stratify else []
    ranked = class_ranks(df, strata, key, seed, order)
    is_test = F.col("__rank") < F.floor(F.col("__size") * F.lit(float(test_fraction)))
    return ranked.withColumn("is_test", is_test.cast("int")).drop("__rank", "__size")


def stratified_kfold(
    df: DataFrame, folds: int, label: str, key: Sequence[str], seed: int = 0, order: Column | None = None
) -> DataFrame:
    """Add ``fold`` in 0..k-1: round robin within each class."""
    ranked = class_ranks(df, [label], key, seed, order)
    return ranked.withColumn("fold", F.pmod(F.col("__rank"), F.lit(folds)).cast("int")).drop("__rank", "__size")


def cross_validate(
    df: DataFrame, folds: int, fit_and_score: Callable[[DataFrame, DataFrame], DataFrame], fold: str = "fold"
) -> DataFrame:
    """Scores of every fold: ``fit_and_score(train, test)`` returns a one-row table of metrics."""
    parts = [
        fit_and_score(df.where(quoted(fold) != k).drop(fold), df.where(quoted(fold) == k).drop(fold)).withColumn(
            "fold", F.lit(k)
        )
        for k in range(folds)
    ]
    return reduce(DataFrame.unionByName, parts)


def mean_scores(scores: DataFrame) -> DataFrame:
    return scores.agg(*[F.avg(quoted(c)).alias(c) for c in scores.columns if c != "fold"])


def grid(options: Mapping[str, Iterable]) -> list[dict]:
    """All combinations of parameter values."""
    names = list(options)
    return [dict(zip(names, values)) for values in itertools.product(*options.values())]


def grid_search(
    spark, options: Mapping[str, Iterable], fit_and_score: Callable[[dict], float], parallel: int = 4
) -> DataFrame:
    """Score every combination; independent fits share the cluster from a small thread pool.

    Use the FAIR scheduler to let their jobs interleave.  Returns one row per combination, best first.
    """
    points = grid(options)
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        scores = list(pool.map(fit_and_score, points))
    rows = [(i, str(p), float(s)) for i, (p, s) in enumerate(zip(points, scores))]
    return spark.createDataFrame(rows, "point int, parameters string, score double").orderBy(F.desc("score"), "point")
