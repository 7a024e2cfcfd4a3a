"""Running sums over sorted distinct values, in one or two levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    names: Sequence[str],
    descending: bool = False,
    bucket: str | None = None,
    prefix: str = "cum_",
) -> DataFrame:
    """Add inclusive running sums ``cum_<name>`` per key.

    With ``bucket`` (a monotone function of ``order``) windows run inside one bucket and the bucket
    totals, few rows, supply the offsets; without it a key is one window partition.
    """
    by = F.col(order).desc() if descending else F.col(order).asc()
    if bucket is None:
        w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(n).over(w).alias(prefix + n) for n in names])
    w = Window.partitionBy(*keys, bucket).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    inner = df.select("*", *[F.sum(n).over(w).alias(prefix + n) for n in names])
    totals = df.groupBy(*keys, bucket).agg(*[F.sum(n).alias(f"__t_{n}") for n in names])
    by_bucket = F.col(bucket).desc() if descending else F.col(bucket).asc()
    before = (
        Window.partitionBy(*(keys or [F.lit(0)])).orderBy(by_bucket).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *keys, bucket, *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0.0)).alias(f"__o_{n}") for n in names]
    )
    joined = inner.join(offsets, [*keys, bucket])
    return joined.select(
        *df.columns, *[(F.col(prefix + n) + F.col(f"__o_{n}")).alias(prefix + n) for n in names]
    )
