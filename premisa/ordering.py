"""Positions of rows in a total order, without a task that holds more than its range of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premisa.session import written


def positioned(df: DataFrame, order: list[Column], out: str, what: str = "order") -> DataFrame:
    """``df`` as a stored table with ``out``, the place of each row from 0 on in the order of the given columns.

    One shuffle deals the rows to ranges of the order; a row's place is the number of rows in the ranges before its own
    plus its place within. Only one count for each range leaves the tasks. Rows that tie in all columns stand in any order,
    so a hot key is split if a later column tells its rows apart. ``df`` is read twice: it should be stored, or cheap to read.
    """
    if {"__part", "__at"} & set(df.columns):
        raise ValueError("reserved column name")
    # ascending ids of a sorted partition: the partition's number in the upper bits, the row's place in the lower 33
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    stored = written(dealt, what)
    part = F.shiftright("__at", 33).cast("int")
    sizes = {r["p"]: r["n"] for r in stored.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    first, rows = 0, []
    for p in sorted(sizes):
        rows.append((p, first))
        first += sizes[p]
    offsets = F.broadcast(df.sparkSession.createDataFrame(rows, "__part int, __first long"))  # one row for each partition
    placed = stored.join(offsets, part == F.col("__part"))
    return placed.withColumn(out, F.col("__first") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__part", "__first", "__at")
