"""Sums over dominated points: for queries (x, y) the sums over the points to the left of and below them, at any size.

Points and queries are ranked together along x and along y (``premisa.ordering``: range shuffles, no quantiles to guess), so
both coordinates become dense whole numbers, however skewed the values are. A tree over x ranks, 2**FAN children to a node and
2**LEAF rows to a leaf, splits a query's left side into the children before its own on each level, and the part of its own
leaf. On each level the rows of a node are cut along y into chunks of 2**LEAF rows: whole chunks below a query come from the prefix sums
of a table of (chunk, child), at most 2**FAN squared cells to a node, and the rest from its own chunk. Every group that a task takes
therefore holds at most 2**LEAF rows, or one table of a node: nothing grows with the data but the number of groups and,
with its logarithm, of levels. Tables and ranks stay in Spark; only the number of rows of each key comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premisa.ordering import positioned

LEAF = 15
FAN = 8


def rank_function():
    """Sums over a prefix of the points with small ranks. Nested like the functions that use it."""

    def prefix_rank_sums(rank: np.ndarray, weights: np.ndarray, first: np.ndarray, below: np.ndarray) -> np.ndarray:
        """For each query the column sums of ``weights`` over the first ``first`` points whose rank is under ``below``."""
        low, high = np.zeros(len(first), dtype=np.int64), first.astype(np.int64)
        out = np.zeros((len(first), weights.shape[1]))
        for bit in reversed(range(max(1, len(rank).bit_length()))):
            small = (rank >> bit) & 1 == 0
            zeros = np.concatenate([[0], np.cumsum(small)])
            upto = np.concatenate([np.zeros((1, weights.shape[1])), np.cumsum(np.where(small[:, None], weights, 0.0), axis=0)])
            take = (below >> bit) & 1 == 1
            out += np.where(take[:, None], upto[high] - upto[low], 0.0)
            low0, high0 = zeros[low], zeros[high]
            low = np.where(take, zeros[-1] + low - low0, low0)
            high = np.where(take, zeros[-1] + high - high0, high0)
            order = np.argsort(~small, kind="stable")
            rank, weights = rank[order], weights[order]
        return out

    return prefix_rank_sums


def _sum_functions(sums: list[str], names: list[str]):
    """The work inside one group. Nested, so that workers get the code itself and need no installed package."""
    prefix_rank_sums = rank_function()

    def dominated(points: pd.DataFrame, queries: pd.DataFrame, a: str, b: str) -> np.ndarray:
        """Sums over the points whose columns a and b are both less than the query's."""
        points = points.sort_values(a, kind="stable")
        first = np.searchsorted(points[a].to_numpy(), queries[a].to_numpy(), "left")
        values = points[b].to_numpy()
        by_b = np.argsort(values, kind="stable")
        rank = np.empty(len(points), dtype=np.int64)
        rank[by_b] = np.arange(len(points))
        below = np.searchsorted(values[by_b], queries[b].to_numpy(), "left")
        return prefix_rank_sums(rank, points[sums].to_numpy(dtype=float), first, below)

    def answer(queries: pd.DataFrame, out: np.ndarray) -> pd.DataFrame:
        made = pd.concat([queries[["k", *names]].reset_index(drop=True), pd.DataFrame(out, columns=sums)], axis=1)
        # text columns as plain objects: they go back to Spark in one piece
        return made.astype({c: object for c in made.columns if pd.api.types.is_string_dtype(made[c].dtype)})

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        """A key that fits one group: ranks are made here, an equal coordinate coming before or after the query's."""
        for axis in ("x", "y"):
            order = np.lexsort((frame[f"{axis}_tie"].to_numpy(), frame[axis].to_numpy()))
            rank = np.empty(len(frame), dtype=np.int64)
            rank[order] = np.arange(len(frame))
            frame = frame.assign(**{f"{axis}_rank": rank})
        return leaf(frame)

    def leaf(frame: pd.DataFrame) -> pd.DataFrame:
        asked = frame["asked"].to_numpy(bool)
        return answer(frame[asked], dominated(frame[~asked], frame[asked], "x_rank", "y_rank"))

    def table(frame: pd.DataFrame) -> pd.DataFrame:
        """The sums (chunk, child) of one node to the sums over all chunks before and children before, one row per chunk."""
        chunks, children = int(frame["chunk"].max()) + 1, int(frame["child"].max()) + 1
        grid = np.zeros((chunks + 1, children + 1, len(sums)))
        grid[frame["chunk"].to_numpy() + 1, frame["child"].to_numpy() + 1] = frame[sums].to_numpy(dtype=float)
        grid = grid.cumsum(axis=0).cumsum(axis=1)
        return pd.DataFrame({"k": frame["k"].iloc[0], "node": frame["node"].iloc[0], "chunk": np.arange(chunks),
                             "before": [row.ravel() for row in grid[:-1]]}).astype({"k": object})

    def chunk(frame: pd.DataFrame) -> pd.DataFrame:
        """The queries of one chunk: its own points below them in children before theirs, and the chunks before."""
        head = frame["before"].notna().to_numpy()
        asked = frame["asked"].to_numpy(bool)
        queries = frame[asked & ~head]
        out = dominated(frame[~asked & ~head], queries, "inside", "child")
        if head.any() and len(queries):
            before = np.asarray(frame["before"][head].iloc[0], dtype=float).reshape(-1, len(sums))
            out += before[np.minimum(queries["child"].to_numpy(), len(before) - 1)]
        return answer(queries, out)

    return whole, leaf, table, chunk


def dominated_sums(points: DataFrame, queries: DataFrame, sums: Sequence[str], tags: str) -> DataFrame:
    """``queries`` with the sums over the points of their key with smaller x and y.

    ``points``: k, x, y and ``sums``, one row per distinct (k, x, y). ``queries``: k, x, y, x_in, y_in (whether an equal
    x or y counts), and the columns of the schema ``tags``, which tell queries apart. Returns k, the tags and the sums.
    """
    sums, names = list(sums), [t.split()[0] for t in tags.split(", ")]
    whole, leaf, table, chunk = _sum_functions(sums, names)
    result = "k string, " + tags + ", " + ", ".join(f"{s} double" for s in sums)
    extra = [f"cast(null as {t.split()[1]}) as {t.split()[0]}" for t in tags.split(", ")]
    # among equal coordinates: queries that leave them out, points, queries that count them
    tie = lambda axis: f"if({axis}_in, 2, 0) as {axis}_tie"
    rows = points.selectExpr("k", "x", "y", *sums, "1 as x_tie", "1 as y_tie", "false as asked", *extra).unionByName(
        queries.selectExpr("k", "x", "y", *[f"0D as {s}" for s in sums], tie("x"), tie("y"), "true as asked", *names))
    counts = {r["k"]: r["n"] for r in rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = max(counts.values(), default=0)
    if most <= 1 << LEAF:
        return rows.groupBy("k").applyInPandas(whole, result)
    ranked = _ranked(rows, names)
    levels = -(-(max(most - 1, 1).bit_length() - LEAF) // FAN)
    parts = ranked.withColumn("node", F.shiftright("x_rank", LEAF)).groupBy("k", "node").applyInPandas(leaf, result)
    for level in range(levels):
        parts = parts.unionByName(_level(ranked, level, levels, sums, names, result, table, chunk))
    return parts.groupBy("k", *names).agg(*[F.sum(s).alias(s) for s in sums])


def _ranked(rows: DataFrame, names: list[str]) -> DataFrame:
    """The rows with x_rank and y_rank, their places among the rows of their key; each sort is stored."""
    unlike = F.xxhash64(*names)
    ranked = positioned(rows, [F.col("k"), F.col("x"), F.col("x_tie"), F.col("y"), unlike], "x_rank", "by-x")
    ranked = positioned(ranked, [F.col("k"), F.col("y"), F.col("y_tie"), F.col("x"), unlike], "y_rank", "by-y")
    first = ranked.groupBy("k").agg(F.min("x_rank").alias("first"))  # the keys stand in one order on both axes
    ranked = ranked.join(F.broadcast(first), "k")  # one row for each attribute
    return ranked.withColumns({"x_rank": F.col("x_rank") - F.col("first"), "y_rank": F.col("y_rank") - F.col("first")}).drop("x", "y", "x_tie", "y_tie")


def _level(ranked: DataFrame, level: int, levels: int, sums: list[str], names: list[str], result: str, table, chunk) -> DataFrame:
    """What the children before a query's own contribute on one level."""
    low, high = LEAF + FAN * level, LEAF + FAN * (level + 1)
    of = ranked.withColumns({"node": F.shiftright("x_rank", high), "child": F.shiftright("x_rank", low).bitwiseAND((1 << FAN) - 1)})
    if level == levels - 1:  # one node: its rows are in the order of the whole key
        of = of.withColumn("within", F.col("y_rank"))
    else:
        of = positioned(of, [F.col("first"), F.col("node"), F.col("y_rank")], "within", "by-node")
        # ranks are dense, so the nodes before it have 2**high rows each
        of = of.withColumn("within", F.col("within") - F.col("first") - F.shiftleft("node", high))
    of = of.withColumns({"chunk": F.shiftright("within", LEAF), "inside": F.col("within").bitwiseAND((1 << LEAF) - 1)})
    cells = of.where("not asked").groupBy("k", "node", "chunk", "child").agg(*[F.sum(s).alias(s) for s in sums])
    # a chunk without points of its own still has those before it: every chunk gets a cell
    cells = cells.unionByName(of.where("asked").groupBy("k", "node", "chunk").agg(F.lit(0).cast("long").alias("child")).selectExpr(
        "k", "node", "chunk", "child", *[f"0D as {s}" for s in sums]))
    cells = cells.groupBy("k", "node", "chunk", "child").agg(*[F.sum(s).alias(s) for s in sums])
    heads = cells.groupBy("k", "node").applyInPandas(table, "k string, node long, chunk long, before array<double>")
    columns = ["k", "node", "chunk", "inside", "child", *sums, "asked", *names]
    plain = of.select(*columns, F.lit(None).cast("array<double>").alias("before"))
    kinds = {f.name: f.dataType for f in plain.schema}
    fill = {"inside": F.lit(0), "child": F.lit(0), "asked": F.lit(False)}
    heads = heads.select(*[F.col(c) if c in heads.columns else fill.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in plain.columns])
    return plain.unionByName(heads).groupBy("k", "node", "chunk").applyInPandas(chunk, result)
