"""Helpers shared by the corpus operators: packing rows, numbering rows without gaps, exporting trees."""

from __future__ import annotations

import math
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from premisa.session import shared_folder, written

__all__ = ["packed", "unpacked", "ready", "written", "shared_folder", "numbered", "tree_nodes", "partitions_for", "WORD_BREAK"]

_sent: set[str] = set()


def ready(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application: they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _sent:
        package = Path(__file__).parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='premisa-code-')}/premisa", "zip", package.parent, package.name)
        context.addPyFile(archive)  # Spark's own file server hands it out
        _sent.add(context.applicationId)


#: White space between words: space and the ASCII controls tab to carriage return.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def packed(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns of ``df`` in one struct column, so that no later column can clash with them."""
    return df.select(F.struct(*[F.col(_quoted(c)) for c in df.columns]).alias(name))


def unpacked(df: DataFrame, name: str = "row") -> DataFrame:
    return df.select(f"{name}.*")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def partitions_for(spark: SparkSession, rows: int, each: int) -> int:
    """Enough partitions that none gets many more than ``each`` rows; at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / each))


def numbered(df: DataFrame, by: list[str], unique: str, out: str) -> DataFrame:
    """Number the rows of each group ``by`` from 0 without gaps, in no particular order.

    ``df`` must be a stored table (it is read three times) and ``unique`` an integer column that tells its rows apart. A
    group of n rows is dealt over sqrt(n) buckets by a hash of ``unique``; each bucket is numbered alone and starts where
    the buckets before it end. So a hot group spreads over many tasks, and no window holds more than about sqrt(n) rows.
    """
    if {"_buckets", "_bucket", "_first", "_inside"} & set(df.columns):
        raise ValueError("reserved column name")
    groups = df.groupBy(*by).agg(F.ceil(F.sqrt(F.count("*"))).cast("int").alias("_buckets"))
    dealt = df.join(groups, by).withColumn("_bucket", F.pmod(F.xxhash64(unique), F.col("_buckets")).cast("int"))
    dealt = dealt.drop("_buckets").repartition(*by, "_bucket")  # else windows may keep the join's dealing by group alone
    sizes = dealt.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(*by, "_bucket").orderBy(unique)
    rows = dealt.withColumn("_inside", F.row_number().over(inside) - 1)
    return (
        rows.join(first, [*by, "_bucket"])
        .withColumn(out, (F.col("_first") + F.col("_inside")).cast("long"))
        .drop("_bucket", "_first", "_inside")
    )


def tree_nodes(tree) -> list[tuple[int, float, int, int, float]]:
    """A fitted Spark ML tree as a list of (feature, threshold, left, right, prediction); feature -1 marks a leaf.

    A row goes left when its feature is at most the threshold.
    """
    nodes: list[tuple[int, float, int, int, float]] = []

    def add(node) -> int:
        here = len(nodes)
        nodes.append((-1, 0.0, 0, 0, float(node.prediction())))
        if node.subtreeDepth() > 0:
            split = node.split()
            left, right = add(node.leftChild()), add(node.rightChild())
            nodes[here] = (int(split.featureIndex()), float(split.threshold()), left, right, 0.0)
        return here

    add(tree._call_java("rootNode"))
    return nodes


def tree_sql(nodes: list[tuple[int, float, int, int, float]], features: list[str], at: int = 0) -> str:
    """The same tree as a SQL expression over the given feature expressions."""
    feature, threshold, left, right, prediction = nodes[at]
    if feature < 0:
        return f"{prediction!r}D"
    yes, no = tree_sql(nodes, features, left), tree_sql(nodes, features, right)
    return yes if yes == no else f"if({features[feature]} <= {threshold!r}D, {yes}, {no})"


def words(text: Column) -> Column:
    """The words of a text; no words for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")
