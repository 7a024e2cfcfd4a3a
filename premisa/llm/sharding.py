"""Stable placement of rows on shards by a weighted hash tree: region, rack, shard.

A row key goes down one level at a time. At each node every child draws an exponential variate, from a hash of the key and
the child's path, whose rate is the summed weight below it; the least draw names the child, so children are picked in
proportion to their weights. Only the racks of the picked region draw, and only the shards of the picked rack. A child's
draw depends on its own path and weight alone: when a weight changes, rows move only into (or only out of) the subtrees
that hold it, at every level, and what happens inside one region changes nothing between the others.

Shards added after the tree was laid out must take rows only into themselves, whereas a region whose rate grew would
deal what it gains to all of its racks. So an added shard draws on its own, against the regions, at the rate of its weight:
a region's draw after growth is the least of its draw before and of those added to it, and a row that an added draw wins goes
straight to that shard. Rows that none wins keep their path. ``base`` tells how many shards the laid out tree has.

Defined cases: a null key is a key of its own; repeated keys share a shard; shards of weight 0 get no row; ties go to the
smaller number, and to the laid out tree before added shards; without any weight there is an error; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premisa.llm.common import numbered, written

SHARDS_PER_RACK = 4
RACKS_PER_REGION = 3
#: First path entry of shards added to a laid out tree.
ADDED = -1


def tree(weights: list[float]) -> list[list[list[float]]]:
    """Weights of shards 0, 1, ... as regions of racks of shards; the last of each may be short."""
    racks = [weights[i : i + SHARDS_PER_RACK] for i in range(0, len(weights), SHARDS_PER_RACK)]
    return [racks[i : i + RACKS_PER_REGION] for i in range(0, len(racks), RACKS_PER_REGION)]


def _array(of: list, depth: int) -> Column:
    return F.array(*[_array(x, depth - 1) if depth > 1 else F.lit(float(x)) for x in of])


def _draw(key: Column, path: list[Column], weight: Column) -> Column:
    """An exponential variate of rate ``weight`` from 52 hash bits, so that a double holds them; infinite without weight."""
    bits = F.shiftrightunsigned(F.xxhash64(key, *path), 12).cast("double")
    return F.when(weight > 0, -F.log((bits + 0.5) / F.lit(float(1 << 52))) / weight).otherwise(F.lit(float("inf")))


def _least(key: Column, path: list[Column], weights: Column) -> Column:
    """The smallest struct (d, i) of draw and number among the children of the node at ``path``."""
    draws = F.transform(weights, lambda w, i: F.struct(_draw(key, [*path, i], w).alias("d"), i.alias("i")))
    return F.array_min(draws)


def _bound(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def shard_of(key: Column, weights: list[float], base: int | None = None) -> Column:
    """The shard of a key: the descent through the first ``base`` shards (all by default), unless an added shard wins."""
    if any(w < 0 for w in weights) or not sum(weights) > 0:
        raise ValueError("weights must be numbers of at least 0, and one of them more")
    base = len(weights) if base is None else base
    regions = tree(weights[:base])
    racks = [[sum(rack) for rack in region] for region in regions]
    added = [(s, w) for s, w in enumerate(weights) if s >= base and w > 0]

    def below(k: Column, r: Column) -> Column:
        """The shard at the end of the descent from a region."""
        def inside(c: Column) -> Column:
            s = _least(k, [r, c], F.get(F.get(_array(regions, 3), r), c))["i"]
            return (r * RACKS_PER_REGION + c) * SHARDS_PER_RACK + s
        return _bound(_least(k, [r], F.get(_array(racks, 2), r))["i"], inside)

    def down(k: Column) -> Column:
        own = [F.struct(_draw(k, [F.lit(ADDED), F.lit(s)], F.lit(float(w))).alias("d"), F.lit(len(regions) + s).alias("i")) for s, w in added]
        if sum(weights[:base]) > 0:
            own.insert(0, _least(k, [], _array([sum(x) for x in racks], 1)))
        first = own[0] if len(own) == 1 else F.least(*own)
        grown = lambda i: i - len(regions)
        return _bound(first["i"], lambda i: F.when(i < len(regions), below(k, i)).otherwise(grown(i)))

    return _bound(F.coalesce(key.cast("string"), F.lit("null")), down)


def sharded(docs: DataFrame, weights: list[float], grown: list[float]) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, and its shard among the ``grown`` weights, whose
    entries beyond those of ``weights`` are added shards."""
    data = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "utf-8")
    placed = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        "doc_id",
        (F.length(data) + 8).cast("long").alias("size"),
        F.crc32(data).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), weights).alias("shard"),
        shard_of(F.col("doc_id"), grown, min(len(weights), len(grown))).alias("grown_shard"),
    )
    placed = numbered(written(placed, "shards"), ["shard"], "row_id", "slot")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
