"""Sums over dominated points against brute force: small keys, and trees of several levels."""

import random

import pytest
from pyspark.sql import functions as F

from premisa.operators import dominance
from premisa.ordering import positioned


def shapes(rng, n):
    """Points of one key: scattered, on a line, many of one x, many of one y."""
    yield {(rng.random(), rng.random()) for _ in range(n)}
    yield {(float(i), float(i + rng.randint(0, 2))) for i in range(n)}
    yield {(rng.choice([1.0, 2.0, float(i)]), rng.random()) for i in range(n)}
    yield {(rng.random(), rng.choice([0.0, 1.0, float("-inf")])) for i in range(n)}


def case(seed, n, asked):
    rng = random.Random(seed)
    points, queries = [], []
    for k, shape in zip("abcd", shapes(rng, n), strict=True):
        held = [(k, x, y, float(rng.randint(0, 3)), float(rng.randint(1, 4))) for x, y in sorted(shape)]
        points += held
        for i in range(asked):
            x, y = rng.choice(held)[1], rng.choice(held)[2]
            x, y = rng.choice([x, x + 0.25, float("inf")]), rng.choice([y, y - 0.25, float("inf")])
            queries.append((k, x, y, rng.random() < 0.5, rng.random() < 0.5, f"q{i}"))
    queries.append(("e", 1.0, 1.0, True, True, "no points"))
    return points, queries


def check(spark, points, queries):
    p = spark.createDataFrame(points, "k string, x double, y double, a double, b double").repartition(3)
    q = spark.createDataFrame(queries, "k string, x double, y double, x_in boolean, y_in boolean, tag string").repartition(3)
    got = {(r["k"], r["tag"]): (r["a"], r["b"]) for r in dominance.dominated_sums(p, q, ["a", "b"], "tag string").collect()}
    assert len(got) == len(queries)
    for k, x, y, x_in, y_in, tag in queries:
        under = [r for r in points if r[0] == k and (r[1] < x or x_in and r[1] == x) and (r[2] < y or y_in and r[2] == y)]
        assert got[k, tag] == (sum(r[3] for r in under), sum(r[4] for r in under)), (k, tag)


@pytest.mark.parametrize("leaf, fan, n", [(15, 8, 60), (4, 2, 120), (3, 1, 60)])
def test_against_brute_force(spark, monkeypatch, leaf, fan, n):
    monkeypatch.setattr(dominance, "LEAF", leaf)
    monkeypatch.setattr(dominance, "FAN", fan)
    check(spark, *case(leaf, n, 40))


def test_no_group_outgrows_a_leaf(spark, monkeypatch):
    """Whatever the values: ranks are dense, so chunks hold 2**LEAF rows at most on every level."""
    monkeypatch.setattr(dominance, "LEAF", 4)
    monkeypatch.setattr(dominance, "FAN", 2)
    points, _ = case(5, 200, 1)
    rows = spark.createDataFrame(points, "k string, x double, y double, a double, b double")
    rows = rows.selectExpr("*", "1 as x_tie", "1 as y_tie", "false as asked", "cast(null as string) as tag")
    ranked = dominance._ranked(rows, ["tag"])
    for k in "abcd":
        own = ranked.where(F.col("k") == k)
        n = own.count()
        for axis in ("x_rank", "y_rank"):
            assert sorted(r[0] for r in own.select(axis).collect()) == list(range(n))


def test_positions(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, null, pmod(id * 7, 13)) as a").repartition(5)
    got = positioned(df, [F.col("a").desc_nulls_last(), F.col("id")], "at").collect()
    want = sorted(got, key=lambda r: (r["a"] is None, -(r["a"] or 0), r["id"]))
    assert [r["at"] for r in want] == list(range(1000))
    assert positioned(df.limit(0), [F.col("id")], "at").count() == 0
