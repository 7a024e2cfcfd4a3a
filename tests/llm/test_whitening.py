"""Whitening against numpy's eigenvectors, and the small solver on matrices with clusters and null spaces."""

import math

import numpy as np
import pytest

from premisa.llm import whitening

SCHEMA = "component string, embedding array<float>, w int, vec_id long, n string"


def square(a):
    r = whitening.triangle(a)
    return np.vstack([r, np.zeros((a.shape[1] - r.shape[0], a.shape[1]))])


def rotated(values, rng):
    return np.diag(values) @ np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]


def matrices():
    rng = np.random.default_rng(4)
    yield rng.standard_normal((300, 40))
    yield rng.standard_normal((300, 40)) * np.logspace(0, -6, 40)
    yield rng.standard_normal((300, 4)) @ rng.standard_normal((4, 40))
    yield rng.standard_normal((3, 20))
    yield np.eye(9)
    yield rotated([3.0] * 10 + [2.0, 2.0], rng)
    yield rotated([3 + 1e-9 * i for i in range(12)], rng)
    yield rotated([3 + 1e-5 * i for i in range(12)], rng)
    yield np.array([[2.0]])
    for _ in range(60):
        a = np.floor(rng.standard_normal((rng.integers(2, 40), rng.integers(1, 20))) * rng.choice([1, 3, 100]))
        yield a - a.mean(axis=0)


def test_solver():
    for a in matrices():
        values, found = whitening.directions(square(a), min(8, a.shape[1]))
        s = np.linalg.svd(a, compute_uv=False) ** 2
        s = np.concatenate([s, np.zeros(a.shape[1] - len(s))])
        assert np.allclose(values, s, rtol=1e-12, atol=1e-13 * s[0])
        assert np.allclose(found @ found.T, np.eye(len(found)), atol=1e-11)
        assert np.allclose(a.T @ (a @ found.T), found.T * values[: len(found)], atol=1e-12 * max(s[0], 1e-300))


def test_small_values_keep_their_digits():
    """dqds on a graded bidiagonal matrix: every singular value to high relative accuracy."""
    d, e = 10.0 ** -np.arange(12.0), 10.0 ** -np.arange(1.0, 12.0) * 0.3
    got = whitening.dqds(d, e)
    assert math.isclose(float(np.prod(got)), float(np.prod(d**2)), rel_tol=1e-12)  # the squared determinant
    assert abs(float(got.sum()) / float((d**2).sum() + (e**2).sum()) - 1) < 1e-14


def expected(rows):
    usable = [r for r in rows if r[1] and all(v is not None and math.isfinite(v) for v in r[1])]
    lengths = [len(r[1]) for r in usable]
    m = max(set(lengths), key=lambda k: (lengths.count(k), k))
    usable = [r for r in usable if len(r[1]) == m]
    x = np.array([[math.floor(1024 * float(np.float32(v))) + 100000 for v in r[1]] for r in usable], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = [int(sum((n * v - t) ** 2 for v, t in zip(row, s, strict=True))) for row in x]
    c = np.array([[float(n * v - t) / n for v, t in zip(row, s, strict=True)] for row in x])
    values, vectors = np.linalg.eigh(c.T @ c / n)
    return [r[3] for r in usable], n, deviation, c, values[::-1], vectors[:, ::-1]


def compare(spark, rows):
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.collect()
    ids, n, deviation, c, values, vectors = expected(rows)
    k = min(8, c.shape[1])
    assert len(got) == len(ids) * k and {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-9
    for j in range(k):
        here = sorted(([r["vec_id"] is None, r["vec_id"] or 0, r["deviation"]], r) for r in got if r["component"] == j + 1)
        want = sorted([[i is None, i or 0, d], w] for i, d, w in zip(ids, deviation, c @ vectors[:, j], strict=True))
        assert [h[0] for h in here] == [w[0] for w in want]
        assert all(abs(h[1]["explained"] - values[j] / values.sum()) < 1e-9 for h in here)
        if values[j] > 1e-9 * values[0]:
            a, b = np.array([h[1]["whitened"] for h in here]), np.array([w[1] for w in want]) / np.sqrt(values[j])
            assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
        else:
            assert all(h[1]["whitened"] is None for h in here)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [("c", (rng.standard_normal(10) * np.arange(1, 11)).tolist(), 1, i, "x") for i in range(60)]
    rows += [("c", v, 1, 100 + i, "x") for i, v in enumerate([None, [], [None] + [1.0] * 9, [float("nan")] * 10, [float("inf")] + [0.0] * 9, [1.0] * 9, [3e30] * 10])]
    rows = [r for r in rows if r[1] != [3e30] * 10] + [("c", rows[0][1], 1, None, "x"), rows[1], rows[1]]
    compare(spark, rows)
    large = spark.createDataFrame([*rows, ("c", [3e30] * 10, 1, 7, "x")], SCHEMA)  # dropped as well
    assert whitening.whitened(large).count() == 63 * 8


def test_few_dimensions_and_no_variance(spark):
    compare(spark, [("c", [float(i), float(i % 3), 5.0], 1, i, "x") for i in range(20)])
    one = whitening.whitened(spark.createDataFrame([("c", [1.0, 2.0], 1, 5, "x")], SCHEMA)).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in sorted(one, key=lambda r: r["component"])] == [
        (1, 1, 0, None, 0.0), (2, 1, 0, None, 0.0)]
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).collect() == []


def test_triangles_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FEW", 1)
    monkeypatch.setattr(whitening, "TOGETHER", 2)
    rng = np.random.default_rng(9)
    compare(spark, [("c", (rng.standard_normal(6) * np.arange(1, 7)).tolist(), 1, i, "x") for i in range(200)])


def test_exact_deviation():
    x, s = np.array([[2**52 + 1, 5]]), np.array([2**62 + 12345, 7])
    assert whitening.deviations(x, 1024, s) == [(1024 * (2**52 + 1) - 2**62 - 12345) ** 2 + (1024 * 5 - 7) ** 2]
    assert whitening.deviations(np.array([[1 << 40]]), 1, np.array([0])) == [None]


@pytest.mark.parametrize("name", ["op11_embedding_whitening"])
def test_query(spark, sf, name):
    from premisa.llm.queries import QUERIES

    rows = [("", r["embedding"], 1, r["vec_id"], "") for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = QUERIES[name](spark, sf).collect()
    ids, n, deviation, c, values, vectors = expected(rows)
    first = {r["vec_id"]: r for r in got if r["component"] == 1}
    assert len(got) == 8 * len(ids) and {i: first[i]["deviation"] for i in first} == dict(zip(ids, deviation, strict=True))
    want = dict(zip(ids, c @ vectors[:, 0] / np.sqrt(values[0]), strict=True))
    sign = np.sign(first[ids[0]]["whitened"] * want[ids[0]])
    assert max(abs(sign * first[i]["whitened"] - want[i]) for i in ids) < 1e-8
    assert first[ids[0]]["identity_error"] < 1e-9
