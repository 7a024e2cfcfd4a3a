"""Whitening directions of a table of vectors by a bidiagonal qd solver.

The rows, in whole numbers, are summed exactly in one pass and centred in the next. Blocks of centred rows are reduced to
triangles by QR, and triangles of many tasks again in blocks, until one small triangle R is left: R'R is the scatter matrix of all
rows, which is never formed. On R, a matrix of the vectors' dimension whatever their number, Householder reflections from
both sides leave an upper bidiagonal B; dqds finds its singular values to high relative accuracy; twisted factorisations of
B'B minus a squared singular value give the direction that belongs to it, and the right reflections turn it back.

Defined cases: rows whose vector is null, empty, or holds a null, non-finite or too large entry (its scaled value must
fit 52 bits) are dropped, and so are vectors of another length than most have (of equally frequent lengths the greatest
stays); repeated rows count each; ids may be null or repeated; a direction without variance has a null ``whitened``, is
``explained`` by 0, and is left out of ``identity_error``; an empty table gives an empty result; a ``deviation`` beyond 64
bits is null; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premisa.llm.common import ready, written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Rows reduced at once, and triangles of one task of the reduction.
BLOCK_ROWS, TOGETHER = 4096, 16
#: Triangles that the driver takes over, each of the vectors' dimension squared.
FEW = 16
EPS = float(np.finfo(np.float64).eps)


# the small dense problem


def triangle(rows: np.ndarray, held: np.ndarray | None = None) -> np.ndarray:
    """The triangular factor of the rows below the triangle held so far."""
    return np.linalg.qr(rows if held is None else np.vstack([held, rows]), mode="r")


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, upper diagonal and right reflectors of a square matrix: it is U B V', V the product of the reflections."""
    a, n, right = np.array(r, dtype=np.float64), r.shape[0], []

    def reflector(x: np.ndarray) -> np.ndarray:
        """The unit vector v with x - 2 v (v'x) a multiple of the first unit vector; zeros if x is one already."""
        v, norm = x.copy(), np.linalg.norm(x)
        if not np.any(x[1:]):
            return np.zeros_like(x)
        v[0] += np.copysign(norm, x[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < n - 1:
            v = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            right.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def dqds(d: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, in falling order, by shifted quotient differences."""
    q, f = [float(x) ** 2 for x in d], [float(x) ** 2 for x in e]
    found: list[float] = []
    todo = [(q, f, 0.0)]  # unreduced parts with the sum of shifts they have had
    while todo:
        q, f, gone = todo.pop()
        for _ in range(200 * len(q) + 100):
            # an end that has come off, or a place where the matrix falls apart
            while len(q) > 1 and f[-1] <= EPS**2 * (gone + q[-1]):
                found.append(gone + q.pop())
                f.pop()
            if len(q) < 2:
                break
            gap = next((i for i, x in enumerate(f) if x <= EPS**2 * (gone + min(q[i], q[i + 1]))), None)
            if gap is not None:
                todo.append((q[gap + 1 :], f[gap + 1 :], gone))
                q, f = q[: gap + 1], f[:gap]
                continue
            if q[0] < q[-1]:  # the small values belong at the end
                q, f = _turned(q, f)
            # what the last pass without shift leaves is an upper bound of the smallest value: take three quarters, then less
            least, shift = _passed(q, f, 0.0)[2], 0.0
            for part in (0.75, 0.25, 0.0):
                new_q, new_f, low = _passed(q, f, part * least)
                if low >= 0:
                    shift = part * least
                    break
            q, f, gone = new_q, new_f, gone + shift
        else:
            raise ArithmeticError("dqds did not converge")
        found += [gone + x for x in q]
    return np.sort(np.array(found))[::-1]


def _passed(q: list[float], f: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One differential pass: the new quotients and differences, and the smallest d on the way (negative: too large a shift)."""
    new_q, new_f = [], []
    d = low = q[0] - shift
    for i in range(len(f)):
        s = d + f[i]
        new_q.append(s)
        if s <= 0:
            ratio = 1.0 if s == 0 == d else 0.0
            low = min(low, s)
            new_f.append(q[i + 1] * (0.0 if s == 0 else f[i] / s))
        else:
            ratio = d / s
            new_f.append(f[i] * (q[i + 1] / s))
        d = ratio * q[i + 1] - shift
        low = min(low, d)
    new_q.append(d)
    return new_q, new_f, low


def _turned(q: list[float], f: list[float]) -> tuple[list[float], list[float]]:
    """The same values read from the other end: a pass of B makes it lower bidiagonal, whose flip is upper again."""
    return q[::-1], f[::-1]


def twisted(d: np.ndarray, e: np.ndarray, value: float, start: np.ndarray | None = None) -> np.ndarray:
    """A vector z with (B'B - value I) z nearly 0: factored from the top and from the bottom, joined where both meet best.

    With ``start`` it is the solution of (B'B - value I) z = start instead, up to its length.
    """
    n = len(d)
    tiny = EPS**2 * max(float(np.max(d**2, initial=0)), float(np.max(e**2, initial=0)), 1e-290)
    a = d**2
    a[1:] += e**2
    a -= value  # the diagonal of B'B - value I
    b = d[:-1] * e  # and the neighbours
    guard = lambda x: x if abs(x) > tiny else float(np.copysign(tiny, x))
    down, up = np.zeros(n), np.zeros(n)  # pivots from the top and from the bottom, by differential recurrences
    s = -value
    for i in range(n):
        down[i] = guard(d[i] ** 2 + s)
        if i < n - 1:
            s = e[i] ** 2 * (s / down[i]) - value
    p = d[-1] ** 2 - value
    for i in range(n - 1, -1, -1):
        if i == 0:
            up[0] = guard(p)
        else:
            up[i] = guard(e[i - 1] ** 2 + p)
            p = d[i - 1] ** 2 * (p / up[i]) - value
    meet = a.copy()
    meet[1:] -= b**2 / down[:-1]
    meet[:-1] -= b**2 / up[1:]
    if start is None:
        r = int(np.argmin(np.abs(meet)))
        z = np.zeros(n)
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -b[i] / down[i] * z[i + 1]
        for i in range(r + 1, n):
            z[i] = -b[i - 1] / up[i] * z[i - 1]
    else:
        r = int(np.argmin(np.abs(meet)))
        y = start.astype(np.float64).copy()
        for i in range(r):
            y[i + 1] -= b[i] / down[i] * y[i]
        for i in range(n - 1, r, -1):
            y[i - 1] -= b[i - 1] / up[i] * y[i]
        z = np.zeros(n)
        z[r] = y[r] / guard(meet[r])
        for i in range(r - 1, -1, -1):
            z[i] = (y[i] - b[i] * z[i + 1]) / down[i]
        for i in range(r + 1, n):
            z[i] = (y[i] - b[i - 1] * z[i - 1]) / up[i]
    big = np.max(np.abs(z))
    z = z / big if big > 0 and np.isfinite(big) else np.zeros(n)
    norm = np.linalg.norm(z)
    return z / norm if norm > 0 else z


def directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of R, falling, and the right singular vectors (rows) of the ``most`` greatest."""
    scale = float(np.max(np.abs(r))) if r.size else 0.0
    n = r.shape[0]
    if scale == 0:
        return np.zeros(n), np.eye(n)[:most]
    d, e, right = bidiagonalised(r / scale)
    values = dqds(d, e)
    rng = np.random.default_rng(1)
    # parts that negligible neighbours separate have vectors of their own
    negligible = np.abs(e) <= EPS * np.sqrt(values[0]) * 1e-3
    edges = [0, *(np.flatnonzero(negligible) + 1).tolist(), n]
    parts = []
    for i, j in zip(edges[:-1], edges[1:], strict=True):
        parts += [(x, i, j) for x in dqds(d[i:j], e[i : j - 1])]
    parts.sort(key=lambda x: -x[0])
    out: list[np.ndarray] = []
    for k, (value, i, j) in enumerate(parts[:most]):
        z = np.zeros(n)
        z[i:j] = twisted(d[i:j], e[i : j - 1], value)
        # neighbours closer than this are made orthogonal, and solved for again where little is left
        close = [y for y, (v, _, _) in zip(out, parts[:k], strict=True) if abs(v - value) <= 1e-3 * parts[0][0]]
        for _ in range(4):
            before = z.copy()
            for y in close:
                z -= (y @ z) * y
            norm = np.linalg.norm(z)
            if norm > 0.5 and np.linalg.norm(z / norm - before / max(np.linalg.norm(before), 1e-300)) < 1e-12:
                z /= norm
                break
            if norm < 0.1:
                z = np.zeros(n)
                z[i:j] = rng.standard_normal(j - i)
                for y in close:
                    z -= (y @ z) * y
            z[i:j] = twisted(d[i:j], e[i : j - 1], value, z[i:j])
        for y in close:
            z -= (y @ z) * y
        out.append(z / np.linalg.norm(z))
    vectors = np.array(out)
    for k in range(len(right) - 1, -1, -1):  # turn back
        vectors[:, k + 1 :] -= 2 * np.outer(vectors[:, k + 1 :] @ right[k], right[k])
    return values * scale**2, vectors


# the table


def _scaled(batch: pa.RecordBatch, length: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the batch, whole numbers as rows) of the usable vectors, for each length (or the given one)."""
    column = batch.column("embedding")
    # list arrays may be slices of longer ones
    ends = column.offsets.to_numpy().astype(np.int64)
    entries = column.values.cast(pa.float64())
    known = entries.is_valid().to_numpy(zero_copy_only=False)
    c = entries.fill_null(np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(SCALE * c)
        bad = np.concatenate([[0], np.cumsum(~(known & (np.abs(x) < 2.0**52)))])
    sizes = ends[1:] - ends[:-1]
    fine = column.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0) & (bad[ends[1:]] == bad[ends[:-1]])
    for size in np.unique(sizes[fine]).tolist() if length is None else [length]:
        rows = np.flatnonzero(fine & (sizes == size))
        if len(rows):
            yield rows, x[ends[rows][:, None] + np.arange(size)].astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """For each task and length: the rows, and the sum in each dimension."""
    held: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for rows, x in _scaled(batch):
            n, s = held.get(x.shape[1], (0, 0))
            held[x.shape[1]] = n + len(rows), s + x.sum(axis=0)
    for size, (n, s) in held.items():
        yield pa.RecordBatch.from_pydict({"size": pa.array([size]), "n": pa.array([n]), "s": pa.array([s])})


def fitted(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """Number of usable vectors and the exact sum of each dimension; 0 and no sums if there are none."""
    sums = vectors.mapInArrow(_sums, "size long, n long, s array<long>")
    each = sums.select("size", "n", F.posexplode("s").alias("k", "s"))
    total = each.groupBy("size", "k").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    best = written(total, "sums")
    of = best.where("k = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if of is None:
        return 0, np.zeros(0, np.int64)
    rows = best.where(F.col("size") == of["size"]).orderBy("k").collect()  # one number for each dimension
    return of["n"], np.array([r["s"] for r in rows], dtype=np.int64)


def reduced(vectors: DataFrame, n: int, s: np.ndarray) -> np.ndarray:
    """The triangle R of all centred rows."""
    m = len(s)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for _, x in _scaled(batch, m):
                for i in range(0, len(x), BLOCK_ROWS):
                    held = triangle(centred(x[i : i + BLOCK_ROWS], n, s), held)
        if held is not None:
            yield pa.RecordBatch.from_pydict({"r": pa.array([held.tobytes()], pa.binary())})

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        held = None
        for r in frame["r"]:
            held = triangle(np.frombuffer(r).reshape(-1, m), held)
        return pd.DataFrame({"r": [held.tobytes()]})

    found = written(vectors.mapInArrow(blocks, "r binary"), "triangles")
    count = found.count()
    while count > FEW:
        parts = -(-count // TOGETHER)
        dealt = found.withColumn("part", F.pmod(F.xxhash64("r"), F.lit(parts)))
        found = written(dealt.groupBy("part").applyInPandas(joined, "r binary"), "triangles")
        count = found.count()
    held = None
    for row in found.orderBy("r").collect():
        held = triangle(np.frombuffer(bytes(row["r"])).reshape(-1, m), held)
    # fewer rows than dimensions: rows of zeros complete the square
    return held if held.shape[0] == m else np.vstack([held, np.zeros((m - held.shape[0], m))])


def centred(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """x - s / n; the difference is taken in whole numbers, so nothing cancels."""
    return _difference(x, n, s).astype(np.float64) / n


def _difference(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """n x - s, exactly."""
    if n * (int(np.abs(x).max(initial=0)) + 1) < 1 << 62 and int(np.abs(s).max(initial=0)) < 1 << 62:
        return n * x - s
    return n * x.astype(object) - s.astype(object)


def deviations(x: np.ndarray, n: int, s: np.ndarray) -> list[int | None]:
    """The exact sum of (n x - s)**2 of each row; None beyond 64 bits."""
    d = _difference(x, n, s)
    if d.dtype != object and d.size and float(np.abs(d).max()) ** 2 * d.shape[1] < 2.0**62:
        return (d**2).sum(axis=1).tolist()
    found = [sum(int(v) ** 2 for v in row) for row in d]
    return [v if v < 1 << 63 else None for v in found]


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    ready(spark)
    vectors = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    n, s = fitted(vectors.select("embedding"))
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    if not n:
        return spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    values, found = directions(reduced(vectors.select("embedding"), n, s), min(components, len(s)))
    values = np.maximum(values, 0) / n
    trace = float(values.sum())
    real = int(np.sum(values[: len(found)] > max(len(s), 8) * EPS * values[0])) if trace > 0 else 0
    matrix = (found[:real] / np.sqrt(values[:real, None])).T

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _scaled(batch, len(s)):
                w = centred(x, n, s) @ matrix
                ends = pa.array(np.arange(0, w.size + 1, max(real, 1), dtype=np.int32) if real else np.zeros(len(rows) + 1, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)), pa.array(deviations(x, n, s), pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(w.ravel()))], ["vec_id", "deviation", "w"])

    scored = written(vectors.mapInArrow(projected, f"vec_id {kind}, deviation long, w array<double>"), "whitened")
    error = identity_error(scored, real, n)
    shares = F.array(*[F.lit(float(v / trace) if trace > 0 else 0.0) for v in values[: len(found)]])
    each = scored.select("vec_id", "deviation", "w", F.explode(F.sequence(F.lit(1), F.lit(len(found)))).alias("component"))
    return each.select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", F.get("w", F.col("component") - 1).alias("whitened"),
        F.get(shares, F.col("component") - 1).alias("explained"), F.lit(error).alias("identity_error"))


def identity_error(scored: DataFrame, real: int, n: int) -> float:
    """The largest absolute entry of the covariance of the whitened values minus the identity."""
    at = lambda i: F.col("w")[i]
    means = [F.sum(at(i)).alias(f"m{i}") for i in range(real)]
    products = [F.sum(at(i) * at(j)).alias(f"p{i}_{j}") for i in range(real) for j in range(i, real)]
    if not real:
        return 0.0
    r = scored.agg(*means, *products).first()
    return max(
        abs(r[f"p{i}_{j}"] / n - r[f"m{i}"] / n * (r[f"m{j}"] / n) - (i == j)) for i in range(real) for j in range(i, real))
