"""Candidate conditions with their counts, as one distributed aggregate per question.

All candidates of all attributes come from one pass: every row is unpivoted to (attribute, value),
the sums are combined on the map side, and prefix sums over the sorted distinct values turn them
into the counts of ``a < cut`` and ``a >= cut``.  The prefix sums run in two levels: each attribute is
split into value buckets, windows run inside one bucket, and the few bucket totals are added as
offsets.  So no task ever holds a whole attribute, however many distinct values it has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premisa.functions import sqltext as q
from premisa.functions.measures import quality
from premisa.functions.premise import quoted
from premisa.roles import NOMINAL, NUMERIC, attribute_types, label_text

# Distinct values per window partition before prefix sums are split into two levels.
VALUES_PER_BUCKET = 20_000
MAX_BUCKETS = 2_000
COARSE = 32
INF = float("inf")


def bucketize(df: DataFrame, cuts: Mapping[str, Sequence[float]], outputs: Mapping[str, str]) -> DataFrame:
    """Index of the half-open cell ``[cut_j, cut_j+1)`` of each column; null stays null.

    ``cuts`` maps an output name to its cuts, ``outputs`` maps an output name to its input column.
    """
    names = [o for o in outputs if cuts[o]]
    if names:
        tool = Bucketizer(
            splitsArray=[[-INF, *cuts[o], INF] for o in names],
            inputCols=[outputs[o] for o in names],
            outputCols=[f"__cell_{i}" for i in range(len(names))],
            handleInvalid="keep",
        )
        df = tool.transform(df)
        df = df.withColumns({o: F.col(f"__cell_{i}").cast("int") for i, o in enumerate(names)}).drop(
            *[f"__cell_{i}" for i in range(len(names))]
        )
    rest = {o: F.when(quoted(outputs[o]).isNotNull(), F.lit(0)) for o in outputs if not cuts[o]}
    return df.withColumns(rest) if rest else df


def _quantile_exprs(parts: Mapping[str, int]) -> list[Column]:
    out = []
    for i, (a, k) in enumerate(parts.items()):
        out.append(F.min(quoted(a)).alias(f"m{i}"))
        out.append(F.percentile_approx(quoted(a), [j / k for j in range(1, k)], max(10_000, 10 * k)).alias(f"q{i}"))
    return out


def _inner_cuts(row, parts: Mapping[str, int]) -> dict[str, list[float]]:
    return {
        a: [float(v) for v in sorted(set(row[f"q{i}"] or [])) if v > row[f"m{i}"]] for i, a in enumerate(parts)
    }


def quantile_cuts(df: DataFrame, parts: Mapping[str, int]) -> dict[str, list[float]]:
    """Strictly increasing inner quantiles of each column, at most ``parts - 1`` of them."""
    wanted = {a: k for a, k in parts.items() if k > 1}
    out: dict[str, list[float]] = {a: [] for a in parts}
    if wanted:
        out.update(_inner_cuts(df.agg(*_quantile_exprs(wanted)).first(), wanted))
    return out


def column_facts(df: DataFrame, attrs: Sequence[str], parts: Mapping[str, int]):
    """Row count, distinct estimates and quantile cuts from one aggregate."""
    distinct = [F.approx_count_distinct(quoted(a)).alias(f"d{i}") for i, a in enumerate(attrs)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *distinct, *_quantile_exprs(parts)).first()
    counts = {a: row[f"d{i}"] for i, a in enumerate(attrs)}
    return row["rows"], counts, _with_rare_values(df, counts, parts, _inner_cuts(row, parts))


def _with_rare_values(df: DataFrame, distinct: Mapping[str, int], parts: Mapping[str, int], cuts: dict[str, list[float]]):
    """More cuts for columns whose row quantiles fall together on heavy values: quantiles of their distinct values.

    Without them the values that few rows have would share one cell, or none would be told apart at all.
    """
    short = {a: k - 1 - len(cuts[a]) for a, k in parts.items() if k > 1 and len(cuts[a]) < min(k, distinct[a]) - 1}
    if not short:
        return cuts
    pairs = [F.struct(F.lit(i).alias("a"), quoted(a).cast("double").alias("v")) for i, a in enumerate(short)]
    values = df.select(F.inline(F.array(*pairs))).where("v is not null and not isnan(v)").distinct()
    found = dict(cuts)
    most = max(short.values()) + 1
    rows = values.groupBy("a").agg(
        F.min("v").alias("low"), F.percentile_approx("v", [j / most for j in range(1, most + 1)], max(10_000, 10 * most)).alias("q")
    )
    names = list(short)
    for r in rows.collect():
        name = names[r["a"]]
        inner = [v for v in sorted(set(r["q"])) if v > r["low"]]
        step = max(1, -(-len(inner) // short[name]))
        found[name] = sorted({*cuts[name], *inner[::step], *inner[:1]})
    return found


def fitting_bounds(df: DataFrame, distinct: Mapping[str, int], coarse: Mapping[str, list[float]]) -> dict[str, list[float]]:
    """Bucket bounds per column: none for few distinct values, the coarse quantiles, or finer ones."""
    parts = {a: min(MAX_BUCKETS, 1 + d // VALUES_PER_BUCKET) for a, d in distinct.items()}
    fine = {a: k for a, k in parts.items() if k > COARSE}
    out = {a: coarse[a] if parts[a] > 1 else [] for a in distinct}
    out.update(quantile_cuts(df, fine))
    return out


def value_buckets(df: DataFrame, attrs: Sequence[str], buckets: int | None = None) -> dict[str, list[float]]:
    """Bucket bounds for two-level prefix sums; none for attributes with few distinct values."""
    if buckets is not None:
        return quantile_cuts(df, dict.fromkeys(attrs, buckets))
    _, distinct, coarse = column_facts(df, attrs, dict.fromkeys(attrs, COARSE))
    return fitting_bounds(df, distinct, coarse)


def value_sums(
    df: DataFrame,
    numeric: Sequence[str],
    nominal: Sequence[str],
    sums: Mapping[str, str],
    bounds: Mapping[str, Sequence[float]] | None = None,
    nominal_buckets: int = 1,
) -> DataFrame:
    """Sums per (attr, bucket, num, nom); rows with a missing value do not count for that attribute.

    ``sums`` maps names to SQL expressions; ``bounds`` are the value buckets of numeric attributes.
    """
    bounds = {a: list((bounds or {}).get(a, [])) for a in numeric}
    split = {a: f"__bucket_{i}" for i, a in enumerate(numeric) if bounds[a]}
    df = df.selectExpr(*[q.name(a) for a in [*numeric, *nominal]], *[f"{e} as {n}" for n, e in sums.items()])
    if split:
        df = bucketize(df, {split[a]: bounds[a] for a in split}, {split[a]: a for a in split})
    cells = [
        f"struct({q.text(a)} as attr, {split.get(a, '0')} as bucket, "
        f"cast({q.name(a)} as double) as num, cast(null as string) as nom)"
        for a in numeric
    ]
    for a in nominal:
        bucket = f"pmod(hash({q.name(a)}), {nominal_buckets})" if nominal_buckets > 1 else "0"
        cells.append(
            f"struct({q.text(a)} as attr, {bucket} as bucket, cast(null as double) as num, "
            f"cast({q.name(a)} as string) as nom)"
        )
    long = df.selectExpr(*sums, f"inline(array({', '.join(cells)}))").where("(num is not null or nom is not null) and bucket is not null")
    return long.groupBy("attr", "bucket", "num", "nom").agg(*[F.sum(n).alias(n) for n in sums])


def split_candidates(
    sums: DataFrame,
    names: Sequence[str],
    keys: Sequence[str] = (),
    complementary: bool = False,
    two_level: bool = False,
    integral: bool = False,
) -> DataFrame:
    """Candidates (keys, attr, op, cut, value) with the sums of the rows they cover.

    ``op``: ``lt`` and ``ge`` for numeric attributes, ``eq`` (and ``ne``) for nominal ones.
    ``integral``: values are cell indices, the cut between two cells is the upper index itself.
    """
    group = [*keys, "attr"]
    part = ", ".join([*group, "bucket"])
    inside = f"over (partition by {part} order by num, nom rows between unbounded preceding and 1 preceding)"
    cand = sums.selectExpr(
        *group, "bucket", "num", "nom", *names,
        f"lag(num) over (partition by {part} order by num, nom) as __prev",
        *[f"coalesce(sum({n}) {inside}, 0D) as __lo_{n}" for n in names],
        *[f"sum({n}) over (partition by {part}) as __all_{n}" for n in names],
    )
    if two_level:
        # One row per (keys, attr, bucket): bounded by attributes x MAX_BUCKETS.
        totals = sums.groupBy(*group, "bucket").agg(
            *[F.sum(n).alias(f"__b_{n}") for n in names], F.max("num").alias("__bmax")
        )
        whole = f"partition by {', '.join(group)}"
        before = f"over ({whole} order by bucket rows between unbounded preceding and 1 preceding)"
        totals = totals.selectExpr(
            *group, "bucket", f"max(__bmax) {before} as __before",
            *[f"coalesce(sum(__b_{n}) {before}, 0D) as __off_{n}" for n in names],
            *[f"sum(__b_{n}) over ({whole}) as __tot_{n}" for n in names],
        )
        cand = cand.join(totals, [*group, "bucket"]).selectExpr(
            *group, "num", "nom", *names, "coalesce(__prev, __before) as __prev",
            *[f"__lo_{n} + __off_{n} as __lo_{n}" for n in names],
            *[f"__tot_{n} as __all_{n}" for n in names],
        )
    cut = "num" if integral else "(__prev + num) / 2"

    def option(when, op, cut_sql, value_sql, sum_sql):
        fields = [f"'{op}' as op", f"cast({cut_sql} as double) as cut", f"cast({value_sql} as string) as value"]
        fields += [f"{sum_sql.format(n=n)} as {n}" for n in names]
        return f"if({when}, struct({', '.join(fields)}), null)"

    options = [
        option("__prev is not null", "lt", cut, "null", "__lo_{n}"),
        option("__prev is not null", "ge", cut, "null", "__all_{n} - __lo_{n}"),
        option("nom is not null", "eq", "null", "nom", "{n}"),
    ]
    if complementary:
        options.append(option("nom is not null", "ne", "null", "nom", "__all_{n} - {n}"))
    return cand.selectExpr(*group, f"inline(array_compact(array({', '.join(options)})))")


# --- the candidate operators over a table and one target class --------------------------------


def _counts(
    df: DataFrame, label: str, target: str, weight: str | None, new: Column | None
) -> tuple[DataFrame, dict[str, str]]:
    """The table with marker columns, and the sums p, c, p_new over them."""
    w = quoted(weight).cast("double") if weight else F.lit(1.0)
    pos = F.coalesce(label_text(df, label) == F.lit(target), F.lit(False))
    fresh = pos if new is None else pos & F.coalesce(new, F.lit(False))
    zero = F.lit(0.0)
    marks = {"p": F.when(pos, w).otherwise(zero), "c": w, "p_new": F.when(fresh, w).otherwise(zero)}
    marked = df.withColumns({f"__{n}": e for n, e in marks.items()})
    return marked, {n: f"__{n}" for n in marks}


def _finish(cand: DataFrame) -> DataFrame:
    return cand.select("attr", "op", "cut", "value", "p", (F.col("c") - F.col("p")).alias("n"), "p_new")


def numeric_candidates(df, attrs, label, target, weight=None, new=None, buckets=None) -> DataFrame:
    """``a < cut`` and ``a >= cut`` for every midpoint between neighbouring distinct values."""
    bounds = value_buckets(df, attrs, buckets)
    marked, sums = _counts(df, label, target, weight, new)
    sums = value_sums(marked, attrs, [], sums, bounds)
    return _finish(split_candidates(sums, ["p", "c", "p_new"], two_level=any(bounds.values())))


def nominal_candidates(df, attrs, label, target, weight=None, new=None) -> DataFrame:
    """``a = {v}`` for every value: a plain aggregate, no window."""
    marked, sums = _counts(df, label, target, weight, new)
    sums = value_sums(marked, [], attrs, sums)
    cand = sums.select("attr", F.lit("eq").alias("op"), F.lit(None).cast("double").alias("cut"),
                       F.col("nom").alias("value"), "p", "c", "p_new")
    return _finish(cand)


def complement_candidates(df, attrs, label, target, weight=None, new=None) -> DataFrame:
    """``a = !{v}``: the attribute's total without the value; totals are one row per attribute."""
    marked, sums = _counts(df, label, target, weight, new)
    sums = value_sums(marked, [], attrs, sums)
    names = ["p", "c", "p_new"]
    totals = sums.groupBy("attr").agg(*[F.sum(n).alias(f"t_{n}") for n in names])
    cand = sums.join(totals, "attr").select(
        "attr", F.lit("ne").alias("op"), F.lit(None).cast("double").alias("cut"), F.col("nom").alias("value"),
        *[(F.col(f"t_{n}") - F.col(n)).alias(n) for n in names],
    )
    return _finish(cand)


def binned_candidates(df, cuts: Mapping[str, Sequence[float]], label, target, weight=None, new=None) -> DataFrame:
    """``a < cut`` / ``a >= cut`` at given cuts: after the aggregate only attributes x bins rows remain."""
    attrs = list(cuts)
    marked, sums = _counts(df, label, target, weight, new)
    base = marked.select(*[quoted(a).cast("double").alias(a) for a in attrs], *sums.values())
    cells = {f"__bin_{i}": a for i, a in enumerate(attrs)}
    base = bucketize(base, {c: list(cuts[a]) for c, a in cells.items()}, cells)
    sums = value_sums(base.select(*[F.col(c).alias(a) for c, a in cells.items()], *sums.values()), attrs, [], sums)
    cand = split_candidates(sums, ["p", "c", "p_new"], integral=True)
    values = F.map_from_arrays(
        F.array(*[F.lit(a) for a in attrs]),
        F.array(*[F.array(*[F.lit(float(x)) for x in cuts[a]]).cast("array<double>") for a in attrs]),
    )
    return _finish(cand.withColumn("cut", F.get(values[F.col("attr")], F.col("cut").cast("int") - 1)))


def candidate_filters(
    cand: DataFrame, p_all, n_all, min_new: float = 1.0, control_prior: bool = True
) -> DataFrame:
    """Keep candidates with enough new coverage and, if wanted, precision above the prior."""
    keep = F.col("p_new") >= F.lit(float(min_new))
    if control_prior:
        keep &= F.col("p") * (F.lit(float(p_all)) + F.lit(float(n_all))) > F.lit(float(p_all)) * (
            F.col("p") + F.col("n")
        )
    return cand.where(keep)


def best_condition(cand: DataFrame, measure, p_all, n_all, keys: Sequence[str] = ()) -> DataFrame:
    """The candidate of highest quality per key.  Ties: higher p, then attribute, op, cut, value."""
    score = quality(measure, F.col("p"), F.col("n"), F.lit(float(p_all)), F.lit(float(n_all)))
    return best_by_quality(cand.withColumn("quality", score), keys)


def best_by_quality(cand: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A hash aggregate (map-side combined), not a sort."""
    cols = [c for c in cand.columns if c not in keys]
    order = "struct(-quality, -p, attr, op, coalesce(cut, 0D), coalesce(value, ''))"
    good = cand.where("quality is not null and not isnan(quality)")
    best = good.groupBy(*keys).agg(F.expr(f"min_by(struct({', '.join(cols)}), {order}) as b"))
    return best.where("b is not null").select(*keys, "b.*")


def feature_kinds(df: DataFrame, attrs: Sequence[str]) -> tuple[list[str], list[str]]:
    kinds = attribute_types(df, attrs)
    return [a for a in attrs if kinds[a] == NUMERIC], [a for a in attrs if kinds[a] == NOMINAL]
