"""Column roles: which columns are features, label, survival time, contrast group and weight."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premisa.functions.premise import nominal, quoted

NUMERIC, NOMINAL = "numeric", "nominal"


class RoleError(ValueError):
    """A column does not fit the role it was given."""


class NotFittedError(RuntimeError):
    """A model was used before fit."""


@dataclass(frozen=True)
class Roles:
    label: str
    features: tuple[str, ...]
    survival_time: str | None = None
    contrast: str | None = None
    weight: str | None = None

    @property
    def columns(self) -> list[str]:
        own = [self.label, self.survival_time, self.contrast, self.weight]
        return list(dict.fromkeys([*self.features, *[c for c in own if c]]))


def attribute_type(field: T.StructField) -> str:
    """Numbers are numeric, strings and booleans nominal; other types must be projected first."""
    if isinstance(field.dataType, T.NumericType):
        return NUMERIC
    if isinstance(field.dataType, (T.StringType, T.BooleanType)):
        return NOMINAL
    raise RoleError(
        f"column {field.name!r} has type {field.dataType.simpleString()}; "
        "project it to a number or a string first"
    )


def attribute_types(df: DataFrame, attrs=None) -> dict[str, str]:
    return {a: attribute_type(df.schema[a]) for a in (attrs or df.columns)}


def validate_roles(
    df: DataFrame,
    problem: str,
    label: str,
    survival_time: str | None = None,
    contrast: str | None = None,
    weight: str | None = None,
    features=None,
) -> Roles:
    """Check the roles against the schema alone (no job) and return them."""
    for c in [label, survival_time, contrast, weight, *(features or [])]:
        if c is not None and c not in df.columns:
            raise RoleError(f"no column {c!r}")
    special = {label, survival_time, contrast, weight}
    chosen = tuple(features) if features else tuple(c for c in df.columns if c not in special)
    if not chosen:
        raise RoleError("no feature columns")
    for c in chosen:
        if c in special:
            raise RoleError(f"column {c!r} is both a feature and a role column")
        attribute_type(df.schema[c])
    if problem == "survival":
        if survival_time is None:
            raise RoleError("survival problems need the name of the survival time column")
        if attribute_type(df.schema[survival_time]) != NUMERIC:
            raise RoleError(f"survival time {survival_time!r} must be numeric")
    if problem == "regression" and attribute_type(df.schema[label]) != NUMERIC:
        raise RoleError(f"regression label {label!r} must be numeric")
    if contrast is not None and attribute_type(df.schema[contrast]) != NOMINAL:
        raise RoleError(f"contrast attribute {contrast!r} must be nominal")
    if weight is not None and attribute_type(df.schema[weight]) != NUMERIC:
        raise RoleError(f"weight {weight!r} must be numeric")
    return Roles(label, chosen, survival_time, contrast, weight)


def _clean(df: DataFrame, name: str) -> Column:
    """One feature in its canonical form: double without NaN, or string without '?'."""
    field = df.schema[name]
    if attribute_type(field) == NOMINAL:
        return F.nullif(nominal(name, df.schema), F.lit("?")).alias(name)
    c = quoted(name).cast("double")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        c = F.when(~F.isnan(c), c)
    return c.alias(name)


def normalise_missing(df: DataFrame, attrs=None) -> DataFrame:
    """NaN and '?' become null; types that are neither numeric nor nominal pass unchanged."""
    attrs = set(attrs or df.columns)

    def fix(f):
        if f.name not in attrs:
            return quoted(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(quoted(f.name)), quoted(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType):
            return F.nullif(quoted(f.name), F.lit("?")).alias(f.name)
        return quoted(f.name)

    return df.select(*[fix(f) for f in df.schema])


def label_text(df: DataFrame, label: str) -> Column:
    """The label as text: booleans read True/False, binary labels are UTF-8."""
    if isinstance(df.schema[label].dataType, T.BinaryType):
        return F.decode(quoted(label), "UTF-8")
    return nominal(label, df.schema).cast("string")


def class_text(df: DataFrame, label: str, value: Column) -> Column:
    """A predicted class in the text form of the label: 1.0 reads 1 for an integer label, booleans read True/False."""
    kind = df.schema[label].dataType
    if isinstance(kind, (T.BinaryType, T.StringType)):
        return value.cast("string")
    if isinstance(kind, T.BooleanType):
        flag = value.cast("string").cast("boolean")
        return F.when(flag, F.lit("True")).when(~flag, F.lit("False"))
    return value.cast(kind).cast("string")


def example_set(
    df: DataFrame,
    label: str,
    survival_time: str | None = None,
    contrast: str | None = None,
    weight: str | None = None,
    features=None,
    key=None,
) -> DataFrame:
    """Canonical table: cleaned features, text label, numeric time, weight, optional key columns."""
    special = {label, survival_time, contrast, weight, *(key or [])}
    names = list(features) if features else [c for c in df.columns if c not in special]
    cols = [*(quoted(k) for k in key or []), *(_clean(df, a) for a in names)]
    if survival_time is not None:
        cols.append(quoted(survival_time).cast("double").alias(survival_time))
    if contrast is not None:
        cols.append(nominal(contrast, df.schema).alias(contrast))
    if weight is not None:
        cols.append(quoted(weight).cast("double").alias(weight))
    return df.select(*cols, label_text(df, label).alias(label))


def explode_features(df: DataFrame, array_col: str, size: int, keep=()) -> DataFrame:
    """An array column of known size as columns att1..attN."""
    return df.select(
        *[quoted(k) for k in keep],
        *[F.get(quoted(array_col), i).cast("double").alias(f"att{i + 1}") for i in range(size)],
    )


def label_domain(df: DataFrame, label: str, order_key: Column) -> DataFrame:
    """Class labels with their rank of first appearance under an explicit order key."""
    firsts = df.groupBy(label_text(df, label).alias("class_label")).agg(
        F.min(order_key).alias("first_key"), F.count(F.lit(1)).alias("n_rows")
    )
    # One row per class remains: the ranking window is over that small result.
    return firsts.select(
        "class_label", "n_rows", F.row_number().over(Window.orderBy("first_key", "class_label")).alias("class_rank")
    )


def dataset_profile(df: DataFrame, attrs=None) -> DataFrame:
    """One row per column: rows, missing, mean, std, min, max.

    One scan with a single wide aggregate; the reshaping works on its one result row.
    """
    types = attribute_types(df, attrs)
    aggs, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, (a, kind) in enumerate(types.items()):
        c = _clean(df, a)
        aggs.append(F.count(c).alias(f"c{i}"))
        if kind == NUMERIC:
            aggs += [F.avg(c).alias(f"m{i}"), F.stddev(c).alias(f"s{i}"), F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}")]
        stats = [F.col(f"{x}{i}") if kind == NUMERIC else F.lit(None).cast("double") for x in "mslh"]
        rows.append(
            F.struct(
                F.lit(a).alias("attr"),
                F.lit(kind).alias("kind"),
                F.col("rows").alias("n_rows"),
                (F.col("rows") - F.col(f"c{i}")).alias("n_missing"),
                *[s.alias(x) for s, x in zip(stats, ("mean_value", "std_value", "min_value", "max_value"))],
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))
