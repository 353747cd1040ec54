"""Schema alignment and coercing cleaners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaDrift(ValueError):
    """Raised by strict alignment when columns are missing or unexpected."""


def default_for(dt: T.DataType):
    if isinstance(dt, T.BooleanType):
        return False
    if isinstance(dt, T.StringType):
        return ""
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)):
        return 0
    return None


def schema_drift(df: DataFrame, target: T.StructType) -> tuple[list[str], list[str]]:
    """Q7: (missing, extra) column names of ``df`` against ``target``."""
    have, want = set(df.columns), [f.name for f in target.fields]
    return [c for c in want if c not in have], sorted(c for c in have if c not in set(want))


def align_to_schema(df: DataFrame, target: T.StructType, defaults: dict | None = None,
                    strict_extra: bool = False, strict_missing: bool = False) -> DataFrame:
    """Add missing columns with defaults, drop extras, order and coerce (``try_cast``) to ``target``.

    Failed coercions of numerics become the column default, as in the product's lenient path.
    """
    defaults = defaults or {}
    missing, extra = schema_drift(df, target)
    if strict_missing and missing:
        raise SchemaDrift(f"missing columns: {missing}")
    if strict_extra and extra:
        raise SchemaDrift(f"unexpected columns: {extra}")
    cols = []
    for f in target.fields:
        d = defaults.get(f.name, default_for(f.dataType))
        lit = F.lit(d).cast(f.dataType)
        if f.name in df.columns:
            cur = dict(df.dtypes)[f.name]
            src = F.col(f.name)
            val = src if cur == f.dataType.simpleString() else src.try_cast(f.dataType)
            cols.append(F.coalesce(val, lit).alias(f.name) if d is not None else val.alias(f.name))
        else:
            cols.append(lit.alias(f.name))
    return df.select(*cols)


def align_features(df: DataFrame, feature_names: list[str], keep: list[str] | None = None) -> DataFrame:
    """Model feature matrix — missing -> 0, +-inf/NaN -> 0, booleans -> 0/1, fixed order."""
    out = [F.col(k) for k in keep or []]
    types = dict(df.dtypes)
    for c in feature_names:
        if c not in types:
            out.append(F.lit(0.0).alias(c))
            continue
        x = F.col(c).cast("int").cast("double") if types[c] == "boolean" else F.col(c).try_cast("double")
        bad = x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf"))
        out.append(F.when(bad, F.lit(0.0)).otherwise(x).alias(c))
    return df.select(*out)


def none_string_to_null(c: str) -> Column:
    """The literal string "None" (and blanks) -> NULL."""
    x = F.trim(F.col(c))
    return F.when((x == "None") | (x == ""), F.lit(None)).otherwise(F.col(c))
