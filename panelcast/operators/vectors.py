"""Topic-vector operators on ``ARRAY<DOUBLE>`` columns.

Vectors stay one array column (DR3): row-wise statistics are higher-order functions evaluated in
the JVM, and the per-key mean is the ML ``Summarizer`` aggregate, which merges fixed-size partial
buffers map-side — a key holding a third of all vectors costs one buffer per task, never a list.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vector_mean_by_key(df: DataFrame, keys: list[str], vec: str = "vec") -> DataFrame:
    """A3: element-wise mean vector per key."""
    m = df.groupBy(*keys).agg(Summarizer.mean(array_to_vector(F.col(vec))).alias("_m"))
    return m.select(*keys, vector_to_array("_m").alias(vec))


def abs_sum(v) -> Column:
    """sum |x|."""
    return F.aggregate(_c(v), F.lit(0.0), lambda a, x: a + F.abs(x))


def abs_max(v) -> Column:
    return F.array_max(F.transform(_c(v), lambda x: F.abs(x)))


def abs_mean(v) -> Column:
    return F.try_divide(abs_sum(v), F.size(_c(v)).cast("double"))


def abs_std(v) -> Column:
    """sample standard deviation (ddof=1) of |x|; null for fewer than 2 elements."""
    n = F.size(_c(v)).cast("double")
    mean = abs_mean(v)
    ss = F.aggregate(_c(v), F.lit(0.0), lambda a, x: a + (F.abs(x) - mean) * (F.abs(x) - mean))
    return F.when(n > 1, F.sqrt(ss / (n - 1)))


def abs_entropy(v, eps: float = 1e-9) -> Column:
    """F16: -sum p ln(p + eps) with p = |x| / sum|x|; an all-zero vector gives 0."""
    s = abs_sum(v)
    ent = F.aggregate(_c(v), F.lit(0.0),
                      lambda a, x: a - (F.abs(x) / s) * F.ln(F.abs(x) / s + F.lit(eps)))
    return F.when(s > 0, ent).otherwise(F.lit(0.0))


def scale(v, factor) -> Column:
    """Multiply every element (e.g. by a decay factor)."""
    f = factor if isinstance(factor, Column) else F.lit(factor)
    return F.transform(_c(v), lambda x: x * f)
