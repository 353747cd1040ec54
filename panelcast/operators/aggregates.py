"""Roll-ups, profiles and matrix reshapes.

Every aggregate is a single hash aggregation with map-side partial combine; data-dependent
"small" tables (per-group means, medians) are joined back rather than evaluated as windows over a
whole group, so a group holding a third of the rows is still reduced per task before any shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.ranking import SALTS, exact_quantiles


def null_outside(c: str, lo: float | None = None, hi: float | None = None) -> Column:
    """Out-of-range -> NULL."""
    x = F.col(c)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (x < F.lit(lo))
    if hi is not None:
        bad = bad | (x > F.lit(hi))
    return F.when(bad, F.lit(None)).otherwise(x)


def group_mean_impute(df: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """Fill NULLs with the mean of their group (computed once per group, joined back).

    Only rows with a NULL meet the means; they are dealt over SALTS parts per group, so a group of any size spreads.
    Rows with a NULL key have no group and stay as they are.
    """
    means = df.groupBy(*keys).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols])
    missing = F.lit(False)
    for c in cols:
        missing = missing | F.col(c).isNull()
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    holes = df.filter(missing).withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    out = holes.join(means.withColumn("_salt", salts), [*keys, "_salt"], "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_m_{c}")))
    return df.filter(~missing).unionByName(out.select(*df.columns))


def median_impute(df: DataFrame, cols: list[str]) -> DataFrame:
    """P10: fill NULLs with the exact global median of each column (one-row broadcast)."""
    meds = None
    for c in cols:
        m = exact_quantiles(df, c, [0.5]).select(F.col("q_value").alias(f"_med_{c}"))
        meds = m if meds is None else meds.crossJoin(m)
    out = df.crossJoin(F.broadcast(meds))
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_med_{c}")))
    return out.drop(*[f"_med_{c}" for c in cols])


def daily_from_hourly(df: DataFrame, keys: list[str], hour: str, value: str) -> DataFrame:
    """A5: daily max / min / mean / sum (nulls skipped; sum of nothing = 0)."""
    return df.groupBy(*keys, F.to_date(hour).alias("day")).agg(
        F.max(value).alias("day_max"), F.min(value).alias("day_min"), F.avg(value).alias("day_mean"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias("day_sum"))


def share_percent(flag: Column) -> Column:
    """100 x share of rows where ``flag`` holds."""
    return F.avg(F.when(flag, F.lit(1.0)).otherwise(F.lit(0.0))) * F.lit(100.0)


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max]; the max lands in the last bin (numpy convention)."""
    b = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    x = df.filter(F.col(value).isNotNull()).crossJoin(F.broadcast(b))
    idx = F.least(F.floor((F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.lit(bins)),
                  F.lit(bins - 1)).cast("int")
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(idx)
    return x.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.first("_lo").alias("lo"),
                                           F.first("_hi").alias("hi"))


def pivot_wide(df: DataFrame, keys: list[str], pivot: str, values: list, agg: Column, prefix: str = "") -> DataFrame:
    """Pivot with an explicit value list (no extra job to discover values)."""
    out = df.groupBy(*keys).pivot(pivot, values).agg(agg)
    return out.withColumnsRenamed({str(v): f"{prefix}{v}" for v in values}) if prefix else out


def unpivot_long(df: DataFrame, keys: list[str], cols: list[str], var: str, val: str, drop_null: bool = True) -> DataFrame:
    """``stack`` a wide matrix to long form, dropping NULL cells."""
    out = df.unpivot(keys, cols, var, val)
    return out.filter(F.col(val).isNotNull()) if drop_null else out


def safe_corr(a, b) -> Column:
    """Pearson correlation over pairwise-complete rows, NULL (not an ANSI divide-by-zero error) for a
    constant column.  Central moments are updated row by row (no difference of large sums), so columns with a
    large mean and a small spread keep their digits."""
    a = (F.col(a) if isinstance(a, str) else a).cast("double")
    b = (F.col(b) if isinstance(b, str) else b).cast("double")
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def corr_matrix_vector(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson matrix of many dense columns with ``ml.stat.Correlation`` (one distributed Gramian;
    only the bounded len(cols) x len(cols) matrix reaches the driver).  Long output, a <= b; a
    constant column gives NULL."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    vec = VectorAssembler(inputCols=cols, outputCol="_v", handleInvalid="keep").transform(df.select(*cols))
    m = Correlation.corr(vec, "_v").first()[0].toArray()
    sd = df.agg(*[F.stddev_pop(c).alias(c) for c in cols]).first()
    const = {c for c in cols if not sd[c]}
    rows = []
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            v = float(m[i, j])
            bad = math.isnan(v) or a in const or cols[j] in const
            rows.append((a, cols[j], None if bad else v))
    return df.sparkSession.createDataFrame(rows, "a string, b string, corr double")


def kde_by_class(df: DataFrame, value: str, cls: str, points: list[float]) -> DataFrame:
    """Gaussian KDE with Scott's bandwidth per class, evaluated on fixed points in one pass.

    A class of equal values has bandwidth 0 and density NaN, a class of one value has neither (NULL).
    """
    stats = df.groupBy(cls).agg(F.count(value).alias("_n"), F.stddev_samp(value).alias("_sd"))
    x = df.join(stats, cls)  # one row per class; the planner broadcasts it if it is small
    # NaN, as 0 / 0 is: a division by 0 raises
    h = F.when(F.col("_sd") == 0, F.lit(float("nan"))).otherwise(F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
    k = [F.sum(F.exp(F.lit(-0.5) * F.pow((F.col(value) - F.lit(p)) / h, 2))).alias(f"p{i}")
         for i, p in enumerate(points)]
    agg = x.groupBy(cls, "_n", "_sd").agg(*k)
    long = agg.unpivot([cls, "_n", "_sd"], [f"p{i}" for i in range(len(points))], "pi", "ksum")
    pts = F.element_at(F.array(*[F.lit(float(p)) for p in points]), F.expr("int(substr(pi, 2)) + 1"))
    dens = F.col("ksum") / (F.col("_n") * h * F.lit(math.sqrt(2 * math.pi)))
    return long.select(cls, pts.alias("point"), dens.alias("density"))
