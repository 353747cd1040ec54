"""Per-entity time-series operators.

All features are evaluated per entity ordered by an integer hour index ``t`` on the dense
(entity, hour) backbone, so "k rows back" and "k hours back" coincide.

Scale design (DR1/DR2): every bounded-frame feature shares one window specification, so Spark plans
one exchange + one sort for the whole feature block.  With ``bucket_rows`` set, the window is keyed
by (entity, time bucket) instead of entity alone: each bucket also receives the last ``lead_in``
rows of the bucket before it, which makes every frame of at most ``lead_in`` rows exact, and the
copied rows are dropped afterwards.  A few entities (or one entity holding a third of all rows) then
still spread over many tasks.  Unbounded running state ("hours since last event", forward fill) is
carried across buckets through a small per-bucket aggregate (rows / bucket_rows), never by pulling
an entity into one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

B = "_bucket"
LEAD = "_lead_in"


def ewm_cutoff_rows(span: float, eps: float = 1e-17) -> int:
    """Rows after which an EWM weight (1-alpha)^k falls below ``eps`` (alpha = 2/(span+1))."""
    decay = 1.0 - 2.0 / (span + 1.0)
    return int(math.ceil(math.log(eps) / math.log(decay)))


def entity_window(entity: str = "entity_id", t: str = "t", bucketed: bool = False) -> WindowSpec:
    parts = [entity, B] if bucketed else [entity]
    return Window.partitionBy(*parts).orderBy(t)


def with_lead_in(df: DataFrame, t: str, bucket_rows: int, lead_in: int) -> DataFrame:
    """Assign time buckets; every row is emitted for its own bucket and for each later bucket that
    needs it as lead-in (b' * bucket_rows - t <= lead_in), flagged with ``_lead_in``.

    One generator over the input (no union, so the input plan is evaluated once); lead_in may exceed
    bucket_rows.
    """
    b = F.floor(F.col(t) / F.lit(bucket_rows))
    if lead_in == 0:
        return df.withColumn(B, b).withColumn(LEAD, F.lit(False))
    copies = F.floor((F.lit(lead_in) + F.pmod(F.col(t), F.lit(bucket_rows))) / F.lit(bucket_rows)).cast("int")
    x = df.withColumn("_j", F.explode(F.sequence(F.lit(0), copies)))
    return x.withColumn(B, b + F.col("_j")).withColumn(LEAD, F.col("_j") > 0).drop("_j")


def apply_windowed(df: DataFrame, features: Callable[[WindowSpec], list[Column]], entity: str = "entity_id",
                   t: str = "t", lead_in: int = 0, bucket_rows: int | None = None,
                   carry: DataFrame | None = None) -> DataFrame:
    """Evaluate ``features(w)`` (aliased window columns) in one window pass.

    ``carry`` — optional (entity, _bucket, ...) frame of cross-bucket state, joined before the pass.
    """
    if not bucket_rows:
        w = entity_window(entity, t)
        return df.select("*", *features(w))
    x = with_lead_in(df, t, bucket_rows, lead_in)
    if carry is not None:
        x = x.join(carry, [entity, B], "left")
    w = entity_window(entity, t, bucketed=True)
    out = x.select("*", *features(w)).filter(~F.col(LEAD)).drop(B, LEAD)
    if carry is not None:
        out = out.drop(*[c for c in carry.columns if c not in (entity, B)])
    return out


def running_carry(df: DataFrame, specs: dict[str, tuple[str, Column]], entity: str = "entity_id", t: str = "t",
                  bucket_rows: int = 1) -> DataFrame:
    """Per (entity, bucket): the max/min of ``expr`` over all earlier buckets (size rows / bucket_rows).

    Joined before an ``apply_windowed`` pass it lets unbounded running max/min features be evaluated in
    the same window as the bounded ones.
    """
    b = F.floor(F.col(t) / F.lit(bucket_rows))
    agg = {"max": F.max, "min": F.min}
    per = df.groupBy(F.col(entity), b.alias(B)).agg(*[agg[k](e).alias(f"_pb_{o}") for o, (k, e) in specs.items()])
    wb = Window.partitionBy(entity).orderBy(B).rowsBetween(Window.unboundedPreceding, -1)
    return per.select(entity, B, *[agg[k](F.col(f"_pb_{o}")).over(wb).alias(o) for o, (k, _) in specs.items()])


def hours_since_in_window(y: str, t: str, w: WindowSpec, carry_last: str | None = None,
                          carry_first: str | None = None) -> Column:
    """W6 inside a window pass: t - (last event strictly before + 1), or t - first row of the entity."""
    ev = F.when(F.col(y) == 1, F.col(t))
    prev = w.rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(ev).over(prev)
    first = F.min(F.col(t)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    if carry_last:
        last = F.greatest(last, F.col(carry_last))
        first = F.least(first, F.col(carry_first))
    return (F.col(t) - F.coalesce(last + 1, first)).cast("double")


# ---------------------------------------------------------------- bounded-frame features

def lag_fill(c: str, k: int, w: WindowSpec, fill=0) -> Column:
    """``shift(k)`` with null -> fill."""
    return F.coalesce(F.lag(F.col(c), k).over(w), F.lit(fill))


def rolling_sum_prev(c: str, n: int, w: WindowSpec) -> Column:
    """``shift(1).rolling(n, min_periods=1).sum()`` -> 0 when empty."""
    return F.coalesce(F.sum(F.col(c)).over(w.rowsBetween(-n, -1)), F.lit(0)).cast("double")


def diff_fill(c: str, k: int, w: WindowSpec) -> Column:
    """``x.diff(k)`` with null -> 0."""
    return F.coalesce(F.col(c) - F.lag(F.col(c), k).over(w), F.lit(0.0)).cast("double")


def rolling_zscore(c: str, n: int, w: WindowSpec, eps: float = 1e-9) -> Column:
    """(x - mean) / (sample std + eps) over the last n rows incl. current; null -> 0."""
    frame = w.rowsBetween(-(n - 1), 0)
    z = (F.col(c) - F.avg(F.col(c)).over(frame)) / (F.stddev_samp(F.col(c)).over(frame) + F.lit(eps))
    return F.coalesce(z, F.lit(0.0))


def ewm_mean(c: str, span: float, w: WindowSpec, shifted: bool, eps: float = 1e-17) -> Column:
    """Pandas ``ewm(span, adjust=True).mean()`` (optionally on ``shift(1)``), null -> 0.

    y_t = sum_i (1-a)^i x_{t-i} / sum_i (1-a)^i.  Evaluated as a fold over a bounded frame whose
    length is where the weights fall below ``eps`` — exact to double precision, linear in rows.
    Inputs must be non-null (the panel fills them), as in the source series.
    """
    k = ewm_cutoff_rows(span, eps)
    decay = 1.0 - 2.0 / (span + 1.0)
    hi = -1 if shifted else 0
    xs = F.collect_list(F.col(c).cast("double")).over(w.rowsBetween(-k, hi))
    init = F.struct(F.lit(0.0).alias("num"), F.lit(0.0).alias("den"))
    acc = F.aggregate(xs, init, lambda a, x: F.struct((a["num"] * F.lit(decay) + x).alias("num"),
                                                      (a["den"] * F.lit(decay) + F.lit(1.0)).alias("den")))
    return F.coalesce(F.try_divide(acc["num"], acc["den"]), F.lit(0.0))


def ewm_max_bucket(span: float, lead_in: int, max_log: float = 600.0) -> int:
    """Largest bucket for :func:`ewm_mean_bucketed` keeping (1/decay)^(bucket + lead_in) inside double range."""
    decay = 1.0 - 2.0 / (span + 1.0)
    return max(1, int(max_log / -math.log(decay)) - lead_in)


def ewm_mean_bucketed(c: str, span: float, w: WindowSpec, t: str, bucket_rows: int, lead_in: int,
                      shifted: bool) -> Column:
    """W9 in linear time inside a bucketed window (same result as :func:`ewm_mean`).

    With base = first position of the bucket's lead-in, y_t = sum r^(t-s) x_s / sum r^(t-s) is
    r^(t-base) * S_t / (r^(t-base) * Q_t) where S_t, Q_t are running sums of r^-(s-base) x_s and r^-(s-base):
    O(1) per row, no per-row arrays.  Terms older than the lead-in weigh below the EWM cut-off.
    """
    decay = 1.0 - 2.0 / (span + 1.0)
    base = F.col(B) * F.lit(bucket_rows) - F.lit(lead_in)
    u = (F.col(t) - base).cast("double")
    inv = F.pow(F.lit(1.0 / decay), u)
    frame = w.rowsBetween(Window.unboundedPreceding, -1 if shifted else 0)
    num = F.sum(F.col(c).cast("double") * inv).over(frame)
    den = F.sum(inv).over(frame)
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


# ---------------------------------------------------------------- unbounded running state

def hours_since_last_event(df: DataFrame, y: str = "y", entity: str = "entity_id", t: str = "t",
                           out: str = "hours_since_last", bucket_rows: int | None = None) -> DataFrame:
    """Gaps-and-islands count of rows since the row after the last event.

    Equals ``s = shift(y,1,0); g = cumsum(s); cumcount within g``: rows before any event count from
    the entity's first row; the row right after an event is 0.  Expressed as a running max of the
    event position strictly before the row (a prefix scan with cross-bucket carry), so it needs
    neither a second window keyed by island nor a whole entity in one task.
    """
    x = prefix_scan(df, {"_last_ev": ("max", F.when(F.col(y) == 1, F.col(t))),
                         "_first_t": ("min", F.col(t))}, entity, t, inclusive=False, bucket_rows=bucket_rows)
    start = F.coalesce(F.col("_last_ev") + 1, F.col("_first_t"), F.col(t))
    return x.withColumn(out, (F.col(t) - start).cast("double")).drop("_last_ev", "_first_t")


def last_row_per_entity(df: DataFrame, entity: str, order: str, cols: list[str]) -> DataFrame:
    """The latest row of each entity as a grouped ``max_by`` (partial aggregation, no sort)."""
    packed = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(order))
    return df.groupBy(entity).agg(F.max(order).alias(order), packed.alias("_s")).select(entity, order, "_s.*")


def last_non_null_per_entity(df: DataFrame, entity: str, order: str, cols: list[str]) -> DataFrame:
    """W13 (``groupby.last()``): last non-null value of each column independently."""
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in cols]
    return df.groupBy(entity).agg(*aggs)


def family_shift(df: DataFrame, shifts: dict[str, int], entity: str = "entity_id", t: str = "t",
                 bucket_rows: int | None = None) -> DataFrame:
    """Leak-free shift of whole column families in a single window pass.

    ``shifts`` maps column -> rows.  Numeric nulls become 0, booleans False, arrays stay NULL-free by
    substituting an all-zero array of the same length.
    """
    dtypes = dict(df.dtypes)
    lead = max(shifts.values()) if shifts else 0

    def feats(w):
        out = []
        for c, k in shifts.items():
            dt = dtypes[c]
            if dt == "boolean":
                fill = F.lit(False)
            elif dt.startswith("array"):
                fill = F.transform(F.col(c), lambda _: F.lit(0.0))
            else:
                fill = F.lit(0).cast(dt)
            out.append(F.coalesce(F.lag(F.col(c), k).over(w), fill).alias(f"__s_{c}"))
        return out

    shifted = apply_windowed(df, feats, entity, t, lead_in=lead, bucket_rows=bucket_rows)
    for c in shifts:
        shifted = shifted.withColumn(c, F.col(f"__s_{c}")).drop(f"__s_{c}")
    return shifted


# ---------------------------------------------------------------- generic prefix scan with carry

_WITHIN = {
    "max": lambda e, w: F.max(e).over(w),
    "min": lambda e, w: F.min(e).over(w),
    "sum": lambda e, w: F.sum(e).over(w),
}


def prefix_scan(df: DataFrame, specs: dict[str, tuple[str, Column]], entity: str | list[str] = "entity_id",
                t: str = "t", inclusive: bool = False, bucket_rows: int | None = None,
                order: list[str] | None = None) -> DataFrame:
    """Running aggregates per entity ordered by ``t`` (rows strictly before, or up to and incl.).

    ``specs`` maps output -> (kind, expr) with kind in {max, min, sum, last}; ``last`` is the last
    non-null value (forward fill).  With ``bucket_rows`` the scan runs per (entity, time bucket) and a
    per-bucket aggregate (rows / bucket_rows in size) carries state across buckets, so no task ever
    holds a whole entity.  ``order`` adds tie-break columns after ``t``.
    """
    keys = [entity] if isinstance(entity, str) else list(entity)
    ordering = [t] + list(order or [])
    hi = 0 if inclusive else -1

    def within(kind, e, w):
        if kind == "last":
            return F.last(e, ignorenulls=True).over(w)
        return _WITHIN[kind](e, w)

    if not bucket_rows:
        w = Window.partitionBy(*keys).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, hi)
        return df.select("*", *[within(k, e, w).alias(o) for o, (k, e) in specs.items()])

    b = F.floor(F.col(t) / F.lit(bucket_rows))
    x = df.withColumn(B, b)
    pos = F.struct(*[F.col(c) for c in ordering])
    per = []
    for o, (k, e) in specs.items():
        if k == "last":
            per.append(F.max_by(e, F.when(e.isNotNull(), pos)).alias(f"_pb_{o}"))
        else:
            per.append({"max": F.max, "min": F.min, "sum": F.sum}[k](e).alias(f"_pb_{o}"))
    pb = x.groupBy(*keys, B).agg(*per)
    wb = Window.partitionBy(*keys).orderBy(B).rowsBetween(Window.unboundedPreceding, -1)
    carry = pb.select(*keys, B, *[
        (F.last(F.col(f"_pb_{o}"), ignorenulls=True) if k == "last" else
         {"max": F.max, "min": F.min, "sum": F.sum}[k](F.col(f"_pb_{o}"))).over(wb).alias(f"_c_{o}")
        for o, (k, _) in specs.items()])
    x = x.join(carry, keys + [B], "left")
    w = Window.partitionBy(*keys, B).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, hi)
    cols = []
    for o, (k, e) in specs.items():
        inner, c = within(k, e, w), F.col(f"_c_{o}")
        if k == "max":
            v = F.greatest(inner, c)
        elif k == "min":
            v = F.least(inner, c)
        elif k == "sum":
            v = F.when(inner.isNull() & c.isNull(), F.lit(None)).otherwise(
                F.coalesce(inner, F.lit(0)) + F.coalesce(c, F.lit(0)))
        else:
            v = F.coalesce(inner, c)
        cols.append(v.alias(o))
    return x.select(*[c for c in df.columns], *cols)
