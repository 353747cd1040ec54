"""Code maps, keyword classes and bands (F11, F18, F22, F24, P15) as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values that must equal the product's definitions -----------------------------------
# F18 ordered keyword classes (first match wins): Snow > Rain > Overcast/cloudy > Clear > Fog > Other
CONDITION_KEYWORDS = [("Snow", ["Snow"]), ("Rain", ["Rain"]), ("Cloudy", ["Overcast", "cloudy"]),
                      ("Clear", ["Clear"]), ("Fog", ["Fog"])]
CONDITION_OTHER = "Other"
# F22 weather-code -> condition flags; two published maps differ only in code 1
CODE_MAP_PATCH = {"Clear": [0], "Cloudy": [1, 2, 3, 45, 48], "Snow": [71, 73, 75, 77, 85, 86],
                  "Rain": [51, 53, 55, 56, 57, 61, 63, 65, 66, 67, 80, 81, 82, 95, 96, 99]}
CODE_MAP_LIVE = {"Clear": [0, 1], "Cloudy": [2, 3, 45, 48], "Snow": [71, 73, 75, 77, 85, 86],
                 "Rain": [51, 53, 55, 56, 57, 61, 63, 65, 66, 67, 80, 81, 82, 95, 96, 99]}
# F24 risk-band upper bounds (probability), then the top band; null -> no-data
RISK_BOUNDS = [0.2, 0.35, 0.5, 0.65, 0.8]
RISK_BANDS = ["very_low", "low", "moderate", "elevated", "high", "very_high"]
RISK_NO_DATA = "no_data"
# F11 moon phase: reference new moon 2000-01-06 18:14 UTC, synodic month in days, evaluated at 12:00 UTC
NEW_MOON_REF = "2000-01-06 18:14:00"
SYNODIC_MONTH = 29.53058867
# F12 W/m2 over one hour -> MJ/m2
WM2_TO_MJ = 0.0036
# -----------------------------------------------------------------------------------------------


def classify_condition(text: Column) -> Column:
    """ordered keyword classification (case-sensitive substring tests)."""
    expr = F.lit(CONDITION_OTHER)
    for label, words in reversed(CONDITION_KEYWORDS):
        hit = None
        for w in words:
            h = text.contains(w)
            hit = h if hit is None else (hit | h)
        expr = F.when(hit, F.lit(label)).otherwise(expr)
    return expr


def code_flags(code: Column, mapping: dict[str, list[int]] = CODE_MAP_PATCH, prefix: str = "cond_") -> list[Column]:
    """one boolean flag per condition class."""
    return [F.coalesce(code.isin(*vals), F.lit(False)).alias(f"{prefix}{name}") for name, vals in mapping.items()]


def one_hot(c: Column, levels: list[str], prefix: str) -> list[Column]:
    """``get_dummies`` with explicit levels (no data-dependent schema)."""
    return [F.coalesce(c == F.lit(v), F.lit(False)).alias(f"{prefix}{v}") for v in levels]


def risk_band(p: Column) -> Column:
    """probability -> band label."""
    expr = F.lit(RISK_BANDS[-1])
    for bound, label in reversed(list(zip(RISK_BOUNDS, RISK_BANDS[:-1]))):
        expr = F.when(p < F.lit(bound), F.lit(label)).otherwise(expr)
    return F.when(p.isNull(), F.lit(RISK_NO_DATA)).otherwise(expr)


def moon_phase(day: Column) -> Column:
    """fraction of the synodic month at 12:00 UTC of ``day``, 2 decimals (half-even like Python)."""
    noon = F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), F.lit(12), F.lit(0), F.lit(0))
    secs = F.timestamp_diff("SECOND", F.lit(NEW_MOON_REF).cast("timestamp_ntz"), noon)
    days = secs / F.lit(86400.0)
    return F.bround(F.pmod(days, F.lit(SYNODIC_MONTH)) / F.lit(SYNODIC_MONTH), 2)
