"""Quality rules with risk-controlled cutoffs.

Row-local counts (:func:`quality_counts`) feed ratio signals.  :func:`select_cutoffs` picks, per stratum and signal,
the cutoff that rejects most while an exact binomial (Clopper-Pearson) bound on the labelled good holdout keeps the
false-rejection rate below ``alpha``: every (stratum, signal, cutoff) is one test, and the confidence is divided by
the number of tests (Bonferroni), so all chosen cutoffs hold together with probability ``1 - delta``.  A stratum with
too few labels gets no cutoff and rejects nothing.  Cutoffs come from a fixed grid, not from the data under test.

Edge cases: a null or empty text has no words, all counts 0 and fails the base rules; a null stratum is a stratum of
its own; repeated rows are counted and judged one by one; unlabelled rows and labels without a row don't count; extra
columns pass through, and one that is named like a result column is replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import (append_columns, boxed, mix, per_text, raw, slices, table, texts_of, valid_windows,
                                  window_hashes, word_bounds, word_hashes)
from panelcast.llm.registry import query
from panelcast.session import materialize

COUNTS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
ALPHA = 0.02
DELTA = 0.05
GRID = 50
_SPACE = " \t\n\x0b\x0c\r"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_IS_SEP = np.zeros(256, bool)
_IS_SEP[[ord(c) for c in _SPACE]] = True


def repeated_words(words: np.ndarray, offsets: np.ndarray, k: int = REPEAT_WINDOW) -> np.ndarray:
    """Per text, words inside a ``k``-word window that occurs twice or more in that text."""
    valid = valid_windows(offsets, k)
    starts = np.flatnonzero(valid)
    if not len(starts):
        return np.zeros(len(offsets) - 1, np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(offsets))[starts]
    keys = mix(window_hashes(words, k)[starts] + mix(doc + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(starts), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts[twice], 1)
    np.add.at(edge, starts[twice] + k, -1)
    return per_text(np.cumsum(edge)[:-1] > 0, offsets)


def duplicate_lines(text: str) -> tuple[int, int]:
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    return len(lines), len(lines) - len(set(lines))


def quality_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the columns of ``COUNTS``; one pass over the text, no shuffle."""

    def counts(batch):
        data, offsets = raw(batch.column(text_col))
        parts = []
        for i, j in slices(offsets):
            d, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            starts, ends, words = word_bounds(d, o)
            letters = per_text(~_IS_SEP[d] & ((d & 0xC0) != 0x80), o)
            parts.append((np.diff(words), letters, per_text(_IS_SYMBOL[d], o),
                          repeated_words(word_hashes(d, starts, ends), words)))
        n, letters, symbols, repeats = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 4
        lines = np.array([duplicate_lines(t) for t in texts_of(batch.column(text_col))], np.int64).reshape(-1, 2)
        return [n, letters, symbols, lines[:, 0], lines[:, 1], repeats]

    return append_columns(df, COUNTS, counts)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _signals() -> dict[str, Column]:
    """Each in 0..1, higher is worse."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    mean = F.col("word_chars") / words
    return {
        "symbols": F.least(F.lit(1.0), F.col("n_symbols") / words),
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / words,
        "long_words": F.least(F.lit(1.0), mean / 20),
        "short_words": F.greatest(F.lit(0.0), 1 - mean / 10),
    }


def upper_bound(failures: int, n: int, confidence: float) -> float:
    """Exact binomial (Clopper-Pearson) upper bound of a rate after ``failures`` in ``n`` trials."""
    if n == 0 or failures >= n:
        return 1.0

    def at_most(p: float) -> float:
        if p <= 0 or p >= 1:
            return 1.0 if p <= 0 else 0.0
        k = np.arange(failures + 1)
        logs = (math.lgamma(n + 1) - _LGAMMA(k + 1) - _LGAMMA(n - k + 1)) + k * math.log(p) + (n - k) * math.log1p(-p)
        top = logs.max()
        return float(math.exp(top) * np.exp(logs - top).sum())

    low, high = failures / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        low, high = (p, high) if at_most(p) > 1 - confidence else (low, p)
    return high


_LGAMMA = np.vectorize(math.lgamma, otypes=[float])


def _cutoffs_of(pdf: pd.DataFrame, tests: int, n_signals: int, alpha: float, delta: float) -> list[dict]:
    """For one stratum's histogram (signal, bin, good, bad): the lowest safe cutoff of each signal."""
    found = []
    good_all, bad_all = pdf.n_good.iloc[0], pdf.n_bad.iloc[0]
    for signal, part in pdf.groupby("signal"):
        good, bad = np.zeros(GRID + 1, np.int64), np.zeros(GRID + 1, np.int64)
        good[part.bin], bad[part.bin] = part.good, part.bad
        above_good, above_bad = np.cumsum(good[::-1])[::-1], np.cumsum(bad[::-1])[::-1]
        best = None
        for b in range(GRID, 0, -1):  # rejecting bins >= b; the bound grows as b falls
            if upper_bound(int(above_good[b]), int(good_all), 1 - delta / tests) > alpha / n_signals:
                break
            best = b
        if best is not None and bad_all and above_bad[best] / bad_all > above_good[best] / max(good_all, 1):
            found.append({"signal": signal, "bin": best})
    return found


def select_cutoffs(labelled: DataFrame, stratum: str, good: Column, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum: ``_stratum`` and, per signal, the lowest rejected bin (null: the signal rejects nothing)."""
    signals = _signals()
    rows = labelled.select(F.coalesce(F.concat(F.lit("="), F.col(stratum)), F.lit("")).alias("_stratum"),
                           good.cast("int").alias("good"),
                           F.explode(F.array(*[F.struct(F.lit(k).alias("signal"), F.floor(v * GRID).cast("int").alias("bin"))
                                               for k, v in signals.items()])).alias("x")).filter("good IS NOT NULL")
    hist = rows.groupBy("_stratum", "x.signal", "x.bin").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    hist = materialize(hist, "quality-hist")
    size = hist.groupBy("_stratum").agg((F.sum("good") / len(signals)).cast("long").alias("n_good"),
                                        (F.sum("bad") / len(signals)).cast("long").alias("n_bad"))
    names = list(signals)
    tests = max(1, size.count()) * len(names) * GRID

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        row = {f"_cut_{k}": None for k in names}
        row |= {f"_cut_{x['signal']}": x["bin"] for x in _cutoffs_of(pdf, tests, len(names), alpha, delta)}
        return pd.DataFrame([{"_stratum": pdf["_stratum"].iloc[0], **row}])

    schema = "_stratum string, " + ", ".join(f"_cut_{k} int" for k in signals)
    return hist.join(size, "_stratum").groupBy("_stratum").applyInPandas(choose, schema)


def apply_rules(df: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """``df`` (with counts) plus ``base_failed`` and ``kept``."""
    rejected = F.lit(False)
    for k, v in _signals().items():
        rejected = rejected | F.coalesce(F.floor(v * GRID) >= F.col(f"_cut_{k}"), F.lit(False))
    counts = [c.split()[0] for c in COUNTS.split(", ")]
    key = F.coalesce(F.concat(F.lit("="), F.col(stratum)), F.lit("")).alias("_stratum")
    joined = df.select(boxed(df, "base_failed", "kept"), key, *counts).join(cutoffs, "_stratum", "left")
    failed = base_failed()
    return joined.select("row.*", failed.alias("base_failed"), (~failed & ~rejected).alias("kept"))


@query("op9_quality_rules")
def op9_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    counts = materialize(quality_counts(docs).drop("text"), "quality-counts")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    labelled = counts.filter(~base_failed()).join(labels, "doc_id")
    cutoffs = materialize(select_cutoffs(labelled, "lang", F.col("quality") == 1), "quality-cutoffs")
    out = apply_rules(counts, cutoffs, "lang")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
