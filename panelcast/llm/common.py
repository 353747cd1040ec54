"""Shared pieces of the training-data operators: reading, row-local Arrow columns, word and window hashing.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``.  Hashing is vectorised over the bytes of a whole
batch: one prefix sum of ``table[byte] * r**position`` (mod 2**64) gives every word's hash, whatever the text sizes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

WORD = r"[^\x20\x09-\x0D]+"
#: Texts are hashed in slices of about so many bytes, which bounds the temporary arrays (about 40 bytes per byte).
SLICE_BYTES = 2 << 20
_IS_SEP = np.zeros(256, dtype=bool)
_IS_SEP[[0x20, *range(0x09, 0x0E)]] = True
_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns called like one of ``names`` (any case): an operator's result columns win."""
    low = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in low])


def boxed(df: DataFrame, *results: str):
    """The columns of ``df`` but for ``results`` as one struct ``row``: an operator's own columns can't clash with them."""
    kept = without(df, *results)
    return F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row")


def append_columns(df: DataFrame, schema: str | T.StructType, fn: Callable[[pa.RecordBatch], list],
                   at_most: int | None = None) -> DataFrame:
    """Row-local operator: all columns of ``df`` plus those of ``schema``, which ``fn`` makes for each Arrow batch, or for each
    ``at_most`` rows of it, which bounds what a worker holds beside the batch.

    Input columns named like a result column are replaced.
    """
    extra = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    kept = without(df, *extra.names)
    out = T.StructType([*kept.schema.fields, *extra.fields])
    positions = [i for i, c in enumerate(df.columns) if c in kept.columns]
    arrow = to_arrow_schema(extra)
    types = [f.type for f in arrow]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, at_most) for b in batches for i in range(0, max(b.num_rows, 1), at_most or max(b.num_rows, 1))):
            made = fn(batch)
            arrays = [batch.column(i) for i in positions] + [pa.array(x, type=t) for x, t in zip(made, types)]
            names = [batch.schema.names[i] for i in positions] + list(arrow.names)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, out)


def texts_of(column) -> list[str]:
    """Python strings of an Arrow column; null counts as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def raw(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after another, and the n + 1 offsets; null counts as empty."""
    arr = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.array([], type=pa.large_string())
    arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes each (a longer text alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits (wraps mod 2**64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=4)
def _constants(seed: int):
    rng = np.random.default_rng(seed)
    byte = rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
    window = rng.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
    return byte, window


_POWERS: dict[str, np.ndarray] = {}
_R = 0x9E3779B97F4A7C15
_R_INV = pow(_R, -1, 2**64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n + 1:
        size = max(n + 1, SLICE_BYTES + 1)
        for k, r in (("up", _R), ("down", _R_INV)):
            steps = np.full(size, r, dtype=np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the n + 1 word offsets of the texts."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    sep = _IS_SEP[data]
    first, last = ~sep, ~sep
    first[1:] &= sep[:-1]
    last[:-1] &= sep[1:]
    full = offsets[1:] > offsets[:-1]
    a, b = offsets[:-1][full], offsets[1:][full] - 1
    first[a] = ~sep[a]
    last[b] = ~sep[b]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hash of every word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    byte, _ = _constants(seed)
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Hash of the ``k`` words that start at each position; positions within ``k`` of the array's end are left out."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    _, c = _constants(seed)
    n = len(words) - k + 1
    total = words[:n] * c[0]
    for j in range(1, k):
        total += words[j : j + n] * c[j]
    return mix(total)


def valid_windows(word_offsets: np.ndarray, k: int) -> np.ndarray:
    """True for the word positions at which a window of ``k`` words of the same text starts (all positions but the last k - 1)."""
    n = int(word_offsets[-1])
    if n < k:
        return np.zeros(0, bool)
    counts = np.diff(word_offsets)
    end = np.repeat(word_offsets[1:], counts)
    return (np.arange(n) + k <= end)[: n - k + 1]


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive ``offsets``."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]
