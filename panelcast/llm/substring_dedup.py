"""Substring deduplication with fixed-block anchors.

A window of ``k`` words of a later document goes if an earlier document has the same window.  Any ``k`` words hold one
whole block of the earlier document's non-overlapping blocks of ``(k + 1) // 2`` words, so:

1. every chunk of documents sends, per hash bucket, the hashes of all its rolling blocks (probes), with a bit for
   those that are reference blocks (the index) and a bit for those that two of its documents share;
2. a bucket answers each chunk with the blocks that are indexed and occur in another document (anchors);
3. a chunk extends its anchors to the ``k``-word windows around them and sends those windows' hashes;
4. a bucket answers with the windows that an earlier chunk has (or that the chunk itself has more than once), and the
   chunk removes the words of the maximal runs of such windows.

Hashes travel as sorted, delta-coded arrays, a row per chunk and bucket: a passage that a third of all documents share
costs a bucket one value per chunk.  Chunks are ranges of ids, so "earlier" needs no document ids in the messages.  A
chunk of more than ``chunk_bytes`` (large texts, or many rows of a null or equal id) is split at random into parts, which
are written, so that all passes see the same; their window messages carry the lowest id's place in the range (``low``),
and a bucket answers with the lowest of all parts: parts of the same id are equal, not earlier.

Edge cases: null or empty text has no words; fewer than ``k`` words never match; documents of the same id don't affect
each other; a null id counts as later than all others (and as equal to other nulls); extra columns are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import raw, slices, table, valid_windows, window_hashes, word_bounds, word_hashes
from panelcast.llm.registry import query
from panelcast.session import materialize

WINDOW = 13
CHUNK_IDS = 512
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
PARTITION_BYTES = 24 << 20
#: Block hashes keep so many bits; windows keep all 64.
ANCHOR_BITS = 44
_LAST = np.iinfo(np.int64).max
_MESSAGE = "bucket long, chunk long, part long, n long, vals binary, aligned binary, multi binary, low binary"
_ANSWER = "chunk long, part long, n long, vals binary, earlier binary, low binary"
_RESULT = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<first:long,last:long>>"


def pack(sorted_values: np.ndarray) -> bytes:
    """Sorted unsigned values as deltas, byte plane by byte plane (planes that are always zero are left out)."""
    deltas = np.diff(sorted_values, prepend=np.uint64(0))
    planes = (int(deltas.max()).bit_length() + 7) // 8 if len(deltas) else 0
    return np.ascontiguousarray(deltas.view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes()


def unpack(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(data, np.uint8).reshape(-1, n)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, : len(planes)] = planes.T
    return np.cumsum(wide.view(np.uint64).ravel(), dtype=np.uint64)


class _Chunk:
    """Ids, word offsets and word hashes of the documents of one chunk, in id order."""

    def __init__(self, rows: pa.Table):
        # null ids have a chunk of their own (``_LAST``, which no id reaches): there all are equal
        self.ids = rows.column("doc_id").combine_chunks().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.data, self.offsets = raw(rows.column("text"))
        hashes, words = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for i, j in slices(self.offsets):
            d, o = self.data[self.offsets[i] : self.offsets[j]], self.offsets[i : j + 1] - self.offsets[i]
            starts, ends, w = word_bounds(d, o)
            hashes.append(word_hashes(d, starts, ends))
            words.append(w[1:] + words[-1][-1])
        self.hashes, self.words = np.concatenate(hashes), np.concatenate(words)
        self.doc = np.repeat(np.arange(len(self.ids)), np.diff(self.words))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Word positions at which a window of ``k`` words starts, and the windows' hashes."""
        at = np.flatnonzero(valid_windows(self.words, k))
        return at, window_hashes(self.hashes, k)[at] if len(at) else np.zeros(0, np.uint64)


def _unique(values: np.ndarray, ids: np.ndarray, mark: np.ndarray | None = None):
    """Distinct sorted values; whether any of its rows is marked; whether two ids have it."""
    order = np.lexsort((ids, values))
    v, d = values[order], ids[order]
    first = np.ones(len(v), bool)
    first[1:] = v[1:] != v[:-1]
    group = np.cumsum(first) - 1
    n = int(group[-1]) + 1 if len(v) else 0
    multi = np.zeros(n, bool)
    multi[group[1:][~first[1:] & (d[1:] != d[:-1])]] = True
    marked = np.zeros(n, bool)
    if mark is not None:
        marked[group[mark[order]]] = True
    return v[first], marked, multi


def _messages(key, values, aligned, multi, buckets: int, bits: int, low=None) -> pa.Table:
    """A row per bucket: equal ranges of the hash space.  ``key`` is chunk and part, ``low`` of a split chunk's values."""
    width = (1 << bits) // buckets + 1
    bucket = (values // np.uint64(width)).astype(np.int64)
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(values) else np.zeros(0, np.int64)
    ends = np.r_[edges[1:], len(values)] if len(values) else edges
    rows = [(int(bucket[a]), *key, int(b - a), pack(values[a:b] - np.uint64(int(bucket[a]) * width)), np.packbits(aligned[a:b]).tobytes(),
             np.packbits(multi[a:b]).tobytes(), b"" if low is None else low[a:b].astype(np.int32).tobytes()) for a, b in zip(edges, ends)]
    cols = list(zip(*rows)) if rows else [[]] * 8
    types = [pa.int64()] * 4 + [pa.binary()] * 4
    names = ["bucket", "chunk", "part", "n", "vals", "aligned", "multi", "low"]
    return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _low(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.int32) if data else np.full(n, -1, np.int32)


def _opened(rows: pa.Table):
    """All values of a bucket's messages with their chunk, part, the two bits and ``low`` (-1 if the chunk isn't split),
    in order of value and chunk."""
    n = rows.column("n").to_numpy()
    get = lambda c: rows.column(c).to_pylist()
    values = np.concatenate([unpack(v, k) for v, k in zip(get("vals"), n)])
    bits = [np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=int(k)) for x, k in zip(get(c), n)]).astype(bool) for c in ("aligned", "multi")]
    low = np.concatenate([_low(x, int(k)) for x, k in zip(get("low"), n)])
    chunk, part = np.repeat(rows.column("chunk").to_numpy(), n), np.repeat(rows.column("part").to_numpy(), n)
    order = np.lexsort((chunk, values))
    return values[order], chunk[order], part[order], bits[0][order], bits[1][order], low[order]


def _answers(bucket: int, buckets: int, bits: int, values, chunk, part, earlier, wanted, low) -> pa.Table:
    """A row per chunk and part with those of its values that are wanted."""
    values, chunk, part, earlier, low = values[wanted], chunk[wanted], part[wanted], earlier[wanted], low[wanted]
    order = np.lexsort((values, part, chunk))
    values, chunk, part, earlier, low = values[order], chunk[order], part[order], earlier[order], low[order]
    edges = np.flatnonzero(np.r_[True, (chunk[1:] != chunk[:-1]) | (part[1:] != part[:-1])]) if len(chunk) else np.zeros(0, np.int64)
    ends = np.r_[edges[1:], len(chunk)] if len(chunk) else edges
    base = np.uint64(bucket * ((1 << bits) // buckets + 1))
    rows = [(int(chunk[a]), int(part[a]), int(b - a), pack(values[a:b] + base), np.packbits(earlier[a:b]).tobytes(),
             b"" if low[a] < 0 else low[a:b].astype(np.int32).tobytes()) for a, b in zip(edges, ends)]
    cols = list(zip(*rows)) if rows else [[]] * 6
    types = [pa.int64()] * 3 + [pa.binary()] * 3
    return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=["chunk", "part", "n", "vals", "earlier", "low"])


def _read_answers(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A part's answered values, sorted, each with its bit and ``low``."""
    if not rows.num_rows:
        return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.int32)
    n = rows.column("n").to_pylist()
    values = np.concatenate([unpack(v, k) for v, k in zip(rows.column("vals").to_pylist(), n)])
    bit = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=k) for x, k in zip(rows.column("earlier").to_pylist(), n)]).astype(bool)
    low = np.concatenate([_low(x, k) for x, k in zip(rows.column("low").to_pylist(), n)])
    order = np.argsort(values)
    return values[order], bit[order], low[order]


def _find(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Index in sorted ``known`` of each value, or -1."""
    if not len(known):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at, -1)


def _sizes(docs: DataFrame, chunk_ids: int) -> tuple[DataFrame, DataFrame]:
    """``docs`` with their chunk, and the chunks' bytes."""
    below = F.when((F.col("doc_id") < 0) & (F.col("doc_id") % chunk_ids != 0), 1).otherwise(0)  # whole numbers: ids may have 64 bits
    ranged = docs.withColumn("chunk", F.coalesce(F.expr(f"doc_id div {chunk_ids}L") - below, F.lit(_LAST)))
    return ranged, materialize(ranged.groupBy("chunk").agg(F.sum(F.octet_length("text")).alias("bytes")), "substring-chunks")


def _split(ranged: DataFrame, sizes: DataFrame, chunk_bytes: int) -> DataFrame:
    """``ranged`` with ``part``: -1, or one of so many parts that each has about ``chunk_bytes`` at most."""
    large = sizes.filter(F.col("bytes") > chunk_bytes).select("chunk", F.ceil(F.col("bytes") * 2 / chunk_bytes).alias("parts"))
    if large.isEmpty():
        return ranged.withColumn("part", F.lit(-1).cast("long"))
    joined = ranged.join(F.broadcast(large), "chunk", "left")  # at most a row per ``chunk_bytes`` of the input
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("parts")).cast("long")
    split = materialize(joined.filter("parts IS NOT NULL").select("doc_id", "text", "chunk", part.alias("part")), "substring-parts")
    return joined.filter("parts IS NULL").select("doc_id", "text", "chunk", F.lit(-1).cast("long").alias("part")).unionByName(split)


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    chunk_ids: int = CHUNK_IDS, anchor_bits: int = ANCHOR_BITS, bucket_bytes: int = BUCKET_BYTES,
                    chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_text, removed`` (word spans, end included).

    ``id_col`` must be integral.  Buckets and partitions are sized from the bytes of all texts and chunks are split by
    their bytes, so that a task's share stays the same however large the input is (but for a single text).
    """
    block = (window + 1) // 2
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranged, sizes = _sizes(docs, chunk_ids)
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(16, -(-total // bucket_bytes))
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PARTITION_BYTES))
    chunked = _split(ranged, sizes, chunk_bytes).repartition(parts, "chunk", "part")

    first_id = lambda chunk: max(chunk * chunk_ids, -_LAST - 1)

    def probe(key, rows):
        c = _Chunk(rows)
        at, h = c.windows(block)
        aligned = (at - c.words[:-1][c.doc[at]]) % block == 0
        values, aligned, multi = _unique(h >> np.uint64(64 - anchor_bits), c.ids[c.doc[at]], aligned)
        return _messages([k.as_py() for k in key], values, aligned, multi, buckets, anchor_bits)

    def meet(key, rows):
        values, chunk, part, aligned, multi, low = _opened(rows)
        first = np.r_[True, values[1:] != values[:-1]]
        group = np.cumsum(first) - 1
        shared = (np.bincount(group) > 1) | (np.bincount(group, weights=multi) > 0)
        indexed = np.bincount(group, weights=aligned) > 0
        return _answers(key[0].as_py(), buckets, anchor_bits, values, chunk, part, np.zeros(len(values), bool), (shared & indexed)[group], low)

    def extend(key, rows, answers):
        c = _Chunk(rows)
        anchors, _, _ = _read_answers(answers)
        at, h = c.windows(block)
        hit = np.zeros(len(c.hashes) + 1, np.int64)
        hit[at[_find(h >> np.uint64(64 - anchor_bits), anchors) >= 0]] = 1
        before = np.r_[0, np.cumsum(hit)]
        at, h = c.windows(window)
        near = before[at + window - block + 1] > before[at]
        own = c.ids[c.doc[at[near]]]
        values, _, multi = _unique(h[near], own)
        chunk, part = [k.as_py() for k in key]
        low = None
        if part >= 0:  # all null ids are equal
            low = np.full(len(values), 0 if chunk == _LAST else chunk_ids, np.int64)
            np.minimum.at(low, np.searchsorted(values, h[near]), 0 if chunk == _LAST else own - first_id(chunk))
        return _messages((chunk, part), values, np.zeros(len(values), bool), multi, buckets, 64, low)

    def decide(key, rows):
        values, chunk, part, _, multi, low = _opened(rows)
        first = np.r_[True, values[1:] != values[:-1]]
        earliest = chunk[np.flatnonzero(first)][np.cumsum(first) - 1]
        earlier = (earliest < chunk) & (chunk != _LAST) | (chunk == _LAST) & (earliest != _LAST)
        same = np.flatnonzero(first | np.r_[True, chunk[1:] != chunk[:-1]])  # values of a chunk, over its parts
        sizes = np.diff(np.r_[same, len(values)])
        low = np.repeat(np.minimum.reduceat(low, same), sizes)
        return _answers(key[0].as_py(), buckets, 64, values, chunk, part, earlier, earlier | multi | np.repeat(sizes > 1, sizes), low)

    def remove(key, rows, answers):
        c = _Chunk(rows)
        known, earlier, low = _read_answers(answers)
        at, h = c.windows(window)
        found = _find(h, known)
        at, found = at[found >= 0], found[found >= 0]
        own = c.ids[c.doc[at]]
        lowest = np.full(len(known), _LAST)
        np.minimum.at(lowest, found, own)
        chunk, part = [k.as_py() for k in key]
        if part >= 0 and chunk != _LAST:
            lowest = np.minimum(lowest, np.where(low >= 0, first_id(chunk) + low.astype(np.int64), _LAST))
        gone = at[earlier[found] | (lowest[found] < own)]
        edge = np.zeros(len(c.hashes) + 1, np.int64)
        np.add.at(edge, gone, 1)
        np.add.at(edge, gone + window, -1)
        keep = np.cumsum(edge)[:-1] == 0
        counts, removed, texts, spans = np.diff(c.words), [], [], []
        for d in range(len(c.ids)):
            words = c.data[c.offsets[d] : c.offsets[d + 1]].tobytes().split()
            mask = keep[c.words[d] : c.words[d + 1]]
            cut = np.flatnonzero(np.diff(np.r_[1, mask, 1].astype(np.int8)))
            spans.append([{"first": int(a), "last": int(b) - 1} for a, b in cut.reshape(-1, 2)])
            removed.append(int(len(mask) - mask.sum()))
            texts.append(b" ".join(compress(words, mask) if removed[-1] else words).decode("utf-8"))
        ids = pa.nulls(len(c.ids), pa.int64()) if chunk == _LAST else pa.array(c.ids, pa.int64())
        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        return pa.table([ids, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, span)],
                        names=["doc_id", "n_words", "n_removed", "kept_text", "removed"])

    pieces = lambda x: x.groupBy("chunk", "part")
    probes = pieces(chunked).applyInArrow(probe, _MESSAGE)
    anchors = probes.groupBy("bucket").applyInArrow(meet, _ANSWER)
    windows = pieces(chunked).cogroup(pieces(anchors)).applyInArrow(extend, _MESSAGE)
    repeats = windows.groupBy("bucket").applyInArrow(decide, _ANSWER)
    return pieces(chunked).cogroup(pieces(repeats)).applyInArrow(remove, _RESULT)


@query("op4_substring_dedup")
def op4_substring_dedup(spark, sf_dir):
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
