"""Near-duplicate groups by SimHash with a Gray-order hierarchical index.

Texts are lower-cased (A-Z only) and cut into words; a text's shingles are its runs of three words, repeats included
(fewer words: the whole sequence).  A fingerprint bit is 1 if it is set in over half of the shingles' XXH64 hashes (seed
42); a text without words has fingerprint zero.  Fingerprints that differ in at most ``DISTANCE`` bits are linked.

The index holds each distinct fingerprint once, sorted by Gray rank: neighbours in that order share most bits, so a run of
them has many bits in common.  These are factored out into the node above the run as (mask, pattern), and so on upwards.
Two nodes whose patterns differ in more than ``DISTANCE`` of the bits that both masks share hold no linked pair: the whole
pair of groups is pruned.  Going down, the shared bits grow, and so do the differences.

* Lower part: ``CHUNK`` consecutive fingerprints are a chunk, one sorted array.
* Upper part, tables: chunks are nodes, ``FAN`` of them make a node above, up to one root.  The frontier starts at (root, root)
  and goes down a level by joins; pruned pairs don't get children.
* A pair of chunks that is left is one group: both arrays get nodes of their own (``FAN`` children each) and the descent goes on
  with arrays, ``PIECE`` pairs at a time, so memory is bounded.  Links leave a pair of chunks as at most one edge per
  fingerprint, those that connect parts that weren't connected.

Nothing is lost: pruning is exact, no bucket is cut.  Positions in the order come from a distributed prefix sum.  A fingerprint
that very many texts share is one entry of the index.

Edge cases: null counts as empty; texts without words are linked to all with at most ``DISTANCE`` bits set; repeated rows give
repeated results; null ids are smallest ids of a group only if it has no other; an empty table gives an empty result; very long
texts are hashed in slices; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import table
from panelcast.llm.components import connected_components
from panelcast.llm.registry import query
from panelcast.operators.ranking import prefix_sum
from panelcast.session import materialize

SHINGLE = 3
SEED = 42
DISTANCE = 3
#: Fingerprints per chunk: 128 KB, and as many in the group of a pair.
CHUNK = 1 << 14
FAN = 16
#: Pairs of nodes that are opened at a time (each has FAN * FAN pairs of children).
PIECE = 1 << 12
#: Hashes whose bits are counted at a time.
SLICE = 1 << 16
_U = np.uint64


def shingle_hashes(text: bytes, k: int = SHINGLE) -> np.ndarray:
    words = text.lower().split()  # bytes: A-Z only; separators 0x20, 0x09-0x0D
    if not words:
        return np.zeros(0, _U)
    joined = b" ".join(words)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], _U)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    return np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), _U, len(words) - k + 1)


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    h = shingle_hashes(text, k)
    if not len(h):
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), SLICE):
        bits = np.unpackbits(h[i:i + SLICE].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(h)).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a long) of every row."""
    def run(batches):
        for b in batches:
            made = [fingerprint(t or b"", k) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.array(made, _U).view(np.int64))], names=["doc_id", "fp"])

    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("_text"))
    return docs.mapInArrow(run, f"doc_id {df.schema[id_col].dataType.simpleString()}, fp long")


def gray_rank(fp: Column) -> Column:
    """Position of a code word in Gray order.  Signed order only rotates it, and the order is cyclic."""
    for n in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, n))
    return fp


def _node(low: str, high: str) -> list[Column]:
    """Aggregates of a node: the AND and the OR of all bits below; they agree on the shared bits."""
    return [F.bit_and(low).alias("low"), F.bit_or(high).alias("high")]


def _differences(a: str, b: str) -> Column:
    """Bits shared below both nodes in which their patterns differ."""
    return F.expr(f"bit_count(({a}.low ^ {b}.low) & ~({a}.low ^ {a}.high) & ~({b}.low ^ {b}.high))")


def chunk_pairs(chunks: DataFrame, distance: int = DISTANCE, fan: int = FAN) -> DataFrame:
    """Pairs (a, b), a <= b, of the ``chunks`` (chunk, low, high) that pruning leaves: the frontier at the lowest level."""
    levels = [chunks.select(F.col("chunk").alias("node"), "low", "high")]
    last = chunks.agg(F.max("chunk")).first()[0]
    while last:
        last //= fan
        above = levels[-1].groupBy(F.floor(F.col("node") / fan).cast("long").alias("node")).agg(*_node("low", "high"))
        levels.append(materialize(above, "simhash-nodes"))
    frontier = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for nodes in reversed(levels[:-1]):
        kids = nodes.select(F.floor(F.col("node") / fan).cast("long").alias("up"), "node", F.struct("low", "high").alias("bits"))
        a = kids.select(F.col("up").alias("a"), F.col("node").alias("x"), F.col("bits").alias("p"))
        b = kids.select(F.col("up").alias("b"), F.col("node").alias("y"), F.col("bits").alias("q"))
        met = frontier.join(a, "a").join(b, "b").filter("x <= y").filter(_differences("p", "q") <= distance)
        frontier = materialize(met.select(F.col("x").alias("a"), F.col("y").alias("b")), "simhash-frontier")
    return frontier


def _levels(leaves: np.ndarray, fan: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mask, pattern) of all nodes over the sorted ``leaves``, lowest level first."""
    low = high = leaves
    out = [(np.full(len(leaves), 0xFFFFFFFFFFFFFFFF, _U), leaves)]
    while len(low) > 1:
        at = np.arange(0, len(low), fan)
        low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
        out.append((~(low ^ high), low))
    return out


def links(x: np.ndarray, y: np.ndarray, same: bool, distance: int = DISTANCE, fan: int = FAN, piece: int = PIECE):
    """Index pairs (i, j) with at most ``distance`` different bits, a piece at a time; i < j if both are the ``same`` array."""
    left, right = _levels(x, fan), _levels(y, fan)
    depth = max(len(left), len(right))
    for side in (left, right):  # equal heights: the lone top node stands for itself further up
        side.extend([side[-1]] * (depth - len(side)))
    todo = [(depth - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    child = np.arange(fan)
    while todo:
        level, i, j = todo.pop()
        if len(i) > piece:
            todo.append((level, i[piece:], j[piece:]))
            i, j = i[:piece], j[:piece]
        (mask, pattern), (mask2, pattern2) = left[level], right[level]
        near = np.bitwise_count((pattern[i] ^ pattern2[j]) & mask[i] & mask2[j]) <= distance
        i, j = i[near], j[near]
        if not len(i):
            continue
        if level == 0:
            keep = i < j if same else slice(None)
            yield i[keep], j[keep]
            continue
        # children past the end of the level below don't exist; a lone top node is its own only child
        a, b = i[:, None] * fan + child, j[:, None] * fan + child
        aa, bb = np.repeat(a, fan, axis=1).ravel(), np.tile(b, (1, fan)).ravel()
        ok = (aa < len(left[level - 1][0])) & (bb < len(right[level - 1][0]))
        if same:
            ok &= aa <= bb
        todo.append((level - 1, aa[ok], bb[ok]))


def union(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the parts of ``i`` and ``j``; ``root`` holds each item's smallest known member and stays flat."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def _linked(rows: pa.Table, distance: int) -> pa.Table:
    """Edges of a pair of chunks: each linked fingerprint with the first of its part."""
    rows = rows.sort_by("side")
    arrays = [np.asarray(r.as_py(), np.int64).view(_U) for r in rows.column("ranks")]
    same = rows.num_rows == 1
    prints = [r ^ (r >> _U(1)) for r in arrays]
    x, y = prints[0], prints[-1]
    every = x if same else np.r_[x, y]
    root, shift = np.arange(len(every)), 0 if same else len(x)
    for i, j in links(x, y, same, distance):
        union(root, i, j + shift)
    at = np.flatnonzero(root != np.arange(len(every)))
    return pa.table({"a": every[at].view(np.int64), "b": every[root[at]].view(np.int64)})


def linked_fingerprints(prints: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """Edges (a, b) that connect all linked fingerprints of ``prints`` (fp, distinct): a spanning set, not all pairs."""
    ranked = prefix_sum(prints.select("fp", gray_rank(F.col("fp")).alias("rank")), ["rank"], out="_at")
    at = F.floor((F.col("_at") - 1) / chunk).cast("long").alias("chunk")
    chunks = ranked.select(at, "fp", "rank").groupBy("chunk").agg(
        *_node("fp", "fp"), F.sort_array(F.collect_list("rank")).alias("ranks"))
    chunks = materialize(chunks, "simhash-chunks")
    pairs = chunk_pairs(chunks.select("chunk", "low", "high"), distance, fan)
    sides = pairs.select("a", "b", F.explode(F.when(F.col("a") == F.col("b"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("side"))
    sides = sides.withColumn("chunk", F.when(F.col("side") == 0, F.col("a")).otherwise(F.col("b")))
    met = sides.join(chunks.select("chunk", "ranks"), "chunk").select("a", "b", "side", "ranks")
    return met.groupBy("a", "b").applyInArrow(lambda rows: _linked(rows, distance), "a long, b long")


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, distance: int = DISTANCE,
                   chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``df``: ``doc_id, fp, component_id`` (smallest id of all texts that links lead to)."""
    rows = materialize(fingerprints(df, id_col, text_col, k), "simhash-rows")
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-prints")
    edges = materialize(linked_fingerprints(prints, distance, chunk), "simhash-links")
    labels = connected_components(edges, "simhash")
    member = prints.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    member = materialize(member, "simhash-members")
    lowest = member.groupBy("label").agg(F.min("first").alias("component_id"))
    by_print = materialize(member.join(lowest, "label").select("fp", "component_id"), "simhash-components")
    # both sides are scans: a fingerprint that a third of the rows share is split by the adaptive skew join
    return rows.join(by_print, "fp").select("doc_id", "fp", "component_id")


@query("op12_simhash")
def op12_simhash(spark, sf_dir):
    out = simhash_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
