"""N-gram Jaccard self-join with a MinHash LSH forest and exact verification.

Texts are lower-cased; shingles are five consecutive words (a shorter text is one shingle).  Texts with equal shingle
sets are one node.  The forest has ``TREES`` trees; a node's label in a tree is a sequence of ``DEPTH`` minimum hashes,
and a tree is the sorted list of labels, a prefix trie.  Matching starts with whole labels and shortens the prefix
until pairs at the threshold meet in some tree with the target recall (``prefix_depth``).

Nodes that share such a prefix are linked through leaders: sorted by label, so longest common prefixes come first, each
member joins a leader nearly equal to it or becomes one, and leaders are linked when their signatures allow a link
between their members (triangle inequality of the Jaccard distance, with a margin for the estimate).  So a group of n
near copies gives about n candidate edges, not n * n.  Their components are then verified: members' whole shingle sets
meet block by block and exact Jaccard similarities decide all links inside.

Salting and bounds: members of a prefix meet first within one of ``SALTS`` parts, only leaders meet for the whole
prefix; a component is cut into blocks of about ``BLOCK`` nodes and blocks meet in pairs.  Rows that share a prefix
with no other node are ruled out before the shuffle by a bitmap of fixed size.

Edge cases: null counts as empty; texts without words are linked to nothing; equal texts share their class, whatever
their ids; null ids are never class ids unless the class has no other; repeated rows give repeated result rows; extra
columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm import bitmap
from panelcast.llm.common import boxed, mix, raw, slices, table, valid_windows, window_hashes, word_bounds, word_hashes
from panelcast.llm.components import connected_components
from panelcast.llm.registry import query
from panelcast.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
DEPTH = 8
RECALL = 0.999
SALTS = 8
BLOCK = 256
FILTER_BITS = 1 << 26
#: Estimated similarity from which a member joins a leader; from which two leaders are linked.
ABSORB, LINK = 0.92, 0.4
#: So many of the nearest leaders are compared before the others.
NEAREST = 64
_SEED = 20
_U = np.uint64


def prefix_depth(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which pairs of similarity ``threshold`` share a prefix in some tree with ``recall``."""
    for k in range(depth, 1, -1):
        if 1 - (1 - threshold**k) ** trees >= recall:
            return k
    return 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted shingle hashes of all texts, one text after another, and the n + 1 offsets."""
    values, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, j in slices(offsets):
        d, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, words = word_bounds(d, o)
        hashes = word_hashes(d, starts, ends)
        n = np.diff(words)
        doc = np.repeat(np.arange(j - i), n)
        at = np.flatnonzero(valid_windows(words, k))
        v, who = (window_hashes(hashes, k)[at], doc[at]) if len(at) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for s in np.flatnonzero((n > 0) & (n < k)):
            w = hashes[words[s] : words[s + 1]]
            v, who = np.r_[v, window_hashes(w, len(w), 2)], np.r_[who, s]
        order = np.lexsort((v, who))
        v, who = v[order], who[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (who[1:] != who[:-1])
        values.append(v[new])
        counts.append(np.bincount(who[new], minlength=j - i))
    return np.concatenate(values), np.r_[0, np.cumsum(np.concatenate(counts))].astype(np.int64)


def _segments(values: np.ndarray, at: np.ndarray, op) -> np.ndarray:
    """``op`` over each text's values; 0 for texts without any."""
    out = np.zeros(len(at) - 1, values.dtype)
    full = at[1:] > at[:-1]
    if full.any():
        out[full] = op.reduceat(values, at[:-1][full])
    return out


def node_keys(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hash of each shingle set (0: no shingles)."""
    sums = _segments(mix(values ^ _U(0xA5A5A5A5A5A5A5A5)), at, np.add)
    keys = mix(sums + np.diff(at).astype(np.uint64))
    keys[at[1:] == at[:-1]] = 0
    return keys.view(np.int64)


def signatures(values: np.ndarray, at: np.ndarray, trees: int, depth: int) -> np.ndarray:
    rng = np.random.default_rng(_SEED)
    odd = rng.integers(1, 2**62, trees * depth, dtype=np.uint64) * _U(2) + _U(1)
    plus = rng.integers(0, 2**63, trees * depth, dtype=np.uint64)
    out = np.zeros((len(at) - 1, trees * depth), np.uint32)
    cuts = at[:-1][at[1:] > at[:-1]]
    full = at[1:] > at[:-1]
    if len(cuts):
        for j in range(trees * depth):
            h = ((values * odd[j] + plus[j]) >> _U(32)).astype(np.uint32)
            out[full, j] = np.minimum.reduceat(h, cuts)
    return out


def _signed(batches, trees: int, depth: int):
    for b in batches:
        data, offsets = raw(b.column("_text"))
        for i, j in slices(offsets):
            values, at = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            sig = signatures(values, at, trees, depth)
            part = b.slice(i, j - i)
            cols = [part.column("doc_id"), part.column("_h"), pa.array(node_keys(values, at)),
                    pa.array([r.astype(">u4").tobytes() for r in sig], pa.binary()),
                    pa.array([(r & 0xFF).astype(np.uint8).tobytes() for r in sig], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "_h", "node", "sig", "bytes"])


def _sets(batches):
    for b in batches:
        data, offsets = raw(b.column("_text"))
        for i, j in slices(offsets):
            values, at = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            keys, first = np.unique(node_keys(values, at), return_index=True)
            sets = [values[at[r] : at[r + 1]].tobytes() for r in first]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sets, pa.binary())], names=["node", "shingles"])


def _grouped(batches, keys: list[str], work, names: list[str], types: list):
    """Runs ``work(key, rows)`` on consecutive rows of equal keys (rows come sorted by them); a group may span batches."""
    held = None
    out: list = [[] for _ in names]

    def flush(rows: pa.Table, final: bool):
        nonlocal out
        if not rows.num_rows:
            return rows
        arrays = [rows.column(k).to_numpy() for k in keys]
        new = np.zeros(rows.num_rows, bool)
        new[0] = True
        for a in arrays:
            new[1:] |= a[1:] != a[:-1]
        edges = np.r_[np.flatnonzero(new), rows.num_rows]
        for a, b in zip(edges[:-1], edges[1:] if final else edges[1:-1]):
            for o, made in zip(out, work(rows.slice(a, b - a))):
                o.extend(made)
        return rows.slice(rows.num_rows if final else edges[-2])

    def ready():
        nonlocal out
        batch = pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)], names=names)
        out = [[] for _ in names]
        return batch

    for b in batches:
        rows = pa.Table.from_batches([b])
        held = flush(pa.concat_tables([held, rows]).combine_chunks() if held is not None and held.num_rows else rows, False)
        if len(out[0]) > 50_000:
            yield ready()
    if held is not None:
        flush(held, True)
    yield ready()


def _matrix(column, dtype) -> np.ndarray:
    n = len(column)
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(n, -1)


def _lead(rows: pa.Table, absorb: float, link: float):
    """Edges that connect the linked rows of a group, and the rows that lead it.

    Rows come in order of their labels, so the nearest leaders in the trie are the last ones; they are tried first.
    An edge is kept only if it joins two parts of the group that weren't connected yet: at most one per row.
    """
    nodes = rows.column("node").to_numpy()
    sig = _matrix(rows.column("bytes"), np.uint8)
    leaders: list[int] = []
    part = np.zeros(len(nodes), np.int64)  # of each leader, in order
    edges: list[tuple[int, int]] = []
    for i in range(len(nodes)):
        n = len(leaders)
        mine = i
        for lo, hi in ((max(0, n - NEAREST), n), (0, max(0, n - NEAREST))):
            at = np.flatnonzero(part[lo:hi] != mine) + lo  # leaders not connected to this row yet
            if not len(at):
                continue
            chosen = np.array(leaders)[at]
            if (nodes[chosen] == nodes[i]).any():
                mine = -1
                break
            like = (sig[chosen] == sig[i]).mean(axis=1)
            if like.max() >= absorb:
                edges.append((nodes[i], nodes[chosen[int(like.argmax())]]))
                mine = -1
                break
            for x in at[like >= link]:
                if part[x] != mine:
                    edges.append((nodes[i], nodes[leaders[x]]))
                    part[:n][part[:n] == part[x]] = mine
        if mine >= 0:
            part[n] = mine
            leaders.append(i)
    return edges, leaders


def _first_round(rows: pa.Table):
    edges, leaders = _lead(rows, ABSORB, LINK)
    key = rows.column("prefix")[0].as_py()
    sig, label = rows.column("bytes"), rows.column("label")
    made = [(None, a, b, None, None) for a, b in edges]
    made += [(key, rows.column("node")[i].as_py(), None, label[i].as_py(), sig[i].as_py()) for i in leaders]
    return list(zip(*made))


def _second_round(rows: pa.Table):
    edges, _ = _lead(rows, 2.0, LINK)
    return list(zip(*edges)) if edges else [[], []]


def candidate_edges(nodes: DataFrame, trees: int, depth: int, prefix: int, filter_bits: int) -> DataFrame:
    """Edges (a, b) between nodes (node, sig, bytes) that share a prefix, through leaders."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    label = F.substring("sig", F.col("tree") * (4 * depth) + 1, F.lit(4 * depth))
    spread = nodes.select("node", "sig", "bytes", tree).select("node", "bytes", label.alias("label"), F.xxhash64("tree", F.substring(label, 1, 4 * prefix)).alias("prefix"))
    met = spread.groupBy(bitmap.position(F.col("prefix"), filter_bits).alias("pos")).agg(F.min("node").alias("x"), F.max("node").alias("y")).filter("x != y")
    words = materialize(bitmap.pack(met, "pos"), "forest-prefixes")
    hit = bitmap.with_hit(spread, words, bitmap.position(F.col("prefix"), filter_bits), "_hit").filter("_hit").drop("_hit")
    hit = hit.withColumn("salt", F.pmod(F.col("node"), F.lit(SALTS)).cast("long"))
    names, types = ["prefix", "a", "b", "label", "bytes"], [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    first = (hit.repartition("prefix", "salt").sortWithinPartitions("prefix", "salt", "label", "node")
             .mapInArrow(lambda it: _grouped(it, ["prefix", "salt"], _first_round, names, types), "prefix long, a long, b long, label binary, bytes binary"))
    first = materialize(first, "forest-leaders")
    leaders = first.filter("prefix IS NOT NULL").select("prefix", F.col("a").alias("node"), "label", "bytes")
    second = (leaders.repartition("prefix").sortWithinPartitions("prefix", "label", "node")
              .mapInArrow(lambda it: _grouped(it, ["prefix"], _second_round, ["a", "b"], [pa.int64(), pa.int64()]), "a long, b long"))
    return first.filter("prefix IS NULL").select("a", "b").union(second)


def _verify(rows: pa.Table, threshold: float):
    """Exact links inside a block, or across a pair of blocks: per linked node the number of links and a local root."""
    nodes, block = rows.column("node").to_numpy(), rows.column("block").to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
    n = np.array([len(s) for s in sets], np.int64)
    m = len(nodes)
    flat, who = np.concatenate(sets), np.repeat(np.arange(m), n)
    _, ids, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1  # others are in no intersection
    col = np.cumsum(shared) - 1
    use = shared[ids]
    col, who = col[ids[use]], who[use]
    inter = np.zeros((m, m), np.float32)
    order = np.argsort(col, kind="stable")
    col, who = col[order], who[order]
    width = max(1, (1 << 22) // max(m, 1))
    for lo in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(col, [lo, lo + width])
        x = np.zeros((m, width), np.float32)
        x[who[a:b], col[a:b] - lo] = 1
        inter += x @ x.T
    inter = np.rint(inter).astype(np.int64)
    linked = inter >= threshold * (n[:, None] + n[None, :] - inter) - 1e-9
    np.fill_diagonal(linked, False)
    if rows.column("i")[0].as_py() != rows.column("j")[0].as_py():  # a pair of blocks (one may be empty): links inside a block are its own
        linked &= block[:, None] != block[None, :]
    links = linked.sum(axis=1)
    root = np.arange(m)
    while True:
        low = np.minimum(root, np.where(linked, root[None, :], m).min(axis=1))
        low = low[low]
        if (low == root).all():
            break
        root = low
    at = np.flatnonzero(links)
    return nodes[at].tolist(), nodes[root[at]].tolist(), links[at].tolist()


def verified_links(docs: DataFrame, comps: DataFrame, threshold: float, filter_bits: int) -> DataFrame:
    """(node, root, links) of each block pair: exact links between the nodes of a component (node, label)."""
    comps = materialize(comps.join(comps.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "label"), "forest-components")
    words = materialize(bitmap.pack(comps.select(bitmap.position(F.col("node"), filter_bits).alias("pos")), "pos"), "forest-members")
    sets = docs.select("_text").mapInArrow(_sets, "node long, shingles binary")
    sets = bitmap.with_hit(sets, words, bitmap.position(F.col("node"), filter_bits), "_hit").filter("_hit").drop("_hit")
    sets = sets.join(comps, "node").dropDuplicates(["node"])
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(F.col("block"), o).alias("i"), F.greatest(F.col("block"), o).alias("j")))
    spread = sets.withColumn("block", block).withColumn("x", F.explode(meets)).select(
        "label", F.col("x.i").alias("i"), F.col("x.j").alias("j"), "block", "node", "shingles")
    return (spread.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j", "node")
            .mapInArrow(lambda it: _grouped(it, ["label", "i", "j"], lambda rows: _verify(rows, threshold), ["node", "root", "links"],
                                            [pa.int64()] * 3), "node long, root long, links long"))


def ngram_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, trees: int = TREES,
                  depth: int = DEPTH, recall: float = RECALL, filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per row of ``df``: ``doc_id, _h`` (hash of the text), ``node`` (of its shingle set; 0: no words),
    ``class_id`` (smallest id of its connected texts) and ``n_links`` (other shingle sets that its own
    is linked to: texts with an equal set add none)."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_h"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"))
    signed = docs.mapInArrow(lambda it: _signed(it, trees, depth), f"doc_id {df.schema[id_col].dataType.simpleString()}, _h long, node long, sig binary, bytes binary")
    signed = materialize(signed, "forest-signatures")
    nodes = signed.filter("node != 0").groupBy("node").agg(F.first("sig").alias("sig"), F.first("bytes").alias("bytes"))
    prefix = prefix_depth(threshold, trees, depth, recall)
    edges = materialize(candidate_edges(nodes, trees, depth, prefix, filter_bits).distinct(), "forest-edges")
    comps = connected_components(edges, "forest-candidates")
    links = materialize(verified_links(docs, comps, threshold, filter_bits), "forest-links")
    classes = connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b")), "forest-classes")
    per_node = materialize(links.groupBy("node").agg(F.sum("links").alias("n_links")).join(classes, "node", "left"), "forest-nodes")
    rows = signed.select("doc_id", "_h", "node").join(per_node, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lowest = materialize(rows.filter("node != 0").groupBy("label").agg(F.min("doc_id").alias("class_id")), "forest-lowest")
    out = rows.join(lowest, "label", "left")
    return out.select("doc_id", "_h", "node", F.when(F.col("node") == 0, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each class of ``df`` stays (the smallest id; of rows with that id, the smallest text hash), and all rows
    without words; columns as in ``df``.  Rows equal in id and text count once."""
    classes = ngram_classes(df, id_col, text_col, **options)
    best = classes.filter("node != 0 AND (doc_id <=> class_id)").groupBy("class_id").agg(F.min("_h").alias("_h"))
    empty = classes.filter("node = 0").select(F.col("doc_id").alias("_id"), "_h")
    keep = materialize(best.select(F.col("class_id").alias("_id"), "_h").union(empty).distinct(), "forest-keep").withColumnRenamed("_h", "_kh")
    docs = df.select(boxed(df), F.col(id_col).alias("_doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_h"))
    kept = docs.join(keep, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_kh")))
    return kept.dropDuplicates(["_doc", "_h"]).select("row.*")


@query("op2_ngram_join")
def op2_ngram_join(spark, sf_dir):
    out = ngram_classes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "n_links")
