"""Merkle manifest of a table, with a witness for every row.

Rows are leaves; a leaf's digest is SHA-256 over its fields, each ``-`` if null, else the UTF-8 byte count, ``:`` and the
value.  Within a part (a language) leaves ascend by id; while several nodes remain, every ``BRANCH`` consecutive ones
become the digest of their joined hex digests.  The parts' roots, in order of the parts, make the dataset's root likewise.

Witnesses grow incrementally (``OpenTree``): an appended leaf starts with an empty witness; a run that is completed hands
each member its siblings, which extends the witnesses of all leaves below it, and the run's digest is appended one level
up.  Appends go by aligned blocks of ``BRANCH**LEVELS`` leaves, one group each; the block roots are further appends of the
same operator, round by round, until one node a part remains.  Coming back down, a block root's witness goes in front of
its block's leaves in the one shuffle by block, and closes theirs.  Positions come from a distributed prefix sum, so a
part may hold any share of the rows; a group holds at most ``BRANCH**LEVELS`` digests.

A witness is an array of (before, after): the joined digests left and right of the path, bottom up.  ``folded`` recomputes
the root from a leaf and its witness as a column expression.

Edge cases: a null part comes first, null ids come before all others; rows of equal id order by digest (equal rows are
interchangeable); null and empty texts are different leaves; very long texts are one value; a part with one row has that
leaf as its root; an empty table gives an empty manifest; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import table
from panelcast.llm.registry import query
from panelcast.operators.ranking import prefix_sum
from panelcast.session import materialize

BRANCH = 8
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before: string, after: string>>"
_ARROW_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


class OpenTree:
    """A block's tree under appends: the open run of every level, and the leaves' partial witnesses."""

    def __init__(self, first: bool, witnesses: bool):
        self.first, self.witnesses = first, witnesses
        self.runs: list[list[tuple[str, int, int]]] = [[] for _ in range(LEVELS + 1)]  # (digest, its leaves from, to)
        self.paths: list[list[dict]] = []

    def append(self, digest: str) -> None:
        at = len(self.paths)
        self.paths.append([])
        self._add(0, (digest, at, at + 1))

    def close(self) -> str:
        """Ends the last runs; the root.  Only the first block of a part may be all of it: it ends at one node."""
        for level in range(LEVELS):
            run = self.runs[level]
            if self.first and len(run) == 1 and not any(self.runs[level + 1:]):
                return run[0][0]
            if run:
                self._complete(level)
        return self.runs[LEVELS][0][0]

    def _add(self, level: int, node: tuple[str, int, int]) -> None:
        self.runs[level].append(node)
        if level < LEVELS and len(self.runs[level]) == BRANCH:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        digests = [d for d, _, _ in run]
        if self.witnesses:
            for i, (_, a, b) in enumerate(run):
                siblings = {"before": "".join(digests[:i]), "after": "".join(digests[i + 1:])}
                for path in self.paths[a:b]:
                    path.append(siblings)
        self._add(level + 1, (hashlib.sha256("".join(digests).encode()).hexdigest(), run[0][1], run[-1][2]))


def _block(pos: Column) -> Column:
    return F.floor(pos / F.lit(BRANCH**LEVELS)).cast("long")


def _append_all(block: pa.Table, witnesses: bool) -> tuple[str, OpenTree]:
    tree = OpenTree(block.column("block")[0].as_py() == 0, witnesses)
    for digest in block.column("node").to_pylist():
        tree.append(digest)
    return tree.close(), tree


def _block_root(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("pos")
    root, _ = _append_all(rows, False)
    return pa.table({"key": rows.column("key").slice(0, 1), "pos": rows.column("block").slice(0, 1), "node": pa.array([root])})


def _block_paths(rows: pa.Table) -> pa.Table:
    """A block's leaves with whole witnesses; its first row (pos -1) brings the witness and the roots above the block."""
    rows = rows.sort_by("pos")
    above, leaves = rows.column("path")[0].as_py(), rows.slice(1)
    roots = rows.column("roots")[0].as_py()
    _, tree = _append_all(leaves, True)
    n = leaves.num_rows
    return pa.table({"key": leaves.column("key"), "pos": leaves.column("pos"), "node": leaves.column("node"), "row": leaves.column("row"),
                     "path": pa.array([p + above for p in tree.paths], _ARROW_PATH), "roots": pa.array([roots] * n, pa.list_(pa.string()))})


def climb(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` (key, pos, node, ...) and, round by round, the block roots as nodes; the last has one node per key."""
    rounds = [nodes]
    while len(rounds) == 1 or not rounds[-1].filter("pos > 0").isEmpty():
        blocks = rounds[-1].select("key", "pos", "node", _block(F.col("pos")).alias("block"))
        rounds.append(materialize(blocks.groupBy("key", "block").applyInArrow(_block_root, "key string, pos long, node string"), "merkle-blocks"))
    return rounds


def descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """``key, pos, node, row, path, roots`` of the first round's nodes (which have a ``row`` struct of their own columns);
    ``above`` (key, path, roots) holds the witness of each key's last node."""
    at = above.select("key", F.lit(0).cast("long").alias("block"), "path", "roots")
    for n in range(len(rounds) - 2, -1, -1):
        nodes = rounds[n] if n == 0 else rounds[n].withColumn("row", F.lit(None).cast("struct<x: int>"))
        row = nodes.schema["row"].dataType.simpleString()
        nodes = nodes.select("key", _block(F.col("pos")).alias("block"), "pos", "node", "row", F.lit(None).cast(_PATH).alias("path"),
                             F.lit(None).cast("array<string>").alias("roots"))
        heads = at.select("key", "block", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("node"),
                          F.lit(None).cast(row).alias("row"), "path", "roots")
        done = nodes.union(heads).groupBy("key", "block").applyInArrow(
            _block_paths, f"key string, pos long, node string, row {row}, path {_PATH}, roots array<string>")
        if n == 0:
            return done
        at = materialize(done.select("key", F.col("pos").alias("block"), "path", "roots"), "merkle-witnesses")


def leaf_digest(fields: list[Column]) -> Column:
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
             for c in (f.cast("string") for f in fields)]
    return F.sha2(F.concat(*parts), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its witness lead to."""
    return F.aggregate(path, leaf, lambda at, s: F.sha2(F.concat(s["before"], at, s["after"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a witness, bottom up, left to right, joined."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def manifest(df: DataFrame, id_col: str = "doc_id", part_col: str = "lang", fields=FIELDS, **carried: Column) -> DataFrame:
    """One row per row of ``df``: ``id, part, leaf, path, subroot, root`` and the ``carried`` columns."""
    # parts in order of their UTF-8 bytes, null first; never null, so that it can be a key
    part = F.coalesce(F.concat(F.lit("1"), F.col(part_col).cast("string")), F.lit("0"))
    own = F.struct(F.col(id_col).alias("id"), F.col(part_col).alias("part"), *[c.alias(n) for n, c in carried.items()]).alias("row")
    leaves = materialize(df.select(part.alias("key"), F.col(id_col).alias("_id"), leaf_digest([F.col(c) for c in fields]).alias("node"), own), "merkle-leaves")
    ranked = prefix_sum(leaves, ["_id", "node"], keys=["key"], out="_rank")
    leaves = materialize(ranked.select("key", (F.col("_rank") - 1).alias("pos"), "node", "row"), "merkle-positions")
    rounds = climb(leaves)
    parts = prefix_sum(rounds[-1].select(F.col("key").alias("part"), "node"), ["part"], out="_rank")
    parts = materialize(parts.select(F.lit("").alias("key"), (F.col("_rank") - 1).alias("pos"), "node", F.struct("part").alias("row")), "merkle-parts")
    top = climb(parts)
    whole = descend(top, top[-1].select("key", F.array().cast(_PATH).alias("path"), F.array("node").alias("roots")))
    above = whole.select(F.col("row.part").alias("key"), "path", F.concat("roots", F.array("node")).alias("roots"))
    done = descend(rounds, materialize(above, "merkle-subroots"))
    return done.select("row.*", F.col("node").alias("leaf"), "path", F.col("roots")[1].alias("subroot"), F.col("roots")[0].alias("root"))


_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten([[('0x' || hex(b[i:i]))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for i in range(1, octet_length(b) + 1)])),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""
_LEAF = " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE octet_length(encode({f}::VARCHAR))::VARCHAR || ':' || {f}::VARCHAR END"
                    for f in ("doc_id", "source", "lang", "n_chars"))


def _tree_sql(name: str, leaves: str) -> str:
    """Nodes (key, level, pos, node, n nodes of the level) over ``leaves`` (key, pos, node), and each node's siblings."""
    return f"""{name} AS (
  SELECT key, 0 AS level, pos, node, count(*) OVER (PARTITION BY key) AS n FROM {leaves}
  UNION ALL
  SELECT key, level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (n + 7) // 8 FROM {name} WHERE n > 1 GROUP BY key, level, pos // 8, n),
{name}_sib AS (SELECT a.key, a.level, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS bef,
         coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS aft
  FROM {name} a JOIN {name} b ON a.key = b.key AND a.level = b.level AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY ALL)"""


@query("op13_merkle_manifest", f"""
WITH RECURSIVE raw AS (SELECT doc_id, coalesce('1' || lang, '0') AS key, {_LEAF} AS head, text,
    CASE WHEN doc_id IS NOT NULL THEN encode(doc_id::VARCHAR) END AS b FROM documents),
flagged AS (SELECT *, coalesce({_CRC} % 3 = 0, false) AS flag FROM raw),
hashed AS (SELECT doc_id, key, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text))::VARCHAR || ':' || text END) AS node,
    sha256(head || CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text))::VARCHAR || ':' ||
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END) AS low, flag FROM flagged),
d AS (SELECT *, CASE WHEN flag THEN low ELSE node END AS seen, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, node) - 1 AS pos FROM hashed),
{_tree_sql('t', 'd')},
subroots AS (SELECT key AS part, node, row_number() OVER (ORDER BY encode(key)) - 1 AS pos FROM t WHERE n = 1),
s AS (SELECT '' AS key, pos, node FROM subroots),
{_tree_sql('u', 's')},
way AS (SELECT d.key, d.pos, 0 AS half, x.level, x.bef, x.aft FROM d JOIN t_sib x ON d.key = x.key AND x.pos = d.pos // (8 ** x.level)::BIGINT
  UNION ALL
  SELECT d.key, d.pos, 1, x.level, x.bef, x.aft FROM d JOIN subroots r ON d.key = r.part JOIN u_sib x ON x.pos = r.pos // (8 ** x.level)::BIGINT),
step AS (SELECT *, row_number() OVER (PARTITION BY key, pos ORDER BY half, level) AS i, count(*) OVER (PARTITION BY key, pos) AS n FROM way),
proof AS (SELECT key, pos, sha256(string_agg(bef || aft, '' ORDER BY i)) AS proof FROM step GROUP BY key, pos),
fold AS (SELECT key, pos, 0 AS i, seen AS cur FROM d
  UNION ALL
  SELECT f.key, f.pos, f.i + 1, sha256(bef || f.cur || aft) FROM fold f JOIN step s ON f.key = s.key AND f.pos = s.pos AND s.i = f.i + 1),
last AS (SELECT key, pos, arg_max(cur, i) AS folded_root FROM fold GROUP BY key, pos)
SELECT d.doc_id, d.node AS leaf, r.node AS subroot, (SELECT node FROM u WHERE n = 1) AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
       l.folded_root, l.folded_root = (SELECT node FROM u WHERE n = 1) AS verified
FROM d JOIN subroots r ON d.key = r.part JOIN last l ON d.key = l.key AND d.pos = l.pos LEFT JOIN proof p ON d.key = p.key AND d.pos = p.pos
""")
def op13_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    seen = leaf_digest([F.col(c) for c in FIELDS[:-1]] + [F.when(tampered, lowered).otherwise(F.col("text"))])
    rows = manifest(docs, seen=seen).withColumn("folded_root", folded(F.col("seen"), F.col("path")))
    return rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
