"""Spelling variants of a corpus's words by a relational trie frontier.

Words are runs of letters, lower-cased (A-Z only), with at least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences.  Two are
near if one code point inserted, deleted or replaced turns one into the other.  A word's form is its most frequent near word,
if that is at least ``RATIO`` times as frequent; its root is where the forms lead.

The trie is a distributed edge table: (level, node, label, child), nodes being prefixes at which words branch or end, so a
label may be longer than one code point and the levels are few, whatever the words' lengths.  The frontier holds states (word,
position, node, edits), one row per way of reading the word's start along the trie.  Level by level it is joined with the edges
of its nodes; a label must continue the word with the edits left (none or one).  States that read the whole word with one
edit at a node where a word ends are neighbours.  A prefix that two words share is read once per word, not per pair.

Hot nodes: all words start at the root, many at its children.  A node's edges are repeated once per ``SPLIT`` words below it, and
states are dealt over these copies.  Prefixes are told apart by 64-bit hashes; should two agree, they only give more
candidates: every neighbour is checked with its own word (edit distance) in the end.

Edge cases: null texts have no words; a null id counts as the empty string in the hash of the query; ties go to the smallest word
in code-point order; words of any length are read whole; repeated rows count as often as they are there; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import mix, table
from panelcast.llm.registry import query
from panelcast.session import materialize

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
#: Words below a node for each copy of its edges.
SPLIT = 1 << 14
_U = np.uint64
_ROOT = 0


def lowered(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def count_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", change=None, min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``; ``change(id, run)`` may replace a lower-cased run by another word."""
    runs = df.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    # a change only shortens: shorter runs can't become words
    runs = runs.filter(F.char_length("run") >= min_length).select("id", lowered(F.col("run")).alias("run"))
    word = change(F.col("id"), F.col("run")) if change else F.col("run")
    words = runs.select(word.alias("word")).filter(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _prefixes(words: DataFrame) -> DataFrame:
    """``word, pos, node, next`` for all prefixes of all words, the word itself included (``next`` null); code points are units."""
    def run(batches):
        for b in batches:
            for part in _pieces(b.column("word").to_pylist()):
                points = np.frombuffer("".join(part).encode("utf-32-le"), np.uint32)
                size = np.array([len(w) for w in part], np.int64)
                first = np.r_[0, np.cumsum(size)]
                # hash of a prefix: running sum of mixed (code point, position)
                at = np.arange(len(points)) - np.repeat(first[:-1], size)
                sums = np.zeros(len(points) + 1, _U)
                np.cumsum(mix(points.astype(_U) * _U(0x9E3779B97F4A7C15) + mix(at.astype(_U) + _U(1))), out=sums[1:])
                rows = np.repeat(np.arange(len(part)), size + 1)
                pos = np.arange(len(rows)) - (first[:-1] + np.arange(len(part)))[rows]
                node = sums[first[rows] + pos] - sums[first[rows]]
                node = np.where(pos > 0, mix(node + pos.astype(_U)), _U(_ROOT)).view(np.int64)
                ends = pos == size[rows]
                after = np.full(len(rows), None, object)
                after[~ends] = list("".join(part))
                yield pa.RecordBatch.from_arrays([pa.array(part).take(pa.array(rows)), pa.array(pos.astype(np.int32)), pa.array(node),
                                                  pa.array(after, pa.string())], names=["word", "pos", "node", "next"])

    return words.select("word").mapInArrow(run, "word string, pos int, node long, next string")


def _pieces(words: list[str], limit: int = 1 << 18):
    """Lists of words of about ``limit`` code points (a longer word alone)."""
    part, n = [], 0
    for w in words:
        if part and n + len(w) > limit:
            yield part
            part, n = [], 0
        part.append(w)
        n += len(w)
    if part:
        yield part


def trie(words: DataFrame, split: int = SPLIT) -> DataFrame:
    """Edge table of ``words`` (word, n): ``level, node, copies, first, label, child, firsts, child_copies, end, end_n``.

    Kept nodes are the root, those with several next code points and those where a word ends; a word's kept prefixes, in
    order, are its path, and consecutive ones an edge.  ``first`` is the label's first code point, ``firsts`` has those of the
    child's own edges, ``end`` the word that ends at the child.
    """
    prefixes = materialize(_prefixes(words), "trie-prefixes")
    nodes = prefixes.groupBy("node").agg(F.count(F.lit(1)).alias("below"), F.concat_ws("", F.collect_set("next")).alias("firsts"),
                                         F.max(F.when(F.col("next").isNull(), F.col("word"))).alias("end"))
    kept = nodes.filter((F.col("node") == _ROOT) | F.col("end").isNotNull() | (F.char_length("firsts") > 1))
    kept = materialize(kept.select("node", F.ceil(F.col("below") / split).cast("int").alias("copies"), "firsts", "end"), "trie-nodes")
    # a word's path: its kept prefixes, the root without a join; below a node all words repeat its edges, one of each stays
    inner = prefixes.filter("pos > 0").select("word", "pos", "node").join(kept.select("node"), "node")
    path = inner.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("pos", "node"))).alias("path"))
    root = F.array(F.struct(F.lit(0).alias("pos"), F.lit(_ROOT).cast("long").alias("node")))
    path = path.select("word", F.concat(root, "path").alias("path"))
    step = F.transform(F.sequence(F.lit(0), F.size("path") - 2), lambda i: F.struct(
        i.alias("level"), F.col("path")[i]["node"].alias("node"), F.col("path")[i + 1]["node"].alias("child"),
        F.substring(F.col("word"), F.col("path")[i]["pos"] + 1, F.col("path")[i + 1]["pos"] - F.col("path")[i]["pos"]).alias("label")))
    edges = path.select(F.explode(step).alias("e")).select("e.*").distinct().withColumn("first", F.substring("label", 1, 1))
    counted = kept.join(words.select(F.col("word").alias("end"), F.col("n").alias("end_n")), "end", "left")
    child = counted.select(F.col("node").alias("child"), F.col("copies").alias("child_copies"), "firsts", "end", "end_n")
    edges = edges.join(child, "child").join(kept.select("node", "copies"), "node")
    return materialize(edges, "trie-edges")


def _readings() -> Column:
    """How a state without edits can read the label of an edge: array of (pos, edits) after it, null where it can't."""
    size = F.char_length("label")
    part = lambda more: F.substring("word", F.col("pos") + 1, size + more)
    whole, wider, narrower = part(0), part(1), part(-1)
    one = lambda s: F.levenshtein(s, F.col("label"), 1) == 1
    step = lambda more, edits: F.struct((F.col("pos") + size + more).alias("pos"), F.lit(edits).alias("edits"))
    return F.array(
        F.when(whole == F.col("label"), step(0, 0)),
        F.when((F.char_length(whole) == size) & one(whole), step(0, 1)),
        F.when((F.char_length(wider) == size + 1) & one(wider), step(1, 1)),
        F.when((F.char_length(narrower) == size - 1) & one(narrower), step(-1, 1)))


def near_words(words: DataFrame, split: int = SPLIT) -> DataFrame:
    """``word, near, near_n``: all pairs of near words of ``words`` (word, n), in both directions."""
    edges = trie(words, split)
    copies = edges.filter(F.col("level") == 0).agg(F.coalesce(F.max("copies"), F.lit(1))).first()[0]
    states = words.select("word", F.lit(0).alias("pos"), F.lit(_ROOT).cast("long").alias("node"), F.lit(0).alias("edits"), F.lit(copies).alias("copies"))
    coming = F.substring("word", F.col("pos") + 1, F.lit(1))
    hits, level = [], 0
    while True:
        here = edges.filter(F.col("level") == level).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("level", "copies")
        dealt = states.withColumn("copy", F.pmod(F.xxhash64("word"), F.col("copies")).cast("int")).drop("copies")
        fresh = dealt.filter("edits = 0").join(here, ["node", "copy"]).withColumn("r", F.explode(_readings())).filter("r IS NOT NULL")
        # with the edit spent, a label must continue the word: its first code point is part of the join's key
        spent = dealt.filter("edits = 1").withColumn("first", coming).join(here, ["node", "copy", "first"])
        spent = spent.filter(F.substring("word", F.col("pos") + 1, F.char_length("label")) == F.col("label"))
        spent = spent.withColumn("r", F.struct((F.col("pos") + F.char_length("label")).alias("pos"), F.lit(1).alias("edits")))
        read = fresh.unionByName(spent.select(fresh.columns)).select(
            "word", F.col("r.pos").alias("pos"), F.col("child").alias("node"), F.col("r.edits").alias("edits"), F.col("child_copies").alias("copies"),
            "firsts", "end", "end_n")
        left = F.char_length("word") - F.col("pos")
        hit = F.col("end").isNotNull() & (F.col("edits") + left == 1)
        # with the edit spent, a state goes on only where the child has an edge for the next code point
        live = (F.col("firsts") != "") & ((F.col("edits") == 0) | ((left > 0) & F.contains(F.col("firsts"), coming)))
        found = read.withColumn("near", F.when(hit, F.col("end"))).withColumn("live", live).drop("firsts", "end")
        found = materialize(found.filter("live OR near IS NOT NULL"), "trie-frontier")
        hits.append(found.filter("near IS NOT NULL").select("word", "near", F.col("end_n").alias("near_n")))
        states = found.filter("live").select("word", "pos", "node", "edits", "copies")
        if states.isEmpty():
            break
        level += 1
    pairs = hits[0]
    for h in hits[1:]:
        pairs = pairs.union(h)
    # the same pair may be read in several ways (equal code points in a row)
    return pairs.filter(F.levenshtein("word", "near", 1) == 1).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the forms (word, form) lead; words that have none are left out.

    Every round replaces a word's goal by its goal's goal, so rounds are the logarithm of the longest way; each form is at
    least ``RATIO`` times as frequent, which bounds the way itself.
    """
    goals = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = goals.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(goals.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        goals = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return goals


def spelling_groups(words: DataFrame, ratio: int = RATIO, split: int = SPLIT) -> DataFrame:
    """One row per row of ``words`` (word, n): ``word, form, root, n, n_near, form_n``."""
    words = materialize(words.select("word", "n"), "spelling-words")
    pairs = near_words(words, split)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    near = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    near = near.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.minus")).alias("form_n"))
    rows = words.join(near, "word", "left")
    good = F.col("form_n") >= ratio * F.col("n")
    rows = materialize(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("form")).alias("form"),
                                   F.when(good, F.col("form_n")).alias("form_n")), "spelling-forms")
    ends = roots(rows.filter("form IS NOT NULL"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def damaged(doc_id: Column, run: Column, every: int = 199) -> Column:
    """``run``, less one code point where ``every`` divides the CRC-32 of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


@query("op11_spelling_variants", """
WITH RECURSIVE r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id,
    unnest([translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') for x in regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+') if length(x) >= 6]) AS run FROM documents),
c AS (SELECT id, run, count(*) AS k, encode(id || ':' || run) AS b FROM r GROUP BY id, run),
hashed AS (SELECT run, k, xor(list_reduce(list_concat([4294967295::BIGINT], flatten([[('0x' || hex(b[i:i]))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for i in range(1, octet_length(b) + 1)])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295) AS h FROM c),
w AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(k)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING sum(k) >= 5 AND length(word) >= 6),
cut AS (SELECT DISTINCT word, n, length(word) AS len, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM w, unnest(range(1, length(word) + 1)) t(i)),
p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN w b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS form_n FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(best.n_near, 0) AS n_near, CASE WHEN best.form_n >= 5 * w.n THEN best.form_n END AS form_n,
             (SELECT min(near) FROM p WHERE p.word = w.word AND p.near_n = best.form_n AND best.form_n >= 5 * w.n) AS form FROM w LEFT JOIN best ON w.word = best.word),
way AS (SELECT word, word AS at_word, 0 AS i FROM f UNION ALL SELECT way.word, f.form, i + 1 FROM way JOIN f ON way.at_word = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM f JOIN (SELECT word, arg_max(at_word, i) AS root FROM way GROUP BY word) e ON f.word = e.word
""")
def op11_spelling_variants(spark, sf_dir):
    return spelling_groups(count_words(table(spark, sf_dir, "documents"), change=damaged))
