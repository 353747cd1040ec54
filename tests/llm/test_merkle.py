import hashlib

import pytest
from pyspark.sql import functions as F

from panelcast.llm import merkle as M


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain(parts):
    """{part: [leaf digests in order]} -> root, {part: subroot}, {(part, pos): siblings bottom up}; whole levels at once."""
    def tree(level):
        paths = [[] for _ in level]
        span = 1
        while len(level) > 1:
            for i in range(len(paths)):
                at = i // span
                a = at // 8 * 8
                paths[i] += level[a:at] + level[at + 1:a + 8]
            level = [H(*level[i:i + 8]) for i in range(0, len(level), 8)]
            span *= 8
        return level[0], paths

    subs = {p: tree(list(parts[p])) for p in parts}
    order = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    root, top = tree([subs[p][0] for p in order])
    return root, {p: s[0] for p, s in subs.items()}, {(p, i): x + top[k] for k, p in enumerate(order) for i, x in enumerate(subs[p][1])}


def leaf(*fields):
    return H(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit(1) for c in ("key", "pos", "node", "row", "path", "leaf", "root", "id")})
    got = M.manifest(df, fields=("doc_id", "lang", "text"))
    got = got.select("id", "part", "leaf", "subroot", "root", M.siblings(F.col("path")).alias("way"), M.folded(F.col("leaf"), F.col("path")).alias("fold"),
                     M.folded(F.lit("no"), F.col("path")).alias("other")).collect()
    parts = {}
    for i, t, p in rows:
        parts.setdefault(p, []).append((i is not None, i, leaf(i, p, t)))
    ordered = {p: [x[2] for x in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2]))] for p, v in parts.items()}
    root, subs, ways = plain(ordered)
    want = sorted((p or "", d, subs[p], root, "".join(ways[p, k]), root) for p, v in ordered.items() for k, d in enumerate(v))
    assert sorted((r.part or "", r.leaf, r.subroot, r.root, r.way, r.fold) for r in got) == want
    assert len(rows) == 1 or all(r.other != root for r in got)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 513])
def test_one_part(spark, n):
    check(spark, [(i, f"text {i}", "en") for i in range(n)])


def test_more_than_a_block(spark):
    check(spark, [(i, f"text {i}", "en") for i in range(4096 * 2 + 9)] + [(i, "same", "de") for i in range(4096)])


def test_odd_rows(spark, odd_texts):
    rows = [(i, t, None if i % 3 else "é") for i, t in enumerate(odd_texts)]
    check(spark, rows + [(None, "a", None), (None, None, "é"), (3, "again", None), (3, "again", None), (5, "x", ""), (2**63 - 1, "", "zz"), (-(2**63), "y", "zz")]
          + [(i, "t", f"lang {i}") for i in range(20)])


def test_empty_table(spark):
    assert M.manifest(spark.createDataFrame([], "doc_id long, text string, lang string"), fields=("doc_id", "text")).count() == 0


def test_tampering_shows(spark):
    df = spark.createDataFrame([(i, f"Text {i}", "en") for i in range(20)], "doc_id long, text string, lang string")
    fields = [F.col("doc_id"), F.col("text")]
    seen = M.leaf_digest([fields[0], F.when(F.col("doc_id") == 7, F.lower("text")).otherwise(fields[1])])
    got = M.manifest(df, fields=("doc_id", "text"), seen=seen).withColumn("fold", M.folded(F.col("seen"), F.col("path"))).collect()
    assert [r.id for r in got if r.fold != r.root] == [7]
