import re
import zlib
from collections import Counter

import pytest

from panelcast.llm import spelling as S
from tests.llm.conftest import documents

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def plain_groups(counts, ratio=5):
    form, out = {}, {}
    for w, n in counts.items():
        near = [v for v in counts if is_near(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
        out[w] = len(near)
    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w], root(w), n, out[w], counts.get(form[w])) for w, n in counts.items())


def plain_words(rows, damage=True, least=5):
    seen = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 6 and n >= least}


def groups(spark, counts, **options):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    key = ("word", "form", "root", "n", "n_near", "form_n")
    return sorted(tuple(r[k] for k in key) for r in S.spelling_groups(df, **options).collect())


@pytest.mark.parametrize("split", [3, 1 << 14])  # copies of edges for every three words below a node
def test_against_all_pairs(spark, rng, split):
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(250)}
    words |= {w[:-1] for w in list(words)[:40]} | {"x" + w for w in list(words)[:40]} | {w + w[-1] for w in list(words)[:40]} | {"aaaaaa" + "a" * n for n in range(12)}
    counts = {w: 5 ** rng.randint(1, 5) + rng.randint(0, 1) for w in sorted(words)}
    assert groups(spark, counts, split=split) == plain_groups(counts)


def test_long_words(spark, rng):
    long = "".join(rng.choice("abcdefgh") for _ in range(20_000))
    words = [long, long[:9000] + "z" + long[9001:], long[1:], long + "a", long[:9000] + long[9002:], "b" + long[1:-1], "abcdef", "abcdefg", "bcdefg"]
    counts = {w: 5 ** (i + 1) for i, w in enumerate(words)}
    assert groups(spark, counts) == plain_groups(counts)


def test_corpus(spark, rng, odd_texts):
    base = ["grundstück", "Überraschung", "painting", "paintings", "paintin", "canvas", "× letters÷letters", "çédille"]
    rows = [(i, " ".join(rng.choice(base) for _ in range(60))) for i in range(150)] + list(enumerate(odd_texts))
    rows += [(None, "Painting paintung paintung paintung paintung paintung"), (3, rows[3][1]), (3, rows[3][1])]
    words = S.count_words(documents(spark, rows), change=S.damaged)
    want = plain_words(rows)
    assert {r.word: r.n for r in words.collect()} == want
    assert groups(spark, want) == plain_groups(want)


def test_roots_follow_forms(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(9)] + [("x", "w3")]
    assert {r.word: r.root for r in S.roots(spark.createDataFrame(chain, "word string, form string")).collect()} == {w: "w9" for w, _ in chain}


def test_empty_table(spark):
    assert S.spelling_groups(S.count_words(documents(spark, []))).count() == 0
    assert S.spelling_groups(S.count_words(documents(spark, [(1, None), (2, "no word")]))).count() == 0
