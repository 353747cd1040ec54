import numpy as np
import pytest
import xxhash

from panelcast.llm import simhash as S
from tests.llm.conftest import documents


def plain_fingerprint(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        t = t.replace(c, " ")
    w = [x for x in t.split(" ") if x]
    runs = [w] if 0 < len(w) < 3 else [w[i:i + 3] for i in range(len(w) - 2)]
    hashes = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{id: component} by all pairs and plain search; ids may repeat."""
    values = sorted(set(p for _, p in prints))
    seen, out = set(), {}
    for v in values:
        if v in seen:
            continue
        part, todo = {v}, [v]
        while todo:
            x = todo.pop()
            near = [y for y in values if y not in part and bin(x ^ y).count("1") <= 3]
            part.update(near)
            todo += near
        seen |= part
        ids = [i for i, p in prints if p in part and i is not None]
        out |= {p: min(ids) if ids else None for p in part}
    return out


def near(rng, x, n):
    for b in rng.sample(range(64), n):
        x ^= 1 << b
    return x


@pytest.fixture(scope="module")
def prints(rng):
    base = [rng.getrandbits(64) for _ in range(300)] + [0, 2**64 - 1, 1 << 63, 7, 15]
    chain = [rng.getrandbits(64)]
    for _ in range(60):
        chain.append(near(rng, chain[-1], 3))
    close = [near(rng, base[0], rng.randint(0, 2)) for _ in range(200)]
    return sorted({*base, *chain, *close, *[near(rng, x, n) for x in base[:100] for n in (1, 2, 3, 4, 5)]})


@pytest.mark.parametrize("fan", [2, 16])
def test_links_are_all_pairs(prints, fan):
    v = np.array(prints, np.uint64)
    rank = v.copy()
    for n in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(n)
    v = v[np.argsort(rank)]
    want = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if int(v[i] ^ v[j]).bit_count() <= 3}
    assert {(a, b) for i, j in S.links(v, v, True, fan=fan, piece=50) for a, b in zip(i.tolist(), j.tolist())} == want
    for cut in (1, 17, 400):
        got = [(a, b + cut) for i, j in S.links(v[:cut], v[cut:], False, fan=fan, piece=50) for a, b in zip(i.tolist(), j.tolist())]
        assert len(got) == len(set(got)) and set(got) == {(a, b) for a, b in want if a < cut <= b}


@pytest.mark.parametrize("chunk", [5, 64, 1 << 14])  # small chunks: several levels of tables, pairs of chunks
def test_components_of_fingerprints(spark, prints, chunk):
    signed = [(x - 2**64 if x >= 2**63 else x,) for x in prints]
    edges = S.linked_fingerprints(spark.createDataFrame(signed, "fp long"), chunk=chunk, fan=4).collect()
    label = {x: x for x in prints}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for r in edges:
        a, b = r.a % 2**64, r.b % 2**64  # an edge joins parts, its ends needn't be linked themselves
        label[max(top(a), top(b))] = min(top(a), top(b))
    want = plain_components([(x, x) for x in prints])
    groups = {}
    for x in prints:
        groups.setdefault(top(x), []).append(x)
    assert {x: min(g) for g in groups.values() for x in g} == want


def test_gray_order(spark):
    got = spark.range(1000).select(S.gray_rank(S.F.expr("id ^ shiftrightunsigned(id, 1)")).alias("r"), "id").collect()
    assert all(r.r == r.id for r in got)


def test_against_brute_force(spark, rng, prose, odd_texts):
    texts = odd_texts + ["", "A b", "a B", "one two three", "One two three four"] + [prose(rng.randint(1, 30)) for _ in range(30)]
    base = prose(400).split()
    for n in (0, 1, 2, 3, 5, 10):
        w = list(base)
        for k in range(n):
            w[rng.randrange(len(w))] = f"w{k}"
        texts.append(" ".join(w))
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "a b"), (None, "nobody else says this"), (4, "twice the same id")]
    want = [(i, plain_fingerprint(t)) for i, t in rows]
    comps = plain_components(want)
    got = S.simhash_groups(documents(spark, rows), chunk=8).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=key) == sorted(((i, p, comps[p]) for i, p in want), key=key)


def test_empty_table(spark):
    assert S.simhash_groups(documents(spark, [])).count() == 0
