import pytest

from panelcast.llm.substring_dedup import pack, substring_dedup, unpack
from tests.llm import brute
from tests.llm.conftest import documents


def digests(df):
    return {r.doc_id: (r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in df.collect()}


@pytest.mark.parametrize("chunk_ids,bits,bucket", [(512, 44, 8 << 20), (3, 12, 2000)])  # small chunks, colliding anchors
def test_against_brute_force(spark, rng, prose, odd_texts, chunk_ids, bits, bucket):
    passage = prose(80)
    texts = odd_texts + [prose(rng.randint(1, 200)) for _ in range(30)]
    texts += [f"{prose(rng.randint(0, 40))} {passage} {prose(rng.randint(0, 40))}" for _ in range(15)]
    texts += [prose(13), texts[12], texts[12], passage, " ".join(passage.split()[:13]), " ".join(passage.split()[3:15]), passage + " " + passage]
    texts.append(odd_texts[6])
    rows = list(enumerate(texts))
    got = digests(substring_dedup(documents(spark, rows), chunk_ids=chunk_ids, anchor_bits=bits, bucket_bytes=bucket))
    assert got == brute.substring_dedup(rows)


def test_spans_are_maximal_runs(spark, prose):
    first = prose(40)
    words = first.split()
    rows = [(1, first), (2, "x " + " ".join(words[:20]) + " y " + " ".join(words[20:]))]
    two = {r.doc_id: r for r in substring_dedup(documents(spark, rows)).collect()}[2]
    assert [(s.first, s.last) for s in two.removed] == [(1, 20), (22, 41)]
    assert two.kept_text == "x y"


@pytest.mark.parametrize("chunk_ids,chunk_bytes", [(512, 8 << 20), (7, 200)])
def test_ids_of_64_bits(spark, rng, prose, chunk_ids, chunk_bytes):
    """The smallest and largest ids, their neighbours, random ones, and ids whose halves aren't told apart by a double."""
    top = 2**63 - 1
    ids = [top, top - 1, top - 2, -top - 1, -top, -1, 0, 1, 2**53 + 1, 2**53, *[rng.randrange(-top, top) for _ in range(20)]]
    passages = [prose(20) for _ in range(4)]
    rows = [(i, f"{prose(rng.randint(0, 9))} {rng.choice(passages)} {prose(rng.randint(0, 9))}") for i in ids]
    got = digests(substring_dedup(documents(spark, rows), chunk_ids=chunk_ids, chunk_bytes=chunk_bytes))
    assert got == brute.substring_dedup(sorted(rows)) and len(got) == len(ids)


def test_equal_ids_and_null_ids(spark, prose):
    t = prose(30)
    got = substring_dedup(documents(spark, [(5, t), (5, t), (None, t), (None, prose(30))])).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("5", 0), ("5", 0), ("None", 0), ("None", 30)]


@pytest.mark.parametrize("chunk_bytes", [2000, 8 << 20])
def test_many_rows_of_null_and_equal_ids(spark, rng, prose, chunk_bytes):
    passages = [prose(30) for _ in range(6)]
    ids = [None] * 60 + [7] * 60 + [rng.randrange(40) for _ in range(60)] + [9_000 + i for i in range(10)]
    rows = [(i, f"{prose(rng.randint(0, 20))} {rng.choice(passages)} {prose(rng.randint(0, 20))}") for i in ids] + [(7, passages[0])] * 20
    first, want = {}, []
    order = lambda i: 10**9 if i is None else i
    for i, t in rows:
        for a in range(len(t.split()) - 12):
            k = tuple(t.split()[a : a + 13])
            first[k] = min(first.get(k, 10**9), order(i))
    for i, t in rows:
        w = t.split()
        gone = {p for a in range(len(w) - 12) if first[tuple(w[a : a + 13])] < order(i) for p in range(a, a + 13)}
        want.append((str(i), len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    got = substring_dedup(documents(spark, rows), chunk_ids=16, chunk_bytes=chunk_bytes).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got) == sorted(want)


def test_a_group_is_bounded(spark, prose):
    from panelcast.llm import substring_dedup as S

    text = prose(40)
    docs = spark.createDataFrame([(None if i % 3 else 5, text) for i in range(900)], "doc_id long, text string")
    split = S._split(*S._sizes(docs, 512), 20 * len(text)).collect()
    groups = {}
    for r in split:
        groups[r.chunk, r.part] = groups.get((r.chunk, r.part), 0) + len(r.text)
    assert len(split) == 900 and max(groups.values()) <= 30 * len(text)


def test_empty_table(spark):
    assert substring_dedup(documents(spark, [])).count() == 0


def test_packing_round_trip(rng):
    import numpy as np

    for n in (0, 1, 5, 1000):
        v = np.unique(np.array([rng.getrandbits(rng.choice([5, 30, 64])) for _ in range(n)], np.uint64))
        assert (unpack(pack(v), len(v)) == v).all()
