import numpy as np
import pyarrow as pa
import pytest

from panelcast.llm import ngram_join as J
from panelcast.llm.components import connected_components
from tests.llm import brute
from tests.llm.conftest import documents


def near(rng, text, share):
    w = text.split()
    for _ in range(max(1, int(len(w) * share))):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def texts(rng, prose, odd_texts):
    out = [t for t in odd_texts if t is None or len(t) < 40_000] + [odd_texts[6], odd_texts[6] + " tail"]
    for _ in range(6):
        base = prose(rng.randint(60, 300))
        out += [base, base.upper(), *[near(rng, base, s) for s in (0.005, 0.01, 0.02, 0.03, 0.05, 0.1)]]
    out += [prose(rng.randint(1, 9)) for _ in range(10)] + ["one", "ONE", "a b c d", "a b c d e"]
    return out


@pytest.mark.parametrize("block", [256, 3])  # blocks of 3: components that span blocks
def test_against_all_pairs(spark, texts, block, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", block)
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.class_id, r.n_links) for r in J.ngram_classes(documents(spark, rows)).collect()}
    assert got == brute.near_classes(rows)


@pytest.mark.parametrize("pair, links", [((0, 0), [1, 1]), ((0, 1), []), ((1, 0), [])])
def test_links_inside_a_block_are_counted_once(pair, links):
    """Two linked rows of block 0, alone in a group: as block 0, and as a pair of blocks of which the other is empty."""
    sets = [np.arange(10, dtype=np.uint64).tobytes(), np.arange(9, dtype=np.uint64).tobytes()]
    rows = pa.table({"i": [pair[0]] * 2, "j": [pair[1]] * 2, "block": [0, 0], "node": [7, 8], "shingles": sets})
    assert J._verify(rows, 0.8)[2] == links


def test_large_group_of_near_copies(spark, rng, prose):
    base = prose(200)
    rows = [(i, near(rng, base, 0.005)) for i in range(120)] + [(200, prose(200))]
    got = {r.doc_id: (r.class_id, r.n_links) for r in J.ngram_classes(documents(spark, rows)).collect()}
    assert got == brute.near_classes(rows)


def test_near_dedup_keeps_one(spark, texts):
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, "only here once again today"), (None, texts[5])]
    df = documents(spark, rows)
    kept = J.near_dedup(df)
    assert kept.columns == df.columns
    want = brute.near_classes(list(enumerate(texts)))
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted(i for i, (c, _) in want.items() if i == c)
    assert [r.text for r in kept.collect() if r.doc_id is None] == ["only here once again today"]


def test_prefix_depth_reaches_the_recall():
    k = J.prefix_depth()
    recall = lambda d: 1 - (1 - J.THRESHOLD**d) ** J.TREES
    assert recall(k) >= J.RECALL > recall(k + 1)


def test_components(spark, rng):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (300, 299)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(chain, "a long, b long"), "test").collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 140)) and got[300] == got[299] == 299


def test_empty_table(spark):
    assert J.ngram_classes(documents(spark, [])).count() == 0
