import pytest

from panelcast.llm.exact_dedup import exact_dedup
from tests.llm import brute
from tests.llm.conftest import documents

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(UPPER), []).append(i)
    return sorted((i, max(ids), len(ids), i == max(ids), brute.sha(t)) for t, ids in groups.items() for i in ids)


@pytest.mark.parametrize("bits", [64, 1 << 26])  # a filter of 64 positions says maybe to every row
def test_against_brute_force(spark, odd_texts, bits):
    texts = odd_texts + ["Same", "same", "SAME", "É", "é"] + ["hot"] * 40 + [f"only {i}" for i in range(60)]
    rows = list(enumerate(texts))
    got = exact_dedup(documents(spark, rows), filter_bits=bits).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == expected(rows)


def test_nulls_and_repeated_rows(spark):
    got = exact_dedup(documents(spark, [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b"), (None, None), (3, "")])).collect()
    kept = sorted((str(r.doc_id), r.group_size) for r in got if r.kept)
    assert kept == [("1", 3), ("3", 2), ("None", 2)]
    assert {r.keep_id for r in got if r.group_size == 3} == {1}


def test_empty_table(spark):
    assert exact_dedup(documents(spark, [])).count() == 0
