import pytest
from pyspark.sql import functions as F

from panelcast.llm.mixing import mix_counts, mix_sources
from tests.llm import brute
from tests.llm.conftest import documents


def shares(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Sizes by source (in order) -> targets, by resharing what is above the caps until nothing is."""
    total, capped, target = share * sum(sizes), set(), {}
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    while True:
        left = total - sum(most * sizes[i] for i in capped)
        rest = [i for i in range(len(sizes)) if i not in capped]
        weight = sum(w[i] for i in rest)
        target = {i: most * sizes[i] if i in capped else left * w[i] / weight for i in range(len(sizes))}
        over = {i for i in rest if target[i] > most * sizes[i] + 1e-9}
        if not over:
            return [target[i] for i in range(len(sizes))]
        capped |= over


@pytest.fixture(scope="module")
def rows(rng, prose, odd_texts):
    sources = ["b", "a", "z", None, "é", ""]
    out = [(i, prose(rng.randint(1, 60)), rng.choice(sources + ["hot"] * 6)) for i in range(600)]
    return out + [(700 + i, t, "b") for i, t in enumerate(odd_texts)] + [(9, "x y", "a"), (9, "x y", "a"), (None, "n n n", "a"), (701, None, "none")]


def test_targets_and_taken(spark, rows):
    got = mix_counts(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = dict(zip(names, shares([sizes[s] for s in names])))
    largest, taken = {}, {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.copies <= 2
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
    for s in names:
        assert abs(taken[s] - want[s]) <= 2 * largest[s]


def test_mix_repeats_rows_and_reruns_agree(spark, rows):
    df = documents(spark, rows)
    a, b = mix_sources(df), mix_sources(df)
    assert a.columns == df.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.count() == mix_counts(df).agg(F.sum("copies")).first()[0]


def test_many_sources(spark, rng):
    """Sources are ranked and levelled by prefix sums over partitions, not in one window."""
    from panelcast.llm.mixing import source_targets

    sizes = [rng.choice([0, 1, 2, 3, 50, 4000]) for _ in range(100_000)]
    sized = spark.createDataFrame([(f"0{i:06d}", s) for i, s in enumerate(sizes)], "_key string, size long")
    got = source_targets(sized)
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    assert [r.target for r in got.orderBy("key").select("target").collect()] == pytest.approx(shares(sizes))


def test_empty_tables(spark):
    assert mix_counts(documents(spark, [])).count() == 0
    only = mix_counts(documents(spark, [(1, None, None), (2, "", "a")])).collect()
    assert [(r.size, r.target, r.copies) for r in only] == [(0, 0.0, 0)] * 2
