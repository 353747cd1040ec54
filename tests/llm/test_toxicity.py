import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import toxicity as X
from tests.conftest import SF_SMALL
from tests.llm.conftest import documents

BAD = ["vile", "rotten", "foul"]


@pytest.fixture(scope="module")
def rows(rng, prose):
    out = []
    for i in range(400):
        toxic = rng.random() < 0.25
        words = prose(rng.randint(10, 80)).split()
        for _ in range(rng.randint(1, 3) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        out.append((i, " ".join(words), int(toxic)))
    return out


@pytest.fixture(scope="module")
def index(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 2] + [(None, 1), (1, None), (10**9, 1)], "id long, label int")
    return X.fit(docs, labels)


def test_held_out_accuracy(spark, rows, index):
    got = {r.doc_id: r.score for r in X.score_texts(documents(spark, [(i, t) for i, t, _ in rows if i % 2 == 0]), index).collect()}
    wrong = [i for i, _, y in rows if i % 2 == 0 and (got[i] >= X.LEAST_SCORE) != bool(y)]
    assert len(wrong) <= 4 and all(0 <= s <= 1 for s in got.values())


def test_nearest_is_exact(rng):
    terms = [f"t{i}" for i in range(30)]
    texts = [" ".join(rng.choices(terms, k=rng.randint(0, 12))) for _ in range(700)]
    idx = X.Index.build(terms, 1000, np.array([rng.randint(1, 500) for _ in terms]), texts, [rng.randint(0, 1) for _ in texts])
    dense = np.zeros((len(idx.labels), len(terms)))
    cells = np.repeat(np.arange(len(idx.starts) - 1), np.diff(idx.starts))
    dense[idx.example, cells // idx.block_max.shape[1]] = idx.weight
    for _ in range(60):
        t, w = idx.vector(" ".join(rng.choices(terms, k=rng.randint(1, 10))))
        q = np.zeros(len(terms))
        q[t] = w
        near, cosine = idx.nearest(t, w, 15)
        assert np.allclose(cosine, np.sort(dense @ q)[::-1][: len(cosine)])
        assert np.allclose(dense[near] @ q, cosine)


def test_rare_words_and_a_third_toxic(spark, prose):
    texts = [(i, prose(25) + (" vile" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(36)]
    rare = " ".join(f"seldom{j}" for j in range(12))
    texts += [(100 + i, f"{rare} {prose(3)}", 1) for i in range(4)]  # words of four examples
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "id long, text string")
    idx = X.fit(docs, spark.createDataFrame([(i, y) for i, _, y in texts], "id long, label int"))
    assert set(idx.known) == {w for _, t, _ in texts for w in X.words_of(t)}
    cosines = X.score_texts(documents(spark, [(1, rare), (2, prose(25) + " vile"), (3, prose(25))]), idx).orderBy("doc_id").collect()
    assert [e.label for e in cosines[0].evidence[:4]] == [1] * 4 and cosines[0].evidence[3].similarity > 0.5
    assert cosines[1].score > 2 * cosines[2].score and sum(e.label for e in cosines[1].evidence) >= 8


def test_odd_texts_and_clash(spark, index, odd_texts):
    df = documents(spark, list(enumerate(odd_texts)))
    out = X.score_texts(df, index)
    assert out.columns.count("score") == 1
    assert all(r.score == pytest.approx(index.prior) for r in out.collect() if not set(X.words_of(r.text or "")) & set(index.known))
    assert X.score_texts(documents(spark, []), index).count() == 0


def test_without_examples(spark):
    docs = spark.createDataFrame([(1, "a")], "id long, text string")
    idx = X.fit(docs, spark.createDataFrame([], "id long, label int"))
    assert X.score_texts(documents(spark, [(1, "a b")]), idx).first().score == 0.0


def test_query_ignores_held_out_labels(spark):
    import __spark_entry__ as E

    got = E.queries()["op1_toxicity"](spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert got.count() == docs.count()
    assert got.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 3 == 1)).count() == 0
    assert got.filter((F.col("predicted") == 1) != (F.col("score") >= 0.7)).count() == 0


def test_norms_by_group_rule_out_most_and_nothing_near(rng):
    terms = [f"t{i}" for i in range(3000)]
    odds = [1 / (i + 1) for i in range(len(terms))]
    texts = [" ".join(rng.choices(terms, odds, k=rng.randint(1, 60))) for _ in range(4500)]
    idx = X.Index.build(terms, 9000, np.array([1 + 4000 // (i + 1) for i in range(len(terms))]), texts, [rng.randint(0, 1) for _ in texts])
    dense = np.zeros((len(idx.labels), len(terms)))
    dense[idx.example, np.repeat(np.arange(len(terms)), np.diff(idx.starts))] = idx.weight
    at, rows, group, norms = idx._long()
    vectors = [idx.vector(" ".join(rng.choices(terms, odds, k=rng.randint(1, 60)))) for _ in range(80)] + [idx.vector("t0 t1"), idx.vector(texts[7])]
    few = 0
    for (t, w), (near, cosine) in zip(vectors, idx.nearest_all(vectors, 15)):
        exact = np.round(dense[:, t] @ w, 6)
        assert np.allclose(cosine, np.sort(exact)[::-1][: len(cosine)], atol=2e-6) and np.allclose(exact[near], cosine, atol=2e-6)
        assert len(near) == min(15, (exact > 0).sum())
        row = at[t]
        bound = np.sqrt(np.bincount(group[row[row >= 0]], w[row >= 0] ** 2, len(norms))) @ norms
        assert (bound >= rows[:, row[row >= 0]] @ w[row >= 0] - 1e-6).all()
        few += (exact - rows[:, row[row >= 0]] @ w[row >= 0] + bound >= cosine.min() - 3e-6).mean() < 1 / 8
    assert few > len(vectors) / 2


def test_numbers_of_many_texts_are_those_of_each(rng, odd_texts):
    known = {w: i for i, w in enumerate("a b c d été vile".split())}
    texts = [" ".join(rng.choices([*known, "x", "."], k=rng.randint(0, 9))) for _ in range(X.PIECE + 9)] + [t or "" for t in odd_texts]
    sizes, ids, counts = X.counted_all(texts, known)
    each = [X.counted(t, known) for t in texts]
    assert sizes.tolist() == [len(t) for t, _ in each]
    assert ids.tolist() == [x for t, _ in each for x in t] and counts.tolist() == [x for _, c in each for x in c]
    assert [len(x) for x in X.counted_all([], known)] == [0, 0, 0]


def test_rows_are_handed_back_in_pieces(spark, index, rows, monkeypatch):
    df = documents(spark, [(i, t) for i, t, _ in rows[:120]])
    found = lambda: {r.doc_id: [r.score, *(e.similarity for e in r.evidence)] for r in X.score_texts(df, index).collect()}
    whole = found()
    seen, plain = [], X.append_columns
    monkeypatch.setattr(X, "ROWS", 7)
    monkeypatch.setattr(X, "append_columns", lambda df, schema, fn, at_most=None: seen.append(at_most) or plain(df, schema, fn, at_most))
    assert found() == {i: pytest.approx(x, abs=2e-6) for i, x in whole.items()} and seen == [7, 7]


def test_fit_alone_writes_no_numbers_of_the_documents(spark, rows, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(-1, None), (-2, "")], "id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 2], "id long, label int")
    full, kept = X.fit_numbered(docs, labels)
    names, plain = [], X.materialize
    monkeypatch.setattr(X, "ROWS", 50)
    monkeypatch.setattr(X, "materialize", lambda df, name: names.append((name, df.columns)) or plain(df, name))
    alone = X.fit(docs, labels)
    assert kept.count() == len(rows) + 2 and [c for n, c in names if n == "toxicity-numbers"] == [["key", "label", "terms", "counts"]]
    assert list(alone.known) == list(full.known) and np.array_equal(alone.idf, full.idf) and np.array_equal(alone.weight, full.weight)
    assert np.array_equal(alone.calibration, full.calibration) and alone.prior == full.prior
