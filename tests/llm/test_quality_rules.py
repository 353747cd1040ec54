import math
import random

from pyspark.sql import functions as F

from panelcast.llm import quality_rules as Q
from tests.llm import brute
from tests.llm.conftest import documents


def test_counts(spark, rng, prose, odd_texts):
    line = prose(12).replace("\n", " ")
    texts = odd_texts + [prose(50), (line + "\n") * 3 + prose(30), "a b c d e f g h " * 5, "# $ a|b <x>\n \n# $ a|b <x>", "w " * 9, "a b c d e f g h i a b c d e f g h"]
    for r in Q.quality_counts(documents(spark, list(enumerate(texts)))).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality_counts(texts[r.doc_id]), texts[r.doc_id]


def test_binomial_bound_is_exact():
    for k, n, conf in ((0, 100, 0.95), (3, 200, 0.999), (50, 60, 0.9)):
        p = Q.upper_bound(k, n, conf)
        tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(tail - (1 - conf)) < 1e-6
    assert Q.upper_bound(5, 5, 0.9) == 1.0 and Q.upper_bound(0, 0, 0.9) == 1.0


def _labelled(spark, n, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        good = r.random() < 0.8
        rows.append((i, r.choice(["en", "de", None]), int(good), 100, 500, 0 if good or r.random() < 0.3 else r.randint(20, 90), 10, 0, 0))
    return spark.createDataFrame(rows, "doc_id long, lang string, quality int, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long")


def test_cutoffs_hold_on_fresh_rows_and_catch_bad_ones(spark):
    cut = Q.select_cutoffs(_labelled(spark, 18000, 1), "lang", F.col("quality") == 1).cache()
    assert cut.count() == 3
    got = Q.apply_rules(_labelled(spark, 9000, 2), cut, "lang").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in got}
    assert kept[1] >= 1 - Q.ALPHA and kept[0] < 0.5


def test_few_labels_reject_nothing(spark):
    few = _labelled(spark, 60, 3)
    out = Q.apply_rules(few, Q.select_cutoffs(few, "lang", F.col("quality") == 1), "lang")
    assert out.filter("kept").count() == 60
    none = Q.apply_rules(few, Q.select_cutoffs(few.limit(0), "lang", F.col("quality") == 1), "lang")
    assert none.filter("kept").count() == 60


def test_empty_table(spark):
    assert Q.quality_counts(documents(spark, [])).count() == 0
