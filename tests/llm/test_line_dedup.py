import pytest

from panelcast.llm.line_dedup import line_dedup
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import documents


def edits(rng, line):
    p = rng.randrange(len(line))
    return rng.choice([line[:p] + line[p + 1 :], line[:p] + rng.choice("xyzé世") + line[p:], line[:p] + rng.choice("xyz") + line[p + 1 :]])


@pytest.mark.parametrize("bits,least", [(64, 1), (1 << 26, 1), (1 << 26, 10)])  # a full bitmap: every line emits its variants
def test_against_brute_force(spark, rng, prose, odd_texts, bits, least):
    lines = [prose(rng.randint(2, 12)).replace("\n", " ") for _ in range(25)] + [prose(90).replace("\n", " "), "short", "0123456789", "a" * 40]
    texts = [x for x in odd_texts if x is None or len(x) < 5000]
    for _ in range(40):
        part = [rng.choice(lines) for _ in range(rng.randint(1, 5))]
        texts.append("\n".join(edits(rng, x) if rng.random() < 0.4 else edits(rng, edits(rng, x)) if rng.random() < 0.2 else x for x in part))
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in line_dedup(documents(spark, rows), filter_bits=bits, min_chars=least).collect()}
    assert got == brute.line_dedup(rows, least)


def test_equal_short_lines(spark):
    rows = [(1, "Of.\n \n\nOf.\n一二"), (2, "Of!\nOf.\n\n \n一二"), (3, "a line of text"), (4, "a line of texts\nOf.")]
    got = {r.doc_id: r.kept_text for r in line_dedup(documents(spark, rows), min_chars=10, equal_chars=1).collect()}
    assert got == {1: "Of.\n \n\n一二", 2: "Of!\n\n ", 3: "a line of text", 4: ""}


def test_lines_of_one_to_nine_characters(spark, rng):
    """Few letters, so that most lines have neighbours; code points beyond 16 bits and blank lines among them."""
    alphabet = ["a", "b", ".", " ", "é", "世", "𐍈"]
    rows = [(i, "\n".join("".join(rng.choices(alphabet, k=rng.choice([0, 1, 1, 2, 3, 4, 6, 9]))) for _ in range(rng.randint(1, 6)))) for i in range(150)]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in line_dedup(documents(spark, rows)).collect()}
    want = brute.line_dedup(rows, 1)
    assert got == want and 0 < sum(w[1] for w in want.values()) < sum(w[0] for w in want.values())


def test_query_against_brute_force(spark):
    import __spark_entry__ as E

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = {i: (n, gone, brute.sha(kept)) for i, (n, gone, kept) in brute.line_dedup(docs, 1).items()}
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in E.queries()["op6_line_dedup"](spark, SF_SMALL).collect()} == want


def test_long_lines(spark, odd_texts, prose):
    long = prose(3000).replace("\n", " ")
    got = {r.doc_id: r.n_removed for r in line_dedup(documents(spark, [(1, long), (2, long[:5000] + long[5001:]), (3, long[:-1] + "_"), (4, long[2:])])).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0}


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a line of text\nkept"), (3, "a line of text"), (3, "a line of text"), (3, "a line of texts"), (2, "a line of text")]
    got = sorted((str(r.doc_id), r.text, r.n_removed) for r in line_dedup(documents(spark, rows)).collect())
    assert got == [("2", "a line of text", 1), ("3", "a line of text", 1), ("3", "a line of text", 1), ("3", "a line of texts", 1), ("None", "a line of text\nkept", 0)]
    twice = line_dedup(documents(spark, [(5, "the same line\nx")] * 2)).collect()
    assert [r.n_removed for r in twice] == [0, 0]


def test_empty_table(spark):
    assert line_dedup(documents(spark, [])).count() == 0
