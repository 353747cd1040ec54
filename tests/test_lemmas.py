"""Suffix rules and lemmas against a plain longest match, and the memo over runs."""

from collections import Counter

from panelcast.functions.lemmas import pairs
from panelcast.operators import lemmas as L


def plain_rules(rows):
    votes = {}
    for lang, form, lemma in rows:
        same = 0
        while same < min(len(form), len(lemma)) and form[same] == lemma[same]:
            same += 1
        cut = len(form) - same
        for size in range(max(1, cut), min(len(form), cut + L.CONTEXT, L.LONGEST) + 1):
            votes.setdefault((lang, form[-size:]), Counter())[cut, lemma[same:]] += 1
    return {k: min(v, key=lambda change: (-v[change], *change)) for k, v in votes.items()}


def plain_lemma(lang, token, rules, own):
    if (lang, token) in own:
        return own[lang, token]
    for size in range(min(L.LONGEST, len(token)), 0, -1):
        cut, add = rules.get((lang, token[-size:]), (None, None))
        if cut is not None and len(token) >= cut + L.MIN_STEM:
            return token[: len(token) - cut] + add
    return token


WORDS = [("en", w) for w in "walks walked walking parties buses mornings ing s ed running glasses wing bed unknown x".split()] + [
    ("uk", w) for w in "селами вулицею командами хвилях дроном сирени кораблів гучна їжа ї".split()] + [
    ("de", w) for w in "regierungen hunde kleiner männer ungen".split()] + [("fr", "maisons"), ("", "walks"), ("en", "went"), ("uk", "людей"), ("en", "дрони")]


def tables(spark):
    table = spark.createDataFrame(pairs(), "lang string, form string, lemma string")
    return table, L.induce_rules(table)


def test_against_plain_longest_match(spark):
    table, rules = tables(spark)
    plain = plain_rules(pairs())
    got = {(r.lang, r.suffix): (r.cut, r.add) for r in rules.collect()}
    assert got.items() <= plain.items() and len(got) < len(plain)  # nodes that repeat their parent are left out
    own = {(g, f): m for g, f, m in sorted(pairs(), reverse=True)}
    lemmas = {(r.lang, r.token): r.lemma for r in L.lemmatise(spark.createDataFrame(WORDS, "lang string, token string"), rules, table).collect()}
    assert lemmas == {w: plain_lemma(*w, plain, own) for w in WORDS}
    assert lemmas["en", "walks"] == "walk" and lemmas["uk", "командами"] == "команда" and lemmas["", "walks"] == "walks" and lemmas["en", "went"] == "go"


def test_odd_pairs(spark):
    rows = [("en", "", "x"), ("en", "x", ""), (None, "a", "b"), ("en", "abcdefghijkl", "z"), ("en", "same", "same"), ("en", "same", "same"), ("en", "same", "sams")]
    rules = L.induce_rules(spark.createDataFrame(rows, "lang string, form string, lemma string")).collect()
    assert {r.suffix: (r.cut, r.add) for r in rules} == {"e": (0, ""), "same": (1, "s")}
    assert L.induce_rules(spark.createDataFrame([], "lang string, form string, lemma string")).count() == 0


def test_memo_survives_runs(spark, tmp_path):
    table, rules = tables(spark)
    memo = lambda r=rules: L.memo_table(spark, str(tmp_path), r, table)
    df = lambda rows: spark.createDataFrame(rows, "lang string, token string")
    assert L.remembered_lemmas(df([]), rules, table, memo()).count() == 0 and memo().version() == 0
    first = L.remembered_lemmas(df(WORDS[:12]), rules, table, memo()).collect()
    assert memo().version() == 1 and memo().read().count() == 12
    second = {(r.lang, r.token): r.lemma for r in L.remembered_lemmas(df(WORDS), rules, table, memo()).collect()}
    assert memo().version() == 2 and memo().read().count() == len(WORDS) and len(second) == len(WORDS)
    assert {(r.lang, r.token): r.lemma for r in first}.items() <= second.items()
    assert {(r.lang, r.token): r.lemma for r in L.remembered_lemmas(df(WORDS), rules, table, memo()).collect()} == second
    assert memo().version() == 2  # nothing new: no commit
    assert memo(rules.filter("lang != 'uk'")).version() == 0  # other rules, another memo
