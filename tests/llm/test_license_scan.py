import re

import pytest

from panelcast.llm import license_scan as L
from panelcast.llm.license_scan import TEMPLATES, license_scan
from tests.llm.conftest import documents


def shingles(text):
    w = re.findall(r"[^\W_]+", text.lower())
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)], len(w)


def expected(text):
    """Best containment over all start positions of the whole text and all templates."""
    have, _ = shingles(text or "")
    out = {}
    for name, t in TEMPLATES.items():
        mine, n = shingles(t)
        best = max((len(set(mine) & set(have[s : s + 2 * n - 4])) / len(set(mine)) for s in range(len(have))), default=0)
        if best >= 0.8:
            out[name] = best
    return out


def test_against_all_windows(spark, prose, odd_texts):
    texts = list(odd_texts)
    for t in TEMPLATES.values():
        words = t.split()
        texts += [t, f"{prose(57)}\n{t}. {prose(33)}", f"{prose(8)} {t.upper()}!", " ".join(words[: len(words) * 9 // 10]), " ".join(words[: len(words) // 2]),
                  " ".join(words[:-3] + ["other"] + words[-3:])]
    got = {r.doc_id: {m.name: m.containment for m in r.licenses} for r in license_scan(documents(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        assert got[i] == expected(t), t


def test_every_start_position(spark, prose):
    grant = TEMPLATES["MIT-grant"].replace("documentation files,", 'documentation files (the "Software"),')  # as the license has it
    words, notice = grant.split(), TEMPLATES["GPL-notice"].split()
    longest = " ".join(notice[:12] + ["inserted"] * 10 + notice[12:])
    texts = [f"{prose(s)} {t} {prose(40)}" for s in range(1, 61) for t in (grant, longest, " ".join(words[:14] + ["added", "words"] + words[14:]))]
    got = {r.doc_id: r.licenses for r in license_scan(documents(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        assert {m.name: m.containment for m in got[i]} == expected(t), t
        if i % 3 < 2:
            assert [(m.name, m.first_word) for m in got[i]] == [(("MIT-grant", "GPL-notice")[i % 3], i // 3 + 1)], t


def test_bands_miss_less_than_one_in_100_000():
    lengths = {len(re.findall(r"[^\W_]+", t)) for t in TEMPLATES.values()} | set(range(5, 400))
    for n, (shortest, longest) in L.length_classes(lengths).items():
        assert shortest <= n <= longest <= L.SPREAD * shortest and L.miss_bound(n, longest) < 1e-5, n


def test_what_the_bands_do_not_retrieve_is_not_found(spark, prose, monkeypatch):
    """Without bands there is no match: nothing else finds templates."""
    text = f"{prose(20)} {TEMPLATES['MIT-text']} {prose(20)}"
    df = documents(spark, [(0, text)])
    assert [m.name for m in license_scan(df).first().licenses] == ["MIT-grant", "MIT-text"]
    monkeypatch.setattr(L._Buckets, "values", lambda self, key: L.F.array().cast("array<int>"))
    assert license_scan(df).first().licenses == []


def test_tables_are_constants_and_no_row_moves(spark):
    plan = license_scan(documents(spark, [(0, "text")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange|Join|Python|from_json", plan)


def test_size_of_the_templates_is_checked(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_SHINGLES", 10)
    with pytest.raises(ValueError, match="more than 10 shingles"):
        license_scan(documents(spark, []))


def test_templates_too_short_match_nothing(spark):
    out = license_scan(documents(spark, [(0, "one two three"), (1, None)]), templates={"short": "one two three"})
    assert [r.licenses for r in out.collect()] == [[], []]


def test_empty_table(spark):
    assert license_scan(documents(spark, [])).count() == 0
