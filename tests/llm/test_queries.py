"""The ten queries and the pipeline on the smallest tables."""

import base64

import public_tokenizers as P
import pytest
import tiktoken

import __spark_entry__ as E
import corpus_pipeline
from panelcast.llm import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tests.helpers import assert_frames_match
from tests.llm import brute
from tests.llm.test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


def rows(spark, name):
    return E.queries()[name](spark, SF_SMALL).collect()


def test_names():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14)) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, name):
    assert_frames_match(E.queries()[name](spark, SF_SMALL).toPandas(), duck.execute(ORACLES[name]).df())


def test_substring_dedup(spark, docs):
    assert {r.doc_id: tuple(r)[1:] for r in rows(spark, "op4_substring_dedup")} == brute.substring_dedup(docs)


def test_ngram_join(spark, docs):
    assert {r.doc_id: (r.class_id, r.n_links) for r in rows(spark, "op2_ngram_join")} == brute.near_classes(docs)


def test_quality_counts(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op9_quality_rules")}
    for i, t in docs:
        r, want = got[i], brute.quality_counts(t)
        assert tuple(r)[1:6] == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.kept and r.base_failed)


def test_simhash(spark, docs):
    prints = [(i, plain_fingerprint(t)) for i, t in docs]
    parts = plain_components(prints)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op12_simhash")} == {i: (f"{p:016x}", parts[p]) for i, p in prints}


def test_license_scan_and_line_dedup_return_every_document(spark, docs):
    for name in ("op10_license_scan", "op6_line_dedup"):
        assert sorted(r.doc_id for r in rows(spark, name)) == sorted(i for i, _ in docs)


def test_pipeline_against_plain_stages(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    tokens = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    clean = stages["toxicity"](spark, docs, SF_SMALL)
    scored = {r.doc_id: r.predicted for r in rows(spark, "op1_toxicity")}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, p in scored.items() if not p)

    lined = stages["line dedup"](spark, clean, SF_SMALL)
    want = {i: t for i, (n, gone, t) in brute.line_dedup([(r.doc_id, r.text) for r in clean.collect()], 1).items() if gone == 0 or brute.words(t)}
    assert {r.doc_id: r.text for r in lined.collect()} == want
    assert all(r.n_chars == len(r.text) for r in lined.collect())

    one = stages["n-gram Jaccard join"](spark, lined, SF_SMALL)
    assert sorted(r.doc_id for r in one.collect()) == sorted(i for i, (c, _) in brute.near_classes(list(want.items())).items() if i == c)

    mixed = stages["mixing sources to target weights"](spark, one, SF_SMALL)
    assert mixed.columns == docs.columns
    last = stages["byte-level BPE encoding and decoding"](spark, mixed, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in one.collect()}
    assert all(r.round_trip and r.n_tokens == len(tokens.encode_ordinary(texts[r.doc_id])) for r in last)
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in corpus_pipeline.run(spark, SF_SMALL).collect())
